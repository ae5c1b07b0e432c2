import sys
from pathlib import Path

import pandas as pd
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rivermill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session(
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    yield s
    s.stop()


def plain(v):
    if pd.isna(v):
        return None
    return v.to_pydatetime() if hasattr(v, "to_pydatetime") else v.item() if hasattr(v, "item") else v


@pytest.fixture(scope="session")
def series(spark):
    """Frame of one site from a list of values, hourly by default."""

    def make(values, start="2026-01-01", freq="h", name="flow", site="a", **extra):
        ts = pd.date_range(start, periods=len(values), freq=freq)
        pdf = pd.DataFrame({"site": site, "ts": ts, name: pd.array(values, dtype="Float64"), **extra})
        rows = [tuple(plain(v) for v in r) for r in pdf.itertuples(index=False)]
        kinds = ", ".join(f"{c} {'STRING' if c == 'site' else 'TIMESTAMP' if c == 'ts' else 'INT' if c == 'point' else 'DOUBLE'}" for c in pdf.columns)
        return spark.createDataFrame(rows, kinds)

    return make


@pytest.fixture(scope="session")
def ordered():
    """Values of one column in time order."""

    def read(df, *columns):
        rows = df.orderBy("ts").select(*columns).collect()
        return [r[0] for r in rows] if len(columns) == 1 else [tuple(r) for r in rows]

    return read
