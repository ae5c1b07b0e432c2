import pytest

SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"
CLASH = ("size", "row", "shard", "slot", "bucket", "label", "id", "_text", "_tag", "_digest", "keep_id", "_turn", "_own", "_lent", "_to", "_gone", "gone", "g", "d", "words", "t")


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (doc_id, text) or longer tuples; `clash` adds columns called like results and helpers."""

    def make(rows, clash=False):
        full = [tuple(r) + (None,) * (5 - len(r)) for r in rows]
        if not clash:
            return spark.createDataFrame(full, SCHEMA)
        return spark.createDataFrame([r + ("x",) * len(CLASH) for r in full], SCHEMA + "".join(f", `{c}` STRING" for c in CLASH))

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Null and empty texts, a null id, blanks only, a very long text, ties and repeated rows."""
    long_text = "word " * 60_000 + "end"
    return [
        (1, None), (2, ""), (3, " \t\n"), (None, "a null id here"), (4, long_text), (5, "same text twice"), (6, "same text twice"),
        (6, "same text twice"), (7, "Ünïcödé 日本 😀 ▁ <|end|> \\ x"), (8, "same text twice "), (9, "1234 ### !!"),
    ]
