from pyspark.sql import functions as F

from rivermill.operators.prepare import closed_hours
from rivermill.streaming import flow as sf


def landed(spark, tmp_path, files):
    for i, rows in enumerate(files):
        df = spark.createDataFrame(rows, "station STRING, at STRING, flow DOUBLE").select("station", F.to_timestamp("at").alias("ts"), "flow")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    schema = "station STRING, ts TIMESTAMP, flow DOUBLE"
    return spark.readStream.schema(schema).parquet(str(tmp_path / "in")), spark.read.schema(schema).parquet(str(tmp_path / "in"))


ROWS = [("A", f"2026-01-01 0{h}:{m:02d}:00", float(h + m / 60)) for h in range(5) for m in (5, 35)] + [("B", "2026-01-01 00:20:00", 9.0)]


def test_closed_hours_equal_the_batch_rule(spark, tmp_path):
    stream, batch = landed(spark, tmp_path, [ROWS])
    out = sf.run_available(sf.closed_hour_means(stream, "0 seconds"), str(tmp_path / "out"), str(tmp_path / "chk"))
    nothing = batch.select("station", "ts").limit(0)
    a = closed_hours(batch.where("station = 'A'").withColumn("litres", F.col("flow") * 1000), nothing)
    got = {(r.ts, round(r.flow, 9)) for r in out.where("station = 'A'").collect()}
    assert got == {(r.ts, round(r.flow, 9)) for r in a.collect()} and len(got) == 4


def test_repeated_delivery_counts_once(spark, tmp_path):
    stream, _ = landed(spark, tmp_path, [ROWS, ROWS])
    out = sf.run_available(sf.without_repeats(stream, "6 hours"), str(tmp_path / "out"), str(tmp_path / "chk"))
    assert out.count() == len(ROWS)


def test_silence_is_reported_after_the_limit(spark, tmp_path):
    rows = [("A", "2026-01-01 00:00:00", 1.0), ("A", "2026-01-01 00:30:00", 1.0), ("B", "2026-01-01 00:00:00", 1.0), ("B", "2026-01-01 05:00:00", 1.0)]
    stream, _ = landed(spark, tmp_path, [rows])
    out = sf.run_available(sf.silences(stream, "2 hours", "0 seconds"), str(tmp_path / "out"), str(tmp_path / "chk")).collect()
    assert {(r.station, r.last_ts.hour, r.last_ts.minute) for r in out} == {("A", 0, 30), ("B", 0, 0)}


def test_upsert_is_idempotent(spark, tmp_path):
    store = str(tmp_path / "store")

    def batch(rows):
        return spark.createDataFrame(rows, "site STRING, at STRING, flow DOUBLE").select(
            "site", F.to_timestamp("at").alias("ts"), "flow", F.substring("at", 1, 10).alias("day"))

    first = batch([("a", "2026-01-01 00:00:00", 1.0), ("a", "2026-01-02 00:00:00", 2.0)])
    second = batch([("a", "2026-01-02 00:00:00", 7.0), ("a", "2026-01-02 01:00:00", 8.0)])
    sf.upsert_store(spark, store, first, ["site", "ts"])
    for _ in range(2):
        sf.upsert_store(spark, store, second, ["site", "ts"])
        assert [r.flow for r in spark.read.parquet(store).orderBy("ts").collect()] == [1.0, 7.0, 8.0]
    now = sf.features_now(spark.read.parquet(store), 1, spd=24).first()
    assert now.now_ts.hour == 1 and now.lag_1 == 7.0 and now.lag_2 is None
