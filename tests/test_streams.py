"""Streams against the same data as a table."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridloom.operators import masks
from gridloom.streaming import streams

SCHEMA = "px int, ts timestamp, value int"


@pytest.fixture
def files(spark, tmp_path):
    t0 = datetime(2024, 1, 1)
    rows = [(i % 3, t0 + timedelta(hours=5 * i), i * 7 % 50) for i in range(120)]
    df = spark.createDataFrame(rows, SCHEMA)
    for k in range(4):
        df.filter(F.col("value") % 4 == k).coalesce(1).write.parquet(str(tmp_path / "in" / f"part={k}"))
    return str(tmp_path / "in" / "part=*"), rows


def test_sliding_windows(spark, files, tmp_path):
    path, rows = files
    stream = streams.observations(spark, path, SCHEMA, 1)
    got = streams.drained(streams.windowed(stream, ["px"], "ts", "7 days", "60 days", "value", "1 day"), "slid")
    want = {}
    for px, t, v in rows:
        day = datetime(t.year, t.month, t.day)
        for k in range(7):
            n, most = want.get((px, day - timedelta(days=k)), (0, 0))
            want[px, day - timedelta(days=k)] = (n + 1, max(most, v))
    assert {(r["px"], r["start"]): (r["n"], r["maxv"]) for r in got.collect()} == want


def test_tracker_resumes(spark, files, tmp_path):
    """Batches that were written are not written again; the first scene of each day is."""
    path, rows = files
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    write = lambda df, _: df.select("px", "day").write.mode("append").parquet(out)
    for _ in range(2):
        streams.tracked(streams.once_a_day(streams.observations(spark, path, SCHEMA, 4), ["px"], "ts", "90 days"), state, write).awaitTermination()
    got = sorted((r["px"], r["day"]) for r in spark.read.parquet(out).collect())
    assert got == sorted({(px, t.date()) for px, t, _ in rows})


def test_checks_raise(spark):
    there = spark.createDataFrame([(1, "a")], "k int, s string")
    masks.check_complete(there, there, ["k"])
    with pytest.raises(masks.TimeSeriesError, match="2"):
        masks.check_complete(spark.createDataFrame([(1, "a"), (2, "b")], "k int, s string"), there, ["k"])
    with pytest.raises(masks.MaskError):
        masks.shade_mask(spark.createDataFrame([(0, 0, 1.0)], "row int, col int, elev double"), [("s", None, 1.0)], [], 10.0)
