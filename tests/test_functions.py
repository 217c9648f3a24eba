from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clickweave.functions import measures, time
from clickweave.session import delete_scratch, materialize


def _map(spark, values, kind, function):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


def test_event_timestamp_accepts_iso_utc_only(spark):
    texts = [
        "2024-03-01T10:20:30.123456Z",
        "2024-03-01T10:20:30Z",
        "2024-03-01T10:20:30",
        "2024-03-01T10:20:30.5Z",
        "2024-03-01 10:20:30",
        "2024-03-01T10:20:30+05:00",
        "2024-13-01T10:20:30Z",
        "2024-02-30T10:20:30Z",
        "yesterday",
        "",
        None,
    ]
    at = datetime(2024, 3, 1, 10, 20, 30)
    assert _map(spark, texts, "string", time.event_timestamp) == [at] * 4 + [None] * 7


def test_event_timestamp_can_keep_the_fraction(spark):
    kept = _map(
        spark,
        ["2024-03-01T10:20:30.123456Z", "2024-03-01T10:20:30.5Z", "2024-03-01T10:20:30Z"],
        "string",
        lambda c: time.event_timestamp(c, keep_fraction=True),
    )
    assert [t.microsecond for t in kept] == [123456, 500000, 0]


def test_any_timestamp_reads_both_layer_forms(spark):
    texts = ["2024-03-01 10:20:30", "2024-03-01T10:20:30.999Z", "2024-03-01T10:20:30", "soon"]
    at = datetime(2024, 3, 1, 10, 20, 30)
    assert _map(spark, texts, "string", time.any_timestamp) == [at, at, at, None]


def test_time_slice_never_decreases(spark):
    stamps = [datetime(1969, 12, 31, 23, 59, 59), datetime(1970, 1, 1), datetime(1970, 1, 1, 1)]
    assert _map(spark, stamps, "timestamp", lambda c: time.time_slice(c, 3600)) == [-1, 0, 1]


def test_clean_amount(spark):
    values = [None, float("nan"), -0.01, 0.0, 12.5]
    assert _map(spark, values, "double", measures.clean_amount) == [0.0, 0.0, 0.0, 0.0, 12.5]


def test_clean_quantity_keeps_removals(spark):
    values = [None, -101, -100, -1, 0, 7]
    assert _map(spark, values, "int", measures.clean_quantity) == [0, 0, -100, -1, 0, 7]


def test_ratio_guards_the_denominator(spark):
    rows = spark.createDataFrame([(1, 2), (1, 0), (1, None), (1, -4)], "a int, b int")
    out = [r[0] for r in rows.select(measures.ratio(F.col("a"), F.col("b"))).collect()]
    assert out == [0.5, 0.0, 0.0, 0.0]


def test_health_level(spark):
    values = [-1.0, 0.0, 0.5, 1.0, None]
    levels = _map(spark, values, "double", lambda c: measures.health_level(c, 1.0))
    assert levels == ["red", "red", "yellow", "green", "red"]


def test_recency_level(spark):
    as_of = F.lit("2024-03-01 10:20:00").cast("timestamp")
    texts = [
        "2024-03-01 10:15:01",
        "2024-03-01 10:15:00",
        "2024-03-01T10:05:01.5Z",
        "2024-03-01 10:05:00",
        "not a time",
        None,
    ]
    levels = _map(
        spark, texts, "string", lambda c: measures.recency_level(c, time.any_timestamp(c), as_of)
    )
    assert levels == ["green", "yellow", "yellow", "red", "yellow", "red"]


@pytest.mark.parametrize("inverse", [False, True])
def test_trend(spark, inverse):
    pairs = [(1.0, 0.0), (1.0, None), (100.5, 100.0), (110.0, 100.0), (90.0, 100.0)]
    rows = spark.createDataFrame(pairs, "now double, before double")
    out = rows.select(measures.trend(F.col("now"), F.col("before"), inverse)).collect()
    up, down = ("down", "up") if inverse else ("up", "down")
    assert [r[0] for r in out] == ["flat", "flat", "flat", up, down]


def test_conversion_band(spark):
    values = [0.0, 4.99, 5.0, 9.99, 10.0, 20.0, 20.1, 300.0, None]
    bands = _map(spark, values, "double", measures.conversion_band)
    assert bands == ["0-5", "0-5", "5-10", "5-10", "10-20", "10-20", "20+", "20+", "unknown"]


def test_scratch_is_deleted_on_request_only(spark):
    delete_scratch(spark)
    rows = materialize(spark.range(5), "trial")
    (path,) = {f.rsplit("/", 1)[0] for f in rows.inputFiles()}
    assert rows.count() == 5
    assert delete_scratch(spark) == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path).count()
    assert delete_scratch(spark) == 0
