"""Sketches of windows against exact counts, on spans they were merged to."""

from pyspark.sql import functions as F

from clickweave.operators import sketches
from tests.helpers import rows_of


def _events(spark, n):
    at = (F.lit(1_700_000_000) + F.col("id") * 7).cast("timestamp")
    return spark.range(n).select(
        at.alias("event_timestamp"),
        F.concat(F.lit("s"), (F.col("id") % 9000).cast("string")).alias("session_id"),
        F.concat(F.lit("u"), (F.col("id") * F.col("id") % 4001).cast("string")).alias("user_id"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("p"), F.floor(F.sqrt(F.col("id") % 3000)))).alias("product_id"),
    )


def test_distinct_states_merge_to_longer_spans(spark, tmp_path):
    events = _events(spark, 40_000)
    sketches.distinct_states(events).write.parquet(str(tmp_path / "states"))
    states = spark.read.parquet(str(tmp_path / "states"))
    for span in ("1 hour", "6 hours", "10 days"):
        exact = events.groupBy(F.window("event_timestamp", span).alias("window")).agg(
            F.count(F.lit(1)).alias("events"),
            F.countDistinct("session_id").alias("sessions"),
            F.countDistinct("user_id").alias("users"),
        )
        found = {r["window"]: r for r in sketches.distinct_over(states, span).collect()}
        rows = exact.collect()
        assert len(found) == len(rows)
        for row in rows:
            near = found[row["window"]]
            assert near["events"] == row["events"]
            for name in ("sessions", "users"):
                assert abs(near[name] - row[name]) <= 3 * sketches.distinct_error() * row[name]


def test_null_ids_and_empty_input(spark):
    events = _events(spark, 10).withColumn("user_id", F.lit(None).cast("string"))
    (row,) = sketches.distinct_over(sketches.distinct_states(events), "30 days").collect()
    assert (row["events"], row["sessions"], row["users"]) == (10, 10, 0)
    empty = events.where("false")
    assert sketches.distinct_over(sketches.distinct_states(empty), "1 day").count() == 0
    assert sketches.top_products_over(sketches.product_states(empty)).count() == 0


def test_top_products_of_hourly_states(spark):
    events = _events(spark, 20_000)
    exact = events.filter("product_id IS NOT NULL").groupBy("product_id").agg(F.count("*").alias("events"))
    states = sketches.product_states(events)
    best = rows_of(exact.orderBy(F.desc("events"), "product_id").limit(20))
    assert rows_of(sketches.top_products_over(states)) == best
    # With fewer tracked than there are products, counts are off by no more than the bound.
    few = 128
    skewed = F.when(F.col("session_id") < "s5", "big").when(F.col("session_id") < "s7", "next")
    hot = events.withColumn("product_id", F.coalesce(skewed, "session_id"))
    true = dict(hot.groupBy("product_id").count().collect())
    rough = sketches.top_products_over(sketches.product_states(hot, tracked=few), 2, few).collect()
    assert [product for product, _ in rough] == ["big", "next"]
    assert len(true) > few
    assert all(abs(n - true[product]) <= 3.5 / few * 20_000 for product, n in rough)
