"""Every operator as a named query over the activity log, for checks and benchmarks.

All queries read the whole table. Results carry text instead of timestamps and rounded doubles,
so that they compare equal with another engine's.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickweave import schemas
from clickweave.config import Settings
from clickweave.functions import measures
from clickweave.operators import events as ops
from clickweave.operators import messages as msg
from clickweave.operators import sessions, sketches, windows
from clickweave.plans import layers, reports, serving
from clickweave.session import materialize, scratch_dir, streaming_session
from clickweave.sinks.lake import DAYS, Lake, hour_range
from clickweave.sources import activity
from clickweave.sources.messages import file_batch, file_stream
from clickweave.streaming import ingest, metrics
from clickweave.streaming import sessions as session_streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TODAY = "2024-01-15"
RANGE_AS_OF = "2024-01-20 00:00:00"
HEALTH_AS_OF = "2024-01-31 00:05:00"
SCHEMA_CHANGE_DAY = "2024-01-16"
# How the log is cut into deliveries: the days between them, and the k of messages that come last.
DELIVERY_DAYS = ("2024-01-11", "2024-01-21")
HELD_BACK = (40, 41)
ONCE = {"availableNow": True}
# A run of a query takes in a delivery as one batch, whatever its number of files.
ALL_FILES = 1_000_000


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, sf_dir)

    run.__name__ = function.__name__
    QUERIES[function.__name__] = run
    return run


# --- inputs ---------------------------------------------------------------------------------


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = _log(spark, sf_dir).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    return _spread(reader.parquet(sf_dir))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.events(_log(spark, sf_dir))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.messages(_log(spark, sf_dir))


def _delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded events with the arrival time of their message."""
    decoded = msg.decode(_messages(spark, sf_dir)).filter(msg.is_parsed())
    return decoded.select("event.*", F.col("timestamp").alias("arrived"))


def _usable(events: DataFrame) -> DataFrame:
    """Clean events of any age; the log is historic, so the range filter stays out."""
    return ops.clean_measures(ops.parse_event_time(events.filter(ops.is_valid())))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver of the clean log; its ids are unique, so nothing needs deduplication."""
    return ops.add_partition_columns(_usable(_events(spark, sf_dir)))


def _funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.funnel_metrics(_silver(spark, sf_dir))


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.product_performance(_silver(spark, sf_dir))


def _traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.traffic_analytics(_silver(spark, sf_dir))


def _layers(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    # Decoded once, and silver made once, for the layers that start from them.
    decoded = materialize(msg.decode(_messages(spark, sf_dir)), "decoded")
    good, invalid = msg.split_decoded(decoded)
    delivered = good.select("event.*", F.col("timestamp").alias("arrived"))
    arrived = F.col("arrived")
    silver = layers.silver_rows(delivered, arrived, arrived).drop("arrived")
    silver = materialize(silver, "silver")
    return {
        "bronze": layers.bronze_rows(delivered, arrived),
        "silver": silver,
        **layers.gold_tables(silver),
        "dead_letter": msg.dead_letters(invalid, failed_at=F.col("timestamp")),
    }


# --- outputs --------------------------------------------------------------------------------


def _text(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)


def _comparable(rows: DataFrame, digits: int = 6) -> DataFrame:
    """Timestamps and dates as text, doubles rounded."""

    def one(name: str, kind: str) -> Column:
        if kind in ("timestamp", "date"):
            return F.col(name).cast("string").alias(name)
        if kind == "double":
            return F.round(name, digits).alias(name)
        return F.col(name)

    return rows.select(*[one(name, kind) for name, kind in rows.dtypes])


def _deliver(
    deliveries: list[DataFrame], folder: str, start: Callable[[], StreamingQuery]
) -> StreamingQuery:
    """Store one delivery after the other, each taken in by a run of the query from its checkpoint.

    So a delivery can have many files, which tasks write and read side by side, and still arrives
    as a whole, after the one before.
    """
    for k, rows in enumerate(deliveries):
        rows.write.parquet(f"{folder}/delivery={k}")
        query = start()
        query.awaitTermination()
    return query


def _spread(log: DataFrame) -> DataFrame:
    """The log dealt evenly to as many tasks as a shuffle has, a core each at least, however few
    splits its file has. Its rows are small; what is made of them is not.
    """
    spark = log.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return log.repartition(max(tasks, spark.sparkContext.defaultParallelism))


def _appended(spark: SparkSession, rows: DataFrame, purpose: str) -> DataFrame:
    """Run a stream over what is there now and read the files it wrote."""
    base = scratch_dir(spark, purpose)
    metrics.append_to(rows, f"{base}/rows", f"{base}/checkpoint", ONCE).awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{base}/rows")


# --- decoding and row-level operators ----------------------------------------------------------


@query
def decode_json_messages(spark, sf_dir):
    return msg.parse_messages(_messages(spark, sf_dir))


@query
def split_invalid_messages(spark, sf_dir):
    _, invalid = msg.split_decoded(msg.decode(_messages(spark, sf_dir)))
    return invalid.select(
        F.col("key").cast("string").alias("raw_key"),
        F.col("value").cast("string").alias("raw_value"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    )


def _odd_payloads(log: DataFrame) -> DataFrame:
    """Messages of the log whose payloads are broken, empty, mistyped or ahead of the schema."""
    n = F.col("event_id").cast("string")
    edges = [
        F.lit("{bad"),
        F.lit("null"),
        F.lit("[]"),
        F.lit(""),
        F.format_string('{"event_id":"%s","price":"9.5"}', n),
        F.format_string('{"event_id":%s,"quantity":2.5}', n),
        F.lit('{"event_id":"","price":2.5,"quantity":3}'),
        F.format_string('{"event_id":"%s","price":NaN}', n),
        F.format_string('{"event_id":"%s","price":1.5,"new_field":{"a":%s}}', n, n),
    ]
    value = F.get(F.array(*edges), (F.col("event_id") % len(edges)).cast("int"))
    return log.select(F.col("event_id").alias("offset"), value.cast("binary").alias("value"))


@query
def payload_edges(spark, sf_dir):
    """What becomes of odd payloads, and a field that the schema lacks, read from the VARIANT."""
    decoded = msg.decode(_odd_payloads(_log(spark, sf_dir)))
    rows = ops.clean_measures(
        decoded.select(
            F.col("offset").alias("kafka_offset"),
            msg.is_parsed().alias("parsed"),
            "event.*",
            F.try_variant_get(msg.payload(), "$.new_field.a", "bigint").alias("new_field"),
        )
    )
    measures_of = [F.when(F.col("parsed"), F.col(c)).alias(c) for c in ("price", "quantity")]
    return rows.select("kafka_offset", "parsed", "event_id", *measures_of, "new_field")


@query
def message_counts(spark, sf_dir):
    return msg.message_counts(msg.decode(_messages(spark, sf_dir)))


@query
def parse_event_time(spark, sf_dir):
    rows = ops.parse_event_time(_events(spark, sf_dir))
    return _comparable(rows.select("event_id", "event_time", "event_timestamp"))


@query
def partition_columns(spark, sf_dir):
    rows = ops.add_partition_columns(ops.parse_event_time(_events(spark, sf_dir)))
    return rows.select("event_id", *schemas.PARTITION_COLUMNS)


@query
def date_columns(spark, sf_dir):
    rows = ops.add_date_columns(ops.parse_event_time(_events(spark, sf_dir)))
    return _comparable(rows.select("event_id", "event_date", "event_hour"))


@query
def event_flags(spark, sf_dir):
    flags = ["is_purchase", "is_cart_add", "is_page_view", "is_checkout", "is_bounce"]
    return ops.add_event_flags(_events(spark, sf_dir)).select("event_id", *flags)


@query
def clean_measures(spark, sf_dir):
    rows = ops.clean_measures(msg.parse_messages(_messages(spark, sf_dir)))
    return rows.select("event_id", "event_time", "price", "quantity", "cart_value")


@query
def time_range_filter(spark, sf_dir):
    rows = ops.parse_event_time(_events(spark, sf_dir))
    kept = ops.within_range(rows, F.lit(RANGE_AS_OF).cast("timestamp"))
    return _comparable(kept.select("event_id", "event_timestamp"))


@query
def validate_valid(spark, sf_dir):
    valid, _ = ops.split_valid(msg.parse_messages(_messages(spark, sf_dir)))
    return valid


@query
def validate_invalid(spark, sf_dir):
    _, invalid = ops.split_valid(msg.parse_messages(_messages(spark, sf_dir)))
    return invalid


@query
def strict_validate(spark, sf_dir):
    events = msg.parse_messages(_messages(spark, sf_dir))
    return events.select(
        "event_id", "event_time", ops.is_strictly_valid().alias("is_strictly_valid")
    )


@query
def dedup_events(spark, sf_dir):
    valid = msg.parse_messages(_messages(spark, sf_dir)).filter(ops.is_valid())
    return ops.deduplicate(valid, [F.col("event_time")])


@query
def dead_letter_rows(spark, sf_dir):
    _, invalid = msg.split_decoded(msg.decode(_messages(spark, sf_dir)))
    return msg.dead_letters(invalid, failed_at=F.date_trunc("second", "timestamp"))


@query
def failure_reasons(spark, sf_dir):
    decoded = msg.decode(_messages(spark, sf_dir))
    rows = decoded.withColumn("failure_reason", msg.failure_reason(F.col("timestamp")))
    return rows.filter(F.col("failure_reason").isNotNull()).select(
        F.col("offset").alias("kafka_offset"), "failure_reason"
    )


@query
def late_events(spark, sf_dir):
    rows = _usable(_delivered(spark, sf_dir))
    late = metrics.late_rows(rows, F.col("arrived"))
    return _comparable(late.select("event_id", "event_timestamp"))


@query
def bronze_table(spark, sf_dir):
    arrived = F.date_trunc("second", "arrived")
    return _comparable(layers.bronze_rows(_delivered(spark, sf_dir), arrived).drop("arrived"))


@query
def silver_table(spark, sf_dir):
    arrived = F.date_trunc("second", "arrived")
    rows = layers.silver_rows(_delivered(spark, sf_dir), F.col("arrived"), arrived)
    # The copies of an event arrive together, so which of them stays does not show.
    return _comparable(rows.drop("arrived"))


# --- windowed metrics -----------------------------------------------------------------------


@query
def funnel_tumbling(spark, sf_dir):
    return _comparable(_funnel(spark, sf_dir))


@query
def funnel_sliding(spark, sf_dir):
    return _comparable(
        windows.funnel_metrics(_silver(spark, sf_dir), "10 minutes", "5 minutes")
    )


@query
def product_performance(spark, sf_dir):
    return _comparable(_products(spark, sf_dir))


@query
def traffic_analytics(spark, sf_dir):
    return _comparable(_traffic(spark, sf_dir))


@query
def top_viewed_products(spark, sf_dir):
    """The 20 products of most events over the whole log, from hourly states."""
    return sketches.top_products_over(sketches.product_states(_silver(spark, sf_dir)))


def _close(name: str) -> Column:
    """Whether an estimate is within three standard errors of the exact number."""
    bound = 3 * sketches.distinct_error() * F.col(name)
    return (F.abs(F.col(f"estimated.{name}") - F.col(name)) <= bound).alias(f"{name}_close")


def _against_exact(estimated: DataFrame, events: DataFrame) -> DataFrame:
    """Exact distinct counts per day, and whether the estimates are close to them."""
    exact = events.groupBy(F.window("event_timestamp", "1 day").alias("window")).agg(
        F.count(F.lit(1)).alias("events"),
        F.countDistinct("session_id").alias("sessions"),
        F.countDistinct("user_id").alias("users"),
    )
    found = estimated.select("window", F.struct("sessions", "users").alias("estimated"))
    return exact.join(found, "window").select(
        F.date_format("window.start", "yyyy-MM-dd").alias("day"),
        "events",
        "sessions",
        "users",
        _close("sessions"),
        _close("users"),
    )


@query
def distinct_estimates(spark, sf_dir):
    silver = _silver(spark, sf_dir)
    estimated = sketches.distinct_over(sketches.distinct_states(silver), "1 day")
    return _against_exact(estimated, silver)


# --- serving --------------------------------------------------------------------------------


@query
def live_metrics(spark, sf_dir):
    return serving.live_metrics(_funnel(spark, sf_dir), TODAY)


@query
def active_counts(spark, sf_dir):
    return serving.active_counts(_silver(spark, sf_dir), TODAY)


@query
def top_categories(spark, sf_dir):
    return _comparable(serving.top_categories(_products(spark, sf_dir)))


@query
def geography(spark, sf_dir):
    return _comparable(serving.geography(_traffic(spark, sf_dir)))


@query
def traffic_sources(spark, sf_dir):
    return _comparable(serving.traffic_sources(_traffic(spark, sf_dir)))


@query
def device_breakdown(spark, sf_dir):
    return serving.device_breakdown(_traffic(spark, sf_dir))


@query
def funnel_latest(spark, sf_dir):
    return _comparable(serving.funnel_latest(_funnel(spark, sf_dir)))


@query
def traffic_timeseries(spark, sf_dir):
    return _comparable(serving.traffic_timeseries(_funnel(spark, sf_dir)))


@query
def traffic_timeseries_latest(spark, sf_dir):
    return _comparable(serving.traffic_timeseries(_funnel(spark, sf_dir), latest=True))


@query
def top_products(spark, sf_dir):
    return _comparable(serving.top_products(_products(spark, sf_dir)))


@query
def top_products_overall(spark, sf_dir):
    return _comparable(serving.top_products_overall(_products(spark, sf_dir)))


@query
def top_converting_products(spark, sf_dir):
    return _comparable(serving.top_converting_products(_products(spark, sf_dir)))


@query
def top_converting_overall(spark, sf_dir):
    return _comparable(serving.top_converting_overall(_products(spark, sf_dir)))


@query
def layer_health(spark, sf_dir):
    return _comparable(serving.layer_health(_layers(spark, sf_dir)))


@query
def lake_summary(spark, sf_dir):
    return _comparable(serving.pipeline_health(_layers(spark, sf_dir)))


@query
def recency_levels(spark, sf_dir):
    health = serving.layer_health(_layers(spark, sf_dir))
    return serving.layer_levels(health, F.lit(HEALTH_AS_OF).cast("timestamp"))


# --- reports --------------------------------------------------------------------------------


@query
def trend(spark, sf_dir):
    # Both branches of the ordered lag read the windows from a table.
    return _comparable(reports.metric_trends(materialize(_funnel(spark, sf_dir), "funnel")))


@query
def latest_window(spark, sf_dir):
    return _comparable(reports.latest_window(_funnel(spark, sf_dir)))


@query
def sparkline(spark, sf_dir):
    return _comparable(reports.sparkline(_funnel(spark, sf_dir)))


@query
def funnel_stages(spark, sf_dir):
    return _comparable(reports.funnel_stages(_funnel(spark, sf_dir)))


@query
def revenue_share(spark, sf_dir):
    categories = serving.top_categories(_products(spark, sf_dir))
    return _comparable(reports.share_of_total(categories, "category", "total_revenue"))


@query
def visit_share(spark, sf_dir):
    sources = serving.traffic_sources(_traffic(spark, sf_dir))
    return _comparable(reports.share_of_total(sources, "traffic_source", "total_visits"))


@query
def conversion_band(spark, sf_dir):
    return reports.conversion_bands(_funnel(spark, sf_dir))


@query
def health_levels(spark, sf_dir):
    funnel = _funnel(spark, sf_dir)
    rate = F.col("events_per_second")
    return funnel.groupBy(measures.health_level(rate, 0.01).alias("level")).agg(
        F.count(F.lit(1)).alias("windows")
    )


# --- sessions -------------------------------------------------------------------------------


@query
def session_rollup(spark, sf_dir):
    return _comparable(sessions.session_rollup(_silver(spark, sf_dir)))


@query
def session_pages(spark, sf_dir):
    return _comparable(sessions.session_items(_silver(spark, sf_dir), "page"))


@query
def running_cart(spark, sf_dir):
    return _comparable(sessions.running_cart(_silver(spark, sf_dir)))


@query
def transition_matrix(spark, sf_dir):
    return _comparable(sessions.transition_matrix(_silver(spark, sf_dir)))


@query
def illegal_transitions(spark, sf_dir):
    return _comparable(sessions.illegal_transitions(_silver(spark, sf_dir)))


@query
def dimension_conformance(spark, sf_dir):
    return sessions.dimension_violations(_silver(spark, sf_dir))


@query
def session_flags(spark, sf_dir):
    rows = sessions.session_flags(_silver(spark, sf_dir))
    flags = ["is_entry", "is_exit", "is_bounce", "session_number"]
    return rows.select("event_id", "session_id", *flags)


def _plain(log: DataFrame) -> DataFrame:
    return log.select("user_id", F.col("ts").cast("timestamp").alias("event_timestamp"))


def _spans(rows: DataFrame) -> DataFrame:
    return rows.select("user_id", _text("session_start"), _text("session_end"), "events")


@query
def gap_sessions(spark, sf_dir):
    return _spans(sessions.gap_sessions(_plain(_log(spark, sf_dir))))


# --- encoding and the lake ------------------------------------------------------------------


@query
def encode_messages(spark, sf_dir):
    rows = msg.encode_events(_events(spark, sf_dir), activity.TOPIC, activity.TOPIC_PARTITIONS)
    return rows.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        F.col("partition").between(0, activity.TOPIC_PARTITIONS - 1).alias("in_topic"),
        *[
            F.col("headers")[i]["value"].cast("string").alias(name)
            for i, name in enumerate(["event_type", "content_type", "schema_version"])
        ],
    )


@query
def encode_dead_letters(spark, sf_dir):
    _, invalid = ops.split_valid(msg.parse_messages(_messages(spark, sf_dir)))
    failed_at = F.lit(HEALTH_AS_OF).cast("timestamp")
    rows = msg.encode_dead_letters(invalid, F.lit("invalid event"), "dead", failed_at)
    value = F.col("value").cast("string")
    return rows.select(
        F.col("key").cast("string").alias("key"),
        F.get_json_object(value, "$.original_event.event_time").alias("event_time"),
        F.get_json_object(value, "$.original_event.event_type").alias("event_type"),
        F.get_json_object(value, "$.error").alias("error"),
        F.get_json_object(value, "$.timestamp").cast("double").alias("failed_at"),
        F.col("headers")[0]["value"].cast("string").alias("error_type"),
    )


def _bronze_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Bronze of the clean log in two batches; only the second has the experiment group."""
    lake = Lake(scratch_dir(spark, "bronze-lake"), DAYS)
    rows = layers.bronze_rows(_events(spark, sf_dir), F.lit(HEALTH_AS_OF))
    change = F.lit(SCHEMA_CHANGE_DAY).cast("timestamp")
    earlier = rows.filter(F.col("event_timestamp") < change).drop("experiment_group")
    lake.append(earlier, "bronze", 0)
    lake.append(rows.filter(F.col("event_timestamp") >= change), "bronze", 1)
    return lake


@query
def union_evolved_schema(spark, sf_dir):
    lake = _bronze_lake(spark, sf_dir)
    return lake.read(spark, "bronze", evolved=True).select(
        "event_id", "experiment_group", "hour", "batch_id"
    )


@query
def lake_time_range(spark, sf_dir):
    rows = _bronze_lake(spark, sf_dir).read(spark, "bronze")
    hours = hour_range(datetime(2024, 1, 10, 6), datetime(2024, 1, 20, 18))
    return rows.filter(hours).select("event_id", "event_time", "experiment_group")


@query
def lake_sql(spark, sf_dir):
    _bronze_lake(spark, sf_dir).register_views(spark)
    return spark.sql(
        """
        SELECT day, event_type, count(*) AS events, count(experiment_group) AS grouped
        FROM bronze GROUP BY day, event_type
        """
    )


# --- streams ----------------------------------------------------------------------------------


def _silver_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = activity.events(_log_stream(streaming_session(spark), sf_dir))
    return _usable(events).withWatermark("event_timestamp", Settings().watermark)


@query
def stream_funnel(spark, sf_dir):
    rows = windows.funnel_metrics_exact(_silver_stream(spark, sf_dir))
    return _comparable(_appended(spark, rows, "stream-funnel"))


@query
def stream_sliding(spark, sf_dir):
    rows = windows.funnel_metrics_panes(_silver_stream(spark, sf_dir), "10 minutes", "5 minutes")
    return _comparable(_appended(spark, rows, "stream-sliding"))


def _log_in_three(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The log as three deliveries; around each border events come out of order."""
    log = _spread(_log(spark, sf_dir))
    delay = F.make_dt_interval(mins=F.get_json_object("props", "$.k").cast("int") % 30)
    ends = [F.lit(f"{day} 12:00:00").cast("timestamp_ntz") for day in DELIVERY_DAYS]
    number = F.when(F.col("ts") + delay < ends[0], 0).when(F.col("ts") + delay < ends[1], 1)
    return [log.filter(F.coalesce(number, F.lit(2)) == k) for k in range(3)]


def _in_three(
    spark: SparkSession, sf_dir: str, base: str, run: Callable[[DataFrame], StreamingQuery]
) -> None:
    """Run a query over a stream of clean events that come in three deliveries."""
    session = streaming_session(spark)
    schema = _log(spark, sf_dir).schema
    reader = session.readStream.schema(schema).option("maxFilesPerTrigger", ALL_FILES)

    def start() -> StreamingQuery:
        events = _usable(activity.events(reader.parquet(f"{base}/log")))
        return run(events.withWatermark("event_timestamp", Settings().watermark))

    _deliver(_log_in_three(spark, sf_dir), f"{base}/log", start)


def _appended_in_three(
    spark: SparkSession, sf_dir: str, operator: Callable[[DataFrame], DataFrame], purpose: str
) -> DataFrame:
    """The rows an operator appends over the three deliveries."""
    base, schemas_seen = scratch_dir(spark, purpose), []

    def run(events: DataFrame) -> StreamingQuery:
        rows = operator(events)
        schemas_seen.append(rows.schema)
        return metrics.append_to(rows, f"{base}/rows", f"{base}/checkpoint", ONCE)

    _in_three(spark, sf_dir, base, run)
    return spark.read.schema(schemas_seen[-1]).parquet(f"{base}/rows")


@query
def stream_transitions(spark, sf_dir):
    steps = _appended_in_three(spark, sf_dir, session_streams.session_steps, "stream-steps")
    return _comparable(sessions.matrix_of(steps))


def _illegal_steps(events: DataFrame) -> DataFrame:
    return sessions.illegal_of(session_streams.session_steps(events))


@query
def stream_illegal_steps(spark, sf_dir):
    return _comparable(_appended_in_three(spark, sf_dir, _illegal_steps, "stream-illegal"))


@query
def stream_running_cart(spark, sf_dir):
    carts = _appended_in_three(spark, sf_dir, session_streams.running_cart, "stream-cart")
    return _comparable(carts)


@query
def stream_products(spark, sf_dir):
    rows = windows.product_performance(_silver_stream(spark, sf_dir))
    return _comparable(_appended(spark, rows, "stream-products"))


@query
def stream_traffic(spark, sf_dir):
    rows = windows.traffic_analytics(_silver_stream(spark, sf_dir))
    return _comparable(_appended(spark, rows, "stream-traffic"))


@query
def stream_dedup(spark, sf_dir):
    messages = activity.messages(_log_stream(streaming_session(spark), sf_dir))
    rows = metrics.clean_stream(messages, Settings())
    kept = rows.select("event_id", "event_time", "event_type", "cart_value")
    return _comparable(_appended(spark, kept, "stream-dedup"))


@query
def stream_gap_sessions(spark, sf_dir):
    log = _log_stream(streaming_session(spark), sf_dir)
    return _spans(_appended(spark, metrics.gap_session_stream(_plain(log)), "stream-sessions"))


@query
def stream_user_sessions(spark, sf_dir):
    log = _plain(_log_stream(streaming_session(spark), sf_dir))
    rows = session_streams.gap_sessions(log.withWatermark("event_timestamp", Settings().watermark))
    return _spans(_appended(spark, rows, "stream-user-sessions"))


@query
def stream_distinct(spark, sf_dir):
    """Hourly states of an update-mode stream, the last of each hour, merged to days."""
    base = scratch_dir(spark, "stream-distinct")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id)).write.parquet(
            f"{base}/states/batch_id={batch_id}", mode="overwrite"
        )

    def run(events: DataFrame) -> StreamingQuery:
        states = sketches.distinct_states(events).writeStream.outputMode("update")
        writer = states.foreachBatch(write).trigger(**ONCE)
        return writer.option("checkpointLocation", f"{base}/checkpoint").start()

    _in_three(spark, sf_dir, base, run)
    columns = ["events", "session_state", "user_state"]
    last = F.max_by(F.struct(*columns), "batch").alias("last")
    stored = spark.read.parquet(f"{base}/states").groupBy("window").agg(last)
    estimated = sketches.distinct_over(stored.select("window", "last.*"), "1 day")
    return _against_exact(estimated, _silver(spark, sf_dir))


@query
def stream_medallion(spark, sf_dir):
    """All layers through the ingest query, as rows and freshness per layer."""
    base = scratch_dir(spark, "stream-lake")
    lake = Lake(f"{base}/lake", DAYS)
    messages = activity.messages(_log_stream(streaming_session(spark), sf_dir))
    ingest.start_ingest(messages, lake, f"{base}/checkpoint", trigger=ONCE).awaitTermination()
    tables = {name: lake.read(spark, name) for name in schemas.TABLES}
    return _comparable(serving.layer_health(tables))


def _messages_in_three(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The messages as three deliveries.

    The last also has messages held back from the first two, and second copies of the first one's
    events, 30 days later and with times of then.
    """
    log = _spread(_log(spark, sf_dir))
    held = F.get_json_object("props", "$.k").cast("int").between(*HELD_BACK)
    ends = [F.lit(day).cast("timestamp_ntz") for day in DELIVERY_DAYS]
    again = log.filter(F.col("ts") < ends[0]).withColumn("ts", F.col("ts") + F.expr("interval 30 days"))
    deliveries = [
        log.filter((F.col("ts") < ends[0]) & ~held),
        log.filter((F.col("ts") >= ends[0]) & (F.col("ts") < ends[1]) & ~held),
        log.filter((F.col("ts") >= ends[1]) | held).unionAll(again),
    ]
    return [activity.messages(rows) for rows in deliveries]


def _topic_in_three(
    spark: SparkSession, sf_dir: str, base: str, run: Callable[[DataFrame], StreamingQuery]
) -> tuple[str, StreamingQuery]:
    """Run a query over the messages' three deliveries, which are its batches 0, 1 and 2."""
    topic, session = f"{base}/topic", streaming_session(spark)
    # A batch without messages after each run would take a number.
    session.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    query = _deliver(
        _messages_in_three(spark, sf_dir),
        topic,
        lambda: run(file_stream(session, topic, max_files_per_trigger=ALL_FILES)),
    )
    return topic, query


def _delivered_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The lake after three batches of the ingest query, the second of them run once more."""
    base = scratch_dir(spark, "delivered-lake")
    lake = Lake(f"{base}/lake", DAYS)
    topic, query = _topic_in_three(
        spark,
        sf_dir,
        base,
        lambda stream: ingest.start_ingest(stream, lake, f"{base}/checkpoint", trigger=ONCE),
    )
    second = msg.decode(file_batch(spark, f"{topic}/delivery=1"))
    second = second.withColumn(ingest.INGESTED, F.current_timestamp())
    ingest.write_batch(lake, Settings(), query_id=str(query.id))(second, 1)
    return lake


@query
def stream_silver(spark, sf_dir):
    silver = _delivered_lake(spark, sf_dir).read(spark, "silver")
    return _comparable(silver.drop("ingestion_timestamp", "batch_id"))


@query
def stream_gold(spark, sf_dir):
    return _comparable(_delivered_lake(spark, sf_dir).read(spark, "funnel_metrics"))


@query
def stream_late_split(spark, sf_dir):
    """Events counted in windows and events listed as late, by the day they happened."""
    base = scratch_dir(spark, "gold-lake")
    lake = Lake(f"{base}/lake", DAYS)
    _topic_in_three(
        spark,
        sf_dir,
        base,
        lambda stream: metrics.start_gold(stream, lake, f"{base}/checkpoint", trigger=ONCE),
    )
    traffic = lake.read(spark, "traffic_analytics")
    counted = traffic.select(F.substring("window_start", 1, 10).alias("day"), "visits")
    late = lake.read(spark, "late_events").filter("late_reason = 'late'")
    late = late.select(F.col("event_date").cast("string").alias("day"), F.lit(None).alias("visits"))
    return (
        counted.unionAll(late)
        .groupBy("day")
        .agg(
            F.coalesce(F.sum("visits"), F.lit(0)).alias("counted"),
            F.count_if(F.col("visits").isNull()).alias("late"),
        )
    )
