"""Streams replayed from the tables until all waiting input is processed."""

from pyspark.sql import functions as F

from lakeline.operators import keyed
from lakeline.plans.registry import query, sql_word_rows
from lakeline.session import work_folder
from lakeline.sources.streams import decode_records, stream_files
from lakeline.streaming import counts
from lakeline.streaming.sinks import per_batch, read_sink


FILES_PER_BATCH = 1000


def _replay(spark, start):
    """Run a query to the end of its input; gives the sink's path."""
    sink, checkpoint = work_folder(spark, "sink"), work_folder(spark, "progress")
    start(sink, checkpoint).awaitTermination()
    return sink


def _stream(spark, folder, name):
    return stream_files(spark, f"{folder}/{name}.parquet", files_per_batch=FILES_PER_BATCH)


@query(
    "stream_kafka",
    "SELECT role AS key, count(*) AS words FROM "
    f"({sql_word_rows('conversations', 'text', 'role')}) GROUP BY role",
)
def stream_kafka(spark, folder):
    records = _stream(spark, folder, "conversations").select(
        F.col("role").cast("binary").alias("key"), F.col("text").cast("binary").alias("value")
    )

    def words(batch):
        return keyed.tokenize_explode(batch, "value", "key").groupBy("key").agg(
            F.count(F.lit(1)).alias("words")
        )

    sink = _replay(
        spark, lambda out, state: per_batch(decode_records(records), words, out, state)
    )
    parts = read_sink(spark, sink, "key string, words bigint")
    return parts.groupBy("key").agg(F.sum("words").alias("words"))


@query("stream_files", "SELECT event_id, event_type, value FROM events")
def stream_of_files(spark, folder):
    events = _stream(spark, folder, "events").select("event_id", "event_type", "value")
    sink = _replay(spark, lambda out, state: per_batch(events, lambda b: b, out, state))
    parts = read_sink(spark, sink, "event_id bigint, event_type string, value double")
    return parts.drop("batch_id")


@query(
    "stream_sink",
    "SELECT event_type, count(*) AS n, CAST(count(DISTINCT event_id) AS BIGINT) AS ids "
    "FROM events GROUP BY event_type",
)
def stream_sink(spark, folder):
    events = _stream(spark, folder, "events").select("event_type", "event_id")
    sink = _replay(spark, lambda out, state: per_batch(events, lambda b: b, out, state, merge=10))
    parts = read_sink(spark, sink, "event_type string, event_id bigint")
    return parts.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("ids")
    )


@query(
    "stream_word_count",
    f"SELECT word, count(*) AS n FROM ({sql_word_rows('conversations', 'text')}) GROUP BY word",
)
def stream_word_count(spark, folder):
    texts = _stream(spark, folder, "conversations").select("text")
    sink = _replay(
        spark,
        lambda out, state: counts.per_batch_word_count(texts, "text", out, state, every=None),
    )
    parts = read_sink(spark, sink, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


@query(
    "stream_interval_count",
    "SELECT strftime(time_bucket(INTERVAL '5 seconds', ts), '%Y-%m-%d %H:%M:%S') AS start, "
    "event_type, count(*) AS n FROM events GROUP BY 1, 2",
)
def stream_interval_count(spark, folder):
    events = _stream(spark, folder, "events").select("ts", "event_type")
    sink = _replay(
        spark,
        lambda out, state: counts.per_batch_interval_count(
            events, "ts", "event_type", out, state, every=None
        ),
    )
    parts = read_sink(spark, sink, "start timestamp_ntz, event_type string, n bigint")
    return counts.merged_intervals(parts, "event_type").withColumn(
        "start", F.date_format("start", "yyyy-MM-dd HH:mm:ss")
    )


@query(
    "stream_interval_closed",
    "SELECT strftime(start, '%Y-%m-%d %H:%M:%S') AS start, event_type, n FROM ("
    "SELECT time_bucket(INTERVAL '5 seconds', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2) "
    "WHERE start + INTERVAL '5 seconds' <= (SELECT max(ts) FROM events) - INTERVAL '1 hour'",
)
def stream_interval_closed(spark, folder):
    events = _stream(spark, folder, "events").select("ts", "event_type")
    sink = _replay(
        spark,
        lambda out, state: counts.closed_interval_count(
            events, "ts", "event_type", out, state, late="1 hour", every=None
        ),
    )
    return spark.read.parquet(sink).select(
        F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n"
    )
