"""Streaming sources. All that follows them takes any streaming DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def kafka_options(
    servers: str,
    topics: list[str],
    group_id: str | None = None,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Reader options of a subscription; ``latest`` starts at the end of the topic."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting_offsets,
    }
    if group_id:
        options["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def decode_records(records: DataFrame) -> DataFrame:
    """Binary Kafka records as ``(key string, value string)``."""
    return records.select(F.col("key").cast("string"), F.col("value").cast("string"))


def stream_kafka(spark: SparkSession, servers: str, topics: list[str], **settings) -> DataFrame:
    """String records of Kafka topics; needs Spark's Kafka connector on the class path."""
    options = kafka_options(servers, topics, **settings)
    return decode_records(spark.readStream.format("kafka").options(**options).load())


def stream_files(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    file_format: str = "parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """A folder of files as a stream; each file is read once.

    ``path`` is a folder or a pattern. It may also name a single file, which is then
    read as a pattern of one name, as the reader takes no file.
    """
    if schema is None:
        schema = spark.read.format(file_format).load(path).schema
    reader = spark.readStream.format(file_format).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    single = files.exists(place) and files.getFileStatus(place).isFile()
    return reader.load(f"{path[:-1]}[{path[-1]}]" if single else path)
