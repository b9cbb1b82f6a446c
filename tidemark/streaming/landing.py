"""Raw landing of messages: key, text value and where it came from, exactly once by checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: What is known of a message, whatever it comes from.
MESSAGE = "key string, value string, topic string, partition int, offset long, timestamp timestamp"
COLUMNS = tuple(c.split()[0] for c in MESSAGE.split(", "))


def file_source(spark: SparkSession, path: str, schema: str, files_a_batch: int = 4) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).json(path)


def table_source(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of Parquet files; a run to the end takes all files that are there as one batch."""
    return spark.readStream.schema(schema).parquet(path)


def broker_options(servers: str, topics: tuple[str, ...], rows_a_batch: int | None = None) -> dict[str, str]:
    """The reader's options for a broker: all topics from their beginning, and an error where messages are gone."""
    out = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "startingOffsets": "earliest", "failOnDataLoss": "true"}
    return out | ({"maxOffsetsPerTrigger": str(rows_a_batch)} if rows_a_batch else {})


def kafka_source(spark: SparkSession, servers: str, topics: tuple[str, ...], rows_a_batch: int | None = None) -> DataFrame:
    """MESSAGE rows from a broker; needs the connector's jar."""
    return as_messages(spark.readStream.format("kafka").options(**broker_options(servers, topics, rows_a_batch)).load())


def as_messages(raw: DataFrame) -> DataFrame:
    """MESSAGE columns of a reader's rows, whose key and value may be bytes."""
    kinds = dict(c.split() for c in MESSAGE.split(", "))
    return raw.select(*[F.col(c).cast(kinds[c]).alias(c) for c in COLUMNS])


def text_source(spark: SparkSession, path: str) -> DataFrame:
    """MESSAGE rows from files of JSON lines that a broker's topics were dumped to, below one folder."""
    lines = spark.readStream.format("text").option("recursiveFileLookup", True).option("maxFilesPerTrigger", 4).load(path)
    return lines.select(F.from_json("value", MESSAGE).alias("m")).select("m.*")


def land(messages: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Appends messages with their load time: all that is there and then ends, or every so often. Checkpoint and table belong together."""
    writer = messages.withColumn("loaded_at", F.current_timestamp()).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
