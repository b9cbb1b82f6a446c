"""Tables of the lake, and the projections that the operators take as their input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ANCHOR = 1704067200  # second 0 of the log: 2024-01-01T00:00Z
DAY = 86400
#: First second of validation, of test, and after test.
SPLITS = (("train", 18), ("valid", 24), ("test", 31))
LABEL_DELAY = 3 * DAY
MONEY = "decimal(18,2)"


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def split_of(t: Column) -> Column:
    """Half-open intervals, contiguous; null behind the last."""
    (first, end), *rest = SPLITS
    out = F.when(t < end * DAY, first)
    for name, end in rest:
        out = out.when(t < end * DAY, name)
    return out


def txn(spark: SparkSession, root: str) -> DataFrame:
    """The event log as transactions: id, t, amount, card, device, email, label, day, split."""
    e = table(spark, root, "events")
    t = F.unix_seconds(F.col("ts").cast("timestamp")) - ANCHOR
    return e.select(
        F.col("event_id").alias("id"), t.alias("t"), F.col("value").cast(MONEY).alias("amount"), F.col("user_id").cast("string").alias("card"),
        F.get_json_object("props", "$.k").alias("device"), F.col("event_type").alias("email"), ((F.col("event_id") * 7919 + F.col("user_id")) % 31 == 0).cast("int").alias("label"),
        F.floor(t / DAY).alias("day"), split_of(t).alias("split"),
    )


def gappy(spark: SparkSession, root: str) -> DataFrame:
    """txn by the hour, so that seconds tie, with three quarters of the devices missing."""
    return txn(spark, root).withColumns({"t": F.floor(F.col("t") / 3600) * 3600, "device": F.when(F.col("device").cast("int") % 4 == 0, F.col("device"))})


#: From this day on the feed of devices is silent in `silent`.
SILENT_DAY = 24


def silent(spark: SparkSession, root: str) -> DataFrame:
    """txn as it is when the feed of devices fails: none from SILENT_DAY on."""
    return txn(spark, root).withColumn("device", F.when(F.col("t") < SILENT_DAY * DAY, F.col("device")))


def order_txn(spark: SparkSession, root: str) -> DataFrame:
    """Orders as a log by the day with long histories and many ties."""
    return table(spark, root, "orders").select(
        F.col("o_orderkey").alias("id"), F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("t"), F.col("o_totalprice").cast(MONEY).alias("amount"),
        F.col("o_custkey").cast("string").alias("card"), F.col("o_orderpriority").alias("device"), F.col("o_orderstatus").alias("email"), (F.col("o_orderstatus") == "F").cast("int").alias("label"),
    )


def load_frame(spark: SparkSession, root: str, splits: tuple[str, ...], columns: tuple[str, ...], purpose: str) -> DataFrame:
    """Rows of some splits, pruned to some columns. Reading the held-out split needs a purpose."""
    if "test" in splits and not purpose:
        raise ValueError("say for what the held-out split is read")
    return txn(spark, root).filter(F.col("split").isin(*splits)).select("id", "t", *columns)


def between(df: DataFrame, start: int, end: int) -> DataFrame:
    return df.filter((F.col("t") >= start) & (F.col("t") < end))


def write_by_time(df: DataFrame, path: str, time: str = "t", key: str = "id", partitions: int = 16) -> None:
    """Replaces a table, its rows by time then key within ranges of time, so that scans of a time range skip row groups. No global sort."""
    df.repartitionByRange(partitions, time).sortWithinPartitions(time, key).write.mode("overwrite").parquet(path)


class HeaderError(ValueError):
    pass


def read_csv(spark: SparkSession, path: str, expected: list[str]) -> DataFrame:
    """A CSV file with exactly the expected header, every column text, with the file's name and the time of loading."""
    df = spark.read.option("header", True).option("inferSchema", False).option("mode", "FAILFAST").csv(path)
    missing, unexpected = [c for c in expected if c not in df.columns], [c for c in df.columns if c not in expected]
    if missing or unexpected:
        raise HeaderError(f"{path}: missing {missing}, unexpected {unexpected}")
    return df.select(*expected, F.col("_metadata.file_name").alias("source_file"), F.current_timestamp().alias("loaded_at"))
