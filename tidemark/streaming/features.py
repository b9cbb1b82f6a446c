"""The streaming twin of the history features, and decisions with a daily review budget, as tables of state that each batch takes on.

A batch takes the rows that are there, and of all that have come those that the clock has passed, in order of time, transactions before labels of the same second; the others wait. So the order in
which files or topics were read doesn't matter. The features of the rows taken are the batch plan's sweep over them and over what the state holds: rows that a window still
reaches, totals of all rows, first seconds of values. So a key of any size is spread over tasks as in a batch. Later rows than the clock allows don't come in;
`split_late` goes before and keeps them in a table of their own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.history import DAY, LONG_AGO, Feature, add_history
from ..operators.history import FEATURES as ALL

EVENT = "id long, card string, t long, kind int, amount double, device string, email string, label int, ts timestamp"
#: What rules and the linear score take, with the positives known.
CARD = tuple(f for f in ALL if f.name in ("card_txn_1h", "card_txn_24h", "card_amt_24h", "card_new_device", "card_known_chargebacks"))
MONEY = "decimal(18,2)"
#: What the state knows of a row, and of all rows of an entity.
ROW = "id long, t long, amount decimal(18,2), card string, device string, email string, label int"
TOTALS = "kind string, entity string, rows long, n long, sum decimal(38,4), square decimal(38,4), last long, positive long, labelled long"
FIRST = "kind string, column string, entity string, value string, t long"
WAITING = "id long, card string, t long, kind int, amount double, device string, email string, label int"
SCHEMAS = {"rows": ROW, "totals": TOTALS, "first": FIRST, "waiting": WAITING, "due": WAITING, "new": f"topic int, {WAITING}", "clock": "topic int, newest long", "given": "day long, n long"}
EPOCH = 1704067200
SPREAD = 64  # parts of a day's rows that ask for a review


def _columns(schema: str) -> dict[str, str]:
    return dict(c.split(" ") for c in schema.split(", "))


@dataclass(frozen=True)
class Taken:
    """The state as a sweep needs it: totals by kind and entity, first values, and labels that come out now."""

    totals: DataFrame
    first: DataFrame
    labels: DataFrame

    def firsts(self, f: Feature) -> DataFrame:
        return self.first.filter((F.col("kind") == f.entity) & (F.col("column") == f.column)).select("entity", "value")

    def steps(self, entity: str, places: dict[tuple[str, int], int]) -> DataFrame:
        past = self.totals.filter(F.col("kind") == entity).select(
            F.col("entity").alias(entity), F.lit(-1).alias("_c"), F.lit(LONG_AGO).cast("long").alias("_at"), F.lit(False).alias("_ask"),
            *[F.col(c).alias(f"_past_{c}") for c in _columns(TOTALS) if c not in ("kind", "entity")],
        )
        for (why, _), n in places.items():
            if why == "delay":
                past = past.unionByName(self.labels.filter(F.col(entity).isNotNull()).select(entity, F.lit(n).alias("_c"), F.col("t").alias("_at"), F.lit(False).alias("_ask"), "label"), allowMissingColumns=True)
        return past


@dataclass(frozen=True)
class Keeper:
    """Tables of state in a folder, a folder of it for each batch, which takes that of the batch before. A batch that is tried again writes its own anew."""

    spark: SparkSession
    at: str
    features: tuple[Feature, ...]

    @property
    def entities(self) -> list[str]:
        return list(dict.fromkeys(f.entity for f in self.features))

    def reach(self, entity: str) -> int:
        """The longest window of an entity."""
        return max((f.window for f in self.features if f.entity == entity and f.window is not None), default=0)

    def read(self, name: str, batch: int) -> DataFrame:
        """A table as of a batch, empty before the first."""
        schema = SCHEMAS[name]
        path, files = self._path(f"{batch}/{name}")
        return self.spark.read.schema(schema).parquet(path.toString()) if files.exists(path) else self.spark.createDataFrame([], schema)

    def write(self, df: DataFrame, name: str, batch: int) -> DataFrame:
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.at}/{batch}/{name}")
        return self.read(name, batch)

    def newest(self) -> int:
        """The last batch of which there is state."""
        at, files = self._path("")
        return max(int(s.getPath().getName()) for s in files.listStatus(at))

    def forget(self, batch: int) -> None:
        """What no batch reads any more."""
        path, files = self._path(str(batch))
        files.delete(path, True)

    def _path(self, below: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.at}/{below}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def totals_of(self, pays: DataFrame, labels: DataFrame) -> DataFrame:
        """What rows and labels add to the totals."""
        x, some = F.col("amount").cast("decimal(18,4)"), F.col("amount").isNotNull()
        own = {"rows": F.count("*"), "n": F.count_if(some), "sum": F.coalesce(F.sum(x), F.lit(0)), "square": F.coalesce(F.sum((x * x).cast("decimal(38,4)")), F.lit(0)), "last": F.max("t")}
        out_ = {"positive": F.coalesce(F.sum("label"), F.lit(0)), "labelled": F.count("*")}
        kinds = _columns(TOTALS)
        shaped = lambda df, e, have: df.filter(F.col(e).isNotNull()).groupBy(F.col(e).alias("entity")).agg(*[c.alias(k) for k, c in have.items()]).select(
            *[(F.lit(e) if c == "kind" else F.col(c) if c == "entity" or c in have else F.lit(None if c == "last" else 0)).cast(t).alias(c) for c, t in kinds.items()])
        return reduce(DataFrame.unionByName, [shaped(df, e, have) for e in self.entities for df, have in ((pays, own), (labels, out_))])

    def firsts_of(self, pays: DataFrame) -> DataFrame:
        each = [f for f in self.features if f.kind == "is_new"]
        out = self.spark.createDataFrame([], FIRST)
        for f in each:
            both = pays.filter(F.col(f.entity).isNotNull() & F.col(f.column).isNotNull())
            out = out.unionByName(both.groupBy(F.col(f.entity).alias("entity"), F.col(f.column).alias("value")).agg(F.min("t").alias("t")).select(F.lit(f.entity).alias("kind"), F.lit(f.column).alias("column"), "entity", "value", "t"))
        return out

    def still_reached(self, rows: DataFrame, totals: DataFrame) -> DataFrame:
        """Rows that a window can still reach: not further back than it is long from the last row of any of their entities."""
        kept, out = F.lit(False), rows
        for e in self.entities:
            last = totals.filter(F.col("kind") == e).groupBy("entity").agg(F.max("last").alias(f"_last_{e}")).withColumnRenamed("entity", f"_key_{e}")
            out = out.join(last, F.col(e) == F.col(f"_key_{e}"), "left")
            kept = kept | F.coalesce(F.col("t") >= F.col(f"_last_{e}") - self.reach(e), F.lit(False))
        return out.filter(kept).select(*rows.columns)

    def start(self, txn: DataFrame, upto: int, delay: int) -> None:
        """The state as of second `upto` from the table, for a stream that takes over from there: what it would be had the table's rows come through the stream."""
        past = txn.filter(F.col("t") < upto).select(*[F.col(c).cast(t).alias(c) for c, t in _columns(ROW).items()])
        totals = self.write(self.summed(self.totals_of(past, past.filter(F.col("t") + delay < upto))), "totals", -1)
        self.write(self.firsts_of(past), "first", -1)
        self.write(self.still_reached(past, totals), "rows", -1)

    def summed(self, totals: DataFrame) -> DataFrame:
        kinds = _columns(TOTALS)
        return totals.groupBy("kind", "entity").agg(*[(F.max(c) if c == "last" else F.sum(c)).cast(t).alias(c) for c, t in kinds.items() if c not in ("kind", "entity")])

    def take(self, new: DataFrame, clock: int | None, number: int) -> DataFrame:
        """Features of the rows that the clock has passed, and the state after them."""
        before = number - 1
        passed = F.lit(False) if clock is None else F.col("t") <= clock
        there = self.read("waiting", before).unionByName(new.select(*_columns(WAITING)))
        self.write(there.filter(~passed), "waiting", number)
        due = self.write(there.filter(passed), "due", number)
        money = due.withColumn("amount", F.col("amount").cast(MONEY))
        pays, labels = money.filter("kind = 0").select(*_columns(ROW)), money.filter("kind = 1")
        old, totals, first = (self.read(x, before) for x in ("rows", "totals", "first"))
        rows = old.withColumn("_ask", F.lit(False)).unionByName(pays.withColumn("_ask", F.lit(True)))
        out = add_history(rows, self.features, state=Taken(totals, first, labels)).filter("_ask").drop("_ask")
        after = self.write(self.summed(totals.unionByName(self.totals_of(pays, labels))), "totals", number)
        kinds = first.unionByName(self.firsts_of(pays)).groupBy("kind", "column", "entity", "value").agg(F.min("t").alias("t"))
        self.write(kinds, "first", number)
        self.write(self.still_reached(old.unionByName(pays), after), "rows", number)
        return out


def messages(txn: DataFrame, delay: int) -> DataFrame:
    """Transactions (kind 0) and their labels, released `delay` later (kind 1), and a row behind the end of time that lets all others out."""
    nothing = F.lit(None).cast("string")
    pay = F.struct(F.lit(0).alias("kind"), F.col("t"), F.col("amount").cast("double").alias("amount"), F.col("device"), F.col("email"))
    label = F.struct(F.lit(1).alias("kind"), (F.col("t") + delay).alias("t"), F.lit(0.0).alias("amount"), nothing.alias("device"), nothing.alias("email"))
    both = txn.select("id", "card", F.explode(F.array(pay, label)).alias("x"), "label").select("id", "card", "x.t", "x.kind", "x.amount", "x.device", "x.email", "label")
    last = txn.agg((F.max("t") + delay + 10 * DAY).alias("t"))
    end = last.select(F.lit(-1).cast("long").alias("id"), F.lit("").alias("card"), "t", F.lit(1).alias("kind"), F.lit(0.0).alias("amount"), F.lit("").alias("device"), F.lit("").alias("email"), F.lit(0).alias("label"))
    return both.unionByName(end).withColumn("ts", F.timestamp_seconds(F.col("t") + EPOCH))


def feature_stream(stream: DataFrame, path: str, state: str, checkpoint: str, features: tuple[Feature, ...] = CARD, lateness: int = 3600, topics: int = 1, then: Callable | None = None) -> Keeper:
    """Takes all EVENT rows that are there and writes (id, t, amount, label, ..., the features) to the table `path`, a folder a batch; the state is in the folder `state`.

    The clock is the newest second that has come less `lateness`; with several topics (numbered by a column `topic`), that of the slowest, and none before each has come. Rows that it had
    passed in an earlier batch are late and don't come in. `then` gets each batch's features, the keeper and the batch's number.
    """
    keeper = Keeper(stream.sparkSession, state, features)

    def take(batch: DataFrame, number: int) -> None:
        rows = batch if "topic" in batch.columns else batch.withColumn("topic", F.lit(0))
        rows.select("topic", *_columns(WAITING)).write.mode("overwrite").option("compression", "zstd").parquet(f"{state}/{number}/new")
        new = keeper.read("new", number)
        before = keeper.read("clock", number - 1)
        seen = keeper.write(before.unionByName(new.groupBy("topic").agg(F.max("t").alias("newest"))).groupBy("topic").agg(F.max("newest").alias("newest")), "clock", number)
        passed = lambda at: min(r.newest for r in at) - lateness if len(at) == topics else None
        late_before = passed(before.collect())
        keeper.take(new if late_before is None else new.filter(F.col("t") > late_before), passed(seen.collect()), number).write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/batch={number}")
        if then:
            then(keeper.spark.read.parquet(f"{path}/batch={number}"), keeper, number)
        keeper.forget(number - 2)

    stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return keeper


def day_decisions(rows: DataFrame, keeper: Keeper, number: int, capacity: int, review_at: int, decline_at: int) -> DataFrame:
    """(id, points, action) of a batch's rows (id, t, day, points): the first of a day that ask, by time, get a review while its budget lasts; state has what each day gave so far.

    In two stages: parts of a day, of which each asks on for no more than the day's capacity, then the day. So no task sees all rows of a day that ask.
    """
    asks = (F.col("points") >= review_at) & (F.col("points") < decline_at)
    first = lambda df, *key: df.withColumn("_at", F.row_number().over(Window.partitionBy(*key).orderBy("t", "id"))).filter(F.col("_at") <= capacity)
    given = keeper.read("given", number - 1)
    asking = first(rows.filter(asks).select("id", "t", "day", F.pmod(F.xxhash64("id"), F.lit(SPREAD)).alias("_part")), "day", "_part")
    room = capacity - F.coalesce(F.col("n"), F.lit(0))
    seated = first(asking, "day").join(F.broadcast(given), "day", "left").filter(F.col("_at") <= room).select("id", "day", F.lit(True).alias("_seat"))
    keeper.write(given.unionByName(seated.groupBy("day").agg(F.count("*").alias("n"))).groupBy("day").agg(F.sum("n").alias("n")), "given", number)
    return rows.join(seated, ["id", "day"], "left").select("id", "points", F.when(F.col("points") >= decline_at, "decline").when(F.col("_seat"), "review").otherwise("approve").alias("action"))


def split_late(stream: DataFrame, lateness: int, on_time: str, late: str, clock: str, checkpoint: str) -> None:
    """Takes all that is there, and writes rows older than the newest one of an earlier batch by more than `lateness` seconds to the dead-letter table `late`.

    All others go to `on_time`, which is what a keyed stream with that watermark may read without losing a row. The newest second of each batch is a
    row of the table `clock`. A batch writes its own folders, so one that is tried again replaces what it wrote.
    """
    spark = stream.sparkSession

    def take(batch: DataFrame, number: int) -> None:
        spark.createDataFrame([], "newest long, batch long").write.mode("append").parquet(clock)
        seen = spark.read.schema("newest long, batch long").parquet(clock).filter(F.col("batch") < number).agg(F.max("newest").alias("m")).first().m
        is_late = F.lit(False) if seen is None else F.coalesce(F.col("t") < seen - lateness, F.lit(False))
        kept = batch.persist()
        try:
            kept.filter(~is_late).write.mode("overwrite").parquet(f"{on_time}/batch={number}")
            kept.filter(is_late).write.mode("overwrite").parquet(f"{late}/batch={number}")
            kept.agg(F.max("t").alias("newest")).withColumn("batch", F.lit(number).cast("long")).write.mode("append").parquet(clock)
        finally:
            kept.unpersist()

    stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
