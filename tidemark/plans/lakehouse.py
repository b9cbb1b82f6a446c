"""Queries over sources, typing, checks, profiles, patterns and monitoring."""

from __future__ import annotations


import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import history, metrics, tables
from ..sources import lake
from ..sources.store import settled
from .decisions import acts, scored
from .registry import query, sql

DAY = 86400

#: The orders table as text, with some values damaged by a rule.
RAW_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "o_orderpriority": "string"}
_RAW_SQL = """
raw AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN 'c' || o_custkey WHEN o_orderkey % 89 = 0 THEN '  ' ELSE CAST(o_custkey AS VARCHAR) END AS o_custkey,
         CASE WHEN o_orderkey % 101 = 0 THEN 'X' WHEN o_orderkey % 103 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus, o_totalprice, o_orderkey AS k, o_custkey AS ck, o_orderpriority
  FROM orders)"""


def raw_orders(spark, sf_dir) -> DataFrame:
    k = F.col("o_orderkey")
    return lake.table(spark, sf_dir, "orders").select(
        k.cast("string").alias("o_orderkey"), F.when(k % 97 == 0, F.concat(F.lit("c"), F.col("o_custkey"))).when(k % 89 == 0, "  ").otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.when(k % 101 == 0, "X").when(k % 103 == 0, None).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"), F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("o_totalprice"), "o_orderpriority",
    )


def _folder(spark) -> str:
    """A new folder in the warehouse, which executors share."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tidemark-{uuid.uuid4().hex}"


@query("src_1_csv_source", sql("SELECT o_orderkey, o_custkey, o_orderstatus FROM raw WHERE trim(o_custkey) <> '' AND o_orderstatus IS NOT NULL", more=_RAW_SQL))
def csv_source(spark, sf_dir):
    """Raw orders through a CSV file with a header and back, every column text; a wrong header fails."""
    path = _folder(spark)
    raw_orders(spark, sf_dir).filter("trim(o_custkey) <> '' AND o_orderstatus IS NOT NULL").write.option("header", True).csv(path)
    return lake.read_csv(spark, path, list(RAW_TYPES)).select("o_orderkey", "o_custkey", "o_orderstatus")


@query("src_3_lineage_columns", sql("SELECT count(*) AS rows, count(*) AS with_file, count(*) AS with_time FROM orders"))
def lineage(spark, sf_dir):
    path = _folder(spark)
    raw_orders(spark, sf_dir).write.option("header", True).csv(path)
    df = lake.read_csv(spark, path, list(RAW_TYPES))
    return df.agg(F.count("*").alias("rows"), F.count_if(F.col("source_file").endswith(".csv")).alias("with_file"), F.count("loaded_at").alias("with_time"))


@query("src_4_layered_scan", sql("SELECT l_orderkey, l_linenumber, o_orderstatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'"))
def layered_scan(spark, sf_dir):
    """Two tables of the lake by name; the filter and the four columns reach their scans."""
    line, orders = lake.table(spark, sf_dir, "lineitem"), lake.table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    return line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_linenumber", "o_orderstatus")


@query("src_5_split_frame", sql("SELECT id, t, CAST(amount AS DOUBLE) AS amount, label FROM txn WHERE split IN ('valid', 'test')", "txn"))
def split_frame(spark, sf_dir):
    return lake.load_frame(spark, sf_dir, ("valid", "test"), ("amount", "label"), "registered query").withColumn("amount", F.col("amount").cast("double"))


@query("src_7_time_range", sql(f"SELECT id, t FROM txn WHERE t >= {5 * DAY} AND t < {9 * DAY}", "txn"))
def time_range(spark, sf_dir):
    return lake.between(lake.txn(spark, sf_dir), 5 * DAY, 9 * DAY).select("id", "t")


@query("snk_1_write_by_time", sql("SELECT count(*) AS rows, min(t) AS first, max(t) AS last FROM txn", "txn"))
def write_by_time(spark, sf_dir):
    path = _folder(spark)
    lake.write_by_time(lake.txn(spark, sf_dir), path, partitions=8)
    return spark.read.parquet(path).agg(F.count("*").alias("rows"), F.min("t").alias("first"), F.max("t").alias("last"))


@query("snk_4_json_encode", sql("""SELECT id, '{"id":' || id || CASE WHEN device IS NULL THEN '' ELSE ',"device":"' || device || '"' END || ',"email":"' || email || '"}' AS value FROM gappy""", "gappy"))
def json_encode(spark, sf_dir):
    """Messages without null or NaN members."""
    return lake.gappy(spark, sf_dir).select("id", F.to_json(F.struct("id", "device", "email")).alias("value"))


@query("snk_5_json_decode", sql("SELECT id, device, n, amount FROM (SELECT id, device, 2 AS n, CAST(amount AS DOUBLE) AS amount FROM gappy)", "gappy"))
def json_decode(spark, sf_dir):
    """Nested decisions as text, decoded and flattened, with the raw fields joined on."""
    g = lake.gappy(spark, sf_dir)
    text = g.select("id", F.to_json(F.struct("id", F.struct("device").alias("features"), F.array(F.struct(F.lit("a").alias("feature")), F.struct(F.lit("b").alias("feature"))).alias("reasons"))).alias("value"))
    back = text.select(F.from_json("value", "id long, features struct<device string>, reasons array<struct<feature string>>").alias("v")).select("v.id", "v.features.device", F.size("v.reasons").alias("n"))
    return back.join(g.select("id", F.col("amount").cast("double").alias("amount")), "id", "left")


@query("snk_6_daily_export", sql("SELECT day, policy, count(*) AS transactions FROM acts GROUP BY day, policy", "acts"))
def export(spark, sf_dir):
    """Aggregates by day and policy as one CSV file without row ids, read back."""
    path = _folder(spark)
    acts(spark, sf_dir).groupBy("day", "policy").agg(F.count("*").alias("transactions")).coalesce(1).write.option("header", True).csv(path)
    return spark.read.option("header", True).schema("day long, policy string, transactions long").csv(path)


_TIMELINE = f"""
line AS (
  SELECT id, t AS release, 0 AS kind, label FROM txn WHERE t >= {18 * DAY} AND t < {24 * DAY}
  UNION ALL SELECT id, t + {3 * DAY}, 1, label FROM txn WHERE t + {3 * DAY} >= {18 * DAY} AND t + {3 * DAY} < {24 * DAY})"""


def _timeline(spark, sf_dir) -> DataFrame:
    df = lake.txn(spark, sf_dir)
    due = df.select("id", (F.col("t") + 3 * DAY).alias("release"), F.lit(1).alias("kind"), "label")
    window = lake.between(df, 18 * DAY, 24 * DAY).select("id", F.col("t").alias("release"), F.lit(0).alias("kind"), "label")
    return window.unionByName(due.filter((F.col("release") >= 18 * DAY) & (F.col("release") < 24 * DAY)))


@query("snk_8_label_timeline", sql("SELECT id, release, kind, label FROM line", "txn", more=_TIMELINE))
def label_timeline(spark, sf_dir):
    """Transactions of the window and labels due in it, of earlier transactions too."""
    return _timeline(spark, sf_dir)


def _released(line: DataFrame) -> DataFrame:
    """Labels released before each transaction, transactions first among equals: running counts by day on top of the days before."""
    day = F.floor(F.col("release") / DAY)
    per = line.groupBy(day.alias("_d")).agg(F.sum("kind").alias("_n")).select("_d", F.coalesce(F.sum("_n").over(Window.orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    w = Window.partitionBy("_d").orderBy("release", "kind", "id").rowsBetween(Window.unboundedPreceding, 0)
    return line.withColumn("_d", day).withColumn("_in", F.sum("kind").over(w)).join(F.broadcast(per), "_d").filter("kind = 0").select("id", (F.col("_in") + F.col("_before")).alias("released"))


@query("snk_9_labels_released_before", sql("SELECT id, CAST(released AS BIGINT) AS released FROM (SELECT id, kind, sum(kind) OVER (ORDER BY release, kind, id) AS released FROM line) WHERE kind = 0", "txn", more=_TIMELINE))
def released_before(spark, sf_dir):
    return _released(_timeline(spark, sf_dir))


@query("set_3_ordered_merge", sql("SELECT release, kind, id FROM line", "txn", more=_TIMELINE))
def ordered_merge(spark, sf_dir):
    return _timeline(spark, sf_dir).select("release", "kind", "id").orderBy("release", "kind", "id")


@query("set_2_union_for_labels_due", sql(f"SELECT id, t + {3 * DAY} AS due FROM txn WHERE t < {18 * DAY} AND t + {3 * DAY} >= {18 * DAY} UNION ALL SELECT id, t + {3 * DAY} FROM txn WHERE t >= {18 * DAY} AND t < {24 * DAY}", "txn"))
def labels_due(spark, sf_dir):
    df = lake.txn(spark, sf_dir)
    both = lake.between(df, 0, 18 * DAY).filter(F.col("t") + 3 * DAY >= 18 * DAY).unionByName(lake.between(df, 18 * DAY, 24 * DAY))
    return both.select("id", (F.col("t") + 3 * DAY).alias("due"))


@query("prj_1_typed", sql("SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, TRY_CAST(trim(o_custkey) AS BIGINT) AS o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM raw", more=_RAW_SQL))
def typed(spark, sf_dir):
    return tables.typed(raw_orders(spark, sf_dir), RAW_TYPES)


@query("prj_2_cast_failures", sql("SELECT 'o_orderkey' AS \"column\", 0 AS failures UNION ALL SELECT 'o_custkey', count(*) FILTER (trim(o_custkey) <> '' AND TRY_CAST(trim(o_custkey) AS BIGINT) IS NULL) FROM raw UNION ALL SELECT 'o_totalprice', 0", more=_RAW_SQL))
def cast_failures(spark, sf_dir):
    return tables.cast_failures(raw_orders(spark, sf_dir), RAW_TYPES)


@query("prj_3_calendar", sql("SELECT id, CAST(make_timestamp((t + 1704067200) * 1000000) AS DATE) AS event_date, strftime(make_timestamp((t + 1704067200) * 1000000), '%Y-%m') AS event_month, t % 86400 // 3600 AS hour FROM txn", "txn"))
def calendar(spark, sf_dir):
    ts = F.timestamp_seconds(F.col("t") + lake.ANCHOR)
    return lake.txn(spark, sf_dir).select("id", F.to_date(ts).alias("event_date"), F.date_format(ts, "yyyy-MM").alias("event_month"), F.floor(F.col("t") % DAY / 3600).alias("hour"))


@query("prj_4_split", sql("SELECT split, count(*) AS rows FROM txn GROUP BY split", "txn"))
def split(spark, sf_dir):
    return lake.txn(spark, sf_dir).groupBy("split").agg(F.count("*").alias("rows"))


@query("prj_5_entity_keys", sql("SELECT id, concat_ws('_', card, coalesce(device, 'NA'), CAST(t // 86400 - label * 3 AS VARCHAR)) AS card_key, CASE WHEN device IS NOT NULL THEN concat_ws('|', device, email, '') END AS device_key, email AS email_key FROM gappy", "gappy"))
def entity_keys(spark, sf_dir):
    """Missing parts of the card key are NA, so it is never null; the device key is null without a device."""
    card = F.concat_ws("_", "card", F.coalesce("device", F.lit("NA")), (F.floor(F.col("t") / DAY) - F.col("label") * 3).cast("string"))
    return lake.gappy(spark, sf_dir).select("id", card.alias("card_key"), F.when(F.col("device").isNotNull(), F.concat_ws("|", "device", "email", F.lit(""))).alias("device_key"), F.col("email").alias("email_key"))


@query("prj_6_local_features", sql("SELECT id, CAST(CAST(amount * 100 AS BIGINT) % 100 AS INTEGER) AS cents, t % 86400 // 3600 AS hour, t // 86400 % 7 AS weekday, CASE WHEN device IS NOT NULL THEN CAST(device = card AS INTEGER) END AS same, CAST(device IS NOT NULL AS INTEGER) AS has_device FROM gappy", "gappy"))
def local_features(spark, sf_dir):
    return lake.gappy(spark, sf_dir).select(
        "id", ((F.col("amount") * 100).cast("long") % 100).cast("int").alias("cents"), F.floor(F.col("t") % DAY / 3600).alias("hour"), (F.floor(F.col("t") / DAY) % 7).alias("weekday"),
        F.when(F.col("device").isNotNull() & F.col("card").isNotNull(), (F.col("device") == F.col("card")).cast("int")).alias("same"), F.col("device").isNotNull().cast("int").alias("has_device"),
    )


def _row_checks() -> dict:
    return {
        "key_null": F.col("o_orderkey").isNull(), "customer_missing": F.col("o_custkey").isNull(), "status_not_allowed": tables.allowed("o_orderstatus", ("P", "F", "O")),
        "price_not_positive": F.col("o_totalprice") <= 0, "priority_missing": F.col("o_orderpriority").isNull(),
    }


_CHECK_SQL = sql("""
SELECT 'key_null' AS "check", 0 AS failed_rows UNION ALL SELECT 'customer_missing', count(*) FILTER (TRY_CAST(trim(o_custkey) AS BIGINT) IS NULL) FROM raw
UNION ALL SELECT 'status_not_allowed', count(*) FILTER (o_orderstatus NOT IN ('P', 'F', 'O')) FROM raw UNION ALL SELECT 'price_not_positive', count(*) FILTER (o_totalprice <= 0) FROM raw UNION ALL SELECT 'priority_missing', 0""", more=_RAW_SQL)


@query("agg_1_row_checks", _CHECK_SQL)
def row_checks(spark, sf_dir):
    return tables.run_checks(tables.typed(raw_orders(spark, sf_dir), RAW_TYPES), _row_checks())


query("prj_7_row_predicates", _CHECK_SQL)(row_checks)


@query("prj_8_gold_predicates", sql("SELECT 'split_missing' AS \"check\", count(*) FILTER (split IS NULL) AS failed_rows FROM txn UNION ALL SELECT 'card_missing', count(*) FILTER (card IS NULL) FROM txn", "txn"))
def gold_checks(spark, sf_dir):
    return tables.run_checks(lake.txn(spark, sf_dir), {"split_missing": F.col("split").isNull(), "card_missing": F.col("card").isNull()})


@query("agg_2_uniqueness", sql("SELECT count(*) - count(DISTINCT o_custkey) AS failed_rows FROM orders"))
def uniqueness(spark, sf_dir):
    return tables.not_unique(lake.table(spark, sf_dir, "orders"), "o_custkey")


@query("agg_3_exact_duplicates", sql("SELECT count(*) + count(*) FILTER (event_id % 10 = 0) AS rows, count(*) FILTER (event_id % 10 = 0) AS duplicates FROM events"))
def duplicates(spark, sf_dir):
    """The log with every tenth event twice: how many rows an exact de-duplication drops."""
    log = lake.table(spark, sf_dir, "events")
    twice = log.unionByName(log.filter("event_id % 10 = 0"))
    return twice.agg(F.count("*").alias("rows")).crossJoin(twice.dropDuplicates().agg(F.count("*").alias("kept"))).select("rows", (F.col("rows") - F.col("kept")).alias("duplicates"))


@query("prj_13_top_levels", sql("SELECT email, count(*) AS rows FROM (SELECT CASE WHEN email IS NULL THEN NULL WHEN email IN (SELECT email FROM (SELECT email, count(*) AS n FROM txn WHERE split = 'train' GROUP BY email) ORDER BY n DESC, email LIMIT 3) THEN email ELSE '__other__' END AS email FROM txn) GROUP BY email", "txn"))
def top_levels(spark, sf_dir):
    """Levels fitted on train; others are one level; null stays."""
    df = lake.txn(spark, sf_dir)
    top = df.filter("split = 'train' AND email IS NOT NULL").groupBy("email").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "email").limit(3).select("email", F.lit(True).alias("_in"))
    return df.join(F.broadcast(top), "email", "left").select(F.when(F.col("email").isNull(), None).when(F.col("_in"), F.col("email")).otherwise("__other__").alias("email")).groupBy("email").agg(F.count("*").alias("rows"))


@query("prj_14_flags", sql("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS flag, CAST(TRY_CAST(trim(o_custkey) AS FLOAT) AS DOUBLE) AS customer FROM raw", more=_RAW_SQL))
def flags(spark, sf_dir):
    return raw_orders(spark, sf_dir).select("o_orderkey", F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0).alias("flag"), F.trim("o_custkey").try_cast("float").cast("double").alias("customer"))


@query("prj_16_bucket_to_top", sql("SELECT device, count(*) AS rows FROM (SELECT CASE WHEN device IS NULL THEN '(missing)' WHEN device IN (SELECT device FROM gappy WHERE device IS NOT NULL GROUP BY device ORDER BY count(*) DESC, device LIMIT 8) THEN device ELSE '(other)' END AS device FROM gappy) GROUP BY device", "gappy"))
def bucket_to_top(spark, sf_dir):
    return tables.bucket_top(lake.gappy(spark, sf_dir), "device", 8).groupBy("device").agg(F.count("*").alias("rows"))


FAMILIES = (("card_txn_24h", "velocity", "payments of the card in a day"), ("card_amt_24h", "spend", "spend of the card in a day"), ("card_new_device", "novelty", "first use of the device"))


@query("prj_19_families", sql("SELECT family, name, count(*) AS rows FROM txn, (VALUES ('velocity', 'payments of the card in a day'), ('spend', 'spend of the card in a day'), ('novelty', 'first use of the device')) f(family, name) GROUP BY family, name", "txn"))
def families(spark, sf_dir):
    dim = spark.createDataFrame(FAMILIES, "feature string, family string, name string")
    long = lake.txn(spark, sf_dir).select("id", F.explode(F.array(*[F.lit(f) for f, _, _ in FAMILIES])).alias("feature"))
    return long.join(F.broadcast(dim), "feature").groupBy("family", "name").agg(F.count("*").alias("rows"))


@query("prj_21_day_normalised", sql("SELECT id, t // 86400 - CAST(device AS INTEGER) AS first_day FROM txn", "txn"))
def day_normalised(spark, sf_dir):
    return lake.txn(spark, sf_dir).select("id", (F.floor(F.col("t") / DAY) - F.col("device").cast("int")).alias("first_day"))


@query("prj_22_silent_feed", sql(f"SELECT day, count(device) AS devices, count(email) AS emails FROM (SELECT day, CASE WHEN t < {24 * DAY} THEN device END AS device, email FROM txn) GROUP BY day", "txn"))
def silent_feed(spark, sf_dir):
    """What-if: a field blank from a cut time on."""
    return lake.txn(spark, sf_dir).withColumn("device", F.when(F.col("t") < 24 * DAY, F.col("device"))).groupBy("day").agg(F.count("device").alias("devices"), F.count("email").alias("emails"))


@query("jn_1_presence_join", sql("SELECT o_orderkey, coalesce(n, 0) AS lines, n IS NOT NULL AS has_lines FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey"))
def presence_join(spark, sf_dir):
    lines = lake.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    return tables.attach(lake.table(spark, sf_dir, "orders").select("o_orderkey"), lines, "o_orderkey", "has_lines").select("o_orderkey", F.coalesce("n", F.lit(0)).alias("lines"), "has_lines")


@query("jn_2_orphans", sql("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"))
def orphans(spark, sf_dir):
    return lake.table(spark, sf_dir, "orders").select("o_orderkey").join(lake.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")


@query("jn_3_shifted_self_join", sql("""
SELECT gap, pairs, round(pairs - avg(pairs) FILTER (gap > 1) OVER (), 6) AS excess FROM (
  SELECT gap, count(*) AS pairs FROM (SELECT DISTINCT card, day FROM txn) a JOIN (SELECT DISTINCT card, day FROM txn) b USING (card), (VALUES (1), (2), (3), (4), (5)) g(gap) WHERE b.day = a.day + gap GROUP BY gap)""", "txn"))
def shifted(spark, sf_dir):
    """Pairs of days of a card that lie 1 to 5 days apart, in one join, and how many more they are than the mean of gaps 2 to 5. Five rows meet in the window."""
    keys = lake.txn(spark, sf_dir).select("card", "day").distinct()
    moved = keys.select("card", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("gap"), "day").withColumn("day", F.col("day") + F.col("gap"))
    pairs = moved.join(keys, ["card", "day"]).groupBy("gap").agg(F.count("*").alias("pairs"))
    return pairs.withColumn("excess", F.round(F.col("pairs") - F.avg(F.when(F.col("gap") > 1, F.col("pairs"))).over(Window.partitionBy()), 6))


@query("jn_6_labels_by_a_time", sql(f"SELECT d.day, count(*) AS labelled FROM (SELECT DISTINCT day FROM txn) d JOIN txn x ON x.t + {3 * DAY} < d.day * 86400 GROUP BY d.day", "txn"))
def labels_by_time(spark, sf_dir):
    """Labels released strictly before each day: releases are counted per day and accumulated; a range join isn't needed."""
    df = lake.txn(spark, sf_dir)
    first = F.floor((F.col("t") + 3 * DAY) / DAY) + 1
    new = df.groupBy(first.alias("day")).agg(F.count("*").alias("n"))
    spine = df.select("day").distinct()
    both = spine.join(new, "day", "full").withColumn("labelled", F.sum(F.coalesce("n", F.lit(0))).over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)))
    return both.join(spine, "day", "left_semi").filter("labelled > 0").select("day", "labelled")


@query("jn_7_decisions_with_raw", sql("SELECT id, action, email, device FROM acts WHERE policy = 'rules'", "acts"))
def with_raw(spark, sf_dir):
    a = acts(spark, sf_dir).filter("policy = 'rules'").select("id", "action")
    return a.join(lake.txn(spark, sf_dir).select("id", "email", "device"), "id", "left")


@query("jn_8_two_versions", sql("SELECT count(*) AS rows, round(max(abs(p - round(p, 3))), 6) AS max_gap, CAST(0 AS BIGINT) AS points_differ FROM scored", "scored"))
def two_versions(spark, sf_dir):
    a = scored(spark, sf_dir)
    b = a.select("id", F.round("p", 3).alias("p2"), F.col("points").alias("points2"))
    return a.join(b, "id").agg(F.count("*").alias("rows"), F.round(F.max(F.abs(F.col("p") - F.col("p2"))), 6).alias("max_gap"), F.count_if(~F.col("points").eqNullSafe(F.col("points2"))).alias("points_differ"))


@query("jn_9_complete_join", sql("SELECT count(*) AS rows, count(*) FILTER (label = 1) AS missing FROM txn", "txn"))
def complete_join(spark, sf_dir):
    """Full join, so that rows of only one side surface."""
    df = lake.txn(spark, sf_dir)
    return df.select("id").join(df.filter("label = 0").select("id", F.lit(1).alias("got")), "id", "full").agg(F.count("*").alias("rows"), F.count_if(F.col("got").isNull()).alias("missing"))


@query("jn_13_equal_before_a_cut", sql(f"SELECT count(*) AS compared, CAST(0 AS BIGINT) AS different FROM txn WHERE t < {24 * DAY}", "txn"))
def equal_before(spark, sf_dir):
    df = lake.txn(spark, sf_dir)
    late = df.withColumn("device", F.when(F.col("t") < 24 * DAY, F.col("device"))).select("id", F.col("device").alias("d2"))
    out = lake.between(df, 0, 24 * DAY).join(late, "id").agg(F.count("*").alias("compared"), F.count_if(~F.col("device").eqNullSafe(F.col("d2"))).alias("different"))
    if out.first()["different"]:
        raise ValueError("the logs differ before the cut")
    return out


@query("agg_5_split_summary", sql("SELECT split, min(day) AS first_day, max(day) AS last_day, count(*) AS rows, CAST(sum(label) AS BIGINT) AS fraud, round(avg(label), 6) AS rate, CAST(sum(amount) AS DOUBLE) AS amount, CAST(sum(CASE WHEN label = 1 THEN amount ELSE 0 END) AS DOUBLE) AS fraud_amount, round(count(device) / count(*), 6) AS device_share FROM gappy GROUP BY split", "gappy"))
def split_summary(spark, sf_dir):
    return lake.gappy(spark, sf_dir).groupBy("split").agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("*").alias("rows"), F.sum("label").alias("fraud"), F.round(F.avg("label"), 6).alias("rate"), F.sum("amount").cast("double").alias("amount"),
        F.sum(F.when(F.col("label") == 1, F.col("amount")).otherwise(0)).cast("double").alias("fraud_amount"), F.round(F.count("device") / F.count("*"), 6).alias("device_share"),
    )


@query("agg_6_daily_counts", sql("""
SELECT kind, n, count(*) AS rows, CAST(sum(label) AS BIGINT) AS fraud
FROM (SELECT unnest(['day', 'weekday', 'month']) AS kind, unnest([day, (day % 7 + 7) % 7, CAST(12 * year(d) + month(d) - 1 AS BIGINT)]) AS n, label FROM (SELECT *, DATE '2024-01-01' + CAST(day AS INTEGER) AS d FROM txn)) GROUP BY kind, n""", "txn"))
def calendar_counts(spark, sf_dir):
    """Rows and positives by day, by weekday (0 is that of the first day) and by month, in one pass."""
    date = F.date_add(F.lit("2024-01-01").cast("date"), F.col("day").cast("int"))
    kinds = {"day": F.col("day"), "weekday": F.pmod(F.col("day"), F.lit(7)), "month": (12 * F.year(date) + F.month(date) - 1).cast("long")}
    long = lake.txn(spark, sf_dir).select("label", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), v.cast("long").alias("n")) for k, v in kinds.items()])).alias("x")).select("label", "x.*")
    return long.groupBy("kind", "n").agg(F.count("*").alias("rows"), F.sum("label").alias("fraud"))


@query("srt_2_busiest_days", sql("SELECT day, count(*) AS rows FROM txn GROUP BY day ORDER BY rows DESC, day LIMIT 5", "txn"))
def busiest_days(spark, sf_dir):
    return lake.txn(spark, sf_dir).groupBy("day").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "day").limit(5)


@query("srt_2_top_levels", sql("SELECT email, count(*) AS rows FROM txn GROUP BY email ORDER BY rows DESC, email LIMIT 8", "txn"))
def top_levels(spark, sf_dir):
    return lake.txn(spark, sf_dir).groupBy("email").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "email").limit(8)


@query("srt_1_arrival_order", sql("SELECT id, t FROM gappy", "gappy"))
def arrival_order(spark, sf_dir):
    return lake.gappy(spark, sf_dir).select("id", "t").orderBy("t", "id")


_KEY_FIELDS = {"email": "email", "hour": "t % 86400 // 3600", "cents": "CAST(amount * 100 AS BIGINT) % 100", "large": "amount >= 150"}


@query("agg_7_key_stability", sql(f"""
SELECT count(*) AS keys, max(n) AS most_rows, quantile_cont(n, 0.5) AS median_rows, quantile_cont(n, 0.9) AS p90_rows, quantile_cont(n, 0.99) AS p99_rows, CAST(sum(CASE WHEN n >= 2 THEN n ELSE 0 END) AS BIGINT) AS rows_in_repeat_keys,
  round(1 - count(*) / sum(n), 6) AS share_with_history, CAST(coalesce(sum(n) FILTER (gone), 0) AS BIGINT) AS rows_with_missing_part,
  {", ".join(f"round(avg(CAST({f} <= 1 AS INTEGER)) FILTER (n >= 2), 6) AS {f}_constant" for f in _KEY_FIELDS)}, round(avg(CAST({" AND ".join(f"{f} <= 1" for f in _KEY_FIELDS)} AS INTEGER)) FILTER (n >= 2), 6) AS all_constant,
  round(avg(CAST(hi = 1 AND lo = 0 AS INTEGER)) FILTER (n >= 2), 6) AS mixed_labels
FROM (SELECT card || '_' || coalesce(device, 'NA') AS k, bool_or(device IS NULL) AS gone, count(*) AS n, {", ".join(f"count(DISTINCT {x}) AS {f}" for f, x in _KEY_FIELDS.items())}, max(label) AS hi, min(label) AS lo FROM gappy GROUP BY k)""", "gappy"))
def key_stability(spark, sf_dir):
    """How far (card, device) acts as one client: rows a key, rows with an earlier one, keys with a part missing, constancy of four fields, mixed labels."""
    df = lake.gappy(spark, sf_dir).withColumns({"hour": F.floor(F.col("t") % DAY / 3600), "cents": (F.col("amount") * 100).cast("long") % 100, "large": F.col("amount") >= 150})
    per = df.groupBy("card", F.coalesce("device", F.lit("NA")).alias("d")).agg(F.bool_or(F.col("device").isNull()).alias("gone"), F.count("*").alias("n"), *[F.count_distinct(f).alias(f) for f in _KEY_FIELDS], F.max("label").alias("hi"), F.min("label").alias("lo"))
    multi = lambda cond: F.round(F.avg(F.when(F.col("n") >= 2, cond.cast("int"))), 6)
    per = settled(per)
    q = metrics.exact_quantiles(per, "n", (0.5, 0.9, 0.99))
    return per.agg(
        F.count("*").alias("keys"), F.max("n").alias("most_rows"), F.sum(F.when(F.col("n") >= 2, F.col("n")).otherwise(0)).alias("rows_in_repeat_keys"),
        F.round(1 - F.count("*") / F.sum("n"), 6).alias("share_with_history"), F.sum(F.when(F.col("gone"), F.col("n")).otherwise(0)).alias("rows_with_missing_part"),
        *[multi(F.col(f) <= 1).alias(f"{f}_constant") for f in _KEY_FIELDS], multi(F.greatest(*_KEY_FIELDS) <= 1).alias("all_constant"), multi((F.col("hi") == 1) & (F.col("lo") == 0)).alias("mixed_labels"),
    ).crossJoin(q).select("*", *[F.col("q")[k].alias(n) for k, n in enumerate(("median_rows", "p90_rows", "p99_rows"))]).drop("q")


@query("agg_18_family_missingness", sql("SELECT 'entity' AS family, round((avg(CAST(device IS NULL AS INTEGER)) + avg(CAST(card IS NULL AS INTEGER))) / 2, 6) AS mean_share, CAST((avg(CAST(device IS NULL AS INTEGER)) > 0.5)::INTEGER + (avg(CAST(card IS NULL AS INTEGER)) > 0.5)::INTEGER AS BIGINT) AS over_half FROM gappy UNION ALL SELECT 'other', round(avg(CAST(email IS NULL AS INTEGER)), 6), 0 FROM gappy", "gappy"))
def family_missingness(spark, sf_dir):
    shares = lake.gappy(spark, sf_dir).agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in ("device", "card", "email")])
    long = shares.select(F.explode(F.array(*[F.struct(F.lit(f).alias("family"), F.col(c).alias("share")) for c, f in (("device", "entity"), ("card", "entity"), ("email", "other"))])).alias("x")).select("x.*")
    return long.groupBy("family").agg(F.round(F.avg("share"), 6).alias("mean_share"), F.count_if(F.col("share") > 0.5).alias("over_half"))


@query("agg_19_missing_together", sql("SELECT 'device,twin' AS columns, count(*) AS missing FROM gappy WHERE device IS NULL UNION ALL SELECT 'card,email', 0", "gappy"))
def missing_together(spark, sf_dir):
    """Columns with the same rows missing, by an order-free digest of those rows' ids."""
    df = lake.gappy(spark, sf_dir).withColumn("twin", F.col("device"))
    names = ("card", "device", "email", "twin")
    digests = df.agg(*[F.struct(F.coalesce(F.bit_xor(F.when(F.col(c).isNull(), F.xxhash64("id"))), F.lit(0)).alias("h"), F.count_if(F.col(c).isNull()).alias("n")).alias(c) for c in names])
    long = digests.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("d")) for c in names])).alias("x")).select("x.c", "x.d.*")
    return long.groupBy("h", "n").agg(F.array_join(F.array_sort(F.collect_set("c")), ",").alias("columns")).select("columns", F.col("n").alias("missing"))


_FIELDS = ("card", "device", "email")
_LEVELS = ", ".join(f"('{c}', {c})" for c in _FIELDS)


@query("agg_20_cardinality", sql(f"""
SELECT field, count(*) AS levels, round(sum(n) / (SELECT count(*) FROM gappy), 6) AS present, round(sum(n) FILTER (place <= 50) / sum(n), 6) AS top_coverage FROM (
  SELECT field, n, row_number() OVER (PARTITION BY field ORDER BY n DESC, v) AS place FROM (SELECT field, v, count(*) AS n FROM gappy, LATERAL (VALUES {_LEVELS}) f(field, v) WHERE v IS NOT NULL GROUP BY ALL))
GROUP BY field""", "gappy"))
def cardinality(spark, sf_dir):
    """Levels of each field, the share of rows with one, and what its 50 commonest levels cover. Only 50 levels a task and field go on to the ranking."""
    df = lake.gappy(spark, sf_dir)
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("v")) for c in _FIELDS])).alias("x")).select("x.*").filter("v IS NOT NULL")
    levels = long.groupBy("field", "v").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("field").orderBy(F.desc("n"), "v"))
    top = levels.withColumn("place", place).filter("place <= 50").groupBy("field").agg(F.sum("n").alias("top"))
    each = levels.groupBy("field").agg(F.count("*").alias("levels"), F.sum("n").alias("with")).join(top, "field").crossJoin(df.agg(F.count("*").alias("rows")))
    return each.select("field", "levels", F.round(F.col("with") / F.col("rows"), 6).alias("present"), F.round(F.col("top") / F.col("with"), 6).alias("top_coverage"))


@query("agg_21_amount_quantiles", sql("SELECT label, round(quantile_cont(CAST(amount AS DOUBLE), 0.5), 4) AS q50, round(quantile_cont(CAST(amount AS DOUBLE), 0.9), 4) AS q90, round(quantile_cont(CAST(amount AS DOUBLE), 0.99), 4) AS q99, round(avg(CAST(CAST(amount * 100 AS BIGINT) % 100 <> 0 AS INTEGER)), 6) AS cents_share FROM txn GROUP BY label", "txn"))
def amount_quantiles(spark, sf_dir):
    df = lake.txn(spark, sf_dir).withColumn("v", F.col("amount").cast("double"))
    q = metrics.exact_quantiles(df, "v", (0.5, 0.9, 0.99), "label")
    cents = df.groupBy("label").agg(F.round(F.avg(_cents().cast("int")), 6).alias("cents_share"))
    return q.join(cents, "label").select("label", *[F.round(F.col("q")[k], 4).alias(n) for k, n in enumerate(("q50", "q90", "q99"))], "cents_share")


def _cents():
    return (F.col("amount") * 100).cast("long") % 100 != 0


@query("agg_21_cents_rates", sql("SELECT CAST(amount * 100 AS BIGINT) % 100 <> 0 AS cents, count(*) AS rows, round(avg(label), 6) AS rate FROM txn GROUP BY cents", "txn"))
def cents_rates(spark, sf_dir):
    """The rate of amounts with and without cents."""
    return lake.txn(spark, sf_dir).groupBy(_cents().alias("cents")).agg(F.count("*").alias("rows"), F.round(F.avg("label"), 6).alias("rate"))


@query("agg_22_rates", sql("""
SELECT "by", level, rows, round(rows / sum(rows) OVER w, 6) AS share, round(rate, 6) AS rate, round(v / sum(v) OVER w, 6) AS value_share, round(fv / v, 6) AS fraud_value_share FROM (
  SELECT "by", level, count(*) AS rows, avg(label) AS rate, CAST(sum(amount) AS DOUBLE) AS v, CAST(sum(CASE WHEN label = 1 THEN amount ELSE 0 END) AS DOUBLE) AS fv
  FROM gappy, LATERAL (VALUES ('hour', lpad(CAST(t % 86400 // 3600 AS VARCHAR), 2, '0')), ('product', email), ('presence', CASE WHEN device IS NULL THEN 'without' ELSE 'with' END), ('month', strftime(to_timestamp(t + 1704067200) AT TIME ZONE 'UTC', '%Y-%m'))) b("by", level)
  GROUP BY ALL) WINDOW w AS (PARTITION BY "by")""", "gappy"))
def rates(spark, sf_dir):
    """Rows, rate and value by hour, product (the e-mail's kind), presence of a device, and month, in one pass."""
    month = F.date_format(F.timestamp_seconds(F.col("t") + lake.ANCHOR), "yyyy-MM")
    levels = {"hour": F.lpad(F.floor(F.col("t") % DAY / 3600).cast("string"), 2, "0"), "product": F.col("email"), "presence": F.when(F.col("device").isNull(), "without").otherwise("with"), "month": month}
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("by"), c.alias("level")) for k, c in levels.items()]))
    df = lake.gappy(spark, sf_dir).select("label", "amount", each.alias("x")).select("label", "amount", "x.*")
    per = df.groupBy("by", "level").agg(F.count("*").alias("rows"), F.avg("label").alias("rate"), F.sum("amount").cast("double").alias("v"), F.sum(F.when(F.col("label") == 1, F.col("amount")).otherwise(0)).cast("double").alias("fv"))
    all_ = Window.partitionBy("by")
    return per.select("by", "level", "rows", F.round(F.col("rows") / F.sum("rows").over(all_), 6).alias("share"), F.round("rate", 6).alias("rate"), F.round(F.col("v") / F.sum("v").over(all_), 6).alias("value_share"), F.round(F.col("fv") / F.col("v"), 6).alias("fraud_value_share"))


@query("agg_22_extreme_hours", sql("SELECT max_by(hour, rate * 1000 - hour) AS highest, min_by(hour, rate * 1000 + hour) AS lowest FROM (SELECT t % 86400 // 3600 AS hour, round(avg(label), 6) AS rate FROM txn GROUP BY hour)", "txn"))
def extreme_hours(spark, sf_dir):
    by = lake.txn(spark, sf_dir).groupBy(F.floor(F.col("t") % DAY / 3600).alias("hour")).agg(F.round(F.avg("label"), 6).alias("rate"))
    return by.agg(F.max_by("hour", F.col("rate") * 1000 - F.col("hour")).alias("highest"), F.min_by("hour", F.col("rate") * 1000 + F.col("hour")).alias("lowest"))


@query("agg_23_client_clustering", sql("""
SELECT keys, repeat_keys, round(repeat_rows / rows, 6) AS rows_in_repeat_keys, with_positive, share_within, all_positive FROM (
  SELECT count(*) AS keys, count(*) FILTER (n >= 2) AS repeat_keys, sum(n) AS rows, sum(n) FILTER (n >= 2) AS repeat_rows, count(*) FILTER (n >= 2 AND f > 0) AS with_positive,
    round(CAST(sum(f) FILTER (n >= 2 AND f > 0) AS DOUBLE) / nullif(sum(n) FILTER (n >= 2 AND f > 0), 0), 6) AS share_within, round(avg(CAST(f = n AS INTEGER)) FILTER (n >= 2 AND f > 0), 6) AS all_positive
  FROM (SELECT card, count(*) AS n, sum(label) AS f FROM txn GROUP BY card))""", "txn"))
def clustering(spark, sf_dir):
    """How far positives come from the same cards: repeat keys, those with a positive, the share of positives within them, and those with nothing else."""
    per = lake.txn(spark, sf_dir).groupBy("card").agg(F.count("*").alias("n"), F.sum("label").alias("f"))
    again, hit = F.col("n") >= 2, (F.col("n") >= 2) & (F.col("f") > 0)
    some = lambda on, x: F.sum(F.when(on, F.col(x)))
    return per.agg(
        F.count("*").alias("keys"), F.count_if(again).alias("repeat_keys"), F.round(some(again, "n") / F.sum("n"), 6).alias("rows_in_repeat_keys"), F.count_if(hit).alias("with_positive"),
        F.round(some(hit, "f").cast("double") / F.nullif(some(hit, "n"), F.lit(0)), 6).alias("share_within"), F.round(F.avg(F.when(hit, (F.col("f") == F.col("n")).cast("int"))), 6).alias("all_positive"),
    )


@query("agg_23_known_history", sql(f"""
SELECT delay, round(avg(CAST(k > 0 AS INTEGER)), 6) AS rows_with_known, round(avg(label) FILTER (k > 0), 6) AS rate_known, round(avg(label) FILTER (k = 0), 6) AS rate_not_known, round(avg(CAST(k > 0 AS INTEGER)) FILTER (label = 1), 6) AS positives_with_known
FROM (SELECT 'delayed' AS delay, label, coalesce(sum(label) OVER (PARTITION BY card ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND {3 * DAY + 1} PRECEDING), 0) AS k FROM txn
      UNION ALL SELECT 'instant', label, coalesce(sum(label) OVER (PARTITION BY card ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) FROM txn) GROUP BY delay""", "txn"))
def known_history(spark, sf_dir):
    """The rate of rows whose card has a known positive against the others, with labels that come late and with labels that come at once."""
    kinds = {"delayed": 3 * DAY, "instant": 0}
    known = history.add_history(lake.txn(spark, sf_dir), tuple(history.Feature(k, "card", "known", None, "label", d) for k, d in kinds.items()))
    long = known.select("label", F.explode(F.array(*[F.struct(F.lit(k).alias("delay"), (F.coalesce(k, F.lit(0)) > 0).alias("known")) for k in kinds])).alias("x")).select("label", "x.*")
    known_int, rate = F.col("known").cast("int"), lambda on: F.round(F.avg(F.when(on, F.col("label"))), 6)
    return long.groupBy("delay").agg(F.round(F.avg(known_int), 6).alias("rows_with_known"), rate(F.col("known")).alias("rate_known"), rate(~F.col("known")).alias("rate_not_known"), F.round(F.avg(F.when(F.col("label") == 1, known_int)), 6).alias("positives_with_known"))


@query("agg_24_constancy", sql("""
SELECT (SELECT round(count(device) / count(*), 6) FROM gappy) AS present, round(avg(CAST(raw = 1 AS INTEGER)), 6) AS raw_constant, round(avg(CAST(norm = 1 AS INTEGER)), 6) AS normalised_constant
FROM (SELECT card, count(DISTINCT CAST(device AS INTEGER)) AS raw, count(DISTINCT day - CAST(device AS INTEGER)) AS norm FROM gappy WHERE device IS NOT NULL GROUP BY card HAVING count(*) >= 3)""", "gappy"))
def constancy(spark, sf_dir):
    """Of cards with three or more rows that have the day count: for how many it is constant, as it is and counted from the start. Rows without it are left out."""
    d, df = F.col("device").cast("int"), lake.gappy(spark, sf_dir)
    per = df.filter(d.isNotNull()).groupBy("card").agg(F.count("*").alias("n"), F.count_distinct(d).alias("raw"), F.count_distinct(F.col("day") - d).alias("norm")).filter("n >= 3")
    const = per.agg(F.round(F.avg((F.col("raw") == 1).cast("int")), 6).alias("raw_constant"), F.round(F.avg((F.col("norm") == 1).cast("int")), 6).alias("normalised_constant"))
    return df.agg(F.round(F.count("device") / F.count("*"), 6).alias("present")).crossJoin(const)


@query("agg_24_mean_by_month", sql("SELECT strftime(to_timestamp(t + 1704067200) AT TIME ZONE 'UTC', '%Y-%m') AS month, count(device) AS rows, round(avg(CAST(device AS INTEGER)), 6) AS mean FROM gappy GROUP BY month", "gappy"))
def mean_by_month(spark, sf_dir):
    month = F.date_format(F.timestamp_seconds(F.col("t") + lake.ANCHOR), "yyyy-MM")
    return lake.gappy(spark, sf_dir).groupBy(month.alias("month")).agg(F.count("device").alias("rows"), F.round(F.avg(F.col("device").cast("int")), 6).alias("mean"))


@query("agg_28_latency_percentiles", sql("""
SELECT round(quantile_cont(v, 0.5), 4) AS p50, round(quantile_cont(v, 0.95), 4) AS p95, round(quantile_cont(v, 0.99), 4) AS p99, max(v) AS max, round(avg(v), 4) AS mean
FROM (SELECT t - lag(t) OVER (PARTITION BY card ORDER BY t, id) AS v FROM txn) WHERE v IS NOT NULL""", "txn"))
def latency(spark, sf_dir):
    """Percentiles of waiting times: the log has no decision timings, so those between a card's events, which it has."""
    wait = (F.col("t") - F.lag("t").over(Window.partitionBy("card").orderBy("t", "id"))).cast("double")
    v = lake.txn(spark, sf_dir).select(wait.alias("v")).filter("v IS NOT NULL")
    q = metrics.exact_quantiles(v, "v", (0.5, 0.95, 0.99)).crossJoin(v.agg(F.max("v").alias("max"), F.round(F.avg("v"), 4).alias("mean")))
    return q.select(*[F.round(F.col("q")[k], 4).alias(n) for k, n in enumerate(("p50", "p95", "p99"))], F.col("max").cast("long").alias("max"), "mean")


@query("agg_15_feed_health", sql(f"""
SELECT day, field, round(share, 6) AS present, ref >= 0.05 AND share < 0.5 * ref AS silent
FROM (SELECT day, 'device' AS field, count(device) / count(*) AS share FROM (SELECT day, CASE WHEN t < {24 * DAY} THEN device END AS device FROM gappy) GROUP BY day UNION ALL SELECT day, 'email', count(email) / count(*) FROM gappy GROUP BY day)
JOIN (SELECT 'device' AS field, count(device) / count(*) AS ref FROM gappy WHERE t < {18 * DAY} UNION ALL SELECT 'email', count(email) / count(*) FROM gappy WHERE t < {18 * DAY}) USING (field)""", "gappy"))
def feed_health(spark, sf_dir):
    df = lake.gappy(spark, sf_dir).withColumn("device", F.when(F.col("t") < 24 * DAY, F.col("device")))
    share = lambda d, *g: d.select(*g, F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).isNotNull().cast("int").alias("p")) for c in ("device", "email")])).alias("x")).groupBy(*g, "x.field").agg(F.avg("x.p").alias("share"))
    ref = share(lake.between(df, 0, 18 * DAY)).withColumnRenamed("share", "ref")
    return share(df, "day").join(F.broadcast(ref), "field").select("day", "field", F.round("share", 6).alias("present"), ((F.col("ref") >= 0.05) & (F.col("share") < 0.5 * F.col("ref"))).alias("silent"))


_PSI = """
edges AS (SELECT list_sort(list_distinct(quantile_cont(p, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e FROM scored WHERE split = 'train'),
inner_edges AS (SELECT unnest(e[2:len(e) - 1]) AS x FROM edges),
bins AS (SELECT s.id, s.split, (SELECT count(*) FROM inner_edges WHERE x <= s.p) AS b FROM scored s WHERE split IN ('train', 'test')),
spine AS (SELECT unnest(range(0, greatest(len(e) - 1, 1))) AS b FROM edges),
shares AS (SELECT b, greatest(coalesce(r, 0) / (SELECT count(*) FROM bins WHERE split = 'train'), 1e-4) AS r, greatest(coalesce(c, 0) / (SELECT count(*) FROM bins WHERE split = 'test'), 1e-4) AS c
  FROM spine LEFT JOIN (SELECT b, count(*) FILTER (split = 'train') AS r, count(*) FILTER (split = 'test') AS c FROM bins GROUP BY b) USING (b))"""


@query("agg_16_psi", sql("SELECT round(sum((c - r) * ln(c / r)), 6) AS psi FROM shares", "scored", more=_PSI))
def psi(spark, sf_dir):
    df = scored(spark, sf_dir)
    return metrics.psi(df.filter("split = 'train'"), df.filter("split = 'test'"), "p").select(F.round("psi", 6).alias("psi"))


_DRIFT = f"""
src AS (SELECT CAST(amount AS DOUBLE) AS amount, CAST(t % 86400 // 3600 AS DOUBLE) AS hour, email, CASE WHEN t < {24 * DAY} THEN device END AS device, split = 'test' AS cur FROM gappy WHERE split IN ('train', 'test')),
nl AS (SELECT 'amount' AS field, amount AS v, cur FROM src UNION ALL SELECT 'hour', hour, cur FROM src),
cl AS (SELECT 'email' AS field, email AS v, cur FROM src UNION ALL SELECT 'device', device, cur FROM src),
num AS (SELECT field, sum(r) OVER w / sum(r) OVER (PARTITION BY field) AS fr, sum(c) OVER w / sum(c) OVER (PARTITION BY field) AS fc, lead(v) OVER w - v AS step
  FROM (SELECT field, v, count(*) FILTER (NOT cur) AS r, count(*) FILTER (cur) AS c FROM nl GROUP BY field, v) WINDOW w AS (PARTITION BY field ORDER BY v)),
cat AS (SELECT field, r / sum(r) OVER (PARTITION BY field) AS r, coalesce(c / nullif(sum(c) OVER (PARTITION BY field), 0), 0) AS c
  FROM (SELECT field, v, count(*) FILTER (NOT cur) AS r, count(*) FILTER (cur) AS c FROM cl WHERE v IS NOT NULL GROUP BY field, v)),
dist AS (SELECT field, round(sum(abs(fr - fc) * step) / (SELECT stddev_pop(v) FROM nl WHERE NOT cur AND nl.field = num.field), 6) AS distance FROM num GROUP BY field
  UNION ALL SELECT field, round(sqrt(greatest(sum((CASE WHEN r > 0 THEN r * ln(2 * r / (r + c)) ELSE 0 END + CASE WHEN c > 0 THEN c * ln(2 * c / (r + c)) ELSE 0 END) / 2), 0) / ln(2)), 6) FROM cat GROUP BY field),
gone AS (SELECT field, round(abs(avg(CAST(v IS NULL AS INTEGER)) FILTER (cur) - avg(CAST(v IS NULL AS INTEGER)) FILTER (NOT cur)), 6) AS missing_shift
  FROM (SELECT field, CAST(v AS VARCHAR) AS v, cur FROM nl UNION ALL SELECT field, v, cur FROM cl) GROUP BY field),
flags AS (SELECT field, distance, missing_shift, distance >= 0.1 OR missing_shift >= 0.2 AS drifted FROM dist JOIN gone USING (field))"""


@query("agg_17_input_drift", sql("SELECT *, round(avg(CAST(drifted AS INTEGER)) OVER (), 6) AS drifted_share FROM flags", "gappy", more=_DRIFT))
def input_drift(spark, sf_dir):
    """Test against train, with a feed that falls silent in the test period."""
    df = lake.gappy(spark, sf_dir).withColumns({"device": F.when(F.col("t") < 24 * DAY, F.col("device")), "hour": F.floor(F.col("t") % DAY / 3600)})
    return metrics.input_drift(df.filter("split = 'train'"), df.filter("split = 'test'"), ("amount", "hour"), ("email", "device"))


@query("win_19_trailing_week", sql("SELECT d.day, count(x.id) AS transactions, round(avg(CAST(x.action <> 'approve' AS INTEGER)), 6) AS alert_rate FROM (SELECT DISTINCT day FROM txn WHERE day >= 7) d JOIN acts x ON x.policy = 'rules' AND x.day >= d.day - 7 AND x.day < d.day GROUP BY d.day", "acts"))
def trailing_week(spark, sf_dir):
    """[d - 7, d) for each day d: counts per day, each served to the seven days after it."""
    a = acts(spark, sf_dir).filter("policy = 'rules'")
    per = a.groupBy("day").agg(F.count("*").alias("n"), F.count_if(F.col("action") != "approve").alias("k"))
    served = per.select(F.explode(F.sequence(F.col("day") + 1, F.col("day") + 7)).alias("day"), "n", "k")
    days = a.select("day").distinct().filter("day >= 7")
    return served.join(days, "day", "left_semi").groupBy("day").agg(F.sum("n").alias("transactions"), F.round(F.sum("k") / F.sum("n"), 6).alias("alert_rate"))


@query("src_2_header_contract", sql("SELECT count(*) AS rows, true AS refused FROM orders"))
def header_contract(spark, sf_dir):
    """A file whose header lacks an expected name and has another is refused before any row is read."""
    path = _folder(spark)
    raw_orders(spark, sf_dir).withColumnRenamed("o_custkey", "customer").write.option("header", True).csv(path)
    try:
        lake.read_csv(spark, path, list(RAW_TYPES))
        refused = False
    except lake.HeaderError:
        refused = True
    return spark.read.option("header", True).csv(path).agg(F.count("*").alias("rows")).withColumn("refused", F.lit(refused))
