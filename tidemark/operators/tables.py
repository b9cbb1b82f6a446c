"""Typing, row checks, deduplication and joins of the typed layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Every column cast without throwing; what can't be read is null."""
    return df.select(*[F.trim(c).try_cast(t).alias(c) if t != "string" else F.col(c) for c, t in types.items()])


def cast_failures(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """(column, failures): values that are there, aren't blank, and can't be read as the column's type. One pass."""
    bad = {c: F.count_if(F.col(c).isNotNull() & (F.trim(c) != "") & F.trim(c).try_cast(t).isNull()) for c, t in types.items() if t != "string"}
    return df.agg(*[x.alias(c) for c, x in bad.items()]).select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("failures")) for c in bad])).alias("x")).select("x.*")


def run_checks(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check, failed_rows) of all checks in one pass; a check is a condition that a bad row meets, and null is no failure."""
    one = df.agg(*[F.count_if(cond).alias(n) for n, cond in checks.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("failed_rows")) for n in checks])).alias("x")).select("x.*")


class QualityError(ValueError):
    pass


def enforce(results: DataFrame, stage: str) -> None:
    """Fails with every failed check; there are as many rows as checks."""
    failed = results.filter("failed_rows > 0").orderBy("check").collect()
    if failed:
        raise QualityError(f"{stage}: " + ", ".join(f"{r['check']} ({r['failed_rows']} rows)" for r in failed))


def not_unique(df: DataFrame, key: str) -> DataFrame:
    """(failed_rows): rows beyond the distinct keys; a null key fails."""
    return df.agg((F.count("*") - F.count_distinct(key)).alias("failed_rows"))


def allowed(column: str, values: tuple[str, ...]) -> Column:
    """The failure of a value outside an enumeration; null passes."""
    return F.col(column).isNotNull() & ~F.col(column).isin(*values)


def attach(df: DataFrame, other: DataFrame, key: str, flag: str) -> DataFrame:
    """Left join with the presence of a match."""
    return df.join(other.withColumn(flag, F.lit(True)), key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def bucket_top(df: DataFrame, column: str, n: int, other: str = "(other)", missing: str = "(missing)") -> DataFrame:
    """`column` with its n most frequent values kept (the first by name among equals). n rows are broadcast."""
    top = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), column).limit(n).select(F.col(column).alias("_top"))
    return df.join(F.broadcast(top), F.col(column) == F.col("_top"), "left").withColumn(column, F.when(F.col(column).isNull(), missing).when(F.col("_top").isNull(), other).otherwise(F.col(column))).drop("_top")
