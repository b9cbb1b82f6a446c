"""Input rows carried through an operator as one struct, so that no column of theirs meets a name used inside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def others(docs: DataFrame, new: tuple | list) -> list[str]:
    """Columns of the input that appended ones don't replace; Spark doesn't tell cases apart."""
    taken = {n.lower() for n in new}
    return [c for c in docs.columns if c.lower() not in taken]


def as_row(docs: DataFrame, new: tuple | list) -> Column:
    """Those columns as one struct named `row`; without any, an empty one isn't allowed, so it holds a null."""
    kept = others(docs, new)
    return (F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.struct(F.lit(None).cast("int").alias("none"))).alias("row")


def from_row(docs: DataFrame, new: tuple | list) -> list[Column]:
    """The same columns again, from `row`."""
    return [F.col("row").getField(c).alias(c) for c in others(docs, new)]
