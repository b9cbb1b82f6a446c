"""Connected components of links, by contraction."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import cut
from .text import mix


def spanning(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the links a forest needs: those that join two parts when taken in order."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(ids)))
    keep = np.zeros(len(a), dtype=bool)
    for k, (x, y) in enumerate(zip(at[: len(a)].tolist(), at[len(a) :].tolist(), strict=True)):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        while parent[y] != y:
            parent[y] = parent[parent[y]]
            y = parent[y]
        if x != y:
            parent[max(x, y)] = min(x, y)
            keep[k] = True
    return keep


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        if len(a):
            keep = spanning(a, b)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])


#: Links that one task contracts at once: some tens of MB.
LOCAL = 300_000


def _rank(ids: np.ndarray, turn: int) -> np.ndarray:
    """The order of vertices in a round: that of the ids in round 0, later a mix of the ids that is another one each round."""
    return ids if turn == 0 else mix(ids.view(np.uint64) ^ mix(np.array([turn], np.uint64))).view(np.int64)


def _roots(turn: int) -> Callable:
    """(a, b) of a whole partition to (v, p, root): every end with the first vertex, in the round's order, that the partition's links reach, and its place."""

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(np.asarray(x.column(0)), np.asarray(x.column(1))) for x in batches]
        a, b = (np.concatenate([np.zeros(0, np.int64), *[p[k] for p in parts]]) for k in (0, 1))
        ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        rank = _rank(ids, turn)
        order = np.argsort(rank)
        ids, rank = ids[order], rank[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        at = place[at]
        parent = list(range(len(ids)))
        for x, y in zip(at[: len(a)].tolist(), at[len(a) :].tolist(), strict=True):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            while parent[y] != y:
                parent[y] = parent[parent[y]]
                y = parent[y]
            parent[max(x, y)] = min(x, y)
        for k in range(len(parent)):  # parents come before their children
            parent[k] = parent[parent[k]]
        to = np.array(parent, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(rank[to]), pa.array(ids[to])], names=["v", "p", "root"])

    return contract


def components(links: DataFrame, rounds: list[int] | None = None) -> DataFrame:
    """(id, component) of every end of links (a, b): component is the smallest id that links reach. Ids are longs without null.

    Links are dealt over tasks of at most about LOCAL links, whatever their number. A task contracts its links and gives every end its root. A
    vertex with roots from several tasks goes over to the first of them, and links its roots: those are the next round's links. "First" is by another mix of
    the ids each round, so of a path in any order of ids about every third vertex stays, and the rounds grow with the logarithm of the links.
    What fits one task ends it. No vertex's links are gathered, so a large star is as good as any other shape. Rounds are cut by checkpoints. Joins are
    sorted ones, since neither links nor components have a size bound that a broadcast could rely on.

    Links of a vertex with itself are left out, so a vertex without other links has no row; repeated links count once; no links give no rows. `rounds`
    gets the number of links of each round.
    """
    edges = cut(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).mapInArrow(_forest, "a long, b long").distinct())
    ids, n, turn = None, edges.count(), 0
    while n:
        rounds is not None and rounds.append(n)
        last = n <= LOCAL
        turn = 0 if last else turn + 1
        found = cut(edges.repartition(1 if last else -(-n // LOCAL)).mapInArrow(_roots(turn), "v long, p long, root long"))
        to = found if last else found.groupBy("v").agg(F.min_by("root", "p").alias("root"))
        steps = to.select(F.col("v").alias("_v"), F.col("root").alias("_to"))
        whole = ids is None and last
        ids = to.select(F.col("v").alias("id"), F.col("root").alias("component")) if ids is None else ids.join(steps.hint("merge"), F.col("component") == F.col("_v"), "left").select("id", F.coalesce("_to", "component").alias("component"))
        if last:
            break
        ids = cut(ids)
        edges = cut(found.join(steps.hint("merge"), F.col("v") == F.col("_v")).filter(F.col("root") != F.col("_to")).select(F.least("root", "_to").alias("a"), F.greatest("root", "_to").alias("b")).distinct())
        n = edges.count()
    if ids is None:
        return links.sparkSession.createDataFrame([], "id long, component long")
    if not whole:
        least = ids.groupBy("component").agg(F.min("id").alias("_least"))
        ids = ids.join(least.hint("merge"), "component").select("id", F.col("_least").alias("component"))
    return cut(ids)


def extended(known: DataFrame, links: DataFrame) -> DataFrame:
    """Components (id, component) of `known` and more links, which are few by now: only the components that they touch are contracted."""
    x, y = known.select(F.col("id").alias("a"), F.col("component").alias("_x")), known.select(F.col("id").alias("b"), F.col("component").alias("_y"))
    top = components(links.join(x.hint("merge"), "a", "left").join(y.hint("merge"), "b", "left").select(F.coalesce("_x", "a").alias("a"), F.coalesce("_y", "b").alias("b")))
    moved = known.join(top.select(F.col("id").alias("component"), F.col("component").alias("_to")).hint("merge"), "component", "left").select("id", F.coalesce("_to", "component").alias("component"))
    alone = top.join(known.select("id").hint("merge"), "id", "left_anti").select("id", "component")
    return cut(moved.unionByName(alone))
