"""Centroid clustering with integer vectors, by dictionaries of subvectors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import as_row, from_row, others
from .store import one_row_batches, stash

#: Rows of a page at most, so that codes are two bytes.
PAGE_ROWS = 1 << 14
#: Components beyond this (as integers) are an error, so that squared distances stay within 64 bits.
LARGEST = 1 << 27


class Dictionary(NamedTuple):
    """The distinct subvectors of one block of dimensions of a page, and each row's number among them."""

    first: int
    values: np.ndarray  # distinct subvectors, a row each
    codes: np.ndarray


def dictionaries(x: np.ndarray) -> list[Dictionary]:
    """Blocks of 1, 2 or 4 dimensions, whichever takes the least work: distances of distinct subvectors and one addition per row and block.

    A block of two is made of the codes of its halves, so nothing is compared but small numbers.
    """
    level = []
    for j in range(x.shape[1]):
        values, codes = np.unique(x[:, j], return_inverse=True)
        level.append(Dictionary(j, values[:, None], codes.reshape(-1)))
    best, least = level, sum(d.values.size + len(x) for d in level)
    while len(level) > 1 and level[0].values.shape[1] < 4:
        wider = []
        for a, b in zip(level[::2], level[1::2], strict=False):
            pairs, codes = np.unique(a.codes * len(b.values) + b.codes, return_inverse=True)
            wider.append(Dictionary(a.first, np.concatenate([a.values[pairs // len(b.values)], b.values[pairs % len(b.values)]], axis=1), codes.reshape(-1)))
        level = wider + level[len(level) & ~1 :]
        work = sum(d.values.size + len(x) for d in level)
        if work < least:
            best, least = level, work
    return best


def distances(page: list[Dictionary], centroids: np.ndarray) -> np.ndarray:
    """Squared distances of all rows and centroids: those of the distinct subvectors, summed up by code."""
    total = np.zeros((len(page[0].codes), len(centroids)), np.int64)
    for d in page:
        part = np.zeros((len(d.values), len(centroids)), np.int64)
        for j in range(d.values.shape[1]):
            part += (d.values[:, j, None] - centroids[None, :, d.first + j]) ** 2
        total += part[d.codes]
    return total


def sums(page: list[Dictionary], cluster: np.ndarray, k: int, dims: int) -> np.ndarray:
    """Sum of the vectors of each cluster: how often a cluster has a code, times its subvector."""
    out = np.zeros((k, dims), np.int64)
    for d in page:
        often = np.bincount(cluster * len(d.values) + d.codes, minlength=k * len(d.values)).reshape(k, -1)
        out[:, d.first : d.first + d.values.shape[1]] += often @ d.values
    return out


def _packed(page: list[Dictionary]) -> list[bytes]:
    shape = np.array([(d.first, *d.values.shape) for d in page], np.int64)
    return [shape.tobytes(), b"".join(d.values.astype(np.int32).tobytes() for d in page), b"".join(d.codes.astype(np.uint16).tobytes() for d in page)]


def _unpacked(shape: bytes, values: bytes, codes: bytes, rows: int) -> list[Dictionary]:
    v, c = np.frombuffer(values, np.int32).astype(np.int64), np.frombuffer(codes, np.uint16).astype(np.int64).reshape(-1, rows)
    out, at = [], 0
    for (first, n, width), own in zip(np.frombuffer(shape, np.int64).reshape(-1, 3).tolist(), c, strict=True):
        out.append(Dictionary(first, v[at : at + n * width].reshape(n, width), own))
        at += n * width
    return out


def _encode(dims: int, scale: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PAGE_ROWS):
                part = batch.slice(at, PAGE_ROWS)
                x = np.floor(np.asarray(part.column(1).flatten(), dtype=np.float64).reshape(-1, dims) * scale)
                if np.abs(x).max(initial=0) > LARGEST:
                    raise ValueError(f"a component times {scale} is beyond {LARGEST}")
                rows = part.column(0)
                packed = [pa.array([v], pa.binary()) for v in _packed(dictionaries(x.astype(np.int64)))]
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows), pa.array([len(rows)], pa.int64()), *packed], names=["rows", "n", "shape", "vals", "codes"])

    return encode


def _pages(batches: Iterator[pa.RecordBatch], first: int) -> Iterator[tuple[pa.RecordBatch, int, list[Dictionary]]]:
    for batch in batches:
        n, shape, vals, codes = (batch.column(first + j) for j in range(4))
        for k in range(batch.num_rows):
            yield batch, k, _unpacked(shape[k].as_py(), vals[k].as_py(), codes[k].as_py(), n[k].as_py())


def _totals(centroids: np.ndarray):
    """One task's sums: (cluster, dim, n, total), so a task sends as many rows as all centroids have components."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for _, _, page in _pages(batches, 0):
            cluster = distances(page, centroids).argmin(axis=1)
            n += np.bincount(cluster, minlength=k)
            total += sums(page, cluster, k, dims)
        own = np.repeat(np.flatnonzero(n), dims)
        dim = np.tile(np.arange(dims), len(own) // dims)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(dim), pa.array(n[own]), pa.array(total[own, dim])], names=["cluster", "dim", "n", "total"])

    return run


def _assigned(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, k, page in _pages(batches, 1):
            d = distances(page, centroids)
            cluster = d.argmin(axis=1)
            rows = batch.column(0).slice(k, 1).flatten()
            yield pa.RecordBatch.from_arrays([rows, pa.array(cluster.astype(np.int32)), pa.array(d[np.arange(len(d)), cluster])], names=["row", "cluster", "distance"])

    return run


def usable(vector: Column, dims: int) -> Column:
    """Whether a vector has that many components, none null, NaN or infinite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) == dims) & ~bad, F.lit(False))


NEW = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def cluster_vectors(df: DataFrame, vector: str = "embedding", id_col: str = "vec_id", k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: str = "2", carry: tuple | None = None) -> DataFrame:
    """Every row with a usable vector, with cluster, distance, cluster_inertia, inertia and centroid_sha256 appended.

    1. Once: components become floor(scale * x), and each page of at most PAGE_ROWS vectors keeps the distinct subvectors of its blocks of dimensions and their codes,
       from which the integers can be read back without loss. Pages are a table in the shared folder; nothing is shuffled.
    2. A round: tasks get the centroids (k * dims numbers). A page computes the exact squared distances of its distinct subvectors once, a row's distance is the sum over
       its codes, ties go to the smaller number. Sums of clusters are made from counts of codes. What is shuffled is one row per task, cluster and dimension.
    3. New centroids are the exact floor of sum by count; empty clusters keep theirs. After the last round rows are assigned once more.

    The first centroids are the k vectors with the smallest sha256 of `seed:id`, in that order; equal ids go by their vectors, rows without id are never first centroids.

    Defined cases: rows whose vector is null, of another length, or holds null, NaN or infinite components are left out; with fewer than k vectors there are as many centroids as
    vectors; repeated rows count as often as they occur; an empty table gives an empty result; integers beyond 2^27 are an error. Columns of `carry` (None: all) are kept; those that clash with appended names are replaced.
    """
    kept = df.filter(usable(F.col(f"`{vector}`"), dims))
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(f"`{id_col}`").cast("string")).cast("binary"), 256)
    firsts = kept.select(key.alias("key"), F.col(f"`{vector}`").cast("array<double>").alias("vector")).filter("key is not null").orderBy("key", "vector").limit(k).collect()
    own = kept.select(*[f"`{c}`" for c in (carry or df.columns)])
    rows = kept.select(as_row(own, NEW), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    row_type = rows.schema["row"].dataType
    out = T.StructType([T.StructField("row", row_type), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    if not firsts:
        found = df.sparkSession.createDataFrame([], out)
        return found.select(*from_row(own, NEW), "cluster", "distance", *[F.lit(None).cast(t).alias(n) for n, t in zip(NEW[2:], ("long", "long", "string"), strict=True)])
    centroids = np.floor(np.array([r.vector for r in firsts]) * scale).astype(np.int64)
    paged = T.StructType([T.StructField("rows", T.ArrayType(row_type)), T.StructField("n", T.LongType()), *[T.StructField(c, T.BinaryType()) for c in ("shape", "vals", "codes")]])
    pages = stash(rows.mapInArrow(_encode(dims, scale), paged), "pages")
    with one_row_batches(df.sparkSession):
        for _ in range(rounds):
            parts = pages.select("n", "shape", "vals", "codes").mapInArrow(_totals(centroids), "cluster long, dim long, n long, total long")
            for r in parts.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
                centroids[r.cluster, r.dim] = r.total // r.n
        found = stash(pages.mapInArrow(_assigned(centroids), out), "assigned")
    each = {r.cluster: r.s for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    about = [(c, s, sum(each.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in each.items()]
    about = df.sparkSession.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select(*from_row(own, NEW), *NEW)


def op11_centroids(spark, sf_dir: str) -> DataFrame:
    return cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), carry=("vec_id",))


def _sql(k: int = 40, rounds: int = 5) -> str:
    """Rounds as chained steps: nearest centroid of each vector, then floors of componentwise means."""
    steps = [
        r"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x FROM (SELECT sha256('2:' || vec_id) AS h, x FROM v WHERE vec_id IS NOT NULL ORDER BY h, x LIMIT {k}))",
    ]
    for n in range(rounds + 1):
        steps.append(f"a{n} AS MATERIALIZED (SELECT r, vec_id, v.x, min({{'d': list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 'c': c.c}}) AS m FROM v, c{n} c GROUP BY ALL)")
        if n < rounds:
            steps.append(
                f"""c{n + 1} AS MATERIALIZED (
  SELECT c.c, coalesce(y, c.x) AS x FROM c{n} c LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS y FROM (SELECT m.c AS c, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n FROM a{n}, range(1, 65) t(i) GROUP BY ALL) GROUP BY c) g USING (c))"""
            )
    return (
        "WITH "
        + ",\n".join(steps)
        + f"""
SELECT vec_id, CAST(m.c AS INTEGER) AS cluster, CAST(m.d AS BIGINT) AS distance, CAST(sum(m.d) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(m.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.m.c = c.c
"""
    )


OP11_SQL = _sql()
