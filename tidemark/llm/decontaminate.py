"""Benchmark decontamination by Wu-Manber multi-pattern search over words."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import others
from .store import frugal
from .text import ALNUM, LOWER, Chunk, Words, text_chunks, words

WINDOW = 10
BLOCK = 3  # words of a block
SHIFT_BITS = 18
#: Bytes of benchmark text whose windows are broadcast at once; a larger benchmark is searched for in several passes.
BLOCK_BYTES = 16 << 20
LANE = 512  # words of a document stretch that one cursor crosses

_STEP = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


class Patterns(NamedTuple):
    """All test strings of one length in words."""

    length: int
    block: int
    shift: np.ndarray  # by the low bits of a block's hash
    suffix: np.ndarray  # sorted hashes of last blocks
    first: np.ndarray  # where the strings with this suffix begin; one more than suffixes
    data: np.ndarray  # bytes of the strings' words, lower case
    at: np.ndarray  # where the words of each string, in the order of suffixes, stand in them
    sizes: np.ndarray  # and how many bytes they have
    item_first: np.ndarray  # where the items of a string begin; one more than strings
    items: np.ndarray


def _block_hash(h: np.ndarray, end: np.ndarray, block: int) -> np.ndarray:
    """Hash of the `block` words that end at each place."""
    out = np.zeros(len(end), dtype=np.uint64)
    for j in range(block):
        out += h[end - j] * _STEP[j]
    return out ^ (out >> np.uint64(29))


def compile_patterns(texts: list[str | None]) -> list[Patterns]:
    """Shift tables and suffix buckets for the windows of all items, by length."""
    strings: dict[int, dict[bytes, tuple[bytes, list[int], list[int]]]] = {}
    for chunk in text_chunks(pa.array(texts, pa.large_string())):
        found, low = words(chunk, ALNUM), LOWER[chunk.data].tobytes()
        spans = [low[a:b] for a, b in zip(found.start.tolist(), found.end.tolist(), strict=True)]
        for k, (a, b) in enumerate(zip(found.offsets[:-1].tolist(), found.offsets[1:].tolist(), strict=True)):
            length = min(WINDOW, b - a)
            for i in range(a, b - length + 1) if length else ():
                own = spans[i : i + length]
                at = strings.setdefault(length, {}).setdefault(b" ".join(own), (found.hash[i : i + length].tobytes(), [len(w) for w in own], []))[2]
                if not at or at[-1] != chunk.first + k:
                    at.append(chunk.first + k)
    out = []
    for length, own in sorted(strings.items()):
        hashes = np.frombuffer(b"".join(h for h, _, _ in own.values()), dtype=np.uint64).reshape(len(own), length)
        block = min(BLOCK, length)
        last = _columns_hash(hashes, length - 1, block)
        order = np.argsort(last, kind="stable")
        suffix, first = np.unique(last[order], return_index=True)
        shift = np.full(1 << SHIFT_BITS, length - block + 1, dtype=np.int64)
        for j in range(block - 1, length):
            key = (_columns_hash(hashes, j, block) & np.uint64((1 << SHIFT_BITS) - 1)).astype(np.int64)
            np.minimum.at(shift, key, length - 1 - j)
        values, keys = list(own.values()), list(own)
        ordered = [values[k] for k in order.tolist()]
        sizes = np.array([n for _, n, _ in ordered], dtype=np.int64)
        ends = np.cumsum(sizes + 1).reshape(sizes.shape)
        data = np.frombuffer(b"".join(keys[k] + b" " for k in order.tolist()), np.uint8)
        out.append(Patterns(length, block, shift, suffix, np.append(first, len(own)), data, ends - sizes - 1, sizes, np.cumsum([0, *(len(x) for *_, x in ordered)]), np.array([x for *_, xs in ordered for x in xs], dtype=np.int64)))
    return out


def _columns_hash(strings: np.ndarray, end: int, block: int) -> np.ndarray:
    out = np.zeros(len(strings), dtype=np.uint64)
    for j in range(block):
        out += strings[:, end - j] * _STEP[j]
    return out ^ (out >> np.uint64(29))


def _same_bytes(x: np.ndarray, at: np.ndarray, y: np.ndarray, to: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether x from `at` and y from `to` have the same `sizes` bytes, which are 1 or more."""
    if not len(sizes):
        return np.zeros(0, bool)
    begin = np.cumsum(sizes) - sizes
    step = np.arange(int(sizes.sum())) - np.repeat(begin, sizes)
    return np.logical_and.reduceat(LOWER[x[np.repeat(at, sizes) + step]] == y[np.repeat(to, sizes) + step], begin)


def occurrences(chunk: Chunk, found: Words, p: Patterns) -> tuple[np.ndarray, np.ndarray]:
    """First words and numbers of strings of all places where a string of `p` stands within one text.

    A cursor stands at the last word of a possible place. Where the shift of the block that ends there isn't 0, none of the
    places up to that shift can end a string, and it jumps. Otherwise the suffix's bucket gives the strings to compare. The words of a
    chunk are cut into lanes, and all lanes' cursors move at once.
    """
    n = len(found.hash)
    none = np.zeros(0, np.int64)
    if n < p.length:
        return none, none
    begin = np.arange(p.length - 1, n, LANE)
    until = np.minimum(begin + LANE, n)
    at, stops = begin.copy(), []
    while len(at):
        shift = p.shift[(_block_hash(found.hash, at, p.block) & np.uint64((1 << SHIFT_BITS) - 1)).astype(np.int64)]
        if (stop := at[shift == 0]).size:
            stops.append(stop)
        at = at + np.maximum(shift, 1)
        going = at < until
        at, until = at[going], until[going]
    if not stops:
        return none, none
    ends = np.concatenate(stops)
    key = _block_hash(found.hash, ends, p.block)
    bucket = np.minimum(np.searchsorted(p.suffix, key), len(p.suffix) - 1)
    hit = p.suffix[bucket] == key
    ends, bucket = ends[hit], bucket[hit]
    text_first = found.offsets[np.searchsorted(found.offsets, ends, side="right") - 1]
    inside = ends - p.length + 1 >= text_first
    ends, bucket = ends[inside], bucket[inside]
    many = p.first[bucket + 1] - p.first[bucket]
    starts = np.repeat(ends - p.length + 1, many)
    string = np.repeat(p.first[bucket], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    for j in range(p.length):  # direct comparison of words, byte by byte
        w = starts + j
        same = found.end[w] - found.start[w] == p.sizes[string, j]
        starts, string, w = starts[same], string[same], w[same]
        same = _same_bytes(chunk.data, found.start[w], p.data, p.at[string, j], p.sizes[string, j])
        starts, string = starts[same], string[same]
    return starts, string


def search_chunk(chunk: Chunk, patterns: list[Patterns]) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words, whether each is hit, and (text, item) pairs."""
    found = words(chunk, ALNUM)
    edge = np.zeros(len(found.hash) + 1, dtype=np.int64)
    texts, items = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for p in patterns:
        starts, string = occurrences(chunk, found, p)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + p.length, -1)
        many = p.item_first[string + 1] - p.item_first[string]
        items.append(p.items[np.repeat(p.item_first[string], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)])
        texts.append(np.repeat(np.searchsorted(found.offsets, starts, side="right") - 1, many))
    pairs = np.unique(np.stack([np.concatenate(texts), np.concatenate(items)]), axis=1)
    return found, np.cumsum(edge[:-1]) > 0, pairs[0], pairs[1]


def _benchmark_blocks(benchmark: DataFrame, text: str, id_col: str, limit: int) -> Iterator[tuple[list[str], list[str | None]]]:
    ids: list[str] = []
    texts: list[str | None] = []
    size = 0
    for row in benchmark.select(F.col(f"`{id_col}`").cast("string").alias("i"), F.col(f"`{text}`").alias("t")).filter("i is not null and t is not null").toLocalIterator(prefetchPartitions=False):
        ids.append(row.i)
        texts.append(row.t)
        size += len(row.t.encode())
        if size >= limit:
            yield ids, texts
            ids, texts, size = [], [], 0
    yield ids, texts


NEW = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def find_benchmark(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every input row with n_words, n_hit, n_items, items_sha256, items and contaminated appended.

    The benchmark is read in blocks of `block_bytes`, so that what is broadcast is bounded; each block is one pass
    over the documents, which carries the words hit so far as bits. There is no shuffle and no pairing of rows.

    Defined cases: null has no words; an item without words, null text or null id is never found; items that repeat
    count once per id; repeated documents are rows of their own; empty tables give empty or clean results; columns that
    clash with appended names are replaced.
    """
    kept = others(docs, (*NEW, "items"))
    mask = "_mask"
    while mask in {c.lower() for c in kept}:
        mask += "_"
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.lit(None).cast("binary").alias(mask), F.array().cast("array<string>").alias("items"))
    schema = T.StructType([*rows.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType())])
    for n, (ids, texts) in enumerate(_benchmark_blocks(benchmark, item_text, item_id, block_bytes)):
        if n and not ids:
            break
        shared = docs.sparkSession.sparkContext.broadcast((ids, compile_patterns(texts)))

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            names, patterns = shared.value
            for batch in batches:
                at, size = kept.index(text), batch.num_rows
                masks, items = batch.column(len(kept)).to_pylist(), batch.column(len(kept) + 1).to_pylist()
                n_words, n_hit = np.zeros(size, np.int64), np.zeros(size, np.int64)
                for chunk in text_chunks(batch.column(at)):
                    found, hit, doc, item = search_chunk(chunk, patterns)
                    borders = found.offsets
                    for k in np.unique(doc).tolist():
                        row, a, b = chunk.first + k, borders[k], borders[k + 1]
                        own = hit[a:b]
                        if masks[row] is not None:
                            own = own | np.unpackbits(np.frombuffer(masks[row], np.uint8), count=b - a).astype(bool)
                        masks[row] = np.packbits(own).tobytes()
                        items[row] = items[row] + [names[j] for j in item[doc == k].tolist()]
                    n_words[chunk.first : chunk.first + len(borders) - 1] = np.diff(borders)
                for row, m in enumerate(masks):
                    n_hit[row] = int(np.unpackbits(np.frombuffer(m, np.uint8)).sum()) if m else 0
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(masks, pa.binary()), pa.array(items, pa.list_(pa.string())), pa.array(n_words), pa.array(n_hit)], names=schema.names)

        rows = rows.select(*[f"`{c}`" for c in [*kept, mask, "items"]]).mapInArrow(frugal(scan), schema)
    items = F.array_sort(F.array_distinct("items"))
    return rows.withColumn("items", items).select(
        *[f"`{c}`" for c in kept], "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "items",
    )


def op3_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return find_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("text", "items")


#: Words as in `find_benchmark`; the parts of a document's words that equal an item's window, by length.
OP3_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
places AS (
  SELECT r, i, m, array_to_string(w[i:i + m - 1], ' ') AS s
  FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM windows) WHERE len(w) >= m)),
found AS (SELECT r, i, p.m, item_id FROM places p JOIN windows q ON p.m = q.m AND p.s = q.s),
hits AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS pos FROM found) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS xs FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(xs, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN its USING (r)
"""
