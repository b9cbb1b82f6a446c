"""Ranked lexical search with MaxScore, its bounds tightened by lists of term pairs."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import frugal, one_row_batches, small_batches, stash
from .text import ALNUM, text_chunks, words

#: Bytes of text of one block of the index.
BLOCK_BYTES = 4 << 20
#: Bytes of item texts whose terms are searched for at once.
ITEM_BYTES = 2 << 20
TOP = 10

INDEX = "ids array<long>, n_docs long, n_terms long, lengths binary, terms binary, first binary, docs binary, tf binary"
LISTS = "ids array<long>, n long, term_first binary, term_docs binary, term_scores binary, pair_first binary, pair_docs binary, pair_scores binary"


def _block(ids: list, lengths: list[np.ndarray], hashes: list[np.ndarray]) -> list:
    n, h = np.concatenate(lengths), np.concatenate(hashes)
    doc = np.repeat(np.arange(len(n), dtype=np.int32), n)
    order = np.argsort(h, kind="stable").astype(np.int32)
    h, doc = h[order], doc[order]
    del order
    new_term = np.append(True, h[1:] != h[:-1])[: len(h)]
    new = new_term.copy()
    new[1:] |= doc[1:] != doc[:-1]
    at = np.flatnonzero(new)
    tf = np.diff(np.append(at, len(h)))
    first = np.append(np.flatnonzero(new_term[at]), len(at))
    return [ids, int((n > 0).sum()), int(n.sum()), *(x.tobytes() for x in (n.astype(np.int64), h[at][first[:-1]], first.astype(np.int64), doc[at], tf.astype(np.int64)))]


def _record(rows: list[list], schema: str) -> pa.RecordBatch:
    kinds = {"array<long>": pa.list_(pa.int64()), "long": pa.int64(), "binary": pa.binary()}
    names, types = zip(*(x.split(" ") for x in schema.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[t]) for k, t in enumerate(types)], names=list(names))


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, lengths, hashes, size = [], [], [], 0
        for chunk in text_chunks(batch.column(1)):
            found = words(chunk, ALNUM)
            ids += batch.column(0).slice(chunk.first, len(chunk.offsets) - 1).to_pylist()
            lengths.append(np.diff(found.offsets))
            hashes.append(found.hash)
            size += len(chunk.data)
            if size >= BLOCK_BYTES:
                yield _record([_block(ids, lengths, hashes)], INDEX)
                ids, lengths, hashes, size = [], [], [], 0
        if ids:
            yield _record([_block(ids, lengths, hashes)], INDEX)


def build_index(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The inverted index of all terms of all documents, in blocks of about 4 MB of text: sorted terms (64-bit hashes), and for each its documents and frequencies."""
    with small_batches(docs.sparkSession):
        return stash(docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(frugal(_index), INDEX), "index", group_rows=1)


class Queries(NamedTuple):
    """What one pass searches for."""

    terms: np.ndarray  # sorted hashes
    items: list[np.ndarray]  # the numbers of each item's terms


def _queries(texts: list[str | None]) -> Queries:
    own = []
    for chunk in text_chunks(pa.array(texts, pa.large_string())):
        found = words(chunk, ALNUM)
        own += [np.unique(found.hash[a:b]) for a, b in zip(found.offsets[:-1].tolist(), found.offsets[1:].tolist(), strict=True)]
    terms = np.unique(np.concatenate([np.zeros(0, np.uint64), *own]))
    return Queries(terms, [np.searchsorted(terms, h) for h in own])


def _get(batch: pa.RecordBatch, name: str, k: int, kind: type) -> np.ndarray:
    return np.frombuffer(batch.column(batch.schema.names.index(name))[k].as_py(), kind)


def _frequencies(terms: np.ndarray):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(terms), np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                own, first = _get(batch, "terms", k, np.uint64), _get(batch, "first", k, np.int64)
                if len(own):
                    at = np.minimum(np.searchsorted(own, terms), len(own) - 1)
                    df += np.where(own[at] == terms, first[at + 1] - first[at], 0)
        hit = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(df[hit])], names=["term", "df"])

    return count


class Plan(NamedTuple):
    """Weights of the terms of a pass, and the pairs of terms whose lists are kept."""

    queries: Queries
    weight: np.ndarray
    total: int  # N
    length: int  # L
    units: list[np.ndarray]  # for each item its units: rows of (pair, term, other term); pair and other are -1 for a term left over
    pairs: np.ndarray  # distinct pairs


def _plan(queries: Queries, df: np.ndarray, total: int, length: int) -> Plan:
    """The terms of an item in falling order of weight, two by two: rare terms have the largest impacts and are least often together, so their joint maximum says most."""
    weight = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    numbers: dict[tuple[int, int], int] = {}
    units = []
    for own in queries.items:
        order = own[np.lexsort((own, -weight[own]))].tolist()
        rows = [(numbers.setdefault((min(a, b), max(a, b)), len(numbers)), a, b) for a, b in zip(order[::2], order[1::2], strict=False)]
        rows += [(-1, order[-1], -1)] if len(order) % 2 else []
        units.append(np.array(rows, np.int64).reshape(-1, 3))
    return Plan(queries, weight, total, length, units, np.array(list(numbers), np.int64).reshape(-1, 2))


def _ranges(first: np.ndarray, k: int) -> slice:
    return slice(int(first[k]), int(first[k + 1]))


#: Steps of a doubling in which the best scores of a unit are counted.
STEPS = 16


def _lists(shared):
    """Index blocks to the lists of the pass's terms and pairs, with scores. A pair's list holds the documents of both terms and their joint scores."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p: Plan = shared.value
        terms = p.queries.terms
        for batch in batches:
            for k in range(batch.num_rows):
                own, first, docs, tf, n = (_get(batch, c, k, t) for c, t in (("terms", np.uint64), ("first", np.int64), ("docs", np.int32), ("tf", np.int64), ("lengths", np.int64)))
                m = 10 + 90 * n * p.total // max(p.length, 1)
                at = np.minimum(np.searchsorted(own, terms), max(len(own) - 1, 0))
                there = own[at] == terms if len(own) else np.zeros(len(terms), bool)
                many = np.where(there, first[at + 1] - first[at], 0) if len(own) else np.zeros(len(terms), np.int64)
                from_ = np.where(there, first[at], 0) if len(own) else many
                t_first = np.append(0, np.cumsum(many))
                take = np.repeat(from_ - t_first[:-1], many) + np.arange(t_first[-1])
                t_docs = docs[take]
                t_scores = np.repeat(p.weight, many) * (1_000_000_000 * tf[take] // (1000 * tf[take] + 8 * m[t_docs]))
                p_docs, p_scores, p_many = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], np.zeros(len(p.pairs), np.int64)
                for j, (a, b) in enumerate(p.pairs.tolist()):
                    if many[a] and many[b]:
                        x, y = _ranges(t_first, a), _ranges(t_first, b)
                        both, i, o = np.intersect1d(t_docs[x], t_docs[y], assume_unique=True, return_indices=True)
                        p_docs.append(both)
                        p_scores.append(t_scores[x][i] + t_scores[y][o])
                        p_many[j] = len(both)
                parts = [t_first, t_docs, t_scores, np.append(0, np.cumsum(p_many)), np.concatenate(p_docs), np.concatenate(p_scores)]
                ids = batch.column(batch.schema.names.index("ids"))[k].as_py()
                yield _record([[ids, len(ids), *(x.tobytes() for x in parts)]], LISTS)

    return make


class Block(NamedTuple):
    n: int
    t_first: np.ndarray
    t_docs: np.ndarray
    t_scores: np.ndarray
    p_first: np.ndarray
    p_docs: np.ndarray
    p_scores: np.ndarray

    def term(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        own = _ranges(self.t_first, t)
        return self.t_docs[own], self.t_scores[own]

    def most(self, scores: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Largest score of each list; 0 for an empty one."""
        out = np.zeros(len(first) - 1, np.int64)
        full = np.flatnonzero(first[1:] > first[:-1])
        if len(full):
            out[full] = np.maximum.reduceat(scores, first[full])
        return out


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, Block]]:
    names = [("term_first", np.int64), ("term_docs", np.int32), ("term_scores", np.int64), ("pair_first", np.int64), ("pair_docs", np.int32), ("pair_scores", np.int64)]
    for k in range(batch.num_rows):
        yield k, Block(batch.column(batch.schema.names.index("n"))[k].as_py(), *(_get(batch, c, k, t) for c, t in names))


def _best_of_units(shared):
    """(item, unit, step, n): the ten best scores of documents by one unit alone, counted by steps of a doubling; a document's score is at least that of any of its units."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p: Plan = shared.value
        best: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for _, b in _blocks(batch):
                sum_of = np.zeros(b.n, np.int64)
                for item, units in enumerate(p.units):
                    for u, (_, x, y) in enumerate(units.tolist()):
                        for t in (x, y) if y >= 0 else (x,):
                            docs, scores = b.term(t)
                            sum_of[docs] += scores
                        docs = np.concatenate([b.term(t)[0] for t in ((x, y) if y >= 0 else (x,))])
                        if len(docs):
                            docs = np.unique(docs)
                            own = np.concatenate([best.get((item, u), np.zeros(0, np.int64)), sum_of[docs]])
                            best[item, u] = np.partition(own, len(own) - TOP)[-TOP:] if len(own) > TOP else own
                            sum_of[docs] = 0
        rows = [(i, u, int(s), int(c)) for (i, u), v in best.items() for s, c in zip(*np.unique(np.floor(STEPS * np.log2(np.maximum(v[v > 0], 1))), return_counts=True), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in range(4)], names=["item", "unit", "step", "n"])

    return count


def _order(found: tuple) -> tuple:
    score, i = found
    return -score, i is None, i or 0


def _search_block(p: Plan, b: Block, ids, item: int, least: int, bound_t: np.ndarray, bound_p: np.ndarray) -> list[tuple[int, int | None]]:
    """The documents of a block that score at least `least` for an item, at most the ten best."""
    units = p.units[item]
    pair, x, y = units[:, 0], units[:, 1], units[:, 2]
    one, two = bound_t[x], np.where(y >= 0, bound_t[y], 0)
    joint = np.where(pair >= 0, bound_p[pair], 0) if len(bound_p) else np.zeros(len(pair), np.int64)
    bound = np.maximum(np.maximum(one, two), joint)
    if bound.sum() < least:
        return []
    order = np.argsort(bound, kind="stable")
    upto = np.cumsum(bound[order])
    rest = int(np.searchsorted(upto, least, side="left"))  # units that can't reach `least` all together
    score = np.zeros(b.n, np.int64)
    for u in order[rest:].tolist():
        for t in (x[u], y[u]) if y[u] >= 0 else (x[u],):
            docs, scores = b.term(t)
            score[docs] += scores
    open_ = np.flatnonzero(score)
    for k in range(rest - 1, -1, -1):
        open_ = open_[score[open_] + upto[k] >= least]
        if not len(open_):
            return []
        u = order[k]
        for t in (x[u], y[u]) if y[u] >= 0 else (x[u],):
            docs, scores = b.term(t)
            if len(docs):
                at = np.minimum(np.searchsorted(docs, open_), len(docs) - 1)
                score[open_] += np.where(docs[at] == open_, scores[at], 0)
    open_ = open_[(score[open_] >= least) & (score[open_] > 0)]
    if len(open_) > TOP:
        open_ = open_[score[open_] >= np.partition(score[open_], len(open_) - TOP)[-TOP]]
    return sorted(((int(score[d]), ids[d]) for d in open_.tolist()), key=_order)[:TOP]


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, least = shared.value
        least, best = list(least), [[] for _ in p.units]
        for batch in batches:
            for k, b in _blocks(batch):
                ids = batch.column(0)[k].as_py()
                bound_t, bound_p = b.most(b.t_scores, b.t_first), b.most(b.p_scores, b.p_first)
                for item, units in enumerate(p.units):
                    if len(units):
                        found = _search_block(p, b, ids, item, least[item], bound_t, bound_p)
                        if found:
                            best[item] = sorted(best[item] + found, key=_order)[:TOP]
                            if len(best[item]) == TOP:
                                least[item] = max(least[item], best[item][-1][0])
        rows = [(i, d, s) for i, own in enumerate(best) for s, d in own]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in range(3)], names=["item", "doc_id", "score"])

    return run


def _item_blocks(items: DataFrame, text: str, id_col: str, limit: int) -> Iterator[list[tuple]]:
    rows, size = [], 0
    for r in items.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text}`").cast("string").alias("t")).toLocalIterator(prefetchPartitions=False):
        more = len((r.t or "").encode()) + 16
        if rows and size + more > limit:
            yield rows
            rows, size = [], 0
        rows.append((r.i, r.t))
        size += more
    if rows:
        yield rows


def search(index: DataFrame, items: DataFrame, text: str = "text", id_col: str = "item_id", item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The ten best documents of each item: the item's id, rank, doc_id, score.

    Items come in blocks of `item_bytes` of text (a longer one is a block of its own), each a pass over the index, so what tasks get is bounded. A pass:

    1. Document frequencies of its terms, from the index. Each item's terms are paired.
    2. For each block of the index the lists of terms and of pairs: documents that have both, with their joint scores. Written to the shared folder.
    3. A first threshold of each item: ten documents reach it by one unit (a pair, or the term left over) alone. It is counted in steps, so tasks send a few rows a unit.
    4. A unit adds at most the largest of its two terms' and its pair's maxima to a document, which is below the sum of both terms' maxima where no document is best in both. In
       a block, units that together can't reach the threshold are looked up only for documents of the other units, and only while these can still reach it. Blocks whose bounds stay
       below are skipped. A task's own ten best raise the threshold.
    5. Tasks send at most ten documents an item; Spark ranks them.

    Terms are told apart by 64-bit hashes: of 10^4 terms searched for among 10^10, two are expected to meet with a chance of 5 in a million.

    Defined cases: null and empty texts have no terms, and items without any have no rows; repeated documents are documents of their own, in any order where they tie; repeated items are items of their own;
    equal scores go by ascending id, null ids last; empty tables give an empty result. Only the id and the text are read, so other columns may have any name.
    """
    spark = index.sparkSession
    kind = items.schema[id_col].dataType if id_col in items.columns else T.StringType()
    out = T.StructType([T.StructField(id_col, kind), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    all_of = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    results = []
    for rows in _item_blocks(items, text, id_col, item_bytes):
        with one_row_batches(spark):
            results += _pass(index, rows, kind, id_col, all_of.n, all_of.l)
    if not results:
        return spark.createDataFrame([], out)
    whole = results[0]
    for r in results[1:]:
        whole = whole.unionByName(r)
    return whole


def _pass(index: DataFrame, rows: list[tuple], kind: T.DataType, id_col: str, total: int | None, length: int | None) -> list[DataFrame]:
    """One block of items: a written table of their best documents, or nothing where no term can be found."""
    spark = index.sparkSession
    queries = _queries([t for _, t in rows])
    if not total or not len(queries.terms):
        return []
    df = np.zeros(len(queries.terms), np.int64)
    for r in index.select("terms", "first").mapInArrow(frugal(_frequencies(queries.terms)), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r.term] = r.df
    plan = _plan(queries, df, total, length)
    shared = spark.sparkContext.broadcast(plan)
    lists = stash(index.select("ids", "lengths", "terms", "first", "docs", "tf").mapInArrow(frugal(_lists(shared)), LISTS), "lists", group_rows=1)
    steps = lists.mapInArrow(frugal(_best_of_units(shared)), "item long, unit long, step long, n long").groupBy("item", "unit", "step").agg(F.sum("n").alias("n"))
    down = Window.partitionBy("item", "unit").orderBy(F.desc("step"))
    reached = steps.withColumn("upto", F.sum("n").over(down)).filter(F.col("upto") >= TOP).groupBy("item").agg(F.max("step").alias("step"))
    least = [0] * len(rows)
    for r in reached.collect():
        least[r.item] = math.floor(2 ** (r.step / STEPS) * (1 - 1e-9))
    more = spark.sparkContext.broadcast((plan, least))
    found = lists.mapInArrow(frugal(_search(more)), "item long, doc_id long, score long")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    names = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(rows)], T.StructType([T.StructField("item", T.LongType()), T.StructField("name", kind)]))
    ranked = found.withColumn("rank", rank).filter(F.col("rank") <= TOP).join(F.broadcast(names), "item")
    found = stash(ranked.select(F.col("name").alias(id_col), "rank", "doc_id", "score"), "found")
    shared.destroy()
    more.destroy()
    return [found]


def op13_search(spark, sf_dir: str) -> DataFrame:
    index = build_index(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return search(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: Every document's score for every item, from all term frequencies.
OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (SELECT row_number() OVER () AS i, item_id, list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
t AS (SELECT DISTINCT unnest(w) AS term FROM b),
s AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) JOIN t USING (term) GROUP BY r, term),
f AS (SELECT term, CAST(floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY term, n),
m AS (SELECT r, doc_id, 10 + (90 * len(w) * n) // l AS m FROM d, s),
e AS (SELECT r, term, w * ((1000000000 * tf) // (1000 * tf + 8 * m)) AS x FROM p JOIN f USING (term) JOIN m USING (r)),
g AS (SELECT i, item_id, r, CAST(sum(x) AS BIGINT) AS score FROM (SELECT i, item_id, unnest(w) AS term FROM b) JOIN e USING (term) GROUP BY i, item_id, r),
k AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM g JOIN m USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 10
"""
