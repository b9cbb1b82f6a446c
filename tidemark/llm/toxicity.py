"""Toxicity: boosted trees over dense features of a whole text, calibrated by isotonic regression."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import as_row, from_row, others
from .quality import held_out, labelled_sample
from .store import cut
from .text import ALNUM, Chunk, mix, text_chunks, words

#: Labelled rows that a fit may take, those with the smallest hash of their id.
FIT_ROWS = 9000
#: A word or stem enters the lexicon with this many toxic texts, and by how much likelier toxic texts have it.
LEAST_TEXTS = 3
MEDIUM, STRONG = 1.5, 3.0
FLAG_FROM = 0.3

#: Entries are whole words and the first bytes of longer words, which endings don't change.
STEMS = (0, 6, 8)

#: Words for the one spoken to, fixed.
SECOND_PERSON = ("you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "euch", "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "vos", "usted", "ustedes", "ti", "tus", "vosotros")
NEAR = 5

NAMES = (
    *[f"{what}_{kind}" for kind in ("word", "stem6", "stem8") for what in ("strong", "medium", "weight", "strongest", "hits")],
    "second_person_near", "capitals", "shouted", "exclamations", "punctuation", "obfuscated", "stretched", "log_words",
)


class Lexicon(NamedTuple):
    hashes: tuple[np.ndarray, ...]  # sorted, by stem length
    weights: tuple[np.ndarray, ...]


def _stem_hashes(chunk: Chunk) -> tuple[list[np.ndarray], object]:
    found = words(chunk, ALNUM)
    out = [found.hash]
    low = np.where((chunk.data >= 65) & (chunk.data <= 90), chunk.data + 32, chunk.data).astype(np.uint64)
    for size in STEMS[1:]:
        h = np.zeros(len(found.start), np.uint64)
        long = found.end - found.start > size
        at = found.start[long]
        for j in range(size):
            h[long] = h[long] * np.uint64(0x100000001B3) + low[at + j] + np.uint64(1)
        out.append(np.where(long, mix(h + np.uint64(size)), np.uint64(0)))
    return out, found


_SECOND = None


def _second_person() -> np.ndarray:
    global _SECOND
    if _SECOND is None:
        (chunk,) = text_chunks(pa.array([" ".join(SECOND_PERSON)]))
        _SECOND = np.sort(words(chunk, ALNUM).hash)
    return _SECOND


def _find(sorted_: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(sorted_, keys), len(sorted_) - 1)
    return sorted_[at] == keys, at


def dense(chunk: Chunk, lexicon: Lexicon) -> np.ndarray:
    """One row of NAMES per text."""
    kinds, found = _stem_hashes(chunk)
    b = found.offsets
    n = len(b) - 1
    count = np.maximum(np.diff(b), 1).astype(np.float64)
    sums = lambda x, o: (lambda t: t[o[1:]] - t[o[:-1]])(np.concatenate([[0.0], np.cumsum(x, dtype=np.float64)]))
    columns, any_strong = [], np.zeros(len(found.hash), bool)
    for h, entries, weights in zip(kinds, lexicon.hashes, lexicon.weights, strict=True):
        is_in, at = _find(entries, h)
        w = np.where(is_in, weights[at] if len(weights) else 0.0, 0.0)
        strong = w >= STRONG
        any_strong |= strong
        top = np.zeros(n)
        np.maximum.at(top, np.repeat(np.arange(n), np.diff(b))[is_in], w[is_in])
        hits = sums(strong, b)
        columns += [hits / count, sums(is_in & ~strong, b) / count, sums(w, b) / count, top, np.log1p(hits)]
    second, _ = _find(_second_person(), found.hash)
    spread = np.concatenate([[0], np.cumsum(second)])
    m = len(found.hash)
    at = np.flatnonzero(any_strong)
    text = np.searchsorted(b, at, side="right") - 1
    near = spread[np.minimum(at + NEAR + 1, b[text + 1])] - spread[np.maximum(at - NEAR, b[text])] > 0 if m else np.zeros(0, bool)
    columns.append(np.bincount(text, weights=near, minlength=n) / count)
    data, o = chunk.data, chunk.offsets
    upper, lower, digit = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122), (data >= 48) & (data <= 57)
    letters = np.maximum(sums(upper | lower, o), 1)
    size = np.maximum(np.diff(o), 1)
    first_two = upper[np.minimum(found.start, max(0, len(data) - 1))] & upper[np.minimum(found.start + 1, max(0, len(data) - 1))] & (found.end - found.start > 1) if m else np.zeros(0, bool)
    odd = digit | (data == 64) | (data == 36) | (data == 42)
    inside = np.zeros(len(data), bool)
    if len(data) > 2:
        inside[1:-1] = odd[1:-1] & (upper | lower)[:-2] & (upper | lower)[2:]
    same = np.zeros(len(data), bool)
    if len(data) > 2:
        same[2:] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & (upper | lower)[2:]
    punct = (data == 33) | (data == 63) | (data == 46) | (data == 44) | (data == 59) | (data == 58)
    columns += [sums(upper, o) / letters, sums(first_two, b) / count, sums(data == 33, o) / size, sums(punct, o) / size, sums(inside, o) / count, sums(same, o) / count, np.log1p(count)]
    return np.stack(columns, axis=1)


def learn_lexicon(sample: DataFrame, ids: str = "_fold") -> list[Lexicon]:
    """Lexicons of fold 0, fold 1 and both, from (_text, _label, _fold).

    Texts that have each word or stem are counted per batch, then summed; only those with LEAST_TEXTS toxic texts
    come back, which the bounded sample bounds.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, fold = np.asarray(batch.column(1)), np.asarray(batch.column(2))
            for chunk in text_chunks(batch.column(0)):
                kinds, found = _stem_hashes(chunk)
                n = len(found.offsets) - 1
                text = np.repeat(np.arange(n), np.diff(found.offsets))
                cell = (label * 2 + fold)[chunk.first : chunk.first + n]
                for k, h in enumerate(kinds):
                    order = np.lexsort((text, h))
                    hs, ts = h[order], text[order]
                    new = np.ones(len(hs), bool)
                    new[1:] = (hs[1:] != hs[:-1]) | (ts[1:] != ts[:-1])
                    new &= hs != 0
                    hs, cells = hs[new], cell[ts[new]]
                    u, at = np.unique(hs, return_inverse=True)
                    table = np.zeros((len(u), 4), np.int64)
                    np.add.at(table, (at, cells), 1)
                    yield pa.RecordBatch.from_pydict({"kind": np.full(len(u), k, np.int32), "hash": u.view(np.int64), **{f"c{j}": table[:, j] for j in range(4)}})

    counts = sample.select("_text", "_label", "_fold").mapInArrow(count, "kind int, hash long, c0 long, c1 long, c2 long, c3 long")
    entries = counts.groupBy("kind", "hash").agg(*[F.sum(f"c{j}").alias(f"c{j}") for j in range(4)]).filter(F.col("c2") + F.col("c3") >= LEAST_TEXTS).collect()
    totals = {(r["_label"], r["_fold"]): r["n"] for r in sample.groupBy("_label", "_fold").agg(F.count("*").alias("n")).collect()}
    out = []
    for folds in ((0,), (1,), (0, 1)):
        toxic, clean = (sum(totals.get((y, f), 0) for f in folds) for y in (1, 0))
        hashes, weights = [], []
        for k in range(len(STEMS)):
            own = [(r["hash"], sum(r[f"c{2 + f}"] for f in folds), sum(r[f"c{f}"] for f in folds)) for r in entries if r["kind"] == k]
            h = np.array([x[0] for x in own], np.int64).view(np.uint64)
            a, z = np.array([x[1] for x in own], float), np.array([x[2] for x in own], float)
            w = np.log((a + 0.5) / (toxic + 1)) - np.log((z + 0.5) / (clean + 1))
            keep = (w >= MEDIUM) & (a >= LEAST_TEXTS)
            order = np.argsort(h[keep])
            hashes.append(h[keep][order])
            weights.append(w[keep][order])
        out.append(Lexicon(tuple(hashes), tuple(weights)))
    return out


def with_dense(docs: DataFrame, text: str, lexicons: list[Lexicon], fold: str | None = None) -> DataFrame:
    """Input rows with `_dense` appended; a row of fold f gets the lexicon of the other fold, so that no text is seen through its own words."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicons)
    names = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField("_dense", T.ArrayType(T.DoubleType()))])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for chunk in text_chunks(batch.column(names.index(text))):
                n = len(chunk.offsets) - 1
                if fold is None:
                    parts.append(dense(chunk, shared.value[-1]))
                else:
                    by_fold = [dense(chunk, shared.value[k]) for k in (1, 0)]
                    own = np.asarray(batch.column(names.index(fold)))[chunk.first : chunk.first + n]
                    parts.append(np.where((own == 0)[:, None], by_fold[0], by_fold[1]))
            rows = np.concatenate(parts) if parts else np.zeros((0, len(NAMES)))
            lists = pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * len(NAMES), pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=schema.names)

    return docs.mapInArrow(add, schema)


class Scorer(NamedTuple):
    lexicons: list[Lexicon]
    trees: object | None  # fitted models
    isotonic: object | None


def train(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", rows: int = FIT_ROWS) -> Scorer:
    """Trees on the whole sample, calibrated on scores that trees of the other half gave, so that no row is calibrated by trees that were fitted on it.

    Null texts are empty ones; repeated and tied rows each count; labels that are null or whose document is missing are left out. Without both
    labels in each half of the sample every score is 0.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.regression import IsotonicRegression

    sample = cut(labelled_sample(docs, labels, "toxic", ~held_out("_id", 4, 2), rows, text, id_col).withColumn("_fold", F.pmod(F.xxhash64("_text", F.lit(1)), F.lit(2)).cast("int")))
    lexicons = learn_lexicon(sample)
    ready = cut(with_dense(sample, "_text", lexicons, "_fold").select(array_to_vector("_dense").alias("features"), F.col("_label").cast("double").alias("label"), F.col("_fold").alias("fold")).repartition(6))
    seen = {(r.label, r.fold) for r in ready.select("label", "fold").distinct().collect()}
    if len(seen) < 4:
        return Scorer(lexicons, None, None)
    grown = lambda part: GBTClassifier(maxIter=20, maxDepth=3, stepSize=0.25, maxBins=64, minInstancesPerNode=2, seed=11).fit(part)
    raw = [grown(ready.filter(F.col("fold") != k)).transform(ready.filter(F.col("fold") == k)).select(vector_to_array("probability")[1].alias("raw"), "label") for k in (0, 1)]
    return Scorer(lexicons, grown(ready), IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="score").fit(cut(raw[0].unionByName(raw[1]))))


def score_toxicity(docs: DataFrame, scorer: Scorer, text: str = "text") -> DataFrame:
    """Every input row with score (0 to 1, higher: label 1 likelier) appended; a column of that name is replaced, any other name may occur.

    A row's score depends on its whole text alone. Null is scored as the empty text; repeated rows get the same score;
    an empty table gives an empty result. Ties of the trees' scores stay ties. The calibrated step score is
    nudged by a hundredth of the trees' own so that rows within one step keep the trees' order.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array

    if scorer.trees is None:
        return docs.select(*[F.col(f"`{c}`") for c in others(docs, ("score",))], F.lit(0.0).alias("score"))
    ready = with_dense(docs.select(as_row(docs, ("score",)), F.col(f"`{text}`").alias("text")), "text", scorer.lexicons).withColumn("features", array_to_vector("_dense"))
    scored = scorer.isotonic.transform(scorer.trees.transform(ready).withColumn("raw", vector_to_array("probability")[1]))
    return scored.select(*from_row(docs, ("score",)), (0.99 * F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score"))) + 0.01 * F.col("raw")).alias("score"))


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scorer = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_toxicity(docs, scorer).select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= FLAG_FROM).cast("int").alias("predicted"))
