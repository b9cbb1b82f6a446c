"""Quality classifier: a factorisation machine over hashed words, structure statistics and length."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import others
from .store import frugal
from .text import ALNUM, SPACED, Chunk, mix, text_chunks, words

WORD_BITS = 16
RANK = 8
#: Labelled rows that a fit may take, those with the smallest hash of their id.
FIT_ROWS = 6000
EPOCHS = 12
REJECT_BELOW = 0.3

#: Dense inputs: structure of the text and its length, each scaled to about 0..1.
STATS = ("log_chars", "log_words", "word_length", "capitals", "digits", "symbols", "marked_words", "bars", "new_lines", "distinct_words", "repeated_next", "repeated_lines", "beyond_ascii", "one")


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of flags between borders."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(np.float64)


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[[*chars]] = True
    return out


_CAPITAL, _DIGIT, _BAR, _LINE = _table(bytes(range(65, 91))), _table(b"0123456789"), _table(b"|"), _table(b"\n")
_SYMBOL = _table(bytes(b for b in range(33, 127) if not (48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123)))
_ASCII_LETTER = _table(bytes(range(65, 91)) + bytes(range(97, 123)))


class Features(NamedTuple):
    index: np.ndarray  # words' buckets, then the statistics' own places
    value: np.ndarray
    offsets: np.ndarray


def features(chunk: Chunk) -> Features:
    """Distinct hashed words of each whole text, each with weight 1/sqrt(distinct words), and its statistics."""
    data, n = chunk.data, len(chunk.offsets) - 1
    chars = np.diff(chunk.offsets).astype(np.float64)
    spaced, plain = words(chunk, SPACED), words(chunk, ALNUM)
    length = np.maximum(chars, 1)
    count = np.diff(spaced.offsets).astype(np.float64)
    some = np.maximum(count, 1)
    share = lambda table: _per_text(table[data], chunk.offsets) / length
    letters = np.maximum(_per_text(_ASCII_LETTER[data], chunk.offsets), 1)
    ends_marked = _SYMBOL[data[np.maximum(spaced.end - 1, 0)]] & _SYMBOL[data[np.maximum(spaced.end - 2, 0)]] & (spaced.end - spaced.start > 2) if len(spaced.end) else np.zeros(0, bool)
    again = np.zeros(len(spaced.hash), dtype=bool)
    again[1:] = spaced.hash[1:] == spaced.hash[:-1]
    bucket = (plain.hash >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    text_of = np.repeat(np.arange(n), np.diff(plain.offsets))
    key = np.unique(text_of * (1 << WORD_BITS) + bucket)
    per_text = np.bincount(key >> WORD_BITS, minlength=n)
    plain_count = np.maximum(np.diff(plain.offsets), 1)
    line_of = np.concatenate([[0], np.cumsum(_LINE[data])])[spaced.start] if len(spaced.start) else np.zeros(0, np.int64)
    repeated = _repeated_lines(spaced.hash, line_of, spaced.offsets)
    stats = np.stack(
        [
            np.log1p(chars) / 12, np.log1p(count) / 10, np.minimum(chars / some / 16, 2), _per_text(_CAPITAL[data], chunk.offsets) / letters, share(_DIGIT) * 4, share(_SYMBOL) * 4,
            _per_text(ends_marked, spaced.offsets) / some, _per_text(_BAR[data], chunk.offsets) / some, np.minimum(_per_text(_LINE[data], chunk.offsets) / some * 8, 2),
            per_text / plain_count, _per_text(again, spaced.offsets) / some, repeated / some, _per_text(data >= 0x80, chunk.offsets) / length * 2, np.ones(n),
        ],
        axis=1,
    )
    k = len(STATS)
    offsets = np.concatenate([[0], np.cumsum(per_text + k)])
    index, value = np.empty(offsets[-1], np.int32), np.empty(offsets[-1], np.float32)
    at = np.arange(len(key)) + (key >> WORD_BITS) * k
    index[at] = key & ((1 << WORD_BITS) - 1)
    value[at] = (1 / np.sqrt(np.maximum(per_text, 1)))[key >> WORD_BITS]
    tail = (offsets[1:] - k)[:, None] + np.arange(k)
    index[tail] = (1 << WORD_BITS) + np.arange(k)
    value[tail] = stats
    return Features(index, value, offsets)


def _repeated_lines(h: np.ndarray, line: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Words in lines that equal an earlier line of their text."""
    n = len(offsets) - 1
    if not len(h):
        return np.zeros(n)
    first = np.concatenate([[True], line[1:] != line[:-1]])
    first[offsets[:-1][offsets[:-1] < len(h)]] = True
    at = np.flatnonzero(first)
    place = (np.arange(len(h)) - np.repeat(at, np.diff(np.append(at, len(h))))).astype(np.uint64)
    sums = np.add.reduceat(mix(h + place * np.uint64(0x9E3779B97F4A7C15)), at)
    size = np.diff(np.append(at, len(h)))
    text = np.searchsorted(offsets, at, side="right") - 1
    order = np.lexsort((at, sums, text))
    same = np.zeros(len(at), dtype=bool)
    same[order[1:]] = (sums[order[1:]] == sums[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
    return np.bincount(text, weights=size * same, minlength=n)


class Machine(NamedTuple):
    bias: float
    linear: np.ndarray
    factors: np.ndarray


def raw_scores(m: Machine, f: Features) -> np.ndarray:
    """bias + <w, x> + the sum over pairs <v_i, v_j> x_i x_j = half of (|sum v_i x_i|^2 - sum |v_i x_i|^2)."""
    xv = m.factors[f.index] * f.value[:, None]
    begin = f.offsets[:-1]
    sums, squares = np.add.reduceat(xv, begin, axis=0), np.add.reduceat((xv * xv).sum(axis=1), begin)
    return m.bias + np.add.reduceat(m.linear[f.index] * f.value, begin) + 0.5 * ((sums * sums).sum(axis=1) - squares)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_machine(f: Features, label: np.ndarray, epochs: int = EPOCHS, batch: int = 64, rate: float = 0.08, decay: float = 1e-5) -> Machine:
    """Minibatch AdaGrad on the log loss; both labels weigh alike, up to 4 to 1. The same rows give the same machine."""
    rng = np.random.default_rng(7)
    size = (1 << WORD_BITS) + len(STATS)
    w, v = np.zeros(size, np.float32), rng.normal(0, 0.02, (size, RANK)).astype(np.float32)
    gw, gv = np.full(size, 1e-4, np.float32), np.full((size, RANK), 1e-4, np.float32)
    n = len(label)
    if not n:
        return Machine(0.0, w, v)
    share = np.clip(label.mean(), 0.05, 0.95)
    weight = np.where(label == 1, min(4.0, max(1.0, (1 - share) / share)), min(4.0, max(1.0, share / (1 - share))))
    bias = 0.0
    for _ in range(epochs):
        order = rng.permutation(n)
        for a in range(0, n, batch):
            rows = order[a : a + batch]
            length = f.offsets[rows + 1] - f.offsets[rows]
            own = np.concatenate([[0], np.cumsum(length)])
            at = np.repeat(f.offsets[rows] - own[:-1], length) + np.arange(own[-1])
            part = Features(f.index[at], f.value[at], own)
            g = ((sigmoid(raw_scores(Machine(bias, w, v), part)) - label[rows]) * weight[rows] / len(rows)).astype(np.float32)
            each = np.repeat(g, length) * part.value
            xv = v[part.index] * part.value[:, None]
            sums = np.repeat(np.add.reduceat(xv, own[:-1], axis=0), length, axis=0)
            used, place = np.unique(part.index, return_inverse=True)
            dw = np.bincount(place, weights=each).astype(np.float32) + decay * w[used]
            dv = np.zeros((len(used), RANK), np.float32)
            order2 = np.argsort(place, kind="stable")
            dv += np.add.reduceat((each[:, None] * (sums - xv))[order2], np.searchsorted(place[order2], np.arange(len(used))), axis=0)
            dv += decay * v[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            w[used] -= rate * dw / np.sqrt(gw[used])
            v[used] -= rate * 0.3 * dv / np.sqrt(gv[used])
            bias -= 0.02 * float(g.sum())
    return Machine(bias, w, v)


def held_out(id_col: str, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves that remainder; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % parts == part, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, rows: int, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(text, label) of at most `rows` labelled documents: the usable ones with the smallest hash of their id.

    Only the chosen ids are sent to all executors; their number is bounded by `rows`.
    """
    chosen = (
        labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label}`").cast("int").alias("_label"))
        .filter(F.col("_id").isNotNull() & F.col("_label").isin(0, 1))
        .groupBy("_id").agg(F.max("_label").alias("_label"))
        .filter(usable).orderBy(F.xxhash64("_id"), "_id").limit(rows)
    )
    return docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").alias("_text")).join(F.broadcast(chosen), "_id").select("_text", "_label")


def train(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", rows: int = FIT_ROWS) -> Machine:
    """A machine fitted on at most `rows` labelled rows, in one order whatever the partitions.

    Null texts are empty ones; repeated and tied rows each count; labels that are null or whose document is missing are left out; without
    labelled rows, every score is the same.
    """
    sample = labelled_sample(docs, labels, "quality", ~held_out("_id", 5, 0), rows, text, id_col)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = np.asarray(batch.column(1))
            for chunk in text_chunks(batch.column(0)):
                f = features(chunk)
                b = f.offsets.tolist()
                yield pa.RecordBatch.from_pydict({
                    "label": label[chunk.first : chunk.first + len(b) - 1],
                    "places": [f.index[x:y].tobytes() for x, y in zip(b[:-1], b[1:], strict=True)],
                    "values": [f.value[x:y].tobytes() for x, y in zip(b[:-1], b[1:], strict=True)],
                })

    got = sample.mapInArrow(frugal(gather), "label int, places binary, values binary").collect()
    got.sort(key=lambda r: (bytes(r.places), bytes(r["values"]), r.label))
    sizes = [len(r.places) // 4 for r in got]
    joined = Features(np.frombuffer(b"".join(bytes(r.places) for r in got), np.int32), np.frombuffer(b"".join(bytes(r["values"]) for r in got), np.float32), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))
    return fit_machine(joined, np.array([r.label for r in got], dtype=np.float32))


def score_quality(docs: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """Every input row with score (0 to 1, higher: label 1 likelier) appended; a column of that name is replaced.

    A row's score depends on its whole text alone. Null is scored as the empty text; repeated rows get the same score;
    an empty table gives an empty result.
    """
    kept = others(docs, ("score",))
    rows = docs.select(*[f"`{c}`" for c in kept])
    schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [sigmoid(raw_scores(shared.value, features(chunk)).astype(np.float64)) for chunk in text_chunks(batch.column(kept.index(text)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(out) if out else np.zeros(0))], names=schema.names)

    return rows.mapInArrow(frugal(score), schema)


def op1_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    machine = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(docs, machine).select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= REJECT_BELOW).cast("int").alias("predicted"))
