"""Secret scans: assignments, access keys, hex runs, and strings whose characters are too evenly spread."""

from __future__ import annotations

import bisect
import hashlib
import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .frames import others
from .store import frugal
from .text import Chunk, text_chunks

KINDS = ("assign", "access", "hex", "entropy")

_ASSIGN = re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")

#: Characters of strings that may be secrets.
_CANDIDATE = np.zeros(256, dtype=bool)
_CANDIDATE[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"]] = True
_HEX = np.zeros(256, dtype=bool)
_HEX[[*b"0123456789abcdef"]] = True

WINDOW = 20
#: Bits a character that a window needs, by the smallest class that holds the whole string.
LEAST_BITS = {"hex": 2.9, "alnum": 3.6, "base64": 3.7}

#: Well-known shapes that are no secrets: UUIDs, digests named as such, runs of one character, counting.
ALLOWED = re.compile(
    rb"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
    rb"|(?:sha1|sha256|sha512|md5)-[A-Za-z0-9+/=_-]+"
    rb"|(.)\1*"
    rb"|[_=-]*(?:0123456789|1234567890|abcdefghijklmnopqrstuvwxyz|ABCDEFGHIJKLMNOPQRSTUVWXYZ)+[_=-]*"
)

_TERM = [0.0, *[c * math.log2(c) for c in range(1, WINDOW + 2)]]


def _char_class(s: bytes) -> str | None:
    """None for strings of letters alone, digits alone, or without both letters and digits: words and numbers."""
    letters, digits = any(65 <= b <= 90 or 97 <= b <= 122 for b in s), any(48 <= b <= 57 for b in s)
    if not (letters and digits):
        return None
    if re.fullmatch(rb"[0-9a-f]+|[0-9A-F]+", s):
        return "hex"
    return "alnum" if s.isalnum() else "base64"


def entropy_spans(s: bytes) -> list[tuple[int, int]]:
    """Parts of a candidate string covered by windows of WINDOW characters with at least the class's bits.

    One step of the window changes two counts, so the sum of c*log2(c) is kept up and never computed anew.
    """
    kind = _char_class(s)
    if kind is None or len(s) < WINDOW or ALLOWED.fullmatch(s):
        return []
    counts = [0] * 256
    total, spans, top = 0.0, [], math.log2(WINDOW)
    for i, b in enumerate(s):
        total += _TERM[counts[b] + 1] - _TERM[counts[b]]
        counts[b] += 1
        if i >= WINDOW:
            old = s[i - WINDOW]
            total += _TERM[counts[old] - 1] - _TERM[counts[old]]
            counts[old] -= 1
        if i >= WINDOW - 1 and top - total / WINDOW >= LEAST_BITS[kind]:
            if spans and spans[-1][1] >= i - WINDOW + 1:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((i - WINDOW + 1, i + 1))
    return spans


def _runs(data: np.ndarray, kind: np.ndarray, border: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    n = len(data)
    inside = kind[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[1:n] = inside[1:] != inside[:-1]
    edge[border] = True
    edge[0] = edge[n] = True
    at = np.flatnonzero(edge)
    long = (at[1:] - at[:-1] >= least) & inside[at[:-1]]
    return zip(at[:-1][long].tolist(), at[1:][long].tolist(), strict=True)


def _occurrences(data: bytes, words: tuple[bytes, ...]) -> list[int]:
    found = set()
    for w in words:
        at = data.find(w)
        while at >= 0:
            found.add(at)
            at = data.find(w, at + 1)
    return sorted(found)


def find_spans(chunk: Chunk) -> list[tuple[int, str, int, int]]:
    """(text, kind, first byte, last byte + 1), both counted from the start of the chunk."""
    data = chunk.data.tobytes()
    border = chunk.offsets[(chunk.offsets > 0) & (chunk.offsets < len(data))]
    text_of = lambda at: int(np.searchsorted(chunk.offsets, at, side="right")) - 1
    found: list[tuple[int, str, int, int]] = []
    for kind, pattern, starts in (("assign", _ASSIGN, _occurrences(data.lower(), _ASSIGN_WORDS)), ("access", _ACCESS, _occurrences(data, (b"AKIA",)))):
        free = 0
        for at in starts:
            if at < free:
                continue
            k = text_of(at)
            if m := pattern.match(data, at, int(chunk.offsets[k + 1])):
                free = m.end()
                if len(m[1]) >= 6 if kind == "assign" else m.end() - m.start() >= 20:
                    found.append((k, kind, m.start(), m.end()))
    found += [(text_of(a), "hex", a, b) for a, b in _runs(chunk.data, _HEX, border, 24)]
    base = sorted((a, b) for _, _, a, b in found)
    begins, reach = [a for a, _ in base], list(itertools.accumulate((b for _, b in base), max))
    for a, b in _runs(chunk.data, _CANDIDATE, border, WINDOW):
        for x, y in entropy_spans(data[a:b]):
            before = bisect.bisect_right(begins, a + x)  # of the spans that begin no later, whether one reaches as far
            if not before or reach[before - 1] < a + y:
                found.append((text_of(a), "entropy", a + x, a + y))
    return found


def _spans_of_batch(column: pa.Array) -> dict[int, list[tuple[int, int, str, int, int]]]:
    """For each row with any: (first code point, order of kind, kind, code point after the last, ...)."""
    out: dict[int, list] = {}
    for chunk in text_chunks(column):
        found = find_spans(chunk)
        points = np.cumsum((chunk.data & 0xC0) != 0x80) if found else None  # code points up to each byte, it included
        upto = lambda at, points=points: int(points[at - 1]) if at else 0
        for k, kind, a, b in found:
            begin = int(chunk.offsets[k])
            start = upto(a) - upto(begin)
            out.setdefault(chunk.first + k, []).append((start, KINDS.index(kind), kind, start + b - a, a - begin))
    for spans in out.values():
        spans.sort()
    return out


NEW = T.StructType([T.StructField("n_assign", T.LongType()), T.StructField("n_access", T.LongType()), T.StructField("n_hex", T.LongType()), T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])


def scan_secrets(docs: DataFrame, text: str = "text", redact: str | None = None) -> DataFrame:
    """Every input row with n_assign, n_access, n_hex, base_sha256 and spans appended.

    spans has all spans as kind:start:end by start, then kind; base_sha256 is of those without kind entropy. With
    `redact`, each span's characters in the text are replaced by that string, overlapping spans by one.

    A row is scanned by itself, so there is no shuffle; texts are scanned as Arrow's bytes. An entropy span within another span
    is left out. Defined cases: null is an empty text (redacted: stays null); no spans give zeros, the
    digest of "" and ""; repeated rows are rows of their own; an empty table gives an empty result; columns that clash
    with appended names are replaced.
    """
    kept = others(docs, NEW.names)
    rows = docs.select(*[f"`{c}`" for c in kept])
    schema = T.StructType([*rows.schema.fields, *NEW.fields])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            column = batch.column(kept.index(text))
            spans = _spans_of_batch(column)
            n = batch.num_rows
            counts = {kind: np.zeros(n, np.int64) for kind in KINDS}
            digest, joined, texts = [nothing] * n, [""] * n, None
            for row, found in spans.items():
                for _, _, kind, _, _ in found:
                    counts[kind][row] += 1
                named = [(kind, f"{kind}:{a}:{b}") for a, _, kind, b, _ in found]
                joined[row] = ",".join(x for _, x in named)
                digest[row] = hashlib.sha256(",".join(x for kind, x in named if kind != "entropy").encode()).hexdigest()
            columns = list(batch.columns)
            if redact is not None and spans:
                texts = column.to_pylist()
                for row, found in spans.items():
                    texts[row] = _replaced(texts[row], [(a, b) for a, _, _, b, _ in found], redact)
                columns[kept.index(text)] = pa.array(texts, column.type)
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array(counts[k]) for k in KINDS[:3]], pa.array(digest, pa.string()), pa.array(joined, pa.string())], names=schema.names)

    return rows.mapInArrow(frugal(scan), schema)


def _replaced(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    out, free = [], 0
    for a, b in spans:
        if a >= free:
            out += [text[free:a], mark]
        free = max(free, b)
    return "".join([*out, text[free:]])


def op7_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan_secrets(docs).drop("text")
