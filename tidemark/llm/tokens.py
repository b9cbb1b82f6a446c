"""Token counts, attributed to sections of a text through the tokens' offsets."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import others

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the rank file's tokenizer splits text before its merges; a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("first", "most")

_loaded: dict[tuple[str, str], tuple] = {}


def encoding(ranks: str = RANKS, pattern: str = PATTERN):
    """The tokenizer of a rank file and the bytes of each of its tokens, once per process."""
    if (ranks, pattern) not in _loaded:
        import tiktoken

        with open(ranks, "rb") as f:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        sizes = np.zeros(max(merges.values()) + 1, np.int64)
        sizes[list(merges.values())] = [len(k) for k in merges]
        _loaded[ranks, pattern] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={}), sizes
    return _loaded[ranks, pattern]


#: Blanks in a row from which they are encoded apart from the text around them.
LONG_BLANK = 10_000
#: What the splitting pattern takes as blank: Unicode's white space. Python's own class has \x1c to \x1f too.
BLANK = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_BLANKS = re.compile(BLANK + "{%d,}" % LONG_BLANK)


def encode(enc, value: str, pattern: str = PATTERN) -> list[int]:
    """The tokens of a whole text.

    The splitting pattern goes back through a run of blanks one by one, and its stack ends at about a million. It always takes a run as one piece, less
    its last blank where more text follows. So long runs are cut out as that piece, whose merges are its own, and the tokens are those of the whole text.
    """
    ids, at = [], 0
    for run in _BLANKS.finditer(value) if pattern == PATTERN and len(value) >= LONG_BLANK else ():
        end = run.end() - (run.end() < len(value))
        ids += enc.encode_ordinary(value[at : run.start()]) + enc._encode_single_piece(value[run.start() : end])
        at = end
    return ids + enc.encode_ordinary(value[at:])


def attribute(token_ends: np.ndarray, section_ends: np.ndarray, rule: str = "first") -> tuple[np.ndarray, int]:
    """Tokens of each section, and how many tokens cross a border.

    Both are sorted ends of spans that cover the text from 0 without gaps, so the interval join is one binary search per token. A
    token belongs to the section of its first byte ("first"), or to that with most of its bytes, the earliest of equals ("most").
    """
    if not len(token_ends):
        return np.zeros(len(section_ends), np.int64), 0
    starts = np.concatenate([[0], token_ends[:-1]])
    first = np.searchsorted(section_ends, starts, side="right")
    last = np.searchsorted(section_ends, token_ends - 1, side="right")
    owner = first.copy()
    crossing = np.flatnonzero(first != last)
    if rule == "most":
        for k in crossing.tolist():
            cuts = np.concatenate([[starts[k]], section_ends[first[k] : last[k]], [token_ends[k]]])
            owner[k] = first[k] + int(np.argmax(np.diff(cuts)))
    return np.bincount(owner, minlength=len(section_ends)), len(crossing)


def line_ends(data: np.ndarray) -> np.ndarray:
    """Where the lines of a text end; a line's last byte is its line feed."""
    ends = np.flatnonzero(data == 10) + 1
    return ends if len(data) == 0 or (len(ends) and ends[-1] == len(data)) else np.append(ends, len(data))


NEW = T.StructType([
    T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_sections", T.LongType()), T.StructField("n_crossing", T.LongType()),
    T.StructField("first_tokens", T.LongType()), T.StructField("most_tokens", T.LongType()), T.StructField("section_tokens", T.ArrayType(T.LongType())),
])


def count_tokens(docs: DataFrame, text: str = "text", rule: str = "most", ranks: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """Every input row with n_bytes, n_tokens, n_sections, n_crossing, first_tokens, most_tokens and section_tokens appended.

    Sections are lines, each with its line feed. A whole text is encoded once, so a section's tokens are those that the model sees, not
    those of the section alone, and all sections' tokens sum up to the text's. Spans are of UTF-8 bytes,
    which the tokens of a byte-level vocabulary partition even where one ends within a character. Tokens over a border go by `rule`.

    A row is a matter of its own: no shuffle. Defined cases: null is an empty text, with no tokens and no sections; repeated rows are rows of
    their own; an empty table gives an empty result; columns that clash with appended names are replaced. Long texts are encoded whole, long runs of blanks included.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    kept = others(docs, NEW.names)
    rows = docs.select(*[f"`{c}`" for c in kept])
    schema = T.StructType([*rows.schema.fields, *NEW.fields])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, sizes = encoding(ranks, pattern)
        for batch in batches:
            column = pc.fill_null(batch.column(kept.index(text)), "")
            table = np.zeros((batch.num_rows, 6), np.int64)
            sections = []
            for k in range(len(column)):
                value = column[k].as_py()
                data = np.frombuffer(value.encode(), np.uint8)
                ids = encode(enc, value, pattern)
                borders = line_ends(data)
                own, crossing = attribute(np.cumsum(sizes[ids]) if ids else np.zeros(0, np.int64), borders, rule)
                sections.append(own)
                table[k] = len(data), len(ids), len(borders), crossing, own[0] if len(own) else 0, own.max() if len(own) else 0
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in sections])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, np.int64), *sections])))
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(table[:, j]) for j in range(6)], lists], names=schema.names)

    return rows.mapInArrow(count, schema)


def op8_token_counts(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return count_tokens(docs).withColumn("section_tokens", F.array_join("section_tokens", ",")).drop("text")
