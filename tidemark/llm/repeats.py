"""Removal of repeated byte strings across documents, by suffix sorting in shards."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import as_row, from_row
from .induced import QUEUE_BYTES, equal_windows
from .store import one_row_batches, shared_dir, stash
from .text import Chunk, mix, text_chunks

LENGTH = 50
#: Bytes of text of a page of documents.
PAGE_BYTES = 4 << 20
#: Hashes of a bucket, bytes of segments of a shard.
BUCKET_HASHES, SHARD_BYTES = 1 << 19, 5 << 20
#: An anchor with more segments than this is dealt out by whole windows.
HOT = 100_000
#: Windows of a segment at most: the bits of a mask.
MASK = 64
LAST = np.iinfo(np.int64).max

_STEP = 0x9E3779B97F4A7C15


class Segments(NamedTuple):
    """Runs of windows of one document with the same anchor; equal ones have the same number."""

    start: np.ndarray  # first byte in the page
    windows: np.ndarray
    doc: np.ndarray  # row of the page
    number: np.ndarray
    first: np.ndarray  # of each number a segment that has it
    key: np.ndarray  # of each number its anchor
    least: np.ndarray  # of each number the smallest and the largest id
    most: np.ndarray


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` (a power of two) bytes from each place on."""
    h, step = data.astype(np.uint64) + np.uint64(1), 1
    while step < size:
        h = h[:-step] * np.uint64(pow(_STEP, step, 1 << 64)) + h[step:]
        step *= 2
    return mix(h)


def _anchors(chunk: Chunk, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows: anchor, first window, number of windows, text. The anchor of a window is the least hash of its grams, so equal windows have the same one wherever they stand."""
    gram = 1 << max(0, (length // 3).bit_length() - 1)
    wide = length - gram + 1
    if len(chunk.data) < length:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    least, size = _gram_hashes(chunk.data, gram), 1
    while size * 2 <= wide:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if wide > size:
        least = np.minimum(least[: size - wide], least[wide - size :])
    n = len(least)
    text = np.repeat(np.arange(len(chunk.offsets) - 1), np.diff(chunk.offsets))
    new = np.append(True, least[1:] != least[:-1])
    inside = chunk.offsets[(chunk.offsets > 0) & (chunk.offsets < n)]
    new[inside] = True
    ends = chunk.offsets[1:] - length + 1  # windows from here on reach over the end of their text
    new[ends[(ends > 0) & (ends < n)]] = True
    start = np.flatnonzero(new)
    many = np.diff(np.append(start, n))
    own = start + length <= chunk.offsets[text[start] + 1]
    start, many = start[own], many[own]
    parts = -(-many // MASK)
    step = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    start, many = np.repeat(start, parts) + MASK * step, np.minimum(MASK, np.repeat(many, parts) - MASK * step)
    return least[start], start, many, text[start]


def _content(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of the bytes from each start on."""
    out = np.zeros(len(start), np.uint64)
    for at in range(0, len(start), 1 << 14):
        a, n = start[at : at + (1 << 14)], size[at : at + (1 << 14)]
        begin = np.cumsum(n) - n
        step = np.arange(int(n.sum())) - np.repeat(begin, n)
        power = np.cumprod(np.full(int(n.max(initial=1)), _STEP, np.uint64))
        out[at : at + len(a)] = np.add.reduceat((data[np.repeat(a, n) + step].astype(np.uint64) + np.uint64(1)) * power[step], begin) + n.astype(np.uint64)
    return mix(out)


def _equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the `size` bytes from a and from b on are the same."""
    out = np.ones(len(a), bool)
    for at in range(0, len(a), 1 << 14):
        x, y, n = (v[at : at + (1 << 14)] for v in (a, b, size))
        begin = np.cumsum(n) - n
        step = np.arange(int(n.sum())) - np.repeat(begin, n)
        out[at : at + len(x)] = np.logical_and.reduceat(data[np.repeat(x, n) + step] == data[np.repeat(y, n) + step], begin)
    return out


def _numbered(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each segment, the same for the same bytes, and the first segment of each number. Hashes propose, bytes decide: one that differs from the first with its hash is a number of its own."""
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, first, number = np.unique(_content(data, start, size), return_index=True, return_inverse=True)
    number, to = number.reshape(-1), first[number.reshape(-1)]
    same = size == size[to]
    same[same] = _equal(data, start[same], start[to[same]], size[same])
    odd = np.flatnonzero(~same)
    number[odd] = len(first) + np.arange(len(odd))
    return number, np.append(first, odd)


def _extremes(number: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    least, most = np.full(n, LAST, np.int64), np.full(n, np.iinfo(np.int64).min, np.int64)
    np.minimum.at(least, number, ids)
    np.maximum.at(most, number, ids)
    return least, most


class Page(NamedTuple):
    data: np.ndarray
    offsets: np.ndarray
    ids: np.ndarray


def _page(batch: pa.RecordBatch, k: int) -> Page:
    """The k-th page of a batch with `ids` and `texts`."""
    names = batch.schema.names
    texts, ids = (batch.column(names.index(c)).slice(k, 1).flatten() for c in ("texts", "ids"))
    (chunk,) = text_chunks(texts, 1 << 62)
    return Page(chunk.data, chunk.offsets, np.asarray(ids.fill_null(LAST)))


def _page_anchors(page: Page, length: int) -> Iterator[tuple[int, int, tuple]]:
    """Anchors of a page, a run of texts of about 1 MB at a time, with the run's first byte and first text."""
    at, n = 0, len(page.offsets) - 1
    while at < n:
        to = min(n, max(at + 1, int(np.searchsorted(page.offsets, page.offsets[at] + (1 << 20), side="right")) - 1))
        a, b = int(page.offsets[at]), int(page.offsets[to])
        yield a, at, _anchors(Chunk(at, page.data[a:b], page.offsets[at : to + 1] - a), length)
        at = to


def _segments(page: Page, shared: np.ndarray, hot: np.ndarray, length: int) -> Segments:
    """The page's segments whose anchor is shared; those of hot anchors window by window, with the window's own hash as anchor. The same each time."""
    keys, starts, many, docs = ([np.zeros(0, d)] for d in (np.uint64, np.int64, np.int64, np.int64))
    for a, at, (key, start, windows, doc) in _page_anchors(page, length) if len(shared) else ():
        k = np.minimum(np.searchsorted(shared, key), len(shared) - 1)
        own = shared[k] == key
        key, start, windows, doc, burning = key[own], start[own], windows[own], doc[own], hot[k[own]]
        if burning.any():
            each = np.where(burning, windows, 1)
            step = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
            key, doc, burning = np.repeat(key, each), np.repeat(doc, each), np.repeat(burning, each)
            start, windows = np.repeat(start, each) + step, np.where(burning, 1, np.repeat(windows, each))
            key[burning] = _content(page.data, start[burning] + a, np.full(int(burning.sum()), length))
        keys.append(key)
        starts.append(start + a)
        many.append(windows)
        docs.append(doc + at)
    key, start, windows, doc = (np.concatenate(x) for x in (keys, starts, many, docs))
    number, first = _numbered(page.data, start, windows + length - 1)
    return Segments(start, windows, doc, number, first, key[first], *_extremes(number, page.ids[doc], len(first)))


def _runs(by: np.ndarray) -> tuple[np.ndarray, Iterator[tuple[int, slice]]]:
    """The order that sorts `by`, and each value with its place in it."""
    order = np.argsort(by, kind="stable")
    line = by[order]
    at = np.flatnonzero(np.append(True, line[1:] != line[:-1])[: len(line)]).tolist()
    return order, ((int(line[a]), slice(a, b)) for a, b in zip(at, [*at[1:], len(line)], strict=False))


def _to_pages(limit: int):
    """Documents to pages of about `limit` bytes of text; a page's number has the task's in its upper bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for chunk in text_chunks(batch.column(2), limit):
                part = batch.slice(chunk.first, len(chunk.offsets) - 1)
                one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
                yield pa.RecordBatch.from_arrays([pa.array([number]), one(part.column(0)), one(part.column(1)), one(part.column(2))], names=["page", "rows", "ids", "texts"])
                number += 1

    return run


MARKS = "bucket long, page long, one binary, more binary, times binary"


def _marks(buckets: int, length: int):
    """A page's distinct anchors by bucket: those of one id, and those of more with their number of segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                page = _page(batch, k)
                keys, ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
                for _, at, (key, _, _, doc) in _page_anchors(page, length):
                    keys.append(key)
                    ids.append(page.ids[doc + at])
                key, times = np.concatenate(keys), None
                order = np.argsort(key)
                key, own = key[order], np.concatenate(ids)[order]
                first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
                if not len(first):
                    continue
                times = np.diff(np.append(first, len(key))).astype(np.uint32)
                several = np.minimum.reduceat(own, first) != np.maximum.reduceat(own, first)
                key = key[first]
                order, runs = _runs((mix(key) % np.uint64(buckets)).astype(np.int64))
                key, several, times = key[order], several[order], times[order]
                rows = [(b, key[at][~several[at]].tobytes(), key[at][several[at]].tobytes(), times[at].tobytes() if several[at].all() else np.concatenate([times[at][~several[at]], times[at][several[at]]]).tobytes()) for b, at in runs]
                page_number = batch.column(0)[k].as_py()
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([page_number] * len(rows), pa.int64()), *(pa.array([r[j] for r in rows], pa.binary()) for j in (1, 2, 3))], names=["bucket", "page", "one", "more", "times"])

    return run


def _shared(hot: int):
    """One bucket: for each page the anchors that other pages, or other ids of the page, have too; whether they are hot; and how many segments they have on it."""

    def run(table: pa.Table) -> pa.Table:
        pages, keys, places, several, times = [], [], [], [], []
        for k, (page, one, more, n) in enumerate(zip(*(table[c].to_pylist() for c in ("page", "one", "more", "times")), strict=True)):
            key = np.concatenate([np.frombuffer(one, np.uint64), np.frombuffer(more, np.uint64)])
            pages.append(page)
            keys.append(key)
            places.append(np.full(len(key), k))
            several.append(np.arange(len(key)) >= len(one) // 8)
            times.append(np.frombuffer(n, np.uint32))
        key, place, several, times = (np.concatenate(x) for x in (keys, places, several, times))
        order = np.argsort(key, kind="stable")
        key, place, several, times = key[order], place[order], several[order], times[order].astype(np.int64)
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
        many = np.diff(np.append(first, len(key)))
        keep = np.repeat((many > 1) | np.logical_or.reduceat(several, first), many)
        burning = np.repeat(np.add.reduceat(times, first) > hot, many)
        key, place, burning, times = key[keep], place[keep], burning[keep], times[keep]
        order, runs = _runs(place)
        key, burning, times = key[order], burning[order], times[order]
        rows = [(pages[p], key[at].tobytes(), burning[at].tobytes(), int(times[at].sum())) for p, at in runs]
        return pa.table([pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int64(), pa.binary(), pa.binary(), pa.int64()))], names=["page", "shared", "hot", "n"])

    return run


def _told(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    """A page's shared anchors in order, and which are hot."""
    names = batch.schema.names
    shared, hot = (batch.column(names.index(c))[k].as_py() for c in ("shared", "hot"))
    key, burning = np.frombuffer(b"".join(shared or ()), np.uint64), np.frombuffer(b"".join(hot or ()), bool)
    order = np.argsort(key)
    return key[order], burning[order]


HEAD = np.dtype([("key", "<u8"), ("least", "<i8"), ("most", "<i8"), ("number", "<u4"), ("size", "<u4")])


SENT = "shard long, page long, n long, heads binary, size long, data binary"


def _packed(head: np.ndarray) -> bytes:
    """Heads field by field, compressed: ids that repeat and numbers that rise take little room so."""
    return pa.compress(b"".join(np.ascontiguousarray(head[f]).tobytes() for f in HEAD.names), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    raw, head, at = pa.decompress(data, HEAD.itemsize * n, codec="zstd", asbytes=True), np.empty(n, HEAD), 0
    for f in HEAD.names:
        head[f] = np.frombuffer(raw, HEAD[f], n, at)
        at += HEAD[f].itemsize * n
    return head


def _to_shards(shards: int, length: int):
    """Each page's different segments, packed by the shard of their anchor: heads and bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                page = _page(batch, k)
                s = _segments(page, *_told(batch, k), length)
                if not len(s.first):
                    continue
                head = np.zeros(len(s.first), HEAD)
                head["key"], head["least"], head["most"], head["number"], head["size"] = s.key, s.least, s.most, np.arange(len(s.first)), s.windows[s.first] + length - 1
                order, runs = _runs((mix(s.key ^ np.uint64(_STEP)) % np.uint64(shards)).astype(np.int64))
                head, start = head[order], s.start[s.first][order]
                rows = []
                for shard, at in runs:
                    n = head["size"][at].astype(np.int64)
                    step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                    text = page.data[np.repeat(start[at], n) + step].tobytes()
                    rows.append((shard, batch.column(0)[k].as_py(), len(n), _packed(head[at]), len(text), pa.compress(text, codec="zstd", asbytes=True)))
                names, kinds = zip(*(c.split() for c in SENT.split(", ")), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64() if t == "long" else pa.binary()) for j, t in enumerate(kinds)], names=list(names))

    return run


def _met_again(data: np.ndarray, start: np.ndarray, size: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of the segments whose hash is met again: segment, first window, number of windows. Equal windows have equal hashes, so none of the others has an equal one."""
    many = size - length + 1
    segment = np.repeat(np.arange(len(size)), many)
    window = np.arange(len(segment)) - np.repeat(np.cumsum(many) - many, many)
    wide = 1 << (length.bit_length() - 1)  # two grams that overlap are a window
    at, grams = start[segment] + window, _gram_hashes(data, wide) if len(segment) else np.zeros(0, np.uint64)
    h = grams[at] * np.uint64(_STEP) + grams[at + length - wide]
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    again = np.zeros(len(h), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    first = again & ((window == 0) | ~np.append(False, again[:-1])[: len(again)])
    return segment[first], window[first], np.bincount(np.cumsum(first)[again])[1:]


def _sorted_shard(length: int, limit: int):
    """One shard: for each page's segments the smallest id that has the segment, and which of its windows start in a document with a smaller id still.

    Equal segments are one. An anchor with one segment left has no window elsewhere, and neither has a window whose hash is met once. The others' bytes are one text, a separator
    behind each run of windows, whose suffixes are sorted by induction; those with a common prefix of `length` are one window.
    """

    def run(table: pa.Table) -> pa.Table:
        heads = [_unpacked(h, n) for h, n in zip(table["heads"].to_pylist(), table["n"].to_pylist(), strict=True)]
        place = np.repeat(np.arange(len(heads)), [len(h) for h in heads])
        head, pages = np.concatenate(heads), table["page"].to_pylist()
        data = np.frombuffer(b"".join(pa.decompress(x.as_buffer(), n, codec="zstd", asbytes=True) for x, n in zip(table["data"], table["size"].to_pylist(), strict=True)), np.uint8)
        del table, heads
        size = head["size"].astype(np.int64)
        start = np.cumsum(size) - size
        number, first = _numbered(data, start, size)
        owner, _ = _extremes(number, head["least"], len(first))
        _, of, many = np.unique(head["key"][first], return_inverse=True, return_counts=True)
        open_ = np.flatnonzero(many[of.reshape(-1)] > 1)
        mask = np.zeros(len(first), np.uint64)
        n = size[first[open_]]
        own = np.cumsum(n) - n
        body = data[np.repeat(start[first[open_]] - own, n) + np.arange(int(n.sum()))]
        segment, window, runs_of = _met_again(body, own, n, length)
        if len(segment):
            n = runs_of + length - 1
            end = np.cumsum(n + 1)
            begin = end - n - 1
            text = np.ones(int(end[-1]) + 1, np.int16)
            step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            text[np.repeat(begin, n) + step] = body[np.repeat(own[segment] + window, n) + step].astype(np.int16) + 2
            text[-1] = 0
            suffix, group = equal_windows(text, length, limit)
            line = np.argsort(group, kind="stable")
            suffix, group = suffix[line], group[line]
            run_of = np.searchsorted(begin, suffix, side="right") - 1
            inside = suffix + length < end[run_of]  # the others hold a separator
            suffix, group, run_of = suffix[inside], group[inside], run_of[inside]
            ids = owner[open_[segment[run_of]]]
            at = np.flatnonzero(np.append(True, group[1:] != group[:-1])[: len(group)])
            if len(at):
                least = np.repeat(np.minimum.reduceat(ids, at), np.diff(np.append(at, len(group))))
                gone = np.flatnonzero(least < ids)
                of_gone = run_of[gone]
                np.bitwise_or.at(mask, open_[segment[of_gone]], np.uint64(1) << (window[of_gone] + suffix[gone] - begin[of_gone]).astype(np.uint64))
        mask, owner = mask[number], owner[number]
        tell = np.flatnonzero((mask > 0) | (head["most"] > owner))
        order, runs = _runs(place[tell])
        tell = tell[order]
        rows = [(pages[p], head["number"][tell[at]].tobytes(), owner[tell[at]].tobytes(), mask[tell[at]].tobytes()) for p, at in runs]
        return pa.table([pa.array([r[j] for r in rows], pa.int64() if j == 0 else pa.binary()) for j in range(4)], names=["page", "numbers", "owners", "masks"])

    return run


def _removed(page: Page, s: Segments, numbers: np.ndarray, owners: np.ndarray, masks: np.ndarray, length: int) -> np.ndarray:
    """Which bytes of the page go. A segment of a larger id than its owner goes whole; of the owner's, the windows of the mask."""
    owner, mask = np.full(len(s.first), LAST, np.int64), np.zeros(len(s.first), np.uint64)
    owner[numbers], mask[numbers] = owners, masks
    edge = np.zeros(len(page.data) + 1, np.int32)
    ids = page.ids[s.doc]
    whole = ids > owner[s.number]
    np.add.at(edge, s.start[whole], 1)
    np.add.at(edge, s.start[whole] + s.windows[whole] + length - 1, -1)
    own = np.flatnonzero(~whole & (mask[s.number] > 0) & (ids == owner[s.number]))
    for j in range(MASK if len(own) else 0):
        at = s.start[own[(mask[s.number[own]] >> np.uint64(j)) & np.uint64(1) > 0]] + j
        np.add.at(edge, at, 1)
        np.add.at(edge, at + length, -1)
    return np.cumsum(edge[:-1], out=edge[:-1]) > 0


def _cut(length: int, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            for k in range(batch.num_rows):
                page = _page(batch, k)
                numbers, owners, masks = (np.frombuffer(b"".join(batch.column(names.index(c))[k].as_py() or ()), t) for c, t in (("numbers", np.uint32), ("owners", np.int64), ("masks", np.uint64)))
                gone = np.zeros(len(page.data), bool)
                if len(numbers):
                    gone = _removed(page, _segments(page, *_told(batch, k), length), numbers, owners, masks, length)
                upto = np.zeros(len(gone) + 1, np.int32)
                np.cumsum(gone, out=upto[1:])
                rise = gone.copy()
                rise[1:] &= ~gone[:-1]
                inside = page.offsets[:-1][page.offsets[:-1] < len(gone)]
                rise[inside] = gone[inside]
                rises = np.zeros(len(gone) + 1, np.int32)
                np.cumsum(rise, out=rises[1:])
                kept = [page.data[a:b][~gone[a:b]].tobytes() if upto[b] > upto[a] else page.data[a:b].tobytes() for a, b in zip(page.offsets[:-1].tolist(), page.offsets[1:].tolist(), strict=True)]
                n = np.diff(page.offsets)
                columns = [pa.array(n), pa.array(np.diff(upto[page.offsets]).astype(np.int64)), pa.array(np.diff(rises[page.offsets]).astype(np.int64)), pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())]
                rows = batch.column(names.index("rows")).slice(k, 1).flatten()
                yield pa.RecordBatch.from_arrays([rows, *columns, *([pa.array(kept, pa.binary())] if texts else [])], names=["row", *NEW, *(["kept"] if texts else [])])

    return run


NEW = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def remove_repeats(docs: DataFrame, text: str = "text", id_col: str = "doc_id", length: int = LENGTH, carry: tuple | None = None, kept_bytes: bool = True, page_bytes: int = PAGE_BYTES, hot: int = HOT, queue_bytes: int = QUEUE_BYTES) -> DataFrame:
    """Every input row with n_bytes, n_removed, n_spans, kept_sha256 and (if wanted) kept, the bytes that stay, appended.

    A byte goes if a string of `length` bytes that covers it also starts in a document with a smaller id; strings are judged on the input.

    1. Documents become pages of about `page_bytes` of text, a table in the shared folder bucketed by page, so that what is told to pages later is all that is shuffled.
    2. Each window of `length` bytes has an anchor, the least hash of its grams; runs of windows with one anchor are segments. Distinct anchors of a page
       meet in buckets, which tell pages those that other documents have too. No window of another anchor can occur elsewhere.
    3. Different segments of shared anchors go to the anchor's shard, so equal windows meet in one. Anchors with more than `hot` segments are dealt out by whole windows.
    4. Windows whose hash a shard meets once are unique. The rest of the shard is suffix-sorted by induction: queues carry suffixes and common prefixes, and go to disk beyond `queue_bytes`. Suffixes that share `length` bytes are one window, and its
       smallest id decides.
    5. Pages are told which segments or windows go, and drop their bytes.

    Hashes only propose: segments are the same if their bytes are, and windows by their order. Nothing is capped.

    Defined cases: null is the empty text; texts shorter than `length` lose nothing; rows with the same id are one document's, and take nothing from each other; null ids come after all others and are
    one document's; ids are whole numbers; an empty table gives an empty result. Columns of `carry` (None: all) are kept; those that clash with appended names are replaced.
    """
    spark = docs.sparkSession
    new = (*NEW, "kept") if kept_bytes else NEW
    own = docs.select(*[f"`{c}`" for c in (carry or docs.columns)])
    rows = docs.select(as_row(own, new), F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    row_type = rows.schema["row"].dataType
    total = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`").cast("string")))).first()[0] or 0
    many = int(min(100_000, max(spark.sparkContext.defaultParallelism, total // page_bytes)))
    paged = T.StructType([T.StructField("page", T.LongType()), T.StructField("rows", T.ArrayType(row_type)), T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("texts", T.ArrayType(T.StringType()))])
    table, path = f"repeats_{uuid.uuid4().hex}", f"{shared_dir(spark)}/repeats-{uuid.uuid4().hex}"
    rows.mapInArrow(_to_pages(page_bytes), paged).write.bucketBy(many, "page").option("path", path).saveAsTable(table)
    with one_row_batches(spark):
        pages = spark.table(table)
        texts = pages.select("page", "ids", "texts")
        marks = texts.mapInArrow(_marks(1 + total // (BUCKET_HASHES * length // 3), length), MARKS)
        told = stash(marks.groupBy("bucket").applyInArrow(_shared(hot), "page long, shared binary, hot binary, n long"), "told")
        shards = 1 + int(told.agg(F.sum("n")).first()[0] or 0) * (length * 4 // 3) // SHARD_BYTES
        each = told.groupBy("page").agg(F.collect_list("shared").alias("shared"), F.collect_list("hot").alias("hot")).hint("shuffle_hash")
        sent = texts.join(each, "page").select("page", "ids", "texts", "shared", "hot").mapInArrow(_to_shards(shards, length), SENT)
        found = stash(sent.groupBy("shard").applyInArrow(_sorted_shard(length, queue_bytes), "page long, numbers binary, owners binary, masks binary"), "gone")
        gone = found.groupBy("page").agg(*[F.collect_list(c).alias(c) for c in ("numbers", "owners", "masks")]).hint("shuffle_hash")
        out = T.StructType([T.StructField("row", row_type), *[T.StructField(c, T.LongType()) for c in NEW[:3]], T.StructField("kept_sha256", T.StringType()), *([T.StructField("kept", T.BinaryType())] if kept_bytes else [])])
        whole = pages.join(each, "page", "left").join(gone, "page", "left").select("rows", "ids", "texts", "shared", "hot", "numbers", "owners", "masks")
        result = stash(whole.mapInArrow(_cut(length, kept_bytes), out), "cut")
    spark.sql(f"DROP TABLE {table}")
    return result.select(*from_row(own, new), *new)


def op12_repeats(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), carry=("doc_id",), kept_bytes=False)


#: Windows as hexadecimal digits, two a byte; spans of windows that also start in a smaller document.
OP12_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, doc_id, p, substr(h, 2 * p + 1, 100) AS s FROM (SELECT r, doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS p FROM d WHERE len(h) >= 100)),
least AS (SELECT s, min(doc_id) AS m FROM w GROUP BY s HAVING count(*) > 1),
gone AS (SELECT r, p FROM w JOIN least USING (s) WHERE doc_id > m),
runs AS (SELECT r, p, sum(CAST(p - before > 50 AS INTEGER)) OVER (PARTITION BY r ORDER BY p) AS n FROM (SELECT r, p, lag(p, 1, p) OVER (PARTITION BY r ORDER BY p) AS before FROM gone)),
spans AS (SELECT r, n, min(p) AS a, max(p) + 50 AS b FROM runs GROUP BY r, n),
sums AS (SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY r),
pieces AS (
  SELECT r, a, substr(h, 2 * before + 1, 2 * (a - before)) AS s FROM (SELECT r, a, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS before FROM spans) JOIN d USING (r)
  UNION ALL SELECT r, b, substr(h, 2 * b + 1) FROM (SELECT r, max(b) AS b FROM spans GROUP BY r) JOIN d USING (r)),
kept AS (SELECT r, string_agg(s, '' ORDER BY a) AS k FROM pieces GROUP BY r)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN sums USING (r) LEFT JOIN kept USING (r)
"""
