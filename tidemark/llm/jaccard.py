"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix with itself.

A document's row of the matrix is told by 128 bits of its set's digest, so equal sets are one row without any join. Entries carry whole
64-bit hashes of n-grams, and overlaps that decide links are counted on sets of the same hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components, extended
from .store import cut, frugal, frugal_group, small_batches
from .text import mix, shingle_sets, text_chunks

WORDS = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 80
#: A column of the matrix with at most so many documents gives all its pairs; a longer one goes by pivots.
LIGHT = 24
#: N-grams counted in more documents than this are put last by all.
FREQUENT = 64
#: Entries of the matrix that one block of columns should hold.
BLOCK_ENTRIES = 1_000_000
#: N-grams of the sets on one side of a cell, about 4 MB of hashes; the longer side of a group has four times as many.
CELL_GRAMS = 500_000
#: Bytes of text that become sets at once, which takes some 40 times as much.
CHUNK = 1 << 18
#: Bits of the maps that are broadcast, whatever the input: 2 MB.
MAP_BITS = 24
SEGMENT_BITS = 15


def _prefix(n: np.ndarray | int):
    """Of any order of n-grams, so many first ones of a document hold one that a linked document has among its own first ones."""
    return n - -(-PERCENT * n // 100) + 1


def _sets(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    for chunk in text_chunks(batch.column(at), CHUNK):
        yield chunk.first, shingle_sets(chunk, WORDS)


def _name(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, key, text) to (id, key, n, name): size and digest of the set."""
    for batch in batches:
        n, name = np.zeros(batch.num_rows, np.int64), [b""] * batch.num_rows
        for first, sets in _sets(batch, 2):
            for k, own in enumerate(sets, first):
                n[k], name[k] = len(own), _name(own)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n), pa.array(name, pa.binary())], names=["id", "key", "n", "name"])


def _deal(grams: np.ndarray, blocks: int) -> Iterator[tuple[int, np.ndarray]]:
    """Which entries go to each block of columns."""
    block = (mix(grams >> np.uint64(24)) % np.uint64(blocks)).astype(np.int64)
    order = np.argsort(block, kind="stable")
    at = np.flatnonzero(np.diff(block[order], prepend=-1))
    for a, b in zip(at.tolist(), [*at[1:].tolist(), len(order)], strict=True):
        yield int(block[order[a]]), order[a:b]


def _pack(h: np.ndarray, size: int = 8) -> bytes:
    """The upper bytes of hashes, byte by byte, so that sorted ones compress."""
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : -size - 1 : -1].T).tobytes()


def _unpacked(packed: list[bytes], size: int = 8) -> np.ndarray:
    out = []
    for x in packed:
        planes = np.frombuffer(x, np.uint8).reshape(size, -1)
        wide = np.zeros((planes.shape[1], 8), np.uint8)
        wide[:, : -size - 1 : -1] = planes.T
        out.append(wide.view("<u8").ravel())
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _column(table: pa.Table, name: str) -> list[bytes]:
    return [x for part in table.column(name).chunks for x in part.to_pylist()]


def _new_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[bytes, np.ndarray]]]:
    """(name, set) of each set with members that this task hasn't met: copies within a task are one."""
    seen: set[bytes] = set()
    for batch in batches:
        out = []
        for _, sets in _sets(batch, 0):
            for own in sets:
                if len(own) and (name := _name(own)) not in seen:
                    seen.add(name)
                    out.append((name, own))
        yield out


#: Bytes of an n-gram's hash in the counts that put frequent n-grams last, which needs no exact ones.
COUNTED = 5


def _first_grams(blocks: int) -> Callable:
    """(text) to packed n-grams by block with counts: how many of a batch's sets have them, or 1 for one set that has it among its first in the order of hashes."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for new in _new_rows(batches):
            if new:
                grams, many = np.unique(np.concatenate([own for _, own in new]), return_counts=True)
                first = np.unique(np.concatenate([own[: _prefix(len(own))] for _, own in new]))
                keep = many > 1
                keep[np.searchsorted(grams, first)] = True
                grams, many = grams[keep], many[keep].astype(np.int32)
                rows = [(b, _pack(grams[own], COUNTED), many[own].tobytes()) for b, own in _deal(grams, blocks)]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), *[pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2)]], names=["block", "grams", "counts"])

    return emit


def _place(h: np.ndarray) -> np.ndarray:
    """Where in a map of 2^MAP_BITS bits a hash has its bit."""
    return (mix(h) >> np.uint64(64 - MAP_BITS)).astype(np.int64)


def _gram_place(h: np.ndarray) -> np.ndarray:
    return _place(h >> np.uint64(64 - 8 * COUNTED))


def _frequent(table: pa.Table) -> pa.Table:
    """Places in the map of the n-grams of a block that were counted in more than FREQUENT sets."""
    grams, at = np.unique(_unpacked(_column(table, "grams"), COUNTED), return_inverse=True)
    many = np.bincount(at, weights=np.frombuffer(b"".join(_column(table, "counts")), np.int32), minlength=len(grams))
    place = np.unique(_gram_place(grams[many > FREQUENT]))
    return pa.table({"segment": place >> SEGMENT_BITS, "bit": place & ((1 << SEGMENT_BITS) - 1)})


def _bits(table: pa.Table) -> pa.Table:
    bits = np.zeros(1 << SEGMENT_BITS, bool)
    bits[np.asarray(table.column("bit").combine_chunks())] = True
    return pa.table({"segment": table.column("segment").slice(0, 1), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})


def _bitmap(places: DataFrame):
    """A broadcast map of the places (segment, bit): of one size for any input, put together on executors. Doubles go first, so a segment gathers each of its bits once."""
    out = np.zeros(1 << (MAP_BITS - 3), np.uint8)
    step = 1 << (SEGMENT_BITS - 3)
    for r in places.distinct().groupBy("segment").applyInArrow(_bits, "segment long, bits binary").toLocalIterator():
        out[r.segment * step : (r.segment + 1) * step] = np.frombuffer(bytes(r.bits), np.uint8)
    return places.sparkSession.sparkContext.broadcast(out)


def _is_set(bits: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1


def _entries(blocks: int, frequent) -> Callable:
    """(text) to packed entries by block of columns: of each set its first n-grams, those that are frequent behind all others.

    Per block a row has the columns of the entries, and per set its row's name, its size, and how many of the entries are its.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for new in _new_rows(batches):
            if not new:
                continue
            sizes = np.array([len(own) for _, own in new], np.int32)
            names = np.frombuffer(b"".join(name for name, _ in new), "<u8").reshape(-1, 2)
            late = _is_set(frequent.value, _gram_place(np.concatenate([own for _, own in new])))
            parts, free = [], 0
            for _, own in new:
                behind = late[free : free + len(own)]
                free += len(own)
                parts.append((np.concatenate([own[~behind], own[behind]]) if behind.any() else own)[: _prefix(len(own))])
            grams, doc = np.concatenate(parts), np.repeat(np.arange(len(new)), [len(x) for x in parts])
            rows = []
            for b, own in _deal(grams, blocks):
                docs, runs = np.unique(doc[own], return_counts=True)
                rows.append((b, _pack(grams[own]), names[docs].tobytes(), sizes[docs].tobytes(), runs.astype(np.int32).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), *[pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2, 3, 4)]], names=["block", "grams", "names", "sizes", "runs"])

    return emit


def _near_in_size(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return 100 * np.minimum(x, y) >= PERCENT * np.maximum(x, y)


def _product(table: pa.Table) -> pa.Table:
    """A block's part of the product: overlap counts (kind 0: a < b, count, sizes) of its light columns, entries (kind 1: document a, column gram) of the long ones."""
    grams = _unpacked(_column(table, "grams"))
    join = lambda name, kind: np.frombuffer(b"".join(_column(table, name)), kind)
    names, own_sizes, runs = join("names", "<u8").reshape(-1, 2), join("sizes", np.int32), join("runs", np.int32)
    by_name = np.lexsort((names[:, 1], names[:, 0]))
    fresh = np.ones(len(names), bool)
    fresh[1:] = (names[by_name[1:]] != names[by_name[:-1]]).any(axis=1)
    at_name = np.empty(len(names), np.int64)
    at_name[by_name] = np.cumsum(fresh) - 1
    ids = [x.tobytes() for x in names[by_name[fresh]]]
    sizes = np.zeros(len(ids), np.int64)
    sizes[at_name] = own_sizes
    doc = np.repeat(at_name, runs)
    order = np.lexsort((doc, grams))
    grams, doc = grams[order], doc[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
    grams, doc = grams[new], doc[new]
    first = np.ones(len(grams), bool)
    first[1:] = grams[1:] != grams[:-1]
    at = np.flatnonzero(first)
    many = np.diff(np.append(at, len(grams)))
    keys = [np.zeros(0, np.int64)]
    for length in np.unique(many[(many > 1) & (many <= LIGHT)]).tolist():
        rows = at[many == length][:, None] + np.arange(length)
        i, j = np.triu_indices(length, 1)
        a, b = doc[rows[:, i]].ravel(), doc[rows[:, j]].ravel()
        close = _near_in_size(sizes[a], sizes[b])
        keys.append(a[close] * len(ids) + b[close])
    pairs, count = np.unique(np.concatenate(keys), return_counts=True)
    a, b = pairs // max(1, len(ids)), pairs % max(1, len(ids))
    long = np.repeat(many > LIGHT, many)
    name_of = pa.array(ids, pa.binary())
    none = lambda n, kind: pa.array([None] * n, kind)
    return pa.table({
        "kind": np.concatenate([np.zeros(len(a), np.int32), np.ones(int(long.sum()), np.int32)]),
        "a": pa.concat_arrays([name_of.take(pa.array(a)), name_of.take(pa.array(doc[long]))]),
        "b": pa.concat_arrays([name_of.take(pa.array(b)), none(int(long.sum()), pa.binary())]),
        "gram": pa.concat_arrays([none(len(a), pa.int64()), pa.array(grams[long].view(np.int64))]),
        "c": np.concatenate([count, np.ones(int(long.sum()), np.int64)]),
        "na": np.concatenate([sizes[a], sizes[doc[long]]]),
        "nb": np.concatenate([sizes[b], np.zeros(int(long.sum()), np.int64)]),
    })


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key) to (segment, bit)."""
    for batch in batches:
        place = _place(np.asarray(batch.column(0)).view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(place >> SEGMENT_BITS), pa.array(place & ((1 << SEGMENT_BITS) - 1))], names=["segment", "bit"])


def _wanted_texts(wanted) -> Callable:
    """(key, text) to (key, packed) of the wanted documents, and of few others that fall on their bits: compressed texts are a fraction of their sets."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            keys = np.asarray(batch.column(0))
            hit = np.flatnonzero(_is_set(wanted.value, _place(keys.view(np.uint64))))
            raw = [t.encode() for t in batch.column(1).take(pa.array(hit)).to_pylist()]
            packed = [len(t).to_bytes(8, "little") + codec.compress(t, asbytes=True) for t in raw]
            yield pa.RecordBatch.from_arrays([pa.array(keys[hit]), pa.array(packed, pa.binary())], names=["key", "packed"])

    return emit


def _with_texts(ends: DataFrame, rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """`ends` (node, ...) with the name of each node's set and its packed text, fetched once for all the rows of a node."""
    own = nodes.join(ends.select("node").distinct().hint("merge"), "node", "left_semi").select("node", "key", "name")
    wanted = _bitmap(own.select("key").mapInArrow(_places, "segment long, bit long"))
    texts = rows.filter("text IS NOT NULL").select("key", "text").mapInArrow(frugal(_wanted_texts(wanted)), "key long, packed binary").groupBy("key").agg(F.first("packed").alias("packed"))
    return ends.join(own.join(texts.hint("merge"), "key").select("node", "name", "packed").hint("merge"), "node")


def _set_of(name: bytes, packed: list[bytes]) -> np.ndarray:
    """The set with that name, made anew from its text."""
    for x in packed:
        text = pa.Codec("zstd").decompress(x[8:], int.from_bytes(x[:8], "little"), asbytes=True).decode()
        (chunk,) = text_chunks(pa.array([text]))
        (own,) = shingle_sets(chunk, WORDS)
        if _name(own) == name:
            return own
    raise RuntimeError("a text doesn't have the set that was counted before: the table has changed meanwhile")


def _common(p: np.ndarray, q: np.ndarray) -> int:
    p, q = (p, q) if len(p) < len(q) else (q, p)
    return int((q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p).sum())


def _enough(common, na, nb):
    return (100 + PERCENT) * common >= PERCENT * (na + nb)


def _linked_pairs(table: pa.Table) -> pa.Table:
    """A forest of the links among the pairs of some cells, those with the largest counts first: pairs that it joins already need no look at their sets."""
    cell, x, y, z = (np.asarray(table.column(k).combine_chunks()) for k in ("cell", "node", "other", "c"))
    is_pair = z >= 0
    name, packed = _column(table, "name"), _column(table, "packed")
    out = []
    order = np.lexsort((y, x, -z, is_pair, cell))
    for own in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1) if len(order) else []:
        held: dict[int, list[int]] = {}
        for k in own[~is_pair[own]].tolist():
            held.setdefault(int(x[k]), []).append(k)
        sets: dict[int, np.ndarray] = {}
        parent = {v: v for v in held}

        def root(v: int) -> int:
            while parent[v] != v:
                parent[v] = parent[parent[v]]
                v = parent[v]
            return v

        def made(v: int) -> np.ndarray:
            if v not in sets:
                sets[v] = _set_of(name[held[v][0]], [packed[k] for k in held[v]])
            return sets[v]

        for k in own[is_pair[own]].tolist():
            a, b = int(x[k]), int(y[k])
            ra, rb = root(a), root(b)
            if ra != rb and _enough(_common(made(a), made(b)), len(made(a)), len(made(b))):
                parent[max(ra, rb)] = min(ra, rb)
                out.append((a, b))
    a, b = np.array(out, np.int64).reshape(-1, 2).T
    return pa.table({"a": a, "b": b})


def _linked_sides(table: pa.Table) -> pa.Table:
    """A forest of the links between the two sides of some cells, among sets in different components.

    The left side's n-grams are one sorted index; each set of the right side adds up its overlaps with all left ones at once.
    """
    cell, node, comp, side = (np.asarray(table.column(k).combine_chunks()) for k in ("cell", "node", "component", "side"))
    name, packed = _column(table, "name"), _column(table, "packed")
    out = []
    order = np.lexsort((node, side, cell))
    for own in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1) if len(order) else []:
        left, right = own[side[own] == 0], own[side[own] == 1]
        if not (len(left) and len(right)):
            continue
        parent = {c: c for c in comp[own].tolist()}

        def root(v: int) -> int:
            while parent[v] != v:
                parent[v] = parent[parent[v]]
                v = parent[v]
            return v

        sets = [_set_of(name[k], [packed[k]]) for k in left.tolist()]
        size = np.array([len(s) for s in sets], np.int64)
        grams, of = np.concatenate(sets), np.repeat(np.arange(len(left)), size)
        by = np.argsort(grams, kind="stable")
        grams, of = grams[by], of[by]
        for k in right.tolist():
            s = _set_of(name[k], [packed[k]])
            lo, hi = np.searchsorted(grams, s, "left"), np.searchsorted(grams, s, "right")
            many = hi - lo
            at = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(many.sum())
            common = np.bincount(of[at], minlength=len(left))
            for h in np.flatnonzero(_enough(common, size, len(s))).tolist():
                ra, rb = root(int(comp[left[h]])), root(int(comp[k]))
                if ra != rb:
                    parent[max(ra, rb)] = min(ra, rb)
                    out.append((int(node[left[h]]), int(node[k])))
    a, b = np.array(out, np.int64).reshape(-1, 2).T
    return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def _near(x: str, y: str) -> Column:
    return 100 * F.least(x, y) >= PERCENT * F.greatest(x, y)


def _behind(n: str) -> Column:
    return F.ceil(PERCENT * F.col(n) / 100) - 1


def _counted_pairs(part: DataFrame, named: DataFrame) -> DataFrame:
    """Pairs whose overlap may still suffice, with what was counted.

    Of two documents' first n-grams, the counted ones in common are c, and at most the smaller number of entries in long columns comes on
    top; behind the first n-grams of the document whose last one is earlier in the order lies all else that they can share.
    """
    end = lambda k: named.select(F.col("name").alias(k), F.col("node").alias(f"{k}_node"), F.col("u").alias(f"u{k}")).hint("merge")
    bound = F.col("c") + F.least("ua", "ub") + F.greatest(_behind("na"), _behind("nb"))
    return (
        part.filter("kind = 0").groupBy("a", "b", "na", "nb").agg(F.sum("c").alias("c")).join(end("a"), "a").join(end("b"), "b")
        .filter(_enough(bound, F.col("na"), F.col("nb"))).select(F.col("a_node").alias("a"), F.col("b_node").alias("b"), "c")
    )


def _all_to(n: str) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))


def _by_cells(ends: DataFrame, cell: list[str], rows: DataFrame, nodes: DataFrame, size: DataFrame, link: Callable, more: DataFrame | None = None) -> DataFrame:
    """Links (a, b) of the cells in `ends` (cell columns, node, ...), whose texts meet in tasks of about two cells' size, whatever the number of cells."""
    tasks = int(1 + (size.first()[0] or 0) // (2 * CELL_GRAMS))
    name = F.xxhash64(*cell).alias("cell")
    keep = [c for c in ends.columns if c not in cell]
    sent = _with_texts(ends, rows, nodes).select(name, *keep, "name", "packed")
    if more is not None:
        sent = sent.unionByName(more.select(name, *[c for c in more.columns if c not in cell]), allowMissingColumns=True)
    return cut(sent.groupBy(F.pmod(F.col("cell"), F.lit(tasks)).alias("task")).applyInArrow(frugal_group(link), "a long, b long"))


def _links_of_pairs(pairs: DataFrame, rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """A forest of links (a, b) among `pairs` (a, b, c), decided by whole sets.

    Pairs that others connect meet in one cell, so a text goes to its pairs once. Where that is too much for a cell, its documents
    are dealt to parts, and a cell holds the pairs of two parts.
    """
    group = components(pairs.select("a", "b"))
    member = group.select(F.col("id").alias("node"), F.col("component").alias("grp")).join(nodes.select("node", "n").hint("merge"), "node")
    parts = member.groupBy("grp").agg(F.ceil(F.sum("n") / CELL_GRAMS).alias("parts"))
    dealt = cut(member.join(parts.hint("merge"), "grp").select("node", "n", "grp", F.pmod(F.xxhash64("node"), F.col("parts")).alias("part")))
    end = lambda k: dealt.select(F.col("node").alias(k), F.col("grp"), F.col("part").alias(f"p{k}")).hint("merge")
    placed = cut(pairs.join(end("a"), "a").join(end("b").drop("grp"), "b").select("grp", F.least("pa", "pb").alias("x"), F.greatest("pa", "pb").alias("y"), "a", "b", "c"))
    cell = ["grp", "x", "y"]
    ends = placed.select(*cell, F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("c", F.lit(-1).cast("long"))
    size = ends.join(dealt.select("node", "n").hint("merge"), "node").agg(F.sum("n"))
    return _by_cells(ends, cell, rows, nodes, size, _linked_pairs, placed.select(*cell, F.col("a").alias("node"), F.col("b").alias("other"), "c"))


def _possible(table: pa.Table) -> pa.Table:
    """(grp, node, is_left) of the documents of some cells that another component's document may link with, as far as entries in long columns tell.

    A pair with a light column in common has been decided before, so only entries in long columns can make up what is missing
    to a link behind the first n-grams. Counts are added up as in `_linked_sides`, one right document at a time.
    """
    cell, grp, node, comp, side, n = (np.asarray(table.column(k).combine_chunks()) for k in ("cell", "grp", "node", "component", "side", "n"))
    lists = table.column("grams").combine_chunks()
    grams, border = np.asarray(lists.flatten()), np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths()))])
    hit = np.zeros(len(cell), bool)
    behind = -(-PERCENT * n // 100) - 1
    order = np.lexsort((node, side, cell))
    for own in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1) if len(order) else []:
        left, right = own[side[own] == 0], own[side[own] == 1]
        if not (len(left) and len(right)):
            continue
        of = np.repeat(np.arange(len(left)), border[left + 1] - border[left])
        index = np.concatenate([grams[border[k] : border[k + 1]] for k in left.tolist()])
        by = np.argsort(index, kind="stable")
        index, of = index[by], of[by]
        for k in right.tolist():
            mine = grams[border[k] : border[k + 1]]
            lo, hi = np.searchsorted(index, mine, "left"), np.searchsorted(index, mine, "right")
            many = hi - lo
            at = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(many.sum())
            bound = np.bincount(of[at], minlength=len(left)) + np.maximum(behind[left], behind[k])
            near = _enough(bound, n[left], n[k]) & _near_in_size(n[left], n[k]) & (comp[left] != comp[k])
            hit[left[near]] = True
            hit[k] |= bool(near.any())
    return pa.table({"grp": grp[hit], "node": node[hit], "is_left": side[hit] == 0})


def _links_in_long_columns(star: DataFrame, long: DataFrame, comp: DataFrame, rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links between documents of long columns that the links so far leave in different components.

    Documents of the columns with one pivot are a group. In a group all but its largest component are compared with what is in other
    components: first by their entries in long columns, which rule out nearly all, then by whole sets. For those, sizes are
    classed by powers of 5/4, so a link's ends are in the same class or in neighbouring ones. Both comparisons are dealt out as cells of bounded
    size; a task returns documents or a forest of its links, never its pairs.
    """
    group = star.select("node", "n", F.col("pivot").alias("grp")).unionByName(star.select(F.col("pivot").alias("node"), F.col("np").alias("n"), F.col("pivot").alias("grp")).distinct())
    member = group.join(comp.withColumnRenamed("id", "node").hint("merge"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    each = member.groupBy("grp", "component").agg(F.count("*").alias("many"))
    top = each.groupBy("grp").agg(F.max(F.struct("many", "component")).alias("t"), F.count("*").alias("k")).filter("k > 1").select("grp", F.col("t.component").alias("top"))
    open_ = cut(member.join(top.hint("merge"), "grp"))
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n))

    def in_cells(lefts: DataFrame, rights: DataFrame, key: list[str], weight: str) -> DataFrame:
        sized = lambda df, most, name: df.groupBy(*key).agg(F.ceil(F.sum(weight) / most).alias(name))
        parts = cut(sized(lefts, CELL_GRAMS, "pl").join(sized(rights, 4 * CELL_GRAMS, "pr").hint("merge"), key))
        put = lambda df, side, x, y: df.join(parts.hint("merge"), key).withColumn("l", x).withColumn("r", y).withColumn("side", F.lit(side)).drop("pl", "pr")
        return put(lefts, 0, own("pl"), _all_to("pr")).unionByName(put(rights, 1, _all_to("pl"), own("pr")))

    listed = open_.join(long.groupBy("node").agg(F.collect_list("gram").alias("grams")).hint("merge"), "node").withColumn("u", F.size("grams"))
    sides = in_cells(listed.filter("component <> top"), listed, ["grp"], "u")
    tasks = int(1 + (sides.agg(F.sum("u")).first()[0] or 0) // (2 * CELL_GRAMS))
    dealt = sides.select(F.xxhash64("grp", "l", "r").alias("cell"), "grp", "node", "component", "side", F.col("n").cast("long"), "grams")
    possible = dealt.groupBy(F.pmod(F.col("cell"), F.lit(tasks)).alias("task")).applyInArrow(frugal_group(_possible), "grp long, node long, is_left boolean").groupBy("grp", "node").agg(F.max("is_left").alias("is_left"))
    left = cut(open_.join(possible.hint("merge"), ["grp", "node"]).withColumn("class", F.floor(F.log("n") / F.log(F.lit(100 / PERCENT)))).select("grp", "class", "node", "n", "component", "is_left"))
    near = left.filter("is_left").withColumn("class", F.explode(F.array(F.col("class") - 1, F.col("class"), F.col("class") + 1)))
    sides = cut(in_cells(near.drop("is_left"), left.drop("is_left"), ["grp", "class"], "n"))
    return _by_cells(sides.drop("n"), ["grp", "class", "l", "r"], rows, nodes, sides.agg(F.sum("n")), _linked_sides)


def _contracted(docs: DataFrame, text: str, id_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What `near_components` puts together, each written: rows with the names of their sets, the sets, and components of those that are linked."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text")).withColumn("key", F.xxhash64("text", "id"))
    signed = cut(rows.select("id", "key", "text").mapInArrow(frugal(_names), "id long, key long, n long, name binary"))
    classes = signed.filter("n > 0").groupBy("name", "n").agg(F.min("id").alias("rep"), F.min("key").alias("key"))
    nodes = cut(classes.withColumn("node", F.monotonically_increasing_id()))
    total = nodes.agg(F.sum(F.col("n") - F.ceil(PERCENT * F.col("n") / 100) + 1)).first()[0] or 0
    blocks = int(16 + total // BLOCK_ENTRIES)
    frequent = _bitmap(rows.select("text").mapInArrow(frugal(_first_grams(blocks)), "block long, grams binary, counts binary").groupBy("block").applyInArrow(frugal_group(_frequent), "segment long, bit long"))
    entries = rows.select("text").mapInArrow(frugal(_entries(blocks, frequent)), "block long, grams binary, names binary, sizes binary, runs binary")
    part = cut(entries.groupBy("block").applyInArrow(frugal_group(_product), "kind int, a binary, b binary, gram long, c long, na long, nb long"))
    long = cut(part.filter("kind = 1").select(F.col("a").alias("name"), "gram", F.col("na").alias("n")).join(nodes.select("name", "node").hint("merge"), "name").select("node", "gram", "n"))
    uncounted = long.groupBy("node").agg(F.count("*").alias("u"))
    named = nodes.select("name", "node").join(uncounted.hint("merge"), "node", "left").select("name", "node", F.coalesce("u", F.lit(0)).alias("u"))
    light = cut(_counted_pairs(part, named))
    crowded = long.join(uncounted.hint("merge"), "node")
    share = F.col("u") / (F.col("n") - F.ceil(PERCENT * F.col("n") / 100) + 1)
    pivots = crowded.groupBy("gram").agg(F.max(F.struct(share.alias("share"), "node", "n")).alias("p")).select("gram", F.col("p.node").alias("pivot"), F.col("p.n").alias("np"))
    star = cut(crowded.join(pivots.hint("merge"), "gram").filter(F.col("node") != F.col("pivot")).groupBy("node", "n", "pivot", "np").agg(F.count("*").alias("c")))
    best_star = star.filter(_near("n", "np")).groupBy("node").agg(F.max(F.struct("c", "pivot")).alias("m")).select(F.least("node", "m.pivot").alias("a"), F.greatest("node", "m.pivot").alias("b"), F.col("m.c").alias("c"))
    ordered = light.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "c").unionByName(best_star)
    pairs = cut(ordered.groupBy("a", "b").agg(F.max("c").alias("c")))
    comp = components(_links_of_pairs(pairs, rows, nodes))
    comp = extended(comp, _links_in_long_columns(star, long, comp, rows, nodes))
    return signed, nodes, comp


def near_components(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, n_shingles, component_id) of every row of `docs`.

    1. Of every order of n-grams that all documents keep, linked documents share one among their first 20 %. Only those entries of the
       matrix are made, packed, and shuffled by blocks of columns. N-grams that many documents would put first are put last by all, by a map
       of fixed size, so columns are short unless documents consist of such n-grams.
    2. A block multiplies its columns: light columns give overlap counts of pairs near in size, summed up over blocks, and pairs
       below the bound of their sizes go. A long column (large groups of near copies) gives one pair per document, with the column's most typical one.
    3. Whole sets decide the pairs that are left. Their texts, which are a fraction of the sets, meet in cells of bounded size and become sets again
       there. Links are contracted to components.
    4. Documents of long columns that are still apart are compared cell by cell, by their entries and then by whole sets. So no pair of different
       texts is passed over, and no group gives all its pairs.

    Defined cases: null, empty and white texts have an empty set, link with nothing and are their own component; repeated rows are one row of the matrix; rows without id
    count as members, but never as a component's smallest id; an empty table gives an empty result.
    """
    with small_batches(docs.sparkSession):
        signed, nodes, comp = _contracted(docs, text, id_col)
    placed = nodes.select("name", "node", "rep").join(comp.withColumnRenamed("id", "node").hint("merge"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = placed.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_name = placed.join(least.hint("merge"), "component").select("name", "component_id")
    return signed.join(by_name.hint("merge"), "name", "left").select("id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def op4_near_documents(spark, sf_dir: str) -> DataFrame:
    return near_components(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumnRenamed("id", "doc_id")


OP4_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, hash(s) AS h FROM (
    SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0))),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 180 * c >= 80 * (p.n + q.n)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, e.y FROM reach r JOIN both_ways e ON r.y = e.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) c USING (doc_id)
"""
