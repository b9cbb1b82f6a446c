"""Near-duplicate embeddings by NN-descent, with an exact comparison of what its lists can't hold."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .store import cut

COSINE = 0.98
LIST, LONGEST = 8, 64  # entries of a neighbour list at first, and after all enlargements
CELL = 256  # vectors that meet in one group of a start table
TABLES = 10  # start tables of an attempt
CENTRE = 64  # members of a centre's group in a local join
ROUNDS = 6  # local joins of an attempt at most; it ends before when next to no list changes
STILL = 0.002  # share of lists
ATTEMPTS = 2  # after these, every vector is compared exactly
TASK_ROWS = 20_000  # vectors that one task of a join gets
PARTS = 8  # parts of a label's dense vectors, as long as parts are not above MOST
LEAST, MOST = 1024, 16384  # vectors that a part should hold
BLOCK = 512  # vectors that are compared at once in a task
AUDIT = 1000  # vectors that the audit compares with all others at once
AUDIT_LINKS = 200
RECALL = 0.97


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of unit vectors in double precision from a column of packed doubles."""
    n = len(column)
    flat = np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64)
    return flat.reshape(n, -1) if n else np.zeros((0, 1))


def _unit_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, vec, label) to (id, label, unit): only vectors that can link with something."""
    for batch in batches:
        ids, units, labels = [], [], []
        for i, v, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if i is None or y is None or not v or any(x is None for x in v):
                continue
            x = np.array(v, dtype=np.float64)
            top = np.abs(x).max()
            if not np.isfinite(x).all() or top == 0:
                continue
            x = x / top
            ids.append(i)
            labels.append(f"{y}/{len(x)}")
            units.append((x / np.sqrt((x * x).sum())).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(labels, pa.string()), pa.array(units, pa.binary())], names=["id", "label", "unit"])


def _start_cells(first: int) -> Callable:
    """(p, unit, planes) to (p, table, code): the side of each random plane on which a vector lies, for each start table."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, planes = np.asarray(batch.column(0)), np.asarray(batch.column(2))
            width = np.array([len(x) // 8 for x in batch.column(1).to_pylist()], np.int64)
            out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for dim in np.unique(width).tolist():
                own = np.flatnonzero(width == dim)
                x = _matrix(batch.column(1).take(pa.array(own)))
                for t in range(first, first + TABLES):
                    side = x @ np.random.default_rng([dim, t]).normal(size=(dim, 62)) > 0
                    side &= np.arange(62) < planes[own][:, None]
                    out.append((p[own], np.full(len(own), t), side @ (1 << np.arange(62))))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["p", "table", "code"])

    return code


def _meet(table: pa.Table) -> pa.Table:
    """(p, near, cos): for each vector of each group the nearest others of its group and label, as many as its list holds."""
    p, grp, y, k = (np.asarray(table.column(c).combine_chunks()) for c in ("p", "grp", "y", "k"))
    units = table.column("unit").combine_chunks()
    order = np.lexsort((p, y, grp))
    new = np.flatnonzero((np.diff(grp[order]) != 0) | (np.diff(y[order]) != 0)) + 1
    out_p, near, cos = [], [], []
    for own in np.split(order, new) if len(order) else []:
        if len(own) < 2:
            continue
        x = _matrix(units.take(pa.array(own)))
        s = x @ x.T
        np.fill_diagonal(s, -2)
        longest = int(min(len(own) - 1, k[own].max()))
        best = np.argsort(-s, axis=1, kind="stable")[:, :longest]
        for r, v in enumerate(own.tolist()):
            mine = best[r, : k[v]]
            out_p.append(p[v])
            near.append(p[own[mine]].tobytes())
            cos.append(s[r, mine].tobytes())
    return pa.table({"p": pa.array(out_p, pa.int64()), "near": pa.array(near, pa.binary()), "cos": pa.array(cos, pa.binary())})


def _merge(table: pa.Table) -> pa.Table:
    """The lists of some vectors, from what they had (`k` not null) and what they met: the k nearest; a list full of links is doubled."""
    p, k = np.asarray(table.column("p").combine_chunks()), np.asarray(table.column("k").combine_chunks().fill_null(-1))
    lists = [x or b"" for x in table.column("near").combine_chunks().to_pylist()]
    long = np.array([len(x) // 8 for x in lists], np.int64)
    owner, near = np.repeat(p, long), np.frombuffer(b"".join(lists), np.int64)
    cos = np.frombuffer(b"".join(x or b"" for x in table.column("cos").combine_chunks().to_pylist()), np.float64)
    old = np.repeat(k >= 0, long)
    ids, at = np.unique(p[k >= 0], return_index=True)
    room = k[k >= 0][at]
    order = np.lexsort((~old, near, owner))
    owner, near, cos, old = owner[order], near[order], cos[order], old[order]
    first = np.ones(len(owner), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (near[1:] != near[:-1])
    owner, near, cos, old = owner[first], near[first], cos[first], old[first]
    order = np.lexsort((near, -cos, owner))
    owner, near, cos, old = owner[order], near[order], cos[order], old[order]
    begin, end = np.searchsorted(owner, ids, "left"), np.searchsorted(owner, ids, "right")
    out = [[], [], [], [], []]
    for v, a, b, n in zip(ids.tolist(), begin.tolist(), end.tolist(), room.tolist(), strict=True):
        b = min(b, a + n)
        full = b - a == n and bool((cos[a:b] >= COSINE).all())
        for x, value in zip(out, (v, min(2 * n, LONGEST) if full else n, near[a:b].tobytes(), cos[a:b].tobytes(), not old[a:b].all() or full and n < LONGEST), strict=True):
            x.append(value)
    return pa.table({"p": pa.array(out[0], pa.int64()), "k": pa.array(out[1], pa.int32()), "near": pa.array(out[2], pa.binary()), "cos": pa.array(out[3], pa.binary()), "changed": pa.array(out[4], pa.bool_())})


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(p, k, near, cos) to (p, q, c, dense): an entry each; a list at its longest that is full of links is dense."""
    for batch in batches:
        p, k = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        lists, cos = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        long = np.array([len(x) // 8 for x in lists], np.int64)
        c = np.frombuffer(b"".join(cos), np.float64)
        links = np.add.reduceat(np.append(c >= COSINE, False), np.minimum(np.cumsum(long) - long, len(c))) * (long > 0) if len(long) else long
        dense = (k >= LONGEST) & (long >= LONGEST) & (links >= long)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(p, long)), pa.array(np.frombuffer(b"".join(lists), np.int64)), pa.array(c), pa.array(np.repeat(dense, long))], names=["p", "q", "c", "dense"])


def _spread(key, many: int):
    return F.pmod(F.xxhash64(*key), F.lit(many))


def _improved(lists: DataFrame, groups: DataFrame, points: DataFrame) -> DataFrame:
    """`lists` after the members (grp, p) of each group have met."""
    rows = groups.join(points.select("p", "y", "unit").join(lists.select("p", "k").hint("merge"), "p").hint("merge"), "p")
    many = int(1 + groups.count() // TASK_ROWS)
    met = rows.groupBy(_spread(["grp"], many).alias("task")).applyInArrow(_meet, "p long, near binary, cos binary")
    both = lists.select("p", "k", "near", "cos").unionByName(met, allowMissingColumns=True)
    return cut(both.groupBy(_spread(["p"], many).alias("task")).applyInArrow(_merge, "p long, k int, near binary, cos binary, changed boolean"))


def _parted(rows: DataFrame, most: int) -> DataFrame:
    """(grp, p) of rows (key, p), where a key with more than `most` rows is dealt by hash to several groups."""
    parts = rows.groupBy("key").agg(F.ceil(F.count("*") / most).alias("parts"))
    return rows.join(parts.hint("merge"), "key").select(F.xxhash64("key", F.pmod(F.xxhash64("p", "key"), F.col("parts"))).alias("grp"), "p")


def _descend(lists: DataFrame, points: DataFrame, attempt: int) -> DataFrame:
    """Neighbour lists after start tables and local joins, until next to none changes.

    In a local join all that have a vector in their list, or are in its list, meet at that vector, if its list has changed.
    """
    cells = points.select("p", "unit", "planes").mapInArrow(_start_cells(attempt * TABLES), "p long, table long, code long")
    keyed = cells.join(points.select("p", "y").hint("merge"), "p").select(F.xxhash64("y", "table", "code").alias("key"), "p")
    lists = _improved(lists, _parted(cut(keyed), CELL), points)
    total = lists.count()
    for _ in range(ROUNDS):
        fresh = lists.filter("changed")
        if fresh.count() <= STILL * total:
            break
        entry = fresh.select("p", "k", "near", "cos").mapInArrow(_entries, "p long, q long, c double, dense boolean").select("p", "q")
        around = cut(entry.select(F.col("p").alias("key"), F.col("q").alias("p")).unionByName(entry.select(F.col("q").alias("key"), "p")).unionByName(fresh.select(F.col("p").alias("key"), "p")).distinct())
        lists = _improved(lists, _parted(around, CENTRE), points)
    return lists


def _grouped(ids: np.ndarray, x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Blocks of similar vectors of a part: their rows, centre and radius."""
    pivots = x[np.argsort(ids, kind="stable")[: max(1, len(x) // (BLOCK // 4))]]
    order = np.argsort((x @ pivots.T).argmax(axis=1), kind="stable")
    out = []
    for k in range(0, len(order), BLOCK):
        own = order[k : k + BLOCK]
        centre = x[own].mean(axis=0)
        out.append((own, centre, float(np.sqrt(((x[own] - centre) ** 2).sum(axis=1).max()))))
    return out


def _compare_parts(table: pa.Table) -> pa.Table:
    """Of one pair of parts, all pairs: (v, null, n) counts the links of each vector of the one with the other, (a, b, 0) is a forest of the links.

    Blocks whose centres are further apart than their radii and the longest link allow are skipped, which leaves out no link.
    """
    side = np.asarray(table.column("_side").combine_chunks())
    ids, x = np.asarray(table.column("id").combine_chunks()), _matrix(table.column("unit").combine_chunks())
    many = np.asarray(table.column("copies").combine_chunks())
    same = bool((side == 2).all())
    rows = [np.flatnonzero(side == k) for k in ((2,) if same else (0, 1))]
    parts = [[(r[own], c, far) for own, c, far in _grouped(ids[r], x[r])] for r in rows if len(r)]
    count, parent, forest = np.zeros(len(ids), np.int64), list(range(len(ids))), []

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    reach = float(np.sqrt(2 - 2 * COSINE)) + 1e-6
    for i, (p, centre, far) in enumerate(parts[0] if len(parts) == 2 or same else []):
        for q, other, wide in parts[0][i:] if same else parts[1]:
            if np.sqrt(((centre - other) ** 2).sum()) > far + wide + reach:
                continue
            near = x[p] @ x[q].T >= COSINE
            if p is q:
                np.fill_diagonal(near, False)
            if not near.any():
                continue
            count[p] += near @ many[q]
            if p is not q:
                count[q] += near.T @ many[p]
            while True:  # each round, every row that still has a link to another tree joins one
                u, w = np.array([root(k) for k in p.tolist()]), np.array([root(k) for k in q.tolist()])
                left = near & (u[:, None] != w[None, :])
                at = np.flatnonzero(left.any(axis=1))
                if not len(at):
                    break
                for a, b in zip(p[at].tolist(), q[left[at].argmax(axis=1)].tolist(), strict=True):
                    ra, rb = root(a), root(b)
                    if ra != rb:
                        parent[max(ra, rb)] = min(ra, rb)
                        forest.append((a, b))
    got = np.flatnonzero(count)
    a, b = np.array(forest, np.int64).reshape(-1, 2).T
    return pa.table({"a": pa.array(np.concatenate([ids[got], ids[a]])), "b": pa.array([None] * len(got) + ids[b].tolist(), pa.int64()), "n": pa.array(np.concatenate([count[got], np.zeros(len(a), np.int64)]))})


def _exact(points: DataFrame) -> DataFrame:
    """Every pair of `points` of equal label, block by block: (a, null, n) counts links, (a, b, 0) is a forest of them.

    The vectors of a label are dealt by hash to parts, and each task compares one pair of parts. So dense groups make no row per pair.
    """
    each = points.select("y", F.col("p").alias("id"), "unit", "copies")
    sizes = each.groupBy("y").agg(F.count("*").alias("_n")).withColumn("_parts", F.ceil(F.col("_n") / F.least(F.greatest(F.ceil(F.col("_n") / PARTS), F.lit(LEAST)), F.lit(MOST))))
    parts = each.join(sizes.drop("_n").hint("merge"), "y").withColumn("_part", F.pmod(F.xxhash64("id"), F.col("_parts")))
    each = parts.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)))
    each = each.select("y", "id", "unit", "copies", F.least("_part", "_other").alias("_x"), F.greatest("_part", "_other").alias("_y"), F.when(F.col("_part") == F.col("_other"), 2).when(F.col("_part") < F.col("_other"), 0).otherwise(1).alias("_side"))
    return cut(each.groupBy("y", "_x", "_y").applyInArrow(_compare_parts, "a long, b long, n long"))


def _links(lists: DataFrame, points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(p, n): links of each vector, counting equal ones; (a, b): links that connect what links connect.

    A list that isn't full of links has all that its vector has met, so links with an end in such a list are its entries. Vectors whose lists are
    full at their longest are dense; links among those are counted exactly.
    """
    entry = cut(lists.select("p", "k", "near", "cos").mapInArrow(_entries, "p long, q long, c double, dense boolean").filter(F.col("c") >= COSINE))
    dense = cut(entry.filter("dense").select("p").distinct())
    exact = _exact(points.join(dense.hint("merge"), "p", "left_semi"))
    pairs = entry.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()
    flag = lambda k: dense.select(F.col("p").alias(k), F.lit(True).alias(f"dense_{k}")).hint("merge")
    pairs = cut(pairs.join(flag("a"), "a", "left").join(flag("b"), "b", "left").filter("dense_a IS NULL OR dense_b IS NULL").select("a", "b"))
    ends = pairs.select(F.col("a").alias("p"), F.col("b").alias("q")).unionByName(pairs.select(F.col("b").alias("p"), F.col("a").alias("q")))
    counted = ends.join(points.select(F.col("p").alias("q"), "copies").hint("merge"), "q").groupBy("p").agg(F.sum("copies").alias("n"))
    n = counted.unionByName(exact.filter("b IS NULL").select(F.col("a").alias("p"), "n")).groupBy("p").agg(F.sum("n").alias("n"))
    return cut(n), pairs.unionByName(exact.filter("b IS NOT NULL").select("a", "b"))


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, list[tuple[int, float]]]:
    """(id, n_links, component_id, kept) of every row, and the audited recall of the links after each attempt.

    1. Equal unit vectors of a label are one vertex. Each vertex has a list of its nearest others, filled from start tables: vectors of a label on
       the same side of some random planes meet.
    2. NN-descent: neighbours of neighbours meet at every vector whose list changed, again and again until the lists stand still. Lists full of
       links are doubled.
    3. Links are the entries of at least COSINE. Vectors whose list is full of links at its longest (dense groups) are compared exactly with each
       other, block by block, without a row per pair. The work of this part grows with the square of a label's dense vectors, less what blocks too far apart save.
    4. AUDIT vectors, chosen by hash, are compared with all others, and more of them until AUDIT_LINKS true links are seen or no vector is left. If fewer than RECALL of their links were found, new start tables and
       more rounds follow, and after ATTEMPTS all vectors are compared exactly.

    Defined cases: vectors that are null, empty, zero, or hold null or non-finite components, rows without label, or of other length link
    with nothing. Repeated rows of the same id and label are one vector, the smallest of those that differ. An empty table gives an empty result.
    """
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").alias("vec"), F.col(f"`{label_col}`").cast("string").alias("label"))
    units = cut(rows.mapInArrow(_unit_vectors, "id long, label string, unit binary").groupBy("id", "label").agg(F.min("unit").alias("unit")))
    labels = cut(units.groupBy("label").agg(F.count("*").alias("_n")).withColumn("y", F.monotonically_increasing_id()).withColumn("planes", F.greatest(F.lit(0), F.ceil(F.log2(F.col("_n") / CELL))).cast("int")))
    named = units.join(labels.select("label", "y", "planes").hint("merge"), "label")
    points = cut(named.groupBy("y", "planes", "unit").agg(F.min("id").alias("rep"), F.count("*").alias("copies")).withColumn("p", F.monotonically_increasing_id()))
    member = cut(named.select("id", "y", "unit").join(points.select("y", "unit", "p").hint("merge"), ["y", "unit"]).select("id", "p"))
    none = F.lit(None).cast("binary")
    lists, audit = points.select("p", F.lit(LIST).alias("k"), none.alias("near"), none.alias("cos"), F.lit(True).alias("changed")), []
    for attempt in range(ATTEMPTS):
        lists = _descend(lists, points, attempt)
        n, links = _links(lists, points)
        audit.append((attempt, _recall(points, n)))
        if audit[-1][1] >= RECALL:
            break
    else:
        exact = _exact(points)
        n, links = exact.filter("b IS NULL").groupBy(F.col("a").alias("p")).agg(F.sum("n").alias("n")), exact.filter("b IS NOT NULL").select("a", "b")
        audit.append((ATTEMPTS, 1.0))
    comp = components(links)
    own = points.select("p", "rep", "copies").join(n.hint("merge"), "p", "left").join(comp.withColumnRenamed("id", "p").hint("merge"), "p", "left").withColumn("component", F.coalesce("component", "p"))
    least = own.groupBy("component").agg(F.min("rep").alias("least"))
    per_point = own.join(least.hint("merge"), "component").select("p", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "least")
    per_id = member.join(per_point.hint("merge"), "p").groupBy("id").agg(F.sum("n_links").alias("n_links"), F.min("least").alias("component"))
    out = rows.select("id").join(per_id.hint("merge"), "id", "left").select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    return out.withColumn("kept", F.col("id") == F.col("component_id")), audit


def _true_counts(points: DataFrame, part: int, parts: int) -> DataFrame:
    """(p, links): links of the vectors of one of `parts` parts by hash, some AUDIT of them, compared with all vectors of their label: queries of a bounded number against all rows."""
    queries = points.select("p", "y", "unit").filter(F.pmod(F.xxhash64("p", "unit"), F.lit(parts)) == part).collect()
    by_label: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for y in {q.y for q in queries}:
        own = [q for q in queries if q.y == y]
        by_label[y] = np.array([q.p for q in own]), np.stack([np.frombuffer(bytes(q.unit), np.float64) for q in own])
    shared = points.sparkSession.sparkContext.broadcast(by_label)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, copies = np.asarray(batch.column(1)), np.asarray(batch.column(3))
            for y in {*labels.tolist()} & {*shared.value}:
                own = np.flatnonzero(labels == y)
                q, vecs = shared.value[y]
                near = (_matrix(batch.column(2).take(pa.array(own))) @ vecs.T >= COSINE) & (np.asarray(batch.column(0))[own][:, None] != q[None, :])
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(copies[own] @ near)], names=["p", "n"])

    return cut(points.select("p", "y", "unit", "copies").mapInArrow(compare, "p long, n long").groupBy("p").agg(F.sum("n").alias("links")).filter("links > 0"))


def _recall(points: DataFrame, n: DataFrame) -> float:
    """Found links by true links of the audited vectors; found ones are all true, so their numbers tell.

    Parts of AUDIT vectors, twice as many each time, are compared until AUDIT_LINKS links are seen, or all vectors have been: then it is exact, and 1.0 if there are no links at all.
    """
    parts, part, many, every, found = int(1 + points.count() // AUDIT), 0, 1, 0, 0
    while part < parts and every < AUDIT_LINKS:
        for k in range(part, min(parts, part + many)):
            r = _true_counts(points, k, parts).join(n.hint("merge"), "p", "left").agg(F.sum("links").alias("every"), F.sum(F.coalesce("n", F.lit(0))).alias("found")).first()
            every, found = every + (r.every or 0), found + (r.found or 0)
            if every >= AUDIT_LINKS:
                break
        part, many = part + many, 2 * many
    return 1.0 if not every else found / every


def op5_near_vectors(spark, sf_dir: str) -> DataFrame:
    found, _ = near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


OP5_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, c AS component_id, vec_id = c AS kept
FROM embeddings JOIN (SELECT x AS vec_id, min(y) AS c FROM reach GROUP BY x) USING (vec_id) LEFT JOIN (SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x) USING (vec_id)
"""
