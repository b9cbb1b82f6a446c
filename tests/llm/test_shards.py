"""Centroids, repeated byte strings and ranked search against plain Python."""

import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tidemark.llm import centroids, induced, repeats, search
from tidemark.llm.store import one_row_batches


def vectors():
    rng = np.random.default_rng(4)
    rows = [(k, [float(x) for x in np.round(rng.normal(0, 0.4, 8), 2)], f"c-{k}") for k in range(300)]
    rows += [(300 + k, rows[k][1], "copy") for k in range(40)] + [rows[7]] * 3
    rows += [(None, rows[1][1], "no id"), (400, None, "null"), (401, [], "none"), (402, [1.0] * 7, "short"), (403, [None] + [0.0] * 7, "gap"), (404, [math.nan] * 8, "nan"), (405, [math.inf] * 8, "inf"), (406, [0.0] * 8, "zero"), (407, [-0.001] * 8, "below")]
    return rows


def plain_clusters(rows, k, rounds):
    own = [(i, np.floor(np.array(v) * 256).astype(np.int64), c) for i, v, c in rows if v is not None and len(v) == 8 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((r for r in own if r[0] is not None), key=lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1].tolist()))[:k]
    cents = [r[1].tolist() for r in first]
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x.tolist(), c, strict=True)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        at = [near(x)[1] for _, x, _ in own]
        for j in range(len(cents)):
            mine = [x for (_, x, _), a in zip(own, at, strict=True) if a == j]
            if mine:
                cents[j] = [int(sum(int(v[d]) for v in mine)) // len(mine) for d in range(8)]
    got = [(i, c, *near(x)) for i, x, c in own]
    each = {}
    for _, _, d, j in got:
        each[j] = each.get(j, 0) + d
    return sorted(((i, c, j, d, each[j], sum(each.values()), hashlib.sha256(",".join(map(str, cents[j])).encode()).hexdigest()) for i, c, d, j in got), key=str)


@pytest.mark.parametrize("k", [1, 12, 1000])
def test_clusters_against_plain_python(spark, monkeypatch, k):
    monkeypatch.setattr(centroids, "PAGE_ROWS", 50)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, CLUSTER string").withColumn("rows", __import__("pyspark").sql.functions.col("CLUSTER"))
    got = centroids.cluster_vectors(df, k=k, rounds=3, dims=8).collect()
    assert sorted(((r.vec_id, r["rows"], r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in got), key=str) == plain_clusters(rows, k, 3)


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert centroids.cluster_vectors(df).columns == ["vec_id", "embedding", *centroids.NEW] and centroids.cluster_vectors(df).count() == 0
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster_vectors(spark.createDataFrame([(1, [1e9] * 64)], df.schema)).count()


def test_dictionaries_lose_nothing():
    rng = np.random.default_rng(1)
    for width, top in ((7, 3), (8, 2), (1, 900), (64, 50)):
        x = rng.integers(-top, top, (500, width))
        page = centroids._unpacked(*centroids._packed(centroids.dictionaries(x)), 500)
        assert (np.concatenate([d.values[d.codes] for d in page], axis=1) == x).all()
    assert max(d.values.shape[1] for d in centroids.dictionaries(np.repeat(rng.integers(-9, 9, (5, 8)), 200, axis=0))) == 4


def test_suffixes_against_sorting(monkeypatch):
    rng = np.random.default_rng(2)
    for trial in range(300):
        monkeypatch.setattr(induced, "TURN", int(rng.integers(1, 40)))
        t = np.append(np.tile(rng.integers(1, 4, 4), 8) if trial % 3 == 0 else rng.integers(1, int(rng.integers(2, 7)), int(rng.integers(1, 60))), 0)
        limit, length = int(rng.integers(1, 400)), int(rng.integers(1, 9))  # bytes in memory: nearly all tuples go to disk
        assert induced.suffix_array(t, limit).tolist() == sorted(range(len(t)), key=lambda i, t=t: t[i:].tolist())
        same = {}
        for i in range(len(t) - length + 1):
            same.setdefault(tuple(t[i : i + length].tolist()), []).append(i)
        got = {}
        for s, g in zip(*(x.tolist() for x in induced.equal_windows(t, length, limit)), strict=True):
            got.setdefault(g, []).append(s)
        assert sorted(map(sorted, got.values())) == sorted(v for v in same.values() if len(v) > 1)


def plain_repeats(rows, length):
    key = lambda i: math.inf if i is None else i
    data = [(key(i), (t or "").encode()) for i, t in rows]
    least = {}
    for i, b in data:
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            least[w] = min(least.get(w, i), i)
    out = []
    for (i, _), (k, b) in zip(rows, data, strict=True):
        gone = [False] * len(b)
        for p in range(len(b) - length + 1):
            if least[b[p : p + length]] < k:
                gone[p : p + length] = [True] * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), sum(g and not (j and gone[j - 1]) for j, g in enumerate(gone)), hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot, length", [(100_000, 50), (2, 50), (0, 20)])
def test_repeats_against_plain_python(spark, monkeypatch, hot, length):
    for name, value in (("SHARD_BYTES", 4000), ("BUCKET_HASHES", 50), ("QUEUE_BYTES", 64)):
        monkeypatch.setattr(repeats, name, value)
    rng = random.Random(6)
    word = [f"v{k}é" for k in range(60)]
    prose = lambda n: " ".join(rng.choice(word) for _ in range(n))
    line, passage = prose(9) + "\n", prose(60)
    texts = [prose(rng.randint(1, 60)) + (line if rng.random() < 0.5 else "") + (passage[rng.randint(0, 60) :] if rng.random() < 0.3 else "") + prose(8) for _ in range(70)]
    texts += [texts[3], texts[3] + "!", " " * 400, " " * 300 + "x", "ab" * 200, "ab" * 150, None, "", "x" * 49, passage, line, "\0" * 70, "\0" * 60, passage]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    rows += [rows[5], (rows[5][0], rows[9][1]), (None, passage), (None, passage), (None, None)]
    df = spark.createDataFrame([(i, t, f"p{i}", -1) for i, t in rows], "doc_id long, text string, page string, KEPT int").repartition(3)
    got = repeats.remove_repeats(df, length=length, page_bytes=3000, hot=hot, queue_bytes=200).collect()
    assert all(r.page == f"p{r.doc_id}" for r in got)
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in got), key=str) == plain_repeats(rows, length)


def test_only_windows_met_again_are_sorted(monkeypatch):
    rng, sorted_, length = np.random.default_rng(5), [], 50
    monkeypatch.setattr(repeats, "equal_windows", lambda t, *a: sorted_.append(len(t)) or induced.equal_windows(t, *a))
    common, other = (rng.integers(0, 256, 60, np.uint8).tobytes() for _ in range(2))
    texts = [rng.integers(0, 256, 53, np.uint8).tobytes() + x for x in (common, other, common, b"")] + [other[:55] + b"x" * 58]
    head = np.zeros(len(texts), repeats.HEAD)
    head["key"], head["least"], head["most"], head["number"], head["size"] = 1, range(5), range(5), range(5), [len(x) for x in texts]
    sent = [(0, 7, len(head), repeats._packed(head), sum(head["size"]), pa.compress(b"".join(texts), codec="zstd", asbytes=True))]
    names, kinds = zip(*(c.split() for c in repeats.SENT.split(", ")), strict=True)
    (got,) = repeats._sorted_shard(length, 1 << 20)(pa.table([pa.array([r[j] for r in sent], pa.int64() if k == "long" else pa.binary()) for j, k in enumerate(kinds)], names=list(names))).to_pylist()
    masks = dict(zip(np.frombuffer(got["numbers"], np.uint32).tolist(), np.frombuffer(got["masks"], np.uint64).tolist(), strict=True))
    assert masks == {2: sum(1 << k for k in range(53, 64)), 4: sum(1 << k for k in range(6))}
    assert sorted_ == [2 * (60 + 1) + 2 * (55 + 1) + (58 + 1) + 1] and sum(head["size"]) == 505


def test_no_repeats(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.remove_repeats(df).count() == 0
    got = repeats.remove_repeats(spark.createDataFrame([(1, None), (2, "short")], df.schema)).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed) for r in got) == [(1, 0, 0), (2, 5, 0)]


def terms(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def plain_search(docs, items):
    bags = [terms(t) for _, t in docs]
    n, length = sum(bool(b) for b in bags), sum(map(len, bags))
    df = {}
    for b in bags:
        for w in {*b}:
            df[w] = df.get(w, 0) + 1
    out = []
    for i, t in items:
        scored = []
        for (d, _), b in zip(docs, bags, strict=True):
            m = 10 + 90 * len(b) * n // max(length, 1)
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (1_000_000_000 * b.count(w) // (1000 * b.count(w) + 8 * m)) for w in {*terms(t)} & {*b})
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out += [(i, k + 1, None if none else d, -s) for k, (s, none, d) in enumerate(sorted(scored)[:10])]
    return sorted(out, key=str)


@pytest.mark.parametrize("block, item_bytes", [(1 << 20, 1 << 20), (600, 200)])
def test_search_against_plain_python(spark, monkeypatch, block, item_bytes):
    monkeypatch.setattr(search, "BLOCK_BYTES", block)
    rng = random.Random(9)
    vocabulary = [f"Wort{k}" for k in range(150)] + ["É", "7", "ab7"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    prose = lambda n: " ".join(rng.choices(vocabulary, weights, k=n))
    docs = [(k, prose(rng.randint(0, 80))) for k in range(300)] + [(300, None), (301, ""), (302, "..."), (303, "wort1 " * 9000)]
    docs += [(k + 400, docs[k][1]) for k in range(30)] + [docs[5]] * 2 + [(None, docs[8][1])]
    items = [(f"i{k}", prose(rng.randint(1, 30))) for k in range(25)] + [("none", None), ("empty", ""), ("unknown", "nowhere"), ("one", "wort0"), ("i1", "Wort1 wort1 WORT2")]
    index = search.build_index(spark.createDataFrame(docs, "doc_id long, text string"))
    df = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id string, text string, rank int")
    got = search.search(index, df, item_bytes=item_bytes).collect()
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got), key=str) == plain_search(docs, items)


def test_search_of_nothing(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert search.search(search.build_index(docs), items).count() == 0
    assert search.search(search.build_index(docs), spark.createDataFrame([(1, "a")], items.schema)).count() == 0
    assert search.search(search.build_index(spark.createDataFrame([(1, "a")], docs.schema)), items).count() == 0


def test_blocks_of_the_index_are_row_groups_of_their_own(spark):
    """So neither the writer nor the reader of a large partition holds many blocks at once."""
    docs = spark.createDataFrame([(k, f"word{k} other words") for k in range(300)], "doc_id long, text string").coalesce(1)
    with one_row_batches(spark):  # a batch of texts is a block at least
        (file,) = search.build_index(docs).inputFiles()
    meta = pq.read_metadata(file.removeprefix("file:"))
    assert meta.num_rows == meta.num_row_groups == 300
