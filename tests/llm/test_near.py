"""Near duplicates of texts and vectors against all pairs."""

import random
import re
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import graph, jaccard, neighbors, store

WORDS = [f"w{k}" for k in range(4000)]


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", low) if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def smallest(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def corpus():
    rng = random.Random(3)
    texts = []

    def edited(w, n):
        w = list(w)
        for _ in range(n):
            w[rng.randrange(len(w))] = rng.choice(WORDS)
        return " ".join(w)

    passage = [rng.choice(WORDS) for _ in range(60)]
    for size, copies, most in ((120, 110, 6), (80, 40, 7), (200, 12, 9), (30, 30, 2)):
        base = [rng.choice(WORDS) for _ in range(size)]
        texts += [edited(base, rng.randint(0, most)) for _ in range(copies)]
        texts += [" ".join(base)] * 5
    texts += [" ".join(passage + [rng.choice(WORDS) for _ in range(rng.randint(5, 60))]) for _ in range(120)]
    texts += [" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 90))) for _ in range(60)]
    texts += [None, "", " \n ", "a b", "A  b", "a b c", "one two three four five", "One two\tthree four five", " ".join(["same"] * 3000)]
    rng.shuffle(texts)
    return list(enumerate(texts, 5))


def test_documents_against_all_pairs(spark):
    docs = corpus()
    sets = {i: shingles(t) for i, t in docs}
    ids = [i for i, _ in docs]
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = smallest(ids, links)
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "doc_id AS n", "text AS grams").repartition(5)
    got = {r.id: (r.n_shingles, r.component_id) for r in jaccard.near_components(df).collect()}
    assert got == {i: (len(sets[i]), want[i]) for i in ids}
    assert len({*want.values()}) < len(ids) - 90


def test_documents_odd_tables(spark):
    assert jaccard.near_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "x y"), (2, None)], "doc_id long, text string")
    got = sorted(((r.id, r.n_shingles, r.component_id) for r in jaccard.near_components(df).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (None, 2, 1), (None, 1, None), (2, 0, 2)], key=str)


def test_documents_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = sorted(con.execute(jaccard.OP4_SQL).fetchall())
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.op4_near_documents(spark, sf).collect()) == want


@pytest.mark.parametrize("local", [graph.LOCAL, 25])
def test_components(spark, monkeypatch, local):
    monkeypatch.setattr(graph, "LOCAL", local)
    rng = random.Random(1)
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(7, 7)]
    want = smallest(sorted({x for e in links for x in e}), links)
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: v for k, v in want.items() if k in got} and {x for a, b in links if a != b for x in (a, b)} == {*got}


def test_chain_takes_few_rounds(spark, monkeypatch):
    monkeypatch.setattr(graph, "LOCAL", 50)
    rounds = []
    got = graph.components(spark.range(40 * 50).selectExpr("id AS a", "id + 1 AS b"), rounds)
    assert [(r.n, r.c) for r in got.selectExpr("count(id) AS n", "max(component) AS c").collect()] == [(40 * 50 + 1, 0)]
    assert rounds[0] == 40 * 50 and len(rounds) <= 9, rounds


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=24).tolist(), k % 2) for k in range(700)]
    center = rng.normal(size=24)
    rows += [(1000 + k, (center + rng.normal(size=24) * 0.05).tolist(), 0) for k in range(300)]
    rows += [(2000 + k, (np.array(rows[k][1]) * (1 + k % 3) + rng.normal(size=24) * 0.05).tolist(), rows[k][2]) for k in range(60)]
    rows += [(3000 + k, rows[3][1], 1) for k in range(5)]
    rows += [(4000, None, 1), (4001, [0.0] * 24, 1), (4002, [float("nan")] * 24, 1), (4003, [1.0] * 23 + [None], 1), (4004, rows[3][1], None), (4005, [], 0)]
    return rows


def test_vectors_against_all_pairs(spark, vectors):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int").repartition(4)
    found, audit = neighbors.near_vectors(df)
    got = {r.id: r for r in found.collect()}
    assert len(got) == len(vectors)
    ok = [(i, np.array(v) / np.linalg.norm(v), y) for i, v, y in vectors if i < 4000]
    x, y = np.stack([v for _, v, _ in ok]), np.array([c for *_, c in ok])
    near = (x @ x.T >= neighbors.COSINE) & (y[:, None] == y[None, :])
    np.fill_diagonal(near, False)
    ids = [i for i, *_ in ok]
    want = smallest(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(np.triu(near)), strict=True)])
    assert [got[i].n_links for i in ids] == near.sum(axis=1).tolist()
    assert {i: got[i].component_id for i in ids} == want
    assert all((r.n_links, r.component_id, r.kept) == (0, i, True) for i, r in got.items() if i >= 4000)
    assert audit[-1][1] >= 0.9


def test_vectors_empty(spark):
    found, _ = neighbors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<double>, label int"))
    assert found.count() == 0


def bridged(dim=24, size=700):
    """Per label two dense groups 13 degrees apart, joined by one pair of 11.4 degrees."""
    rng, rows = np.random.default_rng(9), []
    for label in range(5):
        plane, _ = np.linalg.qr(rng.normal(size=(dim, 2)))
        for degrees, n in ((0, size), (0.8, 1), (13, size), (12.2, 1)):
            on = np.cos(np.radians(degrees)) * plane[:, 0] + np.sin(np.radians(degrees)) * plane[:, 1]
            off = rng.normal(size=(n, dim)) * 0.003 * (n > 1)
            rows += [(len(rows) + k, v.tolist(), label) for k, v in enumerate(on + off - off @ plane @ plane.T)]
    return rows


def test_saturated_groups_joined_by_one_pair(spark):
    rows = bridged()
    found, _ = neighbors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4))
    got = {r.id: r for r in found.collect()}
    x = np.stack([np.array(v) / np.linalg.norm(v) for _, v, _ in rows])
    for label in range(5):
        own = np.array([i for i, _, y in rows if y == label])
        assert {got[i].component_id for i in own.tolist()} == {int(own.min())}
        assert [got[i].n_links for i in own.tolist()] == ((x[own] @ x[own].T >= neighbors.COSINE).sum(axis=1) - 1).tolist()


def test_sparse_links_are_all_found(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(12000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    off = rng.normal(size=(500, 24))
    off -= (off * x[:500]).sum(axis=1, keepdims=True) * x[:500]
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    x = np.concatenate([x, x[:500] * 0.9805 + off * np.sqrt(1 - 0.9805**2)])
    found, _ = neighbors.near_vectors(spark.createDataFrame([(k, v, 0) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<double>, label int").repartition(4))
    got = {r.id: (r.n_links, r.component_id) for r in found.filter("n_links > 0").collect()}
    assert got == {i: (1, k) for k in range(500) for i in (k, 12000 + k)}


def test_exact_after_attempts_without_recall(spark, vectors, monkeypatch):
    monkeypatch.setattr(neighbors, "_recall", lambda points, n: 0.5)
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int")
    found, audit = neighbors.near_vectors(df)
    assert [r for _, r in audit] == [0.5, 0.5, 1.0]
    assert found.agg({"n_links": "sum"}).first()[0] > 80000


def test_audit_counts_what_was_missed(spark, vectors):
    df = spark.createDataFrame([(0, i, np.array(v).tobytes(), 1) for i, v in ((1, [1.0, 0.0]), (2, [0.99, 0.141]), (3, [0.0, 1.0]))], "y long, p long, unit binary, copies long")
    assert neighbors._recall(df, spark.createDataFrame([(1, 1)], "p long, n long")) == 0.5


def test_repeated_vector_ids(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [0.0, 1.0], 0), (3, [1.0, 0.01], 0)]
    found, _ = neighbors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert sorted((r.id, r.n_links, r.component_id) for r in found.collect()) == [(1, 2, 1)] * 3 + [(2, 1, 1)] * 2 + [(3, 1, 1)]


def held():
    return sum(map(int, re.findall(r"\nPss_(?:Anon|Shmem):\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024


def test_memory_goes_back_at_the_end_of_a_partition():
    def part(batches):
        for batch in batches:
            pieces = [np.ones(12_000) for _ in range(800)]
            rest.append(pieces[-1])  # lies above all others
            del pieces
            yield batch
        before.append(held())

    rest, before = [], []
    assert list(store.frugal(part)(iter([1, 2]))) == [1, 2]
    assert before[0] - held() > 40


def test_batches_of_texts_are_bounded_by_bytes(spark, monkeypatch):
    docs = spark.range(90).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("w"), F.col("id"), F.lit(" ")), 50_000).alias("text")).coalesce(1)
    key, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    def cut(df, before=jaccard.cut):
        if not seen:
            seen.append(docs.select("text").mapInArrow(sizes, "n long").agg(F.max("n")).first()[0])
        return before(df)

    monkeypatch.setattr(jaccard, "cut", cut)
    usual = spark.conf.get(key)
    assert jaccard.near_components(docs).count() == 90
    assert seen[0] < 6 << 20 and spark.conf.get(key) == usual
