"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names, with fitted models; the whole pipeline against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from tidemark.llm import decontaminate, licenses, mixing, quality, secrets, tokens, toxicity, warc

from test_near import shingles, smallest

NAMES = "_id _s _mean _tilt _floor _key _fine _edge _last _cross _need _bin _dense features raw rawPrediction probability prediction row tokens found rare".split()
TEXTS = [None, "", " \n ", "same words here", "same words here", "you awful person " * 3, "long " * 60_000, "MIT License"]


@pytest.fixture(scope="module")
def odd(spark):
    """Texts with a column of every name that is used inside, in several cases, and a row that repeats."""
    rows = [(k, t, "a" if k % 3 else None, *[f"{n}-{k}" for n in NAMES], -1.0) for k, t in enumerate(TEXTS)]
    rows += [rows[3]]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in NAMES) + ", SCORE double")


@pytest.fixture(scope="module")
def models(spark):
    rng = random.Random(2)
    docs, labels = [], []
    for k in range(400):
        bad = k % 2
        docs.append((k, " ".join(["you", "stupid", "idiot!!"] * bad + [rng.choice(["plain", "good", "text", "words", "river"]) for _ in range(20)])))
        labels.append((k, 1 - bad, bad))
    docs += [(1000, None), (1001, "")]
    docs, labels = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([*labels, (1000, 0, 0), (1001, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    return {"quality": quality.train(docs, labels), "toxicity": toxicity.train(docs, labels)}


def applied(name, df, models, spark):
    item = spark.createDataFrame([("i", "same words here")], "item_id string, text string")
    return {
        "op1": lambda: quality.score_quality(df, models["quality"]),
        "op2": lambda: licenses.scan_licenses(df),
        "op3": lambda: decontaminate.find_benchmark(df, item),
        "op7": lambda: secrets.scan_secrets(df),
        "op8": lambda: tokens.count_tokens(df),
        "op9": lambda: toxicity.score_toxicity(df, models["toxicity"]),
        "op10": lambda: mixing.mix_sources(df),
    }[name]()


@pytest.mark.parametrize("name", ["op1", "op2", "op3", "op7", "op8", "op9", "op10"])
def test_rows_and_columns_are_kept(spark, odd, models, name):
    df = odd if name in ("op1", "op2", "op9") else odd.drop("found") if name == "op3" else odd
    out = applied(name, df, models, spark)
    got = sorted(out.collect(), key=lambda r: r.doc_id)
    assert len(got) == len(TEXTS) + 1
    for r in got:
        for n in df.columns:
            if n in NAMES:
                assert r[n] == f"{n}-{r.doc_id}"
    new = [c for c in out.columns if c not in df.columns]
    assert len({c.lower() for c in out.columns}) == len(out.columns) and new
    by_text = {}
    for r in got:  # null is the empty text, and equal rows are treated alike
        if name != "op10":
            assert by_text.setdefault(r.text or "", tuple(str(r[c]) for c in new)) == tuple(str(r[c]) for c in new)
    assert applied(name, df.limit(0), models, spark).count() == 0


def test_fitted_toxicity(spark, odd, models):
    assert models["toxicity"].trees is not None
    got = {r.text: r.score for r in toxicity.score_toxicity(odd, models["toxicity"]).collect()}
    assert all(0 <= x <= 1 for x in got.values()) and got[None] == got[""]
    rude = spark.createDataFrame([(1, "you stupid idiot"), (2, "good plain words")], "doc_id long, text string")
    a, b = [r.score for r in toxicity.score_toxicity(rude, models["toxicity"]).orderBy("doc_id").collect()]
    assert a > 0.6 > 0.2 > b


@pytest.mark.parametrize("blank", [" ", "\n", " \n\t"])
def test_long_blanks_are_counted(spark, blank):
    text = "first" + blank * (1_100_000 // len(blank)) + "last words"
    (r,) = tokens.count_tokens(spark.createDataFrame([(text,)], "text string")).collect()
    assert r.n_bytes == len(text) and sum(r.section_tokens) == r.n_tokens > 0


def test_blanks_in_pieces_give_the_tokens_of_the_whole(monkeypatch):
    enc, _ = tokens.encoding()
    rng = random.Random(5)
    texts = ["".join(rng.choice(["a", "it's", "12", " ", "  ", "\n", "\t", " ", "!", "é"]) * rng.randint(1, 6) for _ in range(60)) for _ in range(300)]
    want = [enc.encode_ordinary(t) for t in texts]
    for least in (1, 2, 3):
        monkeypatch.setattr(tokens, "LONG_BLANK", least)
        monkeypatch.setattr(tokens, "_BLANKS", re.compile(r"\s{%d,}" % max(least, 2)))
        assert [tokens.encode(enc, t) for t in texts] == want


def test_gaps_are_logged(spark, tmp_path):
    path = str(tmp_path / "archives")
    warc.write_archives(spark.createDataFrame([(k, "u", f"page {k} " * 40) for k in range(30)], "page_id long, url string, html string").coalesce(1), path)
    (file,) = (tmp_path / "archives").glob("*.warc.gz")
    data = bytearray(file.read_bytes())
    del data[len(data) // 2]
    file.write_bytes(bytes(data))
    file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    file.with_name(f".{file.name.removesuffix('.warc.gz')}.txt.crc").unlink(missing_ok=True)
    records, log = warc.read_records(spark, path)
    gaps = spark.read.parquet(log).collect()
    assert records.count() == 29 and 0 < sum(g.length for g in gaps) < 2 * len(data) // 30 and all(g.reason for g in gaps)


def test_no_pages(spark, tmp_path):
    path = str(tmp_path / "none")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert spark.read.parquet(warc.read_records(spark, path)[1]).count() == 0


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())


def test_pipeline_against_plain_python(spark, tmp_path):
    """All stages but the classifier, whose scores are taken as they are, done again by all pairs."""
    rng = random.Random(8)
    word = [f"v{k}" for k in range(900)]
    prose = lambda n: " ".join(rng.choice(word) for _ in range(n))
    item = prose(30)
    texts = [prose(rng.randint(20, 80)) for _ in range(60)] + [f"{prose(20)} {item} {prose(20)}"] * 2 + [f"{prose(30)} token=abcdef{k}XYZ" for k in range(5)]
    texts += [texts[3], texts[3] + " tail", texts[4], None, None, "", " "]
    docs = [{"doc_id": k, "text": t, "lang": "en", "source": rng.choice(["a", "b", None]), "n_chars": len(t or "")} for k, t in enumerate(texts)] + [{"doc_id": None, "text": prose(30), "lang": None, "source": None, "n_chars": None}]
    docs += [dict(docs[7])]
    fields = [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())]
    pq.write_table(pa.Table.from_pylist(docs, pa.schema(fields)), tmp_path / "documents.parquet")
    pq.write_table(pa.table({"item_id": ["x"], "text": [item]}), tmp_path / "benchmark.parquet")
    pq.write_table(pa.table({"doc_id": pa.array(range(60), pa.int64()), "quality": pa.array([1] * 60, pa.int32()), "toxic": pa.array([0] * 60, pa.int32())}), tmp_path / "labels.parquet")
    good = corpus_pipeline.keep_good(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path)).collect()
    sets = [shingles(r.text) for r in good]
    ids = [r.doc_id for r in good]
    known = [k for k in range(len(good)) if ids[k] is not None]
    comp = smallest(range(len(good)), [(i, j) for i in range(len(good)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])])
    least = {}
    for k in known:
        least[comp[k]] = min(least.get(comp[k], ids[k]), ids[k])
    kept, seen = [], set()
    for k, r in enumerate(good):
        if ids[k] is None or not sets[k] or ids[k] == least[comp[k]]:
            if ids[k] is None or ids[k] not in seen:
                kept.append(r)
            seen.add(ids[k])
    w = words(item)
    windows = {tuple(w[i : i + 10]) for i in range(len(w) - 9)}
    clean = [r for r in kept if not any(tuple(words(r.text)[i : i + 10]) in windows for i in range(len(words(r.text)) - 9))]
    want = sorted(((r.doc_id, re.sub(r"token=\w+", "<secret>", r.text) if r.text else r.text) for r in clean), key=str)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(want) < len(good) - 4 and any("<secret>" in (t or "") for _, t in want)
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == [x for x in want if x in {(r.doc_id, r.text) for r in got}]
    left = [x for x in want if x not in {(r.doc_id, r.text) for r in got}]
    totals = {}
    for r in got:
        totals[r.source] = totals.get(r.source, 0) + r.taken
        assert r.copies in (1, 2) and r.taken == r.copies * r.size == r.copies * len((r.text or "").split())
    for r in got:
        assert abs(totals[r.source] - r.target) <= max(x.size for x in got)
    assert all(not (t or "").split() or np.isfinite(len(t)) for _, t in left)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    fields = [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())]
    pq.write_table(pa.Table.from_pylist([], pa.schema(fields)), tmp_path / "documents.parquet")
    pq.write_table(pa.table({"item_id": ["x"], "text": ["a b c"]}), tmp_path / "benchmark.parquet")
    pq.write_table(pa.table({"doc_id": pa.array([1], pa.int64()), "quality": pa.array([1], pa.int32()), "toxic": pa.array([0], pa.int32())}), tmp_path / "labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_many_sources_mix_the_same_without_broadcast(spark, monkeypatch):
    rows = [(k, "w " * (k % 17 + 1), f"s{k % 40}" if k % 11 else None) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = sorted((r.doc_id, r.target, r.copies, r.taken) for r in mixing.mix_sources(df).collect())
    monkeypatch.setattr(mixing, "MOST_SOURCES", 3)
    assert sorted((r.doc_id, r.target, r.copies, r.taken) for r in mixing.mix_sources(df).collect()) == want


def test_blanks_are_those_of_the_tokenizer():
    enc, _ = tokens.encoding()
    rng = random.Random(6)
    texts = ["\n" * 9000 + "\x1d" * 3000 + "x", "\x1c" * 12_000, " " * 12_000 + "\x1f" + "\x85" * 12_000]
    texts += ["".join(rng.choice(["\x1c", "\x1d", "\x1f", "\x85", "\xa0", "\u2003", " ", "\n", "a", "\u200b"]) * rng.randint(1, 4000) for _ in range(12)) for _ in range(6)]
    assert all(tokens.encode(enc, t) == enc.encode_ordinary(t) for t in texts)


def test_inner_names_may_occur(spark):
    """Columns named like those that are used inside come out as they went in."""
    item = spark.createDataFrame([("i", "same words here")], "item_id string, text string")
    names = ("_mask", "_MASK_", "_first", "_digest", "_id", "_last", "row")
    df = spark.createDataFrame([(k, "same words here", "u", f"page {k // 2} " * 30, *[f"{n}{k}" for n in names]) for k in range(6)], "page_id long, text string, url string, html string, " + ", ".join(f"{n} string" for n in names))
    for out in (decontaminate.find_benchmark(df, item), warc.dedup(df)):
        got = out.collect()
        assert len(got) == 6 and all(r[n] == f"{n}{r.page_id}" for r in got for n in names)
    assert sorted((r.page_id, r.refers_to) for r in warc.dedup(df).collect()) == [(k, k - 1 if k % 2 else None) for k in range(6)]


def test_long_texts_take_linear_time():
    import hashlib
    import time

    from tidemark.llm.text import text_chunks

    text = "é ".join(hashlib.sha256(str(k).encode()).hexdigest() for k in range(40_000))
    (chunk,) = text_chunks(pa.array([text]), 1 << 62)
    began = time.time()
    assert sum(kind == "hex" for _, kind, _, _ in secrets.find_spans(chunk)) == 40_000
    assert len(secrets._spans_of_batch(pa.array([text]))[0]) >= 40_000
    found = list(warc.salvage_plain(b"WARC/1.1\r\n" * 400_000))
    assert time.time() - began < 60 and [r.kind for r in found] == ["gap"]


@pytest.mark.parametrize("repeats", [1000, 3])
def test_a_repeated_document_comes_near_its_target(spark, repeats):
    rows = [(7, "one two three four five six seven eight nine ten", "a")] * repeats + [(8, "w " * 9_000, "b"), (None, "x y", None), (None, "x y", None)]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    own = [r for r in got if r.source == "a"]
    assert abs(sum(r.taken for r in own) - own[0].target) <= 10 and all(r.copies <= 2 for r in got)


def test_recall_is_measured_or_exact(spark, monkeypatch):
    """A pair among many vectors that no list has is seen, however few are audited at once."""
    from tidemark.llm import neighbors

    monkeypatch.setattr(neighbors, "AUDIT", 20)
    rng = np.random.default_rng(5)
    units = rng.normal(size=(200, 16))
    units[-1] = units[0] + 1e-3
    units /= np.linalg.norm(units, axis=1)[:, None]
    points = spark.createDataFrame([(k, 0, bytearray(u.tobytes()), 1) for k, u in enumerate(units)], "p long, y long, unit binary, copies long")
    none = spark.createDataFrame([], "p long, n long")
    assert neighbors._recall(points, none) == 0.0
    assert neighbors._recall(points, spark.createDataFrame([(0, 1), (199, 1)], none.schema)) == 1.0
    assert neighbors._recall(points.filter("p < 199"), none) == 1.0
