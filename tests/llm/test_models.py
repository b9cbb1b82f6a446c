"""Fitted scores, token counts, archives, mixing and the pipeline."""

import gzip
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import mixing, quality, registry, text, tokens, toxicity, warc

SF = "/root/testdata/sf0.01"


def accuracy(df, labels, label):
    rows = df.filter("held_out").join(labels, "doc_id").select("predicted", label).collect()
    return len(rows), sum(r[0] == r[1] for r in rows) / len(rows)


def test_quality_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    n, share = accuracy(registry.queries()["op1_quality"](spark, SF), labels, "quality")
    assert n > 50 and share > 0.93


def test_sum_of_squares_identity():
    rng = np.random.default_rng(0)
    m = quality.Machine(0.3, rng.normal(size=50), rng.normal(size=(50, 4)))
    at, x = np.array([3, 7, 8, 20, 1, 2]), rng.normal(size=6)
    f = quality.Features(at, x, np.array([0, 4, 6]))
    want = [0.3 + sum(m.linear[at[i]] * x[i] for i in r) + sum(m.factors[at[i]] @ m.factors[at[j]] * x[i] * x[j] for i in r for j in r if i < j) for r in (range(4), range(4, 6))]
    assert np.allclose(quality.raw_scores(m, f), want)


def test_quality_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 5.0), (2, "", 5.0), (3, "a b " * 20000, 5.0), (4, "fine words here", 5.0)], "doc_id long, text string, score double")
    m = quality.train(docs, spark.createDataFrame([(4, 1), (3, 0), (None, 1), (9, None)], "doc_id long, quality int"))
    got = quality.score_quality(docs, m).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got) and got[0].score == got[1].score
    assert quality.score_quality(docs.limit(0), m).count() == 0


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = registry.queries()["op9_toxicity"](spark, sf).cache()
    n, share = accuracy(out, labels, "toxic")
    assert n > 500 and share > 0.97
    caught = out.filter("held_out").join(labels.filter("toxic = 1"), "doc_id").agg(F.avg("predicted")).first()[0]
    assert caught > 0.85


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, None), (2, "x")], "doc_id long, text string")
    s = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.score for r in toxicity.score_toxicity(docs, s).collect()] == [0.0, 0.0]


def test_word_hashes_are_of_words():
    texts = ["The quick\tbrown fox", None, "", "the QUICK brown  fox é É", "x" * 70000]
    (a, *rest) = [text.words(c, text.SPACED) for c in text.text_chunks(pa.array(texts), limit=1 << 30)]
    assert not rest and a.offsets.tolist() == [0, 4, 4, 4, 10, 11]
    assert a.hash[:4].tolist() == a.hash[4:8].tolist() and len({*a.hash.tolist()}) == 7


def test_tokens_round_trip(spark):
    enc, sizes = tokens.encoding()
    texts = [None, "", "one\ntwo words\n\n\n  three é漢字 lines\n", "no line feed", "\n\n\n", "a" * 5000 + "\n" + "b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for rule in tokens.RULES:
        for r in tokens.count_tokens(df, rule=rule).collect():
            data = (r.text or "").encode()
            lines = data.splitlines(keepends=True) if b"\r" not in data else None
            ids = enc.encode_ordinary(r.text or "")
            ends, want, at, crossing = np.cumsum([len(x) for x in lines]), [0] * len(lines), 0, 0
            for i in ids:
                inside = [max(0, min(at + sizes[i], e) - max(at, e - len(x))) for e, x in zip(ends, lines, strict=True)]
                crossing += sum(x > 0 for x in inside) > 1
                want[next(k for k, x in enumerate(inside) if x > 0) if rule == "first" else int(np.argmax(inside))] += 1
                at += sizes[i]
            assert (r.n_bytes, r.n_tokens, r.n_sections, r.n_crossing, r.section_tokens) == (len(data), len(ids), len(lines), crossing, want)


def test_warc_query(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    assert sorted(map(tuple, warc.op6_warc(spark, sf).collect()), key=str) == sorted(con.execute(warc.OP6_SQL).fetchall(), key=str)


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    big = "<html>" + "é" * 200 + "\r\n\r\nWARC/1.1 in text</html>"
    pages = [(3, "http://a/\r\nX: y", big), (1, None, big), (2, "http://b", "short"), (4, "u", "short"), (5, "u", None), (5, "u", None), (None, "u", big), (6, "u", "x" * 99), (7, "u", "y" * 100), (8, "u", "y" * 100)]
    at = str(tmp_path_factory.mktemp("w") / "a")
    warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(1), at)
    return pages, at


def test_warc_round_trip(spark, archive):
    pages, at = archive
    got = warc.read_archives(spark, at).collect()
    assert len(got) == len(pages) and {r.kind for r in got} == {"record"}
    text_of = sorted((r.payload.decode() for r in got if r.record_type == "response"))
    assert text_of == sorted(["short", "short", "", "", "x" * 99, "y" * 100, pages[0][2], pages[0][2]])
    assert sorted((r.record_id, r.refers_to) for r in got if r.record_type == "revisit") == [("<urn:page:3>", "<urn:page:1>"), ("<urn:page:8>", "<urn:page:7>")]


def plain(archive):
    import glob

    (f,) = glob.glob(archive[1] + "/*.gz")
    return gzip.open(f).read()


def test_salvage_plain(archive):
    data = plain(archive)
    whole = [r for r in warc.salvage(data)]
    assert all(r.kind == "record" for r in whole)
    broken = bytearray(data)
    hurt = whole[2]
    broken[hurt.offset + hurt.length - 8] ^= 1
    got = list(warc.salvage(bytes(broken)))
    gaps = [(r.offset, r.length) for r in got if r.kind == "gap"]
    assert gaps == [(hurt.offset, hurt.length)] and sum(r.kind == "record" for r in got) == len(whole) - 1
    cut = list(warc.salvage(data[:-10]))
    assert cut[-1].kind == "gap" and cut[-1].reason == "block cut short" and sum(r.length for r in cut) == len(data) - 10
    assert list(warc.salvage(b"")) == [] and [r.kind for r in warc.salvage(b"garbage")] == ["gap"]


def test_salvage_members(archive):
    data = plain(archive)
    members = [gzip.compress(data[r.offset : r.offset + r.length]) for r in warc.salvage(data)]
    assert sum(r.kind == "record" for r in warc.salvage(b"".join(members))) == len(members)
    members[3] = members[3][:12] + b"\x00\xff" * 5 + members[3][22:]
    members.insert(5, b"junk between members")
    got = list(warc.salvage(b"".join(members)))
    gaps = [r for r in got if r.kind == "gap"]
    assert sum(r.kind == "record" for r in got) == len(members) - 2 and len(gaps) == 2
    assert gaps[0].offset == sum(map(len, members[:3])) and gaps[0].length == len(members[3]) and gaps[1].length == len(members[5])
    assert zlib.crc32(b"") == 0


def test_targets_fill_to_the_caps(spark):
    sizes = {"a": 100, "b": 1000, "c": 10, "d": 400, None: 300, "e": 0}
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    names = sorted((s for s in sizes if s), key=str) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    want, left = {}, 1.5 * sum(sizes.values())
    free = [s for s in names]
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        full = [s for s in free if share[s] >= 2 * sizes[s]]
        if not full:
            want |= share
            break
        for s in full:
            want[s] = 2 * sizes[s]
            left -= want[s]
            free.remove(s)
    assert {s: pytest.approx(v) for s, v in want.items()} == got


def test_mix(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").unionByName(spark.createDataFrame([(-1, None, None), (-2, "a b c", None), (-2, "a b c", None), (-3, "", "src1")], "doc_id long, text string, source string")).withColumn("taken", F.lit("clash"))
    out = mixing.mix_sources(docs).cache()
    assert out.count() == docs.count() and out.filter("taken > 2 * size OR taken < 0 OR taken <> copies * size").count() == 0
    for r in out.groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("want"), F.max("source_size").alias("s")).collect():
        assert abs(r.t - r.want) <= max(6, 0.002 * r.want)
    again = mixing.mix_sources(docs.repartition(7)).select("doc_id", "copies")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.select("doc_id", "copies").collect()))
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "mixing"]
    good = corpus_pipeline.keep_good(spark, docs, SF).cache()
    lost = docs.join(good, "doc_id", "left_anti").join(labels, "doc_id")
    assert lost.filter("quality = 1").count() <= 0.02 * labels.filter("quality = 1").count() and good.columns == docs.columns
    one = corpus_pipeline.keep_one_of_each(spark, good.unionByName(good.limit(3)), SF).cache()
    assert one.count() == one.select("doc_id").distinct().count() < good.count()
    clean = corpus_pipeline.keep_clean(spark, one, SF).cache()
    assert 0 < clean.count() < one.count()
    hidden = corpus_pipeline.hide_secrets(spark, clean, SF).cache()
    assert hidden.count() == clean.count() and hidden.filter("text LIKE '%<secret>%'").count() > 0 and hidden.filter("n_chars <> length(text)").count() == clean.filter("n_chars <> length(text)").count()
    mixed = corpus_pipeline.mix(spark, hidden, SF)
    assert 0 < mixed.count() <= hidden.count()
