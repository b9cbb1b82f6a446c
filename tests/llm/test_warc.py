"""Archives that were damaged after they were written."""

import gzip
import random
from pathlib import Path

from tidemark.llm import warc


def _pages(spark, urls):
    rng = random.Random(4)
    rows = [(k, u, "".join(chr(rng.randrange(33, 127)) for _ in range(700))) for k, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)


def test_one_damaged_byte_loses_one_record(spark, tmp_path):
    warc.write_archives(_pages(spark, [f"http://a/{k}" for k in range(60)]), str(tmp_path / "w"))
    (file,) = Path(tmp_path / "w").glob("part-*")
    data = bytearray(file.read_bytes())
    assert gzip.decompress(bytes(data)).count(b"WARC/1.1\r\n") == 60
    data[len(data) // 2] ^= 0xFF
    got = list(warc.salvage(bytes(data)))
    assert sum(r.kind == "record" for r in got) == 59 and sum(r.kind == "gap" for r in got) == 1


def test_records_before_a_fault_of_a_member_are_kept(spark, tmp_path):
    warc.write_archives(_pages(spark, [f"http://a/{k}" for k in range(60)]), str(tmp_path / "w"))
    (file,) = Path(tmp_path / "w").glob("part-*")
    plain = gzip.decompress(file.read_bytes())
    data = gzip.compress(plain)
    assert len(data) < 1 << 16
    broken = data[: len(data) // 2] + b"\xff" * 64 + data[len(data) // 2 + 64 :]
    got = [r for r in warc.salvage(broken) if r.kind == "record"]
    assert len(got) >= 20 and got == [r._replace(offset=0) for r in warc.salvage_plain(plain)][: len(got)]


def test_long_urls_and_pages_are_records(spark, tmp_path):
    urls = ["http://a/" + "x" * (1 << 20), "http://b/", None]
    pages = _pages(spark, urls).selectExpr("page_id", "url", "CASE WHEN page_id = 1 THEN repeat(html, 30000) ELSE html END AS html")
    warc.write_archives(pages, str(tmp_path / "w"))
    got = {r.record_id: (r.kind, r.uri, r.payload_bytes) for r in warc.read_archives(spark, str(tmp_path / "w")).collect()}
    assert got == {f"<urn:page:{k}>": ("record", u or "", 700 * (30000 if k == 1 else 1)) for k, u in enumerate(urls)}


def test_files_are_bounded_by_bytes(spark, tmp_path):
    warc.write_archives(_pages(spark, [f"http://a/{k}" for k in range(60)]), str(tmp_path / "w"), file_bytes=10_000)
    sizes = [x.stat().st_size for x in Path(tmp_path / "w").glob("*.warc.gz")]
    assert len(sizes) > 3 and max(sizes) < 12_000 and not list(Path(tmp_path / "w").glob("file=*"))
    got = warc.read_archives(spark, str(tmp_path / "w")).collect()
    assert sorted(r.record_id for r in got) == sorted(f"<urn:page:{k}>" for k in range(60)) and {r.kind for r in got} == {"record"}
