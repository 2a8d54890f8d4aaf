"""WARC archives: exact round trip, revisit rule, determinism."""

import base64
import hashlib

import __spark_entry__ as entry
from statflow.llm import warc
from statflow.llm.files import open_file

SF = "/root/testdata/sf0.001"


def brute(rows, least=0):
    first, out = {}, []
    key = lambda r: (r[0] is None, r[0] or 0)
    for page_id, html in sorted(rows, key=key):
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        seen = len(data) >= least and digest in first
        out.append((page_id, len(data), digest, "revisit" if seen else "response",
                    first[digest] if seen else None))
        first.setdefault(digest, page_id)
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2], r[3]))


def test_op4_against_brute_force(spark):
    pages = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    got = [tuple(r) for r in entry.queries()["op4_warc_archives"](spark, SF).collect()]
    assert order(got) == order(brute(pages))


ROWS = [(5, "http://a/b c\r\nX: y", "<p>same</p>", "k"), (2, "http://x", "<p>same</p>", "k"),
        (9, None, None, None), (3, "u", "", ""), (2, "http://x", "<p>same</p>", "k"),
        (None, "u", "<p>same</p>", ""), (None, "v", "only null", ""), (None, "v", "only null", ""),
        (11, "http://big", "é\r\n\r\n" * 200_000, ""), (12, "w", "x", "")] + \
    [(100 + i, f"http://n/{i}", f"page {i % 7} " * 50, "") for i in range(60)]


def pages(spark):
    return spark.createDataFrame(ROWS, "page_id long, url string, html string, sha string")


def test_odd_rows_rolling_and_payloads(spark):
    manifest = warc.write_archives(pages(spark).repartition(4), file_bytes=600, task_bytes=20_000)
    files = manifest.collect()
    assert len(files) > 4 and max(f["seq"] for f in files) > 0
    assert sum(f["records"] for f in files) == len(ROWS)
    got = [tuple(r) for r in warc.read_archives(manifest).collect()]
    assert order(got) == order(brute([(r[0], r[2]) for r in ROWS]))
    full = warc.read_archives(manifest, with_payload=True).collect()
    want = {(r[0], (r[2] or "").encode()) for r in ROWS}
    assert {(r["page_id"], bytes(r["payload"])) for r in full if r["record_type"] == "response"} <= want
    heads = [h for f in files for h, _ in warc.read_records(f["path"])]
    ids = {h["WARC-Record-ID"] for h in heads if h["WARC-Type"] == "response"}
    assert all(h["WARC-Refers-To"] in ids for h in heads if h["WARC-Type"] == "revisit")


def test_small_payloads_are_all_responses(spark):
    got = warc.read_archives(warc.write_archives(pages(spark), revisit_bytes=20)).collect()
    assert order([tuple(r) for r in got]) == order(brute([(r[0], r[2]) for r in ROWS], 20))


def test_same_pages_same_bytes(spark):
    def data(df):
        rows = warc.write_archives(df, file_bytes=2000, task_bytes=1 << 30).orderBy("part", "seq").collect()
        return [open_file(r["path"]).read() for r in rows]
    assert data(pages(spark).repartition(3)) == data(pages(spark).repartition(5, "url"))


def test_same_pages_same_bytes_with_several_ranges(spark):
    rows = [(i if i % 50 else None, f"http://h/{i}", f"page {i * i % 97} " * (1 + i % 40)) for i in range(8000)]
    rows += [(7, "http://hot", "hot " * 500)] * 30 + [(9000 + i, "http://none", None) for i in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")

    def data(df):
        rows = warc.write_archives(df, file_bytes=20_000, task_bytes=100_000).orderBy("part", "seq").collect()
        return [(r["part"], r["seq"], r["records"], open_file(r["path"]).read()) for r in rows]

    one = data(df.repartition(3))
    assert len({r[0] for r in one}) > 10 and sum(r[2] for r in one) == len(rows)
    assert one == data(df.repartition(7, "url")) == data(df.coalesce(1))


def test_empty_table(spark):
    manifest = warc.write_archives(pages(spark).limit(0))
    assert manifest.count() == 0 and warc.read_archives(manifest).count() == 0
