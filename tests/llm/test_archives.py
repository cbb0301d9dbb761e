"""WARC packages: round trip, revisits, ZIP64, range reads; and the pipeline over a small table."""

from __future__ import annotations

import hashlib
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from trailmark.llm import mixing, warc
from trailmark.llm.queries import QUERIES
from trailmark.llm.sql import ORACLE

DIR = "/root/testdata/sf0.001"


def pages_of(spark, htmls):
    return spark.createDataFrame([(i, f"http://h/{i} é\n", h, "x") for i, h in htmls], "page_id long, url string, html string, digest string")


def test_round_trip_and_revisits(spark, monkeypatch):
    monkeypatch.setattr(warc, "PACKAGE_BYTES", 2000)
    long_, edge = "é" * 60, "a" * 100
    htmls = [(5, long_), (3, long_), (9, long_), (1, "a" * 99), (2, "a" * 99), (7, edge), (8, edge), (4, None), (6, ""), (10, "x\r\n\r\ny" * 500), (None, long_), (9, long_)]
    got = sorted(warc.read_archives(warc.archive(pages_of(spark, htmls)), payloads=True).collect(), key=str)
    assert len(got) == len(htmls)
    for r in got:
        html = (dict(htmls)[r["page_id"]] or "").encode()
        first = {long_: 3, edge: 7}.get(html.decode())
        again = first is not None and r["page_id"] != first
        assert (r["record_type"], r["refers_to"]) == (("revisit", first) if again else ("response", None))
        assert (r["payload_bytes"], r["payload_digest"]) == (len(html), hashlib.sha256(html).hexdigest())
        assert r["payload"] is None if again else bytes(r["payload"]) == html


def test_empty_table_makes_no_package(spark):
    assert warc.write_archives(pages_of(spark, [])).count() == 0


def test_packages_are_plain_zip_files(spark):
    row = warc.write_archives(pages_of(spark, [(1, "a")])).first()
    with zipfile.ZipFile(io.BytesIO(row["content"])) as z:
        assert z.namelist() == [warc.DATA, warc.INDEX] and row["length"] == len(row["content"])
        assert json.loads(z.read(warc.INDEX).splitlines()[0])["offset"] == 0


@pytest.mark.parametrize("zip64", [False, True])
def test_reader_takes_ranges_only(zip64):
    raw = warc.record(1, "u", b"payload", "d", 7, None, "t")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in ((warc.DATA, b"junk" * 1000 + raw), (warc.INDEX, json.dumps({"offset": 4000, "length": len(raw)}).encode()), ("note", b"n")):
            with z.open(zipfile.ZipInfo(name), "w", force_zip64=zip64) as f:
                f.write(data)
        z.comment = b"a comment"
    data = out.getvalue()
    if zip64:  # move the directory's place into a ZIP64 record
        end = data.rfind(b"PK\x05\x06")
        count, size, start = int.from_bytes(data[end + 10 : end + 12], "little"), int.from_bytes(data[end + 12 : end + 16], "little"), int.from_bytes(data[end + 16 : end + 20], "little")
        n = lambda v, k: v.to_bytes(k, "little")
        big = b"PK\x06\x06" + n(44, 8) + n(45, 2) * 2 + n(0, 4) * 2 + n(count, 8) * 2 + n(size, 8) + n(start, 8)
        locator = b"PK\x06\x07" + n(0, 4) + n(end, 8) + n(1, 4)
        data = data[:end] + big + locator + b"PK\x05\x06" + n(0, 4) + n(0xFFFF, 2) * 2 + n(0xFFFFFFFF, 4) * 2 + n(0, 2)
    read_bytes = []

    def read(at, n):
        read_bytes.append(n)
        return data[at : at + n]

    ((r),) = warc.read_package(read, len(data))
    assert r["payload"] == b"payload" and r["record_type"] == "response"


def test_pipeline_against_its_parts(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DIR)
        if name != "tokens":
            assert out.columns == docs.columns
        docs = corpus_pipeline.materialise(out, name)
        seen[name] = docs
    n = {k: v.count() for k, v in seen.items()}
    assert 200 >= n["toxicity"] >= n["near_duplicates"] == n["personal_data"] and n["tokens"] == n["mixing"]
    taken = {r["doc_id"]: r["copies"] for r in mixing.mix(seen["personal_data"]).collect()}
    assert {r["doc_id"]: r["count"] for r in seen["tokens"].groupBy("doc_id").count().collect()} == {k: v for k, v in taken.items() if v}
    assert not seen["personal_data"].where(F.col("text").rlike("@mail[0-9]+[.]example[.]com")).count()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    df = QUERIES[name](spark, DIR)
    want = con.execute(ORACLE[name])
    columns = [c[0] for c in want.description]
    cell = lambda x: f"{x:.9g}" if isinstance(x, float) else str(x)
    assert sorted(columns) == sorted(df.columns)
    assert sorted(tuple(map(cell, r)) for r in df.select(*columns).collect()) == sorted(tuple(map(cell, r)) for r in want.fetchall())
