from __future__ import annotations

import zlib

import pytest
from compare import assert_same, duck

from evenkeel.llm import queries, warc
from evenkeel.llm.common import ship
from evenkeel.staging import scratch_path

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pages(spark):
    ship(spark)
    rows = [
        (1, "http://a/1", "same", 0), (7, "http://a/7", "same", 0), (3, "http://a/3 x\r\ny", "same", 0), (
            None, None, "same", 0
        ),
        (4, "http://b", None, 0), (5, "http://c", "", 0), (6, None, "only", 0), (6, None, "only", 0),
        (None, "http://d", "lonely null", 0), (None, "http://e", "lonely null", 0), (
            9, "http://é", "ü\r\n\r\n" * 50_000, 0
        ),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string, offset int")


def read(pages, **settings):
    index = warc.archive_pages(pages, **settings)
    return index, [r.asDict() for r in warc.read_records(index).collect()]


def test_round_trip(pages):
    index, records = read(pages)
    assert len(records) == pages.count()
    of = {}
    for r in records:
        of.setdefault(r["page_id"], []).append(r)
    assert of[7][0]["record_type"] == "response" and bytes(of[7][0]["payload"]) == b"same"
    for page in (1, 3):
        assert (of[page][0]["record_type"], of[page][0]["refers_to"], of[page][0]["payload_bytes"]) == ("revisit", 7, 4)
        assert of[page][0]["payload"] is None and of[page][0]["payload_digest"] == of[7][0]["payload_digest"]
    assert (of[4][0]["record_type"], of[4][0]["refers_to"], of[5][0]["record_type"]) == ("revisit", 5, "response")
    assert [r["record_type"] for r in of[6]] == ["response", "response"]  # a tie for the largest id
    assert sorted((r["record_type"], r["refers_to"]) for r in of[None] if r["payload_bytes"] == 4) == [("revisit", 7)]
    assert {r["record_type"] for r in of[None] if r["payload_bytes"] == 11} == {"response"}
    assert bytes(of[9][0]["payload"]).decode() == "ü\r\n\r\n" * 50_000
    assert of[3][0]["url"] == "http://a/3%20x%0D%0Ay"


def test_index_leads_to_every_record(pages):
    index, _ = read(pages)
    for row in index.collect():
        system, path = warc._files(row["file"])
        with system.open_input_file(path) as archive:
            member = archive.read_at(row["length"], row["offset"])
        assert zlib.decompress(member, 31).startswith(b"WARC/1.1\r\n")
        fields = warc.parse(member)
        assert (fields["page_id"], fields["record_type"], fields["payload_digest"]) == (
            row["page_id"], row["record_type"], row["payload_digest"]
        )


def test_selected_records_and_small_stretches(pages):
    index, _ = read(pages, min_bytes=5)
    chosen = index.where("page_id in (5, 9)")
    found = warc.read_records(chosen, stretch_bytes=50, gap_bytes=0).collect()
    assert sorted(r["page_id"] for r in found) == [5, 9]
    assert index.where("payload_bytes < 5 and record_type = 'revisit'").count() == 0


def test_files_roll_over(spark, pages):
    index = warc.write_archives(warc.with_revisits(pages.repartition(1)), scratch_path(spark, "warc"), file_bytes=300)
    assert index.select("file").distinct().count() > 2
    assert warc.read_records(index).count() == pages.count()


def test_hot_payload_spreads(spark):
    rows = spark.range(0, 3000, 1, 8).selectExpr(
        "id as page_id", "'http://x' as url", "if(id % 3 = 0, 'hot', concat('p', id)) as html"
    )
    out = warc.with_revisits(rows)
    assert out.where("refers_to = 2997").count() == 999 and out.where("refers_to is null").count() == 2001


def test_damage_is_noticed(pages):
    member = warc.record(1, "http://a", b"payload", None)
    broken = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = zlib.decompress(member, 31).replace(b"\r\npayload", b"\r\nPayload")
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(broken.compress(data) + broken.flush())


def test_empty_table(pages):
    index, records = read(pages.limit(0))
    assert index.count() == 0 and records == []


def test_query(spark):
    assert assert_same(queries.QUERIES["op2_warc"](spark, SF), duck(SF).sql(queries.ORACLES["op2_warc"])) == 250
