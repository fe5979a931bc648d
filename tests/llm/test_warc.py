"""WARC files and the fixity audit."""

import gzip

import pytest
from saldomart.llm.queries import ORACLE_SQL, QUERIES
from saldomart.llm.warc import fixity_audit, page_records, parse_warc, record_leaves, warc_leaves, write_warc

from compare import oracle_connection, oracle_rows, spark_rows

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string, archive string, ordinal int"


def _pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash", 3) for i, u, h in rows], SCHEMA)


PAGES = [(i, f"http://x/{i}", f"<p>{i}</p>\r\n\r\nWARC/1.0\r\n" * (i % 4)) for i in range(40)]


def test_audit_equals_sql(spark):
    got = spark_rows(QUERIES["op6_warc_fixity"](spark, SF))
    assert got == oracle_rows(oracle_connection(SF), ORACLE_SQL["op6_warc_fixity"])
    assert got[1]


def test_files_are_warc_and_places_are_right(spark, tmp_path):
    records = page_records(_pages(spark, PAGES), 25)
    path = str(tmp_path / "warc")
    write_warc(records, path)
    content = b"".join(gzip.decompress(f.read_bytes()) for f in sorted((tmp_path / "warc").glob("archive=0/*.gz")))
    found = list(parse_warc(content))
    assert [i for _, _, i in found] == list(range(25))
    at, size, _ = found[7]
    record = content[at : at + size]
    assert record.startswith(b"WARC/1.0\r\n") and record.endswith(PAGES[7][2].encode())
    assert sorted(warc_leaves(spark, path).collect()) == sorted(record_leaves(records).collect())


def test_sound_replicas_have_no_rows(spark, tmp_path):
    odd = PAGES + [(None, None, None), (None, "u\r\nX: y", "h"), (3, "http://x/3", "twice"), (3, "http://x/3", "twice"), (41, "é", "中" * 9)]
    records = page_records(_pages(spark, odd), 10)
    write_warc(records, str(tmp_path / "warc"))
    leaves = warc_leaves(spark, str(tmp_path / "warc"))
    assert leaves.count() == len(odd)
    assert fixity_audit(record_leaves(records), leaves, 4).count() == 0


@pytest.mark.parametrize("fanout", [2, 16])
def test_each_kind_of_damage(spark, fanout):
    def leaves(rows):
        placed, at = [], 0
        for ordinal, (number, size, digest) in enumerate(rows):
            placed.append((0, ordinal, number, at, size, digest))
            at += size + 4
        return spark.createDataFrame(placed, "archive long, ordinal long, record_id long, record_offset long, n_bytes long, hash string")

    whole = [(i, 10, f"h{i}") for i in range(20)]
    flipped = [(i, s, "other" if i == 11 else h) for i, s, h in whole]
    assert [(r.record_id, r.status, r.record_offset) for r in fixity_audit(leaves(whole), leaves(flipped), fanout).collect()] == [
        (11, "corrupt", 154)
    ]
    short = [x for x in whole if x[0] != 17]
    found = {r.record_id: r.status for r in fixity_audit(leaves(whole), leaves(short), fanout).collect()}
    assert found == {17: "missing", 18: "moved", 19: "moved"}
    found = {r.record_id: r.status for r in fixity_audit(leaves(short), leaves(whole), fanout).collect()}
    assert found == {17: "extra", 18: "moved", 19: "moved"}
    assert fixity_audit(leaves(whole), leaves(whole).limit(0), fanout).filter("status = 'missing'").count() == 20


def test_broken_headers_are_stretches_without_a_number():
    good = b"WARC/1.0\r\nWARC-Record-ID: <urn:page:5>\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    bad = good.replace(b"Content-Length: 2", b"Content-Length: x")
    assert list(parse_warc(good + bad + good)) == [
        (0, len(good) - 4, 5),
        (len(good), len(bad) - 4, None),
        (len(good + bad), len(good) - 4, 5),
    ]
    assert list(parse_warc(b"")) == [] and list(parse_warc(b"rubbish"))[0][2] is None


def test_empty_tables(spark, tmp_path):
    records = page_records(_pages(spark, []))
    write_warc(records, str(tmp_path / "warc"))
    assert fixity_audit(record_leaves(records), warc_leaves(spark, str(tmp_path / "warc"))).count() == 0
