import base64
import glob
import gzip
import hashlib
import uuid

import pytest
from hypothesis import given
from hypothesis import strategies as st

from namesieve.llm import archives


def expected(rows, least=0):
    first = {}
    for page_id, _, html in rows:
        body = (html or "").encode()
        if page_id is not None:
            first[body] = min(first.get(body, page_id), page_id)
    out = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        owner = first.get(body) if len(body) >= least else page_id
        again = owner is not None and owner != page_id
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page_id, len(body), digest, "revisit" if again else "response", owner if again else None))
    return sorted(out, key=str)


def listed(df):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect()), key=str)


@given(st.text(max_size=300), st.integers(4, 40))
def test_chunks_and_slices_come_back(text, size):
    data = text.encode()
    assert b"".join(archives.slices(data, size)) == data
    assert all(len(x) <= size and x.decode() is not None for x in archives.slices(data, size))
    assert archives.unchunked(archives.chunked(data, size)) == data


def test_chunk_extensions_and_broken_chunks():
    assert archives.unchunked(b"3;name=v\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        archives.unchunked(b"2\r\nabc\r\n0\r\n\r\n")


ROWS = [
    (5, "http://a/", "same"), (3, "http://b/", "same"), (9, "http://c/ d\n", "same"), (7, None, None), (8, "u", ""),
    (1, "http://l/", "WARC/1.1\r\n\r\n" + "lörem \U0001f600 " * 9000), (2, "http://l/2", "x" * 70_000), (4, "http://l/3", "x" * 70_000),
    (None, "n", "no id"), (None, "n", "same"), (6, "r", "repeated" * 4000), (6, "r", "repeated" * 4000),
]


def test_round_trip(spark, tmp_path):
    folder = f"{tmp_path}/w"
    pages = spark.createDataFrame([(*r, "x", "x") for r in ROWS], "page_id bigint, url string, html string, digest string, kind string").repartition(3)
    archives.write_archives(pages, folder)
    back = archives.read_archives(spark, folder)
    assert listed(back) == expected(ROWS)
    bodies = {(r["page_id"], bytes(r["payload"])) for r in back.collect()}
    assert bodies == {(i, (h or "").encode()) for i, _, h in ROWS}


def test_small_payloads_are_never_revisits(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, "page_id bigint, url string, html string")
    archives.write_archives(pages, f"{tmp_path}/w", revisit_from=1000)
    assert listed(archives.read_archives(spark, f"{tmp_path}/w", payloads=False)) == expected(ROWS, 1000)


def test_archives_are_well_formed_and_split(spark, tmp_path):
    archives.write_archives(spark.createDataFrame(ROWS, "page_id bigint, url string, html string"), f"{tmp_path}/w")
    kinds, segments = [], {}
    for name in glob.glob(f"{tmp_path}/w/part-*"):
        assert gzip.open(name).read(5) in (b"WARC/", b"")
        for fields, block in archives.parse(open(name, "rb").read()):
            kinds.append(fields["warc-type"])
            assert len(block) <= archives.SEGMENT_BYTES
            if "warc-segment-number" in fields:
                segments.setdefault(fields.get("warc-segment-origin-id", fields["warc-record-id"]), []).append(int(fields["warc-segment-number"]))
    assert "continuation" in kinds and all(sorted(x) == list(range(1, len(x) + 1)) for x in segments.values())


def segment(number, block, total=None, origin="<urn:uuid:o>"):
    fields = [("WARC-Type", "response" if number == 1 else "continuation"), ("WARC-Record-ID", origin if number == 1 else f"<urn:uuid:{uuid.uuid4()}>"), ("Page-Id", 1), ("WARC-Segment-Number", number)]
    fields += [("WARC-Segment-Origin-ID", origin)] * (number > 1) + [("WARC-Segment-Total-Length", total)] * (total is not None)
    return archives._record(fields, block) + archives.END


@pytest.mark.parametrize("records", [[segment(1, "ab"), segment(3, "c", 3)], [segment(1, "ab"), segment(2, "c", 4)], [segment(1, "ab"), segment(2, "c")]])
def test_missing_segments_and_wrong_lengths_are_errors(spark, tmp_path, records):
    (tmp_path / "part-0.warc").write_text("".join(records), newline="")
    with pytest.raises(Exception, match="segments of"):
        archives.read_archives(spark, str(tmp_path)).collect()


def test_segments_of_several_archives_in_any_order(spark, tmp_path):
    head = "HTTP/1.1 200 OK\r\n\r\n"
    (tmp_path / "part-0.warc").write_text(segment(3, "last", len(head) + 8), newline="")
    (tmp_path / "part-1.warc").write_text(segment(2, "mid ") + segment(1, head, origin="<urn:uuid:o>"), newline="")
    (row,) = archives.read_archives(spark, str(tmp_path)).collect()
    assert bytes(row["payload"]) == b"mid last" and row["record_type"] == "response"


def test_query_and_empty_table(spark, folder, tmp_path):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    rows = [(r["page_id"], r["url"], r["html"]) for r in pages.collect()]
    assert listed(archives.op3_warc(spark, folder)) == expected(rows)
    archives.write_archives(pages.limit(0), f"{tmp_path}/none")
    assert archives.read_archives(spark, f"{tmp_path}/none").count() == 0
