import base64
import gzip
import hashlib
import io
import zlib
from collections import defaultdict

import pytest

from revtide.llm import warc
from revtide.llm.queries import QUERIES


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, extra string")


ROWS = [
    *((i, f"http://h/{i}", f"<p>{'x' * (i % 7) * 50}</p>é", None) for i in range(100)),
    (100, None, None, "a"), (101, "http://h/\r\n: x", "", "b"), (102, "u", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n", None),
    (103, "u", "y" * 3_000_000, None), (None, "u", "no id", None), (104, "u", "no id", None), (105, "u", "tie", None), (105, "u", "tie", None),
]


def test_round_trip(spark, tmp_path):
    got = warc.round_trip(pages(spark, ROWS).repartition(4), str(tmp_path)).collect()
    assert len(got) == len(ROWS)
    largest = defaultdict(lambda: -1)
    for page, _, html, _ in ROWS:
        largest[html or ""] = max(largest[html or ""], -1 if page is None else page)
    by_id = defaultdict(list)
    for r in got:
        by_id[r.page_id].append(r)
    for page, _, html, _ in ROWS:
        payload = (html or "").encode()
        for r in by_id[page]:
            assert r.payload_bytes == len(payload) and r.intact
            assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if page == largest[html or ""]:
                assert (r.record_type, r.refers_to, r.block_bytes) == ("response", None, len(payload))
            else:
                assert (r.record_type, r.refers_to, r.block_bytes) == ("revisit", largest[html or ""], 0)


def test_small_payloads_are_not_shared(spark, tmp_path):
    got = warc.round_trip(pages(spark, ROWS), str(tmp_path), least_shared=10**7).collect()
    assert {r.record_type for r in got} == {"response"}


def test_normalised_archive(tmp_path):
    records = [warc.page_record(i, f"u{i}", b"body" * i, warc.digest(b"body" * i), None) for i in range(50)]
    source, target = f"{tmp_path}/a.warc.gz", f"{tmp_path}/out/a.warc.gz"
    # Two members in the source, records across the border of blocks.
    cut = sum(map(len, records)) // 2
    joined = b"".join(records)
    with open(source, "wb") as out:
        out.write(gzip.compress(joined[:cut]) + gzip.compress(joined[cut:]))
    assert warc.normalise(source, target) == (target, 50)
    data = open(target, "rb").read()
    assert gzip.decompress(data) == joined
    entries = [__import__("json").loads(line) for line in open(f"{target}.idx")]
    for entry, record in zip(entries, records, strict=True):
        assert gzip.decompress(data[entry["offset"] : entry["offset"] + entry["length"]]) == record
    assert sum(e["length"] for e in entries) == len(data)


@pytest.mark.parametrize("block", [1, 7, 1 << 16])
def test_streams_in_pieces(block):
    records = [warc.record_bytes({"WARC-Type": "response", "N": str(i)}, bytes(range(256)) * i) for i in range(5)]
    stream = io.BytesIO(gzip.compress(b"".join(records)))
    assert list(warc.records_of_stream(warc.inflated(stream.read, block))) == records


def test_broken_archives_raise():
    with pytest.raises(ValueError):
        list(warc.records_of_stream([warc.record_bytes({"WARC-Type": "response"}, b"abc")[:-6]]))
    with pytest.raises(ValueError):
        warc.parse_record(b"GET / HTTP/1.1\r\n\r\n")
    with pytest.raises(zlib.error):
        list(warc.inflated(io.BytesIO(b"not gzip").read))


def test_empty_table_and_query(spark, tmp_path):
    assert warc.round_trip(pages(spark, []), f"{tmp_path}/none").count() == 0
    pages(spark, ROWS).write.parquet(f"{tmp_path}/pages.parquet")
    assert QUERIES["op4_warc_normaliser"](spark, str(tmp_path)).count() == len(ROWS)


def test_headers_of_other_writers(tmp_path):
    """Lower-case names, no space after the colon, folded lines."""
    heads = [
        b"WARC/1.0\r\nwarc-type: response\r\ncontent-length: 2\r\npage-id: 7",
        b"WARC/1.1\r\nWARC-Type:resource\r\nContent-Length:3\r\nPage-ID:8",
        b"WARC/1.1\r\nContent-Type: text/html;\r\n charset=utf-8\r\nWARC-TYPE: response\r\nX-Own: a: b\r\nContent-Length: 0",
    ]
    blocks = [b"ab", b"c\r\n", b""]
    data = b"".join(h + b"\r\n\r\n" + b + b"\r\n\r\n" for h, b in zip(heads, blocks, strict=True))
    records = [warc.parse_record(r) for r in warc.records_of_stream(iter([data[:30], data[30:]]))]
    assert [r.block for r in records] == blocks
    assert [r.headers["WARC-Type"] for r in records] == ["response", "resource", "response"]
    assert records[2].headers["Content-Type"] == "text/html; charset=utf-8" and records[2].headers["X-Own"] == "a: b"
    source = tmp_path / "other.warc.gz"
    source.write_bytes(gzip.compress(data))
    assert warc.normalise(str(source), str(tmp_path / "normal.warc.gz"))[1] == 3
