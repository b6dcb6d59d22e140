"""WARC archives: exact round trips, the same bytes from any partitioning, and the edge cases."""

import base64
import gzip
import hashlib
from collections import Counter

import pytest

from scarmap.llm import warc as W

SF = "/root/testdata/sf0.001"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def files(folder):
    return {p.name: p.read_bytes() for p in folder.glob("*.warc.gz")}


def test_round_trip_of_the_table_and_same_bytes_from_any_partitioning(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    more = {"shard_bytes": 40_000, "file_bytes": 10_000}
    one = W.write_archives(pages, str(tmp_path / "one"), **more)
    back = W.read_archives(one, str(tmp_path / "one"))
    assert Counter((r.page_id, r.url, r.payload.decode()) for r in back.collect()) == Counter((r.page_id, r.url, r.html) for r in pages.collect())
    W.write_archives(pages.repartition(7, "html"), f"file://{tmp_path}/two", **more)
    a, b = files(tmp_path / "one"), files(tmp_path / "two")
    assert a == b and len(a) > 5 and len({n[:12] for n in a}) > 3
    assert not (tmp_path / "one" / "_parts").exists()
    rows = {r.file: r for r in one.collect()}
    assert {n: (len(x), hashlib.sha1(x).hexdigest()) for n, x in a.items()} == {n: (r.n_bytes, r.sha1) for n, r in rows.items()}
    assert all(len(x) < 10_000 + 40_000 for x in a.values())
    assert gzip.decompress(next(iter(a.values()))).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
    with pytest.raises(FileExistsError):
        W.write_archives(pages, str(tmp_path / "one"))


CASES = [(1, "u1", "same"), (2, "u2", "same"), (0, "u0", "same"), (3, None, None), (4, "", ""), (5, "u\r\n5 x", "é\r\n\r\nx"), (5, "u5", "é\r\n\r\nx"), (6, "u6", "own"), (6, "u6", "own"), (None, "n", "same"), (None, None, "lone"), (7, "u7", "x" * 3_000_000), (-9, "low", "low")]


@pytest.mark.parametrize("shard_bytes", [W.SHARD_BYTES, 1])
def test_revisits_ties_nulls_and_long_pages(spark, tmp_path, shard_bytes):
    pages = spark.createDataFrame([(*c, "x", 1) for c in CASES], "page_id long, url string, html string, record_type string, shard int")
    manifest = W.write_archives(pages, str(tmp_path / "a"), shard_bytes=shard_bytes)
    got = W.read_archives(manifest, str(tmp_path / "a")).collect()
    want = Counter()
    least = {}
    for p, _, h in CASES:
        if p is not None:
            least[h or ""] = min(p, least.get(h or "", p))
    seen = set()
    for p, _, h in sorted(CASES, key=lambda c: (c[0] is None, c[0] or 0)):
        h = h or ""
        first = p == least.get(h) and (p, h) not in seen
        seen.add((p, h))
        want[(p, len(h.encode()), digest(h), "response" if first else "revisit", None if first else least[h])] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    responses = {r.record_id for r in got if r.record_type == "response"}
    assert len({r.record_id for r in got}) == len(CASES) and len(responses) == 7
    assert {r.url for r in got if r.page_id == 5} == {"u%0D%0A5%20x", "u5"}


def test_small_payloads_are_all_responses(spark, tmp_path):
    pages = spark.createDataFrame([(1, "a", "abc"), (2, "b", "abc"), (3, "c", "abcd"), (4, "d", "abcd")], "page_id long, url string, html string")
    got = W.read_archives(W.write_archives(pages, str(tmp_path / "a"), min_bytes=4), str(tmp_path / "a")).collect()
    assert sorted((r.page_id, r.record_type) for r in got) == [(1, "response"), (2, "response"), (3, "response"), (4, "revisit")]
    empty = W.write_archives(pages.limit(0), str(tmp_path / "b"))
    assert W.read_archives(empty, str(tmp_path / "b")).count() == 0


def test_damage_is_found(spark, tmp_path):
    record = W.page_record(1, "u", b"body", hashlib.sha1(b"body").digest(), 0, None, False, W.DATE)
    plain = gzip.decompress(record)
    assert W.parse_record(plain)[1].endswith(b"\r\n\r\nbody")
    with pytest.raises(ValueError):
        W.parse_record(plain.replace(b"body", b"bodx"))
