import base64
import gzip
import hashlib
import io

from wellspring.llm import warc

SCHEMA = "html string, page_id bigint, url string, payload string, first int, n int, sha1 string"


def rows_of(spark, pages, **how):
    return warc.archived(spark, spark.createDataFrame(pages, SCHEMA).repartition(3), **how).collect()


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip(spark):
    texts = ["<p>é</p>", None, "", "x", "<p>é</p>", "line\r\n\r\nline", "ab" * 400_000, "\u0000", "WARC/1.1\r\n\r\n"]
    pages = [(t, i, None if i == 2 else f"http://a/{i} b\n", "p", 0, 0, "s") for i, t in enumerate(texts)]
    got = {r.page_id: r for r in rows_of(spark, pages)}
    assert sorted(got) == list(range(len(texts)))
    for i, t in enumerate(texts):
        r, first = got[i], [x or "" for x in texts].index(t or "")
        assert r.problem is None
        assert (r.payload_bytes, r.payload_digest) == (len((t or "").encode()), sha(t))
        assert (r.record_type, r.refers_to) == (("response", None) if first == i else ("revisit", first))
        assert r.payload is None if first != i else bytes(r.payload).decode() == (t or "")


def test_small_payloads_stay_responses(spark):
    pages = [("aa", 1, "u", "", 0, 0, ""), ("aa", 2, "u", "", 0, 0, ""), ("bbb", 3, "u", "", 0, 0, ""), ("bbb", 4, "u", "", 0, 0, "")]
    kinds = {r.page_id: r.record_type for r in rows_of(spark, pages, revisit_from=3)}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_null_ids_repeated_rows_and_no_rows(spark):
    pages = [("a", None, "u", "", 0, 0, ""), ("a", 5, "u", "", 0, 0, ""), ("a", 5, "u", "", 0, 0, ""), ("b", None, "u", "", 0, 0, "")]
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in rows_of(spark, pages)), key=str)
    assert got == sorted([(None, "revisit", 5), (5, "response", None), (5, "response", None), (None, "response", None)], key=str)
    assert rows_of(spark, []) == []


def test_archives_of_bounded_size(spark, tmp_path):
    pages = spark.createDataFrame([(str(i) * 50, i, "u", "", 0, 0, "") for i in range(20)], SCHEMA).coalesce(1)
    manifest = warc.write_archives(pages, str(tmp_path / "w"), archive_bytes=2000)
    assert manifest.count() > 1 and sum(r.records for r in manifest.collect()) == 20
    assert warc.read_archives(manifest).count() == 20
    first = manifest.first().archive
    with gzip.open(first) as f:  # plain gzip reads the members as one stream
        assert f.read().count(b"WARC/1.1\r\n") == manifest.first().records + 1


def test_long_headers(spark):
    """A url of 2 MB between other pages, and one whose encoding is three times as long."""
    urls = ["u", "http://a/" + "x" * 2_000_000, "v", "http://a/" + "é" * 300_000, "w"]
    got = {r.page_id: r for r in rows_of(spark, [(f"t{i}", i, u, "", 0, 0, "") for i, u in enumerate(urls)])}
    assert sorted(got) == [0, 1, 2, 3, 4] and all(r.problem is None and bytes(r.payload) == f"t{i}".encode() for i, r in got.items())


def test_reading_goes_on_after_a_broken_record():
    """Whatever is broken, the records after it are read."""
    def record(text):
        return warc.member([("WARC-Type", "resource"), ("WARC-Record-ID", text)], text.encode() * 3000)

    seen = lambda data: [(h.get("warc-record-id"), p is None) for h, _, _, p in warc.records(io.BytesIO(data))]
    good = [record(c) for c in "abc"]
    assert seen(b"".join(good)) == [("a", True), ("b", True), ("c", True)]
    short = gzip.compress(b"WARC/1.1\r\nWARC-Record-ID: x\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n")
    headless = gzip.compress(b"WARC/1.1 without an end" * 10_000)
    torn = bytearray(record("t" + "".join(map(chr, range(48, 90))) * 50))
    torn[40:60] = bytes(20)
    for bad in (short, headless, bytes(torn), b"no member at all", b"\x1f\x8b\x08" * 5, record("z")[:-9]):
        found = seen(good[0] + bad + good[1] + good[2])
        assert [f for f in found if f[1]] == [("a", True), ("b", True), ("c", True)], bad[:30]
        assert sum(not ok for _, ok in found) == 1


def test_broken_archives_are_reported():
    good = warc.member([("WARC-Type", "resource"), ("WARC-Payload-Digest", f"sha1:{sha('abc')}")], b"abc")
    bad = warc.member([("WARC-Type", "resource"), ("WARC-Payload-Digest", f"sha1:{sha('x')}")], b"abc")
    problems = lambda data: [p for *_, p in warc.records(io.BytesIO(data))]
    assert problems(good + good) == [None, None]
    assert problems(good + bad + good) == [None, "warc-payload-digest differs", None]
    assert problems(good + good[:-12]) == [None, "archive ends within a record"]
    assert problems(gzip.compress(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n")) == ["block shorter than its Content-Length"]
    assert problems(gzip.compress(b"WARC/1.1\r\nContent-Length: 1\r\n\r\nabc\r\n\r\n")) == ["record does not end with its member"]
    assert problems(b"plain text")[0] is not None
    assert problems(b"") == []


def test_query_agrees_with_sql(same):
    same("op2_warc")
