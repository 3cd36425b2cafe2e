"""Web archives: round trips of odd payloads, foreign archives, and captures assembled by identifiers."""

import collections
import gzip
import hashlib
import random

import pytest

from panelkit.llm import warc

SCHEMA = "page_id long, url string, html string, type string, record string, _row int"


def plain(rows, least=1000):
    """page_id, bytes, digest, type, refers_to of every page, as counts."""
    best = collections.defaultdict(list)
    for i, r in enumerate(rows):
        best[r[2] or ""].append(((r[0] is not None, r[0] or 0), i))
    out = collections.Counter()
    for i, (page, _, html, *_) in enumerate(rows):
        data = (html or "").encode()
        top = max(best[html or ""])
        again = len(data) >= least and top[1] != i
        out[(page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", rows[top[1]][0] if again else None)] += 1
    return out


def pages():
    rng = random.Random(3)
    crlf = lambda n: "".join(rng.choice(["\r", "\n", "\r\n", "\r\n\r\n", "a", "é", "WARC/1.1\r\n", "Content-Length: 9"]) for _ in range(n))
    same, tie = crlf(2000), "x" * 1000
    rows = [(i, f"https://host{i}.example/p{i}?q=é#f", crlf(rng.randint(0, 400))) for i in range(60)]
    rows += [(100, "http://a/b", same), (101, "http://a/b", same), (99, None, same), (None, "no scheme", same), (None, None, None)]
    rows += [(102, "http://a/\r\nWARC-Type: x", tie), (102, "http://a/", tie), (102, "http://a/", tie), (103, "", "x" * 999), (104, "", "x" * 999)]
    rows += [(105, "http://big/", crlf(120_000)), (106, "u", ""), (-7, "u", "\r\n\r\n"), (107, "u", "x" * 300_000)]
    rows += [(200 + i, "http://hot/", "hot" * 400) for i in range(70)]
    return [(*r, "t", "r", i) for i, r in enumerate(rows)]


@pytest.mark.parametrize("per_file", [7, 30_000])
def test_round_trip(spark, tmp_path, per_file):
    rows = pages()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    out = warc.round_trip(df, str(tmp_path / "w"), records_per_file=per_file).collect()
    assert all(r["intact"] for r in out)
    got = collections.Counter(tuple(r)[:5] for r in out)
    want = plain(rows)
    assert got == want
    assert collections.Counter(tuple(r)[:5] for r in warc.round_trip(df, str(tmp_path / "v"), payload=False).collect()) == want
    # whole payloads and requests come back
    found = warc.captures(warc.read(spark, str(tmp_path / "w"))).collect()
    full = collections.Counter(bytes(r["response"]["payload"]) for r in found if r["type"] == "response")
    assert full == collections.Counter({(r[2] or "").encode(): 1 for r in rows if len((r[2] or "").encode()) >= 1000}) + collections.Counter(
        (r[2] or "").encode() for r in rows if len((r[2] or "").encode()) < 1000)
    assert all(r["n_request"] == r["n_metadata"] == 1 and r["request"]["target_uri"] == r["response"]["target_uri"] for r in found)
    if per_file == 7:
        assert len(list((tmp_path / "w").glob("part-*.gz"))) > 10


def test_files_are_archives(spark, tmp_path):
    """The bytes are what the format asks for: version, headers, block of the named length, two line breaks."""
    warc.write(spark.createDataFrame([(5, "http://a.example/x?y=1", "<p>é</p>")], "page_id long, url string, html string"),
               str(tmp_path / "w"), crawl="c", date="2020-02-03T04:05:06Z")
    data = b"".join(gzip.open(p).read() for p in (tmp_path / "w").glob("part-*.gz"))
    first = data.split(b"\r\n\r\n")[0].decode().split("\r\n")
    digest = hashlib.sha1("<p>é</p>".encode()).hexdigest()
    assert first[0] == "WARC/1.1" and first[1] == "WARC-Type: response" and "WARC-Date: 2020-02-03T04:05:06Z" in first
    assert f"WARC-Payload-Digest: sha1:{digest}" in first and "WARC-Target-URI: http://a.example/x?y=1" in first
    assert b"GET /x?y=1 HTTP/1.1\r\nHost: a.example\r\n\r\n\r\n\r\n" in data and data.endswith(b"page_id: 5\r\n\r\n\r\n")


def test_foreign_and_broken_archives(spark, tmp_path):
    """Base 32 digests, record members of their own, leading blank lines, a cut last record, orphans and repeats."""
    def record(kind, name, block, *headers, content="application/http"):
        head = "\r\n".join(["WARC/1.0", f"warc-type: {kind}", f"WARC-Record-ID: {name}", *headers, f"Content-Type: {content}",
                            f"Content-Length: {len(block)}"])
        return gzip.compress(head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n")
    body = b"\x00\xff\r\n\r\nbinary"
    import base64
    b32 = base64.b32encode(hashlib.sha1(body).digest()).decode()
    folder = tmp_path / "w"
    folder.mkdir()
    whole = [gzip.compress(b"\r\n\r\n"), record("warcinfo", "<i>", b"a: b", content="application/warc-fields"),
             record("response", "<r1>", b"HTTP/1.1 200 OK\r\n\r\n" + body, f"WARC-Payload-Digest: sha1:{b32}"),
             record("metadata", "<m2>", b"page_id: 1\r\nb: 2", "WARC-Concurrent-To: <r1>", content="application/warc-fields"),
             record("metadata", "<m1>", b"page_id: 1\r\nb: 1", "WARC-Concurrent-To: <r1>", content="application/warc-fields"),
             record("request", "<q9>", b"GET / HTTP/1.1\r\n\r\n", "WARC-Concurrent-To: <nothing>"),
             record("revisit", "<v1>", b"HTTP/1.1 200 OK\r\n\r\n", "WARC-Refers-To: <r1>", f"WARC-Payload-Digest: sha1:{b32}"),
             record("revisit", "<v2>", b"", "WARC-Refers-To: <gone>")]
    (folder / "a.warc.gz").write_bytes(b"".join(whole))
    cut = gzip.decompress(record("response", "<cut>", b"HTTP/1.1 200 OK\r\n\r\nabc"))[:-9]
    (folder / "b.warc.gz").write_bytes(gzip.compress(b"noise\r\n\r\n" + cut))
    got = {r["record_id"]: r for r in warc.read(spark, str(folder)).collect()}
    assert set(got) == {"<i>", "<r1>", "<m1>", "<m2>", "<q9>", "<v1>", "<v2>"}
    assert bytes(got["<r1>"]["payload"]) == body and got["<r1>"]["digest"] == hashlib.sha1(body).hexdigest() == got["<r1>"]["payload_sha1"]
    out = {r["record_id"]: r for r in warc.resolve(warc.written(warc.captures(warc.read(spark, str(folder))))).collect()}
    assert set(out) == {"<r1>", "<v1>", "<v2>"}
    assert out["<r1>"]["metadata"]["record_id"] == "<m1>" and out["<r1>"]["n_metadata"] == 2 and out["<r1>"]["request"] is None
    assert out["<v1>"]["origin"]["record_id"] == "<r1>" and out["<v2>"]["origin"] is None


def test_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert warc.round_trip(empty, str(tmp_path / "w")).count() == 0
    text = spark.createDataFrame([("a b\r\n", "u", "y" * 2000), ("z", "u", "y" * 2000)], "page_id string, url string, html string")
    got = {(r["page_id"], r["record_type"], r["refers_to"]) for r in warc.round_trip(text, str(tmp_path / "v")).collect()}
    assert got == {("a b\r\n", "revisit", "z"), ("z", "response", None)}
