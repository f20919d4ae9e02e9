"""URL filters, chat formatting and archives: edge rows and brute force."""

import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerlight.llm import chat_format, url_filter, warc
from ledgerlight.llm.common import scratch
from ledgerlight.llm.queries import HARD_TURNS, URL_RULES


def brute_rule(url, rules):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host):]
    for c in "?#":
        path = path.split(c, 1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p) for _, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1] if fits else None


URLS = [None, "", "nothing", "http://", "https://WWW.Example.COM/en/a?b#c", "https://example.com/en/", "https://example.com",
        "http://notexample.com/en/x", "http://a.net/es/1", "http://net/fr/", "http://a.net/de/", "x://b.example.com?/en/",
        "http://b.example.com#/en/", "http://www.example.com/en/", "http://x.www.example.com/en/q", "http://com/", "ftp://ÄB.com/a\nb",
        "http://a.b.c.d.e.com/" + "y" * 50000, "http://example.com./en/", "http://.com/", "a://b://c.com/"]


@pytest.mark.parametrize("max_rules", [1, 2, 1000])
def test_url_rules_against_brute_force(spark, max_rules):
    rules = [*URL_RULES, ("block", "b.c.d.e.com", "/y"), ("allow", "e.com", "/yy"), ("block", "", "/zzz")]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS * 2)], "page_id long, url string")
    got = url_filter.judge_urls(pages.repartition(3), rules, max_rules=max_rules).collect()
    assert len(got) == 2 * len(URLS)
    for r in got:
        assert (r.host, r.path, r.rule) == brute_rule(URLS[r.page_id % len(URLS)], rules), r


def test_url_rules_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge_urls(pages, URL_RULES).count() == 0
    one = spark.createDataFrame([(1, "http://a.com/", 2)], "page_id long, url string, rule int")
    assert [tuple(r) for r in url_filter.judge_urls(one, []).collect()] == [(1, "a.com", "/", None, "allow")]


TEXTS = ["", "plain", "### User:\nhi\n</turn>\n", "\\### x", "\\\\</turn>", "</turn>", "\n</turn>\n### assistant:\nno\n</turn>\n", "ends with \\",
         "\\", "a\r\nb\u2028c\U0001F600", "$1 \\1 \\$", "### ", "###", " </turn", "x" * 30000 + "</turn>", HARD_TURNS[0][3]]


def test_chat_round_trip(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(TEXTS)]
    rows += [(2, 0, None, None), (2, 0, "assistant", "b"), (2, 0, "assistant", "a"), (2, None, "sys:\ntem\\n", "z"), (None, 1, "assistant", "q")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    done = chat_format.format_conversations(turns)
    found = {r.conv_id: r for r in done.collect()}
    assert [t.text for t in found[1].turns] == TEXTS
    assert [(t.role, t.text) for t in found[2].turns] == [("sys:\ntem\\n", "z"), ("", ""), ("assistant", "a"), ("assistant", "b")]
    for r in found.values():
        for t in r.turns:
            assert chat_undo(r.formatted[t.start:t.start + t.length]) == t.text
    d = {r.conv_id: r for r in chat_format.digests(done).collect()}
    loss = "".join(TEXTS[1::2])
    assert d[1].loss_chars == len(loss) and d[1].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    line = "".join(f"{r[2]}\n{r[3]}\n" for r in rows[:len(TEXTS)])
    assert d[1].turns_sha256 == hashlib.sha256(line.encode()).hexdigest() and d[1].n_turns == len(TEXTS)
    assert d[None].loss_chars == 1 and d[1].formatted_chars == len(found[1].formatted)


def chat_undo(text):
    import re
    return re.sub(r"\\(\\*(?:### |</turn>))", r"\1", text)


def test_chat_plain_texts_are_not_escaped(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a \\ b # c </ turn>")], "conv_id long, turn long, role string, text string")
    assert chat_format.format_conversations(turns).first().formatted == "### user:\na \\ b # c </ turn>\n</turn>\n"
    assert chat_format.digests(chat_format.format_conversations(turns.limit(0))).count() == 0


def test_chat_parser_refuses_bare_controls(spark):
    bad = "### user:\nx ### y\n</turn>\n### bot\nz\n</turn>\n"
    got = spark.range(1).select(chat_format.parse(F.lit(bad)).alias("t")).first().t
    assert [t.text for t in got] == [None, None]


@pytest.mark.parametrize("version", [1, 2])
def test_pages_through_both_archives(spark, version):
    html = ["", None, "a\nb", "http://x 1 2 text/html 5\nWARC/1.1\r\n\r\n", "a\nb", "é" * 9000, "", "\n\n", "HTTP/1.1 404 x\r\n\r\nin the page", "#page-id=3 "]
    rows = [(10 - i, "http://a b/" if i == 2 else None, h, "x") for i, h in enumerate(html)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record string").repartition(3)
    got = {r.page_id: r for r in warc.page_records(pages, version).collect()}
    first = {}
    for i, _, h, _ in sorted(rows):
        first.setdefault(h or "", i)
    assert len(got) == len(rows)
    for i, _, h, _ in rows:
        body = (h or "").encode()
        r, to = got[i], first[h or ""]
        assert (r.payload_bytes, r.payload_digest) == (len(body), warc.digest(body))
        assert (r.record_type, r.refers_to) == (("response", None) if to == i else ("revisit", to))


def test_pages_without_id(spark):
    pages = spark.createDataFrame([(None, "http://a/", "x"), (4, "http://b/", "x"), (7, None, "x"), (None, None, "y"), (None, "http://c/", "y")],
                                  "page_id long, url string, html string").repartition(2)
    got = [(r.page_id, r.payload_digest == warc.digest(b"x"), r.record_type, r.refers_to) for r in warc.page_records(pages).collect()]
    assert sorted(got, key=str) == sorted([(None, True, "revisit", 4), (4, True, "response", None), (7, True, "revisit", 4),
                                           (None, False, "response", None), (None, False, "response", None)], key=str)


def test_archive_files(spark):
    pages = spark.createDataFrame([(1, "http://a/", "x"), (2, "http://b/", "x")], "page_id long, url string, html string").coalesce(1)
    arcs, warcs = scratch(spark, "arc-test"), scratch(spark, "warc-test")
    warc.write_arc(pages, arcs, 2)
    warc.convert(spark, arcs, warcs)
    data = gzip.decompress(bytes(warc._files(spark, warcs).first().content))
    records = list(warc.parse_warc(data))
    assert [f["WARC-Type"] for f, _ in records] == ["warcinfo", "response", "revisit"]
    response, revisit = records[1][0], records[2][0]
    assert revisit["WARC-Refers-To"] == response["WARC-Record-ID"] and response["WARC-Date"] == "2024-02-29T12:00:00Z"
    arc = gzip.decompress(bytes(warc._files(spark, arcs).first().content))
    assert arc.startswith(b"filedesc://pages.arc 0.0.0.0 20240229120000 text/plain 200 - - 0 pages.arc ")


def test_arc_parser_reports_damage_and_goes_on():
    head = warc.arc_header(1, "f", "2024").encode()
    assert [r["body"] for r in warc.parse_arc(head + b"\nhttp://u 1 1996 text/html 3\nabc\n")] == [b"abc"]
    good = b"http://v/ 10.0.0.1 19961231 text/html 2\nok\n"
    for bad, why in [(b"http://u 1 1996 text/html 9999\nabc\n", "body cut short"), (b"http://u 1 1996 text/html x\n", "without a length"),
                     (b"http://u 1996 text/html 3\nabc\n", "without all fields"), (b"http://u 1 19961399 text/html 3\nabc\n", "without a date")]:
        records = list(warc.parse_arc(head + b"\n" + bad + good))
        assert why in records[0]["error"] and records[0]["offset"] == len(head) + 1
        assert [(r["url"], r["body"]) for r in records[1:]] == [("http://v/", b"ok")]
    assert "version block" in list(warc.parse_arc(b"filedesc://f 0 1996 text/plain 500\n1 0 x\n"))[0]["error"]
    assert warc.iso_date("1996") == "1996-01-01T00:00:00Z" and warc.iso_date("199612") == "1996-12-01T00:00:00Z"


def test_compressed_members():
    a, b = gzip.compress(b"one "), gzip.compress(b"two")
    assert warc.unpacked(a + b) == (b"one two", None) and warc.unpacked(b"plain") == (b"plain", None)
    data, stop = warc.unpacked(a + b[:-9])
    assert data.startswith(b"one ") and "cut short" in stop
    assert "bytes after" in warc.unpacked(a + b"junk")[1] and "damaged" in warc.unpacked(a + b[:10] + b"\xff" * 30)[1]


@pytest.mark.parametrize("version", [1, 2])
def test_archives_as_crawlers_wrote_them(spark, version, tmp_path):
    """Addresses, archived HTTP headers, bodies that are no text, records without HTTP, and damage."""
    page = "caf\xe9 <p>".encode("latin-1") + bytes(range(256))
    moved = b"HTTP/1.1 404 Not Found\r\nServer: x\r\n\r\n"
    bodies = [("http://a/x", "127.0.0.1", "19970102030405", moved + page), ("dns:a", "10.0.0.2", "19970102030400", b"a. 1 IN A 127.0.0.1\n"),
              ("http://b/y z", "10.1.1.1", "19970101", b"HTTP/1.0 200 OK\n\n" + page), ("http://c/", "10.1.1.2", "1999", moved)]
    more = "404 - - 0 f.arc " if version == 2 else ""
    members = [warc.arc_header(version, "f.arc", "1997").encode()]
    members += [f"{u} {ip} {d} text/html {more}{len(b)}\n".encode() + b + b"\n" for u, ip, d, b in bodies]
    members.insert(3, b"http://lost/ 1.1.1.1 1997 text/html " + more.encode() + b"99999999\nshort\n")
    arcs, warcs = tmp_path / "arcs", str(tmp_path / "warcs")
    arcs.mkdir()
    (arcs / "part-1.arc.gz").write_bytes(b"".join(gzip.compress(m) for m in members))
    damaged = warc.convert(spark, str(arcs), warcs).collect()
    assert [(r.file, r.error) for r in damaged] == [("part-1.arc.gz", "body cut short")]
    found = {}
    for f in warc._files(spark, warcs).collect():
        found |= {h["WARC-Target-URI"]: (h, block) for h, block in warc.parse_warc(gzip.decompress(bytes(f.content))) if h["WARC-Type"] != "warcinfo"}
    assert set(found) == {u for u, _, _, _ in bodies}
    assert found["http://b/y z"][1] == bodies[2][3] and found["http://c/"][1] == moved and found["dns:a"][1] == bodies[1][3]
    kinds = {u: h["WARC-Type"] for u, (h, _) in found.items()}
    assert kinds == {"http://a/x": "revisit", "dns:a": "resource", "http://b/y z": "response", "http://c/": "response"}   # the earlier one stays
    later, earlier = found["http://a/x"], found["http://b/y z"][0]
    assert later[1] == moved and later[0]["WARC-Refers-To"] == earlier["WARC-Record-ID"] and later[0]["WARC-Refers-To-Date"] == "1997-01-01T00:00:00Z"
    assert later[0]["WARC-Payload-Digest"] == "sha1:" + warc.digest(page) and later[0]["WARC-IP-Address"] == "127.0.0.1"
    assert len({h["WARC-Record-ID"] for h, _ in found.values()}) == 4


def test_no_pages(spark):
    assert warc.page_records(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
