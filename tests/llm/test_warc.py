import base64
import hashlib
import html
import json
import re
from html.parser import HTMLParser

from docmill.llm import warc

PAGE = '<html><head><title>A &amp; B</title><style>p{}</style><script>var t="</p>";</script></head><body><!-- no --><p>One<br>two  <b>bold</b></p><a href="/x">go</a><a href=y.html>&lt;y</a></body></html>'


def sha(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], "page_id long, url string, html string, record_id string, block string")


def test_text_title_links():
    assert warc.plain_text(PAGE) == "One\ntwo bold\ngo<y"
    assert warc.title_of(PAGE) == "A & B" and warc.links_of(PAGE, "http://h/a/") == ["http://h/x", "http://h/a/y.html"]
    assert warc.plain_text("<script>never closed") == "" and warc.plain_text("a < b <!-- open") == "a < b" and warc.title_of("<p>") is None


def test_derivatives_refer_to_their_response(spark):
    rows = [(1, "http://h/a/", PAGE), (2, None, None), (3, "http://h/é", ""), (3, "http://h/é", ""), (None, "http://[bad", "<a href='http://[x'>t")]
    source = warc.responses(pages(spark, rows))
    by = {r["record_id"]: r for r in source.collect()}
    got = warc.derive(source).collect()
    assert len(got) == 2 * len(rows) and {r["warc_type"] for r in got} == {"metadata", "conversion"}
    for r in got:
        s = by[r["refers_to"]]
        assert (r["target_uri"], r["warc_date"], r["source_headers"], r["source_payload_digest"]) == (s["target_uri"], s["warc_date"], s["http_headers"], s["payload_digest"])
        data = r["block"].encode()
        assert r["block_digest"] == sha(data) and r["content_length"] == len(data) and s["payload_digest"] == sha(s["payload"].encode())
        if r["warc_type"] == "metadata":
            m = json.loads(r["block"])
            assert m["WARC-Record-ID"] == s["record_id"] and m["WARC-Block-Digest"] == s["block_digest"] and m["HTTP-Headers"]["Content-Type"].startswith("text/html")
        else:
            assert r["block"] == warc.plain_text(s["payload"])
    assert warc.derive(warc.responses(pages(spark, []))).collect() == []


def test_files_round_trip(spark, tmp_path):
    made = [warc.make_response(i, f"http://h/{i}", PAGE + str(i), "2024-01-01T00:00:00Z") for i in range(3)]
    names = [f.split()[0] for f in warc.RESPONSE_SCHEMA.split(", ")]
    for compress in (True, False):
        parts = []
        for r in (dict(zip(names, m)) for m in made):
            head = {"WARC-Type": "response", "WARC-Record-ID": r["record_id"], "WARC-Target-URI": r["target_uri"], "WARC-Date": r["warc_date"], "Content-Type": r["content_type"], "WARC-Payload-Digest": r["payload_digest"]}
            parts.append(warc.serialize(head, (r["http_headers"] + r["payload"]).encode(), compress))
        (tmp_path / f"a{compress}.warc").write_bytes(b"".join(parts) + parts[0][: len(parts[0]) // 2])
    back = warc.read_warc(spark, str(tmp_path))
    want = sorted((m[1], m[2], m[6], m[7], m[8]) for m in made) 
    got = sorted(set((r["record_id"], r["target_uri"], r["payload"], r["payload_digest"], r["block_digest"]) for r in back.collect()))
    assert got == want and back.count() == 6
    derived = warc.derive(back)
    for r in warc.serialized(derived, False).collect():
        (headers, block), = warc.parse_warc(r["record"])
        assert headers["warc-refers-to"] in {m[1] for m in made} and int(headers["content-length"]) == len(block)


class Brute(HTMLParser):
    """Visible text by the standard library's parser."""

    HIDDEN = {"script", "style", "template", "noscript", "title"}
    INLINE = {"a", "b", "i", "em", "strong", "span", "small", "sub", "sup", "code", "img", "u", "meta", "link", "input", "label", "button"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.hidden, self.links, self.title = [], None, [], None

    def handle_starttag(self, tag, attrs):
        if tag == "a" and dict(attrs).get("href") is not None and self.hidden is None:
            self.links.append(dict(attrs)["href"].strip())
        if self.hidden is None and tag in self.HIDDEN:
            self.hidden = tag
            self.title = "" if tag == "title" and self.title is None else self.title
        if tag not in self.INLINE and tag not in self.HIDDEN:
            self.out.append("\n")

    def handle_endtag(self, tag):
        self.hidden = None if tag == self.hidden else self.hidden
        if tag not in self.INLINE and tag not in self.HIDDEN:
            self.out.append("\n")

    def handle_data(self, data):
        if self.hidden is None:
            self.out.append(data)
        elif self.hidden == "title":
            self.title += data


def test_derivatives_of_the_table_equal_another_parser(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {(r["page_id"], r["warc_type"]): r for r in warc.derive_pages(table).collect()}
    rows = table.collect()
    assert len(got) == 2 * len(rows)
    for r in rows:
        p = Brute()
        p.feed(r["html"] or "")
        p.close()
        lines = [re.sub(r"[ \t\r\f\v\xa0]+", " ", line).strip() for line in "".join(p.out).split("\n")]
        conversion, metadata = got[r["page_id"], "conversion"], json.loads(got[r["page_id"], "metadata"]["block"])
        assert conversion["block"] == "\n".join(line for line in lines if line), r["page_id"]
        assert metadata["Title"] == (None if p.title is None else " ".join(html.unescape(p.title).split())) and len(metadata["Links"]) == len(p.links) == conversion["n_links"]


def test_one_pass_equals_two(spark):
    rows = pages(spark, [(1, "http://h/a/", PAGE), (2, None, None), (3, "http://h/é", "x" * 200_000), (3, "http://h/é", "x" * 200_000), (None, "u", "<p>")])
    assert sorted(map(str, warc.derive_pages(rows).collect())) == sorted(map(str, warc.derive(warc.responses(rows)).collect()))
    assert warc.derive_pages(pages(spark, [])).collect() == []


def test_links_are_those_of_href_alone():
    assert warc.links_of('<a data-href="/no" href="/yes">x</a><a data-href="/no">y</a><a\nhref=/z>', "http://h/") == ["http://h/yes", "http://h/z"]


def test_damage_is_skipped_and_noted(spark, tmp_path):
    def record(i, size=30):
        return warc.serialize({"WARC-Type": "response", "WARC-Record-ID": f"r{i}"}, bytes([65 + i]) * size, False)

    import gzip

    members = [gzip.compress(record(i), mtime=0) for i in range(5)]
    broken = members[2][:12] + b"\xff\xff\xff" + members[2][15:]
    faults = []
    got = [h["warc-record-id"] for h, _ in warc.parse_warc(b"".join([*members[:2], broken, *members[3:], members[0][:-12]]), faults)]
    assert got[:2] == ["r0", "r1"] and got[-2:] == ["r3", "r4"] and any("damaged" in f for _, f in faults) and faults[-1][1].startswith("cut")
    cut = record(0) + record(1)[:-20] + record(2)
    assert [h["warc-record-id"] for h, _ in warc.parse_warc(record(0)[:40] + record(3))] == ["r3"]
    assert "r0" in [h["warc-record-id"] for h, _ in warc.parse_warc(cut)]
    whole = gzip.compress(b"".join(record(i, 3_000_000) for i in range(3)), mtime=0)
    assert [(h["warc-record-id"], len(b)) for h, b in warc.parse_warc(whole)] == [(f"r{i}", 3_000_000) for i in range(3)]
    (tmp_path / "a.warc.gz").write_bytes(b"".join([*members[:2], broken, *members[3:]]))
    assert warc.archive_faults(spark, str(tmp_path)).count() >= 1 and list(warc.parse_warc(b"")) == []
