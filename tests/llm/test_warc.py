"""Derived records: links, digests, texts against an HTML parser, and written files."""

import gzip
import hashlib
import re
from glob import glob
from html.parser import HTMLParser

from farelens.llm import warc


class Visible(HTMLParser):
    def __init__(self):
        super().__init__()
        self.out, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in (*warc.HIDDEN, "title")
        self.out.append("\n" * (tag in warc.BLOCKS))

    def handle_endtag(self, tag):
        self.hidden -= tag in (*warc.HIDDEN, "title")
        self.out.append("\n" * (tag in warc.BLOCKS))

    def handle_data(self, data):
        self.out.append("" if self.hidden else data)


def parsed_text(page):
    parser = Visible()
    parser.feed(page)
    parser.close()
    lines = (" ".join(x.split()) for x in "".join(parser.out).split("\n"))
    return "\n".join(x for x in lines if x)


def fields_of(header):
    assert header.startswith("WARC/1.1\r\n") and header.endswith("\r\n\r\n")
    return dict(x.split(": ", 1) for x in header.split("\r\n")[1:-2])


def test_texts_match_a_parser(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    for p in pages:
        assert warc.visible_text(p.html) == parsed_text(p.html)
    odd = ('<P title="a>b">x&amp;y<br/>z<script>"</p>"</script> &lt;b&gt;<!-- <p>no</p> -->w'
           "<a href='q'>l</a>")
    assert warc.visible_text(odd) == parsed_text(odd) == "x&y\nz <b>wl"
    assert warc.visible_text("<" * 50_000 + "'" * 50_000) is not None


def test_records(spark, tmp_path):
    rows = [(1, "http://a.org/é", '<html lang="FR"><title>T &amp; u</title><p>Hé<p>there', "x"),
            (2, None, None, "x"), (None, "http://b.org", "", None),
            (1, "http://a.org/é", '<html lang="FR"><title>T &amp; u</title><p>Hé<p>there', "x"),
            (3, "http://c.org/", "long " * 50_000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, block string")
    sources = {r.record_id: r for r in warc.responses(pages).collect()}
    found = warc.derive(warc.responses(pages)).collect()
    assert len(found) == 2 * len(rows) and len(sources) == len(rows) - 1
    by_id = {r.record_id: r for r in found}
    for r in found:
        source, fields = sources[r.refers_to], fields_of(r.header)
        data = r.block.encode()
        assert by_id[r.concurrent_to].concurrent_to == r.record_id
        assert by_id[r.concurrent_to].warc_type != r.warc_type
        assert fields["WARC-Refers-To"] == r.refers_to and fields["WARC-Type"] == r.warc_type
        assert fields.get("WARC-Target-URI") == source.target_uri == r.target_uri
        assert fields["Content-Length"] == str(len(data)) == str(r.content_length)
        assert r.block_digest == f"sha256:{hashlib.sha256(data).hexdigest()}"
        body = bytes(source.block).split(b"\r\n\r\n", 1)[1]
        assert r.source_digest == f"sha256:{hashlib.sha256(body).hexdigest()}"
    one = {r.warc_type: r.block for r in found if r.target_uri == "http://a.org/é"}
    assert one["conversion"] == "Hé\nthere"
    assert "title: T & u\r\nlanguage: fr\r\nlinks: 0\r\ntext-characters: 8\r\n" in one["metadata"]
    assert "source-header-Content-Type: text/html; charset=utf-8\r\n" in one["metadata"]
    warc.write(warc.derive(warc.responses(pages)), str(tmp_path / "out"))
    count = 0
    for path in glob(str(tmp_path / "out" / "*.gz")):
        data = gzip.decompress(open(path, "rb").read())
        while data:
            head, _, data = data.partition(b"\r\n\r\n")
            size = int(re.search(rb"Content-Length: (\d+)", head)[1])
            assert data[size:size + 4] == b"\r\n\r\n"
            data, count = data[size + 4:], count + 1
    assert count == len(found)
    assert warc.derive(warc.responses(pages.limit(0))).count() == 0
