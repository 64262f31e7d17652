import hashlib

from tidemark.llm.warc import derivatives, responses, serialised

ROWS = [
    (1, "http://a.example/x?a=1&b=2", '<html><head><title> A &amp; B\n c</title><script>var t="</p>";</script></head><body><!-- no -->'
     "<p>One&nbsp;<b>two</b> &lt;3&gt; &#233;&#x4e2d;&#0;&#55296;</p><p>three<br>four &amp;lt; </p><a class=x href='/y?p=1&amp;q=2'>link</a>"),
    (2, None, None), (3, "", ""), (None, "http://b.example/", "plain & simple <3"), (1, "http://a.example/x?a=1&b=2", "<style>p{}</style>"),
    (5, "u", "<P>" + "long text " * 50_000 + "</P><SCRIPT>x"),
]


def test_records(frame, spark):
    pages = frame(ROWS + [ROWS[2]], "page_id long, url string, html string")
    source = responses(pages)
    made = derivatives(source, "page_id").collect()
    assert len(made) == 2 * (len(ROWS) + 1)
    ids = {r["record_id"]: r for r in source.collect()}
    for r in made:
        src = ids[r["refers_to"]]
        assert r["content_length"] == len(r["block"].encode())
        assert r["block_digest"] == "sha256:" + hashlib.sha256(r["block"].encode()).hexdigest()
        assert r["source_digest"] == "sha256:" + hashlib.sha256(src["payload"].encode()).hexdigest()
        head = r["header"].split("\r\n")
        assert head[0] == "WARC/1.1" and head[-2:] == ["", ""]
        fields = dict(line.split(": ", 1) for line in head[1:-2])
        assert fields["WARC-Record-ID"] == r["record_id"] and fields["WARC-Refers-To"] == r["refers_to"]
        assert fields.get("WARC-Target-URI") == r["target_uri"] and fields["Content-Length"] == str(r["content_length"])
        assert fields["WARC-Type"] == r["record_type"] and fields["Content-Type"] == r["content_type"]
    text = {(r["page_id"], r["target_uri"]): r["block"] for r in made if r["record_type"] == "conversion"}
    meta = [r["block"] for r in made if r["record_type"] == "metadata" and r["page_id"] == 1]
    assert any(b == "" for b in text.values())
    firsts = [r["block"] for r in made if r["record_type"] == "conversion" and r["page_id"] == 1]
    assert "One two <3> é中��\nthree\nfour &lt;\nlink" in [b.replace(" \n", "\n") for b in firsts]
    assert text[(None, "http://b.example/")] == "plain & simple <3"
    assert len(text[(5, "u")]) > 490_000
    full = next(m for m in meta if "outlink" in m)
    assert full.startswith("title: A & B c\r\n") and "\r\noutlink: /y?p=1&q=2\r\n" in full
    assert "source-header: HTTP/1.1 200 OK" in full
    raw = [bytes(r["record"]) for r in serialised(derivatives(source)).collect()]
    assert all(b.startswith(b"WARC/1.1\r\n") and b.endswith(b"\r\n\r\n") for b in raw)
    assert derivatives(responses(pages.limit(0))).count() == 0


def test_links_and_references(spark):
    html = (
        """<a href="/o'brien">x</a><a title=t HREF=/plain>y</a><a href='/q"z'>z</a><a data-href="/no">n</a><a href="/c&eacute;&amp;d">"""
        "<p>stra&szlig;e &eacute;t&eacute; &amp;lt; &#38;lt; &unknown; &amp &#xZ; &lt;&gt;&notin;&hellip; AT&T; x & y;</p>"
    )
    df = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    rows = {r["record_type"]: r["block"] for r in derivatives(responses(df)).collect()}
    links = [line.removeprefix("outlink: ") for line in rows["metadata"].split("\r\n") if line.startswith("outlink: ")]
    assert links == ["/o'brien", "/plain", '/q"z', "/cé&d"]
    assert rows["conversion"].split("\n")[-1] == "straße été &lt; &lt; &unknown; &amp &#xZ; <>∉… AT&T; x & y;"


def test_given_headers_are_kept(spark):
    df = spark.createDataFrame(
        [("<urn:uuid:1>", "http://x/", "2020-02-02T00:00:00Z", "HTTP/1.1 404 Not Found\r\nServer: s\r\n\r\n", "<p>hi"), ("<urn:uuid:2>", None, None, None, None)],
        "record_id string, target_uri string, date string, http_headers string, payload string",
    )
    rows = {(r["refers_to"], r["record_type"]): r for r in derivatives(df).collect()}
    assert "source-header: HTTP/1.1 404 Not Found\r\nsource-header: Server: s\r\n" in rows[("<urn:uuid:1>", "metadata")]["block"]
    assert "WARC-Date: 2020-02-02T00:00:00Z" in rows[("<urn:uuid:1>", "conversion")]["header"]
    assert "WARC-Date" not in rows[("<urn:uuid:2>", "conversion")]["header"]
