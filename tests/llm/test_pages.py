import gzip
import hashlib
from base64 import b32encode

from matchwright.llm import extract, warc
from matchwright.llm.blocks import page_blocks, title_and_links

PAGE = (
    "<!DOCTYPE html><html><head><title>T &amp; U</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><ul><li>"
    "<a href='/a?x=1&amp;y=2'>Home</a></li></ul></nav><!-- ad --><div class=\"ad\">Buy lamps.</div><article><h1>A &lt;b&gt; &eacute;</h1>"
    "<p><b>One   two.<br><p>Be.</p><p>x<i>y</i>z\n w</p><div class='comments'><p>Nice!</p></div></article><form><p>Mail</p></form>"
    "<footer>&copy; me</footer></body></html>"
)
ROWS = [(1, "http://a/", PAGE), (2, "http://b/", None), (3, None, ""), (1, "http://a/", PAGE), (None, "u", "plain words only"), (4, "http://c/", PAGE[:420])]


def pages(spark, rows=ROWS):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.select("*", F.lit(1).alias("text"), F.lit("r").alias("record"), F.lit(2).alias("block"))


def test_main_text(spark):
    got = [tuple(r) for r in extract.main_texts(pages(spark)).collect()]
    main = "A <b> é\nOne two.\nBe.\nxyz w"
    assert got[0] == got[3] == (1, "http://a/", main, len(main))
    assert got[1] == (2, "http://b/", "", 0) and got[2] == (3, None, "", 0)
    assert got[5][2].startswith("A <b> é\nOne two.")
    assert extract.main_texts(pages(spark).limit(0)).count() == 0


def test_tree_learns_the_labelled_pages():
    tree = extract.labelled_tree()
    for page in extract.labelled_pages():
        blocks = page_blocks(page)
        assert list(extract.classify(tree, extract.features(blocks))) == [b.marked and not b.furniture and not b.named for b in blocks]


def test_tree_on_held_out_pages(small, spark):
    """Pages of the driver: their article element holds the main text."""
    import html
    import re

    rows = spark.read.parquet(f"{small}/pages.parquet")
    for r in extract.main_texts(rows).join(rows.select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in re.split("</?(?:p|h1)>", inner))
        assert r.text == "\n".join(b for b in blocks if b)


def test_unbalanced_markup():
    for page in ("<", "a < b", "<p", "<p title='x>y", "</div></div>x", "<script>x", "<!-- x", "<a href=x", "<div" * 500, "&am&amp;p"):
        page_blocks(page)
    assert [b.text for b in page_blocks("a < b<p>c")] == ["a < b", "c"]


def test_custom_elements_do_not_hide_the_page():
    tree = extract.labelled_tree()
    for name in ("video-player", "svg-icon", "title-bar", "button-group", "audio-player", "script-x"):
        page = f"<title-bar></title-bar><title>T</title><article><p>one</p><{name} a='b'></{name}><p>two</p><{name}/><p>three <a href=/x>x</a></p></article>"
        assert [b.text for b in page_blocks(page)] == ["one", "two", "three x"]
        assert extract.main_text(page, tree) == "one\ntwo\nthree x"
        assert title_and_links(page) == ("T", ["/x"])
    assert [b.text for b in page_blocks("<p>a<video\nsrc=x>no</video>b<svg/>c")] == ["a b c".replace(" ", "")]


def test_layout_names_do_not_hide_the_article():
    tree = extract.labelled_tree()
    text = "Rain fell on the harbour for most of the week and the boats stayed in, so the market had little fish to sell."
    article = f"<article><h1>Storm</h1><p>{text}</p><div class='comments'><p>Nice!</p></div></article>"
    for page in (
        f"<body class='right-sidebar'>{article}</body>",
        f"<body class='sidebar'>{article}</body>",
        f"<body><main class='has-sidebar'>{article}</main></body>",
        f"<article class='post no-comments' id=comments>{article[9:]}",
        f"<body><div class='page with-menu'>{article}</div></body>",
        f"<html><head><title>T</title><meta charset=utf-8><body>{article}</body></html>",
        f"<html><head><title>T</title>{article}</html>",
    ):
        assert extract.main_text(page, tree) == f"Storm\n{text}", page
    assert extract.main_text(f"<body><div class='box sidebar'><p>{text}</p></div>{article}</body>", tree) == f"Storm\n{text}"


TEXT = "Rain fell on the harbour for most of the week and the boats stayed in, so the market had little fish to sell."


def test_compound_names_are_page_furniture():
    tree = extract.labelled_tree()
    names = "cookie-banner site-footer comment-list ad-container related-posts left-sidebar share-buttons cookie_notice newsletter-signup leftSidebar"
    for name in names.split():
        part = f"<div class='{name}'><p>We set two small files on your machine to count visits.</p></div>"
        for page in (
            f"<article><h1>Storm</h1>{part}<p>{TEXT}</p></article>",
            f"<article><h1>Storm</h1><p>{TEXT}</p></article>{part}",
            f"<div class=post><h1>Storm at sea</h1>{part}<p>{TEXT}</p><p>{TEXT}</p></div>",
            f"<div class=post><h1>Storm at sea</h1><p>{TEXT}</p><p>{TEXT}</p></div>{part}",
        ):
            assert "files" not in extract.main_text(page, tree) and TEXT in extract.main_text(page, tree), page
    kept = f"<article><div class=post-header><h1>Storm</h1></div><p class=advice-box>{TEXT}</p></article>"
    assert extract.main_text(kept, tree) == f"Storm\n{TEXT}"


def test_wrappers_do_not_hide_the_article():
    tree = extract.labelled_tree()
    for host in ("article", "main"):
        body = f"<{host}><h1>Storm</h1><p>{TEXT}</p></{host}>"
        for where in ("form", "div class='content search'", "div class=widget", "div class=top-banner", "div class=has-sidebar"):
            assert extract.main_text(f"<{where}>{body}</{where.split()[0]}>", tree) == f"Storm\n{TEXT}", where
        for where in ("aside", "footer", "nav", "div class=comments", "ol class=comment-list", "div class=related-posts"):
            page = f"{body}<{where}><article><p>Nice words on the storm from us all.</p></article></{where.split()[0]}>"
            assert extract.main_text(page, tree) == f"Storm\n{TEXT}", where


def test_open_buttons_end_at_the_next_block():
    tree = extract.labelled_tree()
    assert extract.main_text(f"<article><button>Like<p>{TEXT}</p><button type=x>No</button><p>two</p></article>", tree) == f"{TEXT}\ntwo"
    assert [b.text for b in page_blocks("<option>a<option>b<p>c</p><button-group>d")] == ["c", "d"]


def _read(data):
    """Records of a WARC file by their Content-Length."""
    out = []
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        fields = dict(x.split(": ", 1) for x in lines[1:])
        n = int(fields["Content-Length"])
        out.append((fields, rest[:n]))
        assert rest[n : n + 4] == b"\r\n\r\n"
        data = rest[n + 4 :]
    return out


def test_derivatives_link_and_round_trip(spark, tmp_path):
    source = warc.responses(pages(spark))
    records = warc.derivatives(source)
    rows = records.collect()
    assert len(rows) == 2 * len(ROWS)
    by_source = {r.record.split("WARC-Record-ID: ")[1].split("\r\n")[0]: r.record for r in source.collect()}
    for r in rows:
        record = by_source[r.refers_to]
        assert r.digests_agree and f"WARC-Refers-To: {r.refers_to}\r\n" in r.headers
        data = r.block.encode()
        assert r.block_digest == "sha1:" + b32encode(hashlib.sha1(data).digest()).decode() and r.content_length == len(data)
        payload = record.split("\r\n\r\n", 2)[2]
        assert r.source_payload_digest == "sha1:" + b32encode(hashlib.sha1(payload.encode()).digest()).decode()
        if r.record_type == "metadata":
            for line in record.split("\r\n\r\n")[0].split("\r\n")[1:]:
                assert f"source-{line}\r\n" in r.block
    first = [r for r in rows if r.page_id == 1]
    assert "title: T & U\r\noutlink: /a?x=1&y=2\r\n" in first[0].block
    assert first[1].block.startswith("Home\nBuy lamps.\nA <b> é")
    assert len({r.record_id for r in rows if r.page_id != 1}) == 2 * (len(ROWS) - 2)
    warc.write(records, str(tmp_path / "w"))
    back = [x for f in (tmp_path / "w").glob("part-*") for x in _read(gzip.open(f).read())]
    assert sorted(f["WARC-Record-ID"] for f, _ in back) == sorted(r.record_id for r in rows)
    assert {(f["WARC-Record-ID"], b) for f, b in back} == {(r.record_id, r.block.encode()) for r in rows}


def test_broken_responses(spark):
    good = warc.response_record(1, "http://a/", "<p>x", "2024-01-01T00:00:00Z")
    bad = [(1, None), (2, ""), (3, "WARC/1.1\r\nWARC-Type: request\r\n\r\nx"), (4, good[:-1]), (5, "WARC/1.1\r\nWARC-Type: response\r\n\r\nno http")]
    rows = warc.derivatives(spark.createDataFrame(bad, "page_id long, record string")).collect()
    assert len(rows) == 10 and not any(r.digests_agree for r in rows)
    assert all("error: " in r.block for r in rows if r.record_type == "metadata" and r.page_id != 4)
    assert warc.derivatives(warc.responses(pages(spark).limit(0))).count() == 0
