"""Page text by wrappers, and WARC derivatives."""

import gzip
import json
import random

import pytest

from railctx.llm import html_text, warc

SCHEMA = "html string, url string, page_id long, host string, wrapper string, text string, record binary"

PAGE = """<!DOCTYPE html><html><head><title>T{n}</title><style>p{{}}</style><script>var t="</p><article>";</script></head>
<body><header><h2>Site</h2></header><nav><ul><li><a href="/a">menu {n}</a></li><li>more</ul></nav><!-- <p>hidden</p> -->
<div class="cookie-notice">We use cookies</div><div class="ad">buy {n}</div>{start}<h1>Title {n}</h1>
<p>Fish &amp; <b>chi</b>ps&nbsp;{n}
 now.<p>Second<br>line &lt;b&gt; &eacute;<form><input value="x">Subscribe</form><aside>side</aside>
<ul><li>one<li>two</ul><div class="comments"><article><p>nice post</p></article></div>{end}
<footer>&copy; footer {n}</footer></body></html>"""
WANT = "Title {n} Fish & chips {n} now. Second line <b> é one two"


def frame(spark, rows):
    return spark.createDataFrame([(h, u, i, "clash", "x", "y", b"") for i, u, h in rows], SCHEMA).repartition(3)


def test_main_text(spark):
    with_article = [(n, "https://WWW.one.example/p", PAGE.format(n=n, start="<article>", end="</article>")) for n in range(6)]
    without = [
        (n, "http://two.example:80/x", PAGE.format(n=n, start='<div id="wrap-1"><div class="post">', end="<h4>Always the same</h4></div></div>").replace("Subscribe", "x" * 40))
        for n in range(10, 16)
    ]
    rows = [*with_article, *without, (20, None, None), (21, "", ""), (22, "https://one.example/", "no tags &lt;"), with_article[0]]
    found = html_text.main_text(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    got: dict = {}
    for r in found:
        got.setdefault(r.page_id, []).append(r.text)
        assert r.n_chars == len(r.text)
    assert got[0] == [WANT.format(n=0)] * 2
    for n in range(1, 6):
        assert got[n] == [WANT.format(n=n)]
    for n in range(10, 16):
        # What is the same on every page of the host is template, not text.
        assert "Always the same" not in got[n][0] and got[n][0].startswith(f"Title {n} Fish & chips {n} now.")
        assert "menu" not in got[n][0] and "footer" not in got[n][0]
    assert got[20] == [""] and got[21] == [""] and got[22] == ["no tags <"]
    assert html_text.main_text(frame(spark, [])).count() == 0


def test_wrapper_is_a_union_free_expression():
    def infer(*pages):
        whole, *others = [html_text.as_wrapper(html_text.parse(p)) for p in pages]
        for other in others:
            html_text.merge(whole, other, False)
        return html_text.expression(whole)

    one = "<ul><li>a</li><li>b</li></ul><p>same</p>"
    assert infer(one) == "<#page><ul>(<li>#</>)+</><p>same</></>"
    assert infer(one, "<ul><li>c</li></ul><i>x</i><p>same</p>") == "<#page><ul>(<li>#</>)+</>(<i>x</>)?<p>same</></>"
    assert infer("<p>a</p>", "<p>b</p><hr>") == "<#page><p>#</>(<hr></>)?</>"


def test_wrapper_does_not_depend_on_how_pages_are_dealt(spark):
    rng = random.Random(3)
    rows = [(n, f"http://h{n % 3}.example/", PAGE.format(n=n, start="<div>" * (n % 2), end="<p>" + "z" * rng.randint(1, 90))) for n in range(40)]
    few = {r.page_id: r.text for r in html_text.main_text(frame(spark, rows).coalesce(1)).collect()}
    many = {r.page_id: r.text for r in html_text.main_text(frame(spark, rows).repartition(16)).collect()}
    assert few == many


def test_very_long_page_is_whole():
    words = " ".join(f"w{i}" for i in range(100_000))
    assert html_text.extract(f"<body><article><p>{words}</p></article>", None) == words


def test_derivatives(spark):
    rows = [(1, "http://a.example/x", PAGE.format(n=1, start="", end="")), (2, None, None), (3, "http://a\r\nb", "é"), (1, "http://a.example/x", "other")]
    pages = frame(spark, rows)
    responses = warc.responses(pages, "2024-01-01T00:00:00Z")
    built = warc.build(responses).collect()
    assert len(built) == 2 * len(rows)
    payloads = {}
    for r in responses.collect():
        (headers, block), = warc.parse(bytes(r.record))
        status, source, payload = warc.http(block)
        assert status == 200 and dict(source)["Content-Length"] == str(len(payload))
        payloads[headers["warc-record-id"]] = (headers, payload)
    assert len(payloads) == len(rows)
    for r in built:
        (headers, block), = warc.parse(bytes(r.record))
        source, payload = payloads[r.refers_to]
        assert headers["warc-refers-to"] == r.refers_to and headers["warc-record-id"] == r.record_id
        assert headers["warc-block-digest"] == warc.digest(block) and int(headers["content-length"]) == len(block) == r.content_length
        assert headers["warc-date"] == source["warc-date"] and headers.get("warc-target-uri") == source.get("warc-target-uri")
        if r.record_type == "conversion":
            assert headers["warc-source-payload-digest"] == source["warc-payload-digest"] == warc.digest(payload)
            assert block.decode() == warc.plain_text(payload.decode())
        else:
            envelope = json.loads(block)
            assert envelope["payload-digest"] == warc.digest(payload) and envelope["warc-headers"] == source
            assert envelope["conversion"] in {b.record_id for b in built if b.record_type == "conversion"}
    catalogue = warc.catalogue(pages, "2024-01-01T00:00:00Z").collect()
    assert sorted(r.record_id for r in catalogue) == sorted(r.record_id for r in built)
    assert warc.catalogue(frame(spark, []), "2024-01-01T00:00:00Z").count() == 0


def test_file_of_compressed_members():
    records = [warc.response(f"http://x/{i}", b"<p>t%d" % i, "2024-01-01T00:00:00Z") for i in range(3)]
    data = b"".join(gzip.compress(r) for r in records)
    derived = list(warc.derivatives(data))
    assert [kind for _, kind, _, _ in derived] == ["metadata", "conversion"] * 3
    with pytest.raises(ValueError):
        list(warc.parse(records[0][:-40]))


def test_plain_text_and_links():
    page = "<title>A  b</title><p>x <b>y</b>z</p><script>no</script><a href='/q?a=1&amp;b'>l</a><img src=i.png>"
    assert warc.plain_text(page).split("\n")[1:] == ["x yz", "l"]
    assert warc.links(page) == [{"tag": "a", "url": "/q?a=1&b"}, {"tag": "img", "url": "i.png"}]


def test_open_head():
    page = "<html><head><title>T</title><meta charset=utf-8><link rel=icon href=i.ico>{}<article><p>the text</p><a href=/l>l</a></article>"
    for start in ("<body>", "", "</head><body>"):
        assert html_text.extract(page.format(start), None) == "the text l"
        assert warc.plain_text(page.format(start)).split("\n") == ["the text", "l"]
        assert {"tag": "a", "url": "/l"} in warc.links(page.format(start))
    assert html_text.extract("<head><title>T</title>words <b>only</b>", None) == "words only"


@pytest.mark.parametrize("name", ["svg-icon", "title-bar", "select-box", "object-card", "script-note", "template-part"])
def test_custom_elements_are_not_raw(name):
    page = f"<body><article><p>before</p><{name}>inside</{name}><p>after</p></article>"
    assert html_text.extract(page, None) == "before inside after"
    assert warc.plain_text(page).split() == ["before", "inside", "after"]


def test_formulas_are_text():
    page = "<body><article><p>where <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p></article>"
    assert html_text.extract(page, None) == "where x = 2 holds"


def texts_of_host(pages):
    whole, *others = [html_text.as_wrapper(html_text.parse(p)) for p in pages]
    for other in others:
        html_text.merge(whole, other, False)
    return [html_text.extract(p, whole) for p in pages]


def test_deep_text_is_not_left_for_a_teaser():
    pages = [f"<body><div>{'<div>' * 30}<p>long story {n} {'w ' * 200}</p>{'</div>' * 30}</div><div class=teaser>t {n}</div>" for n in range(5)]
    for n, text in enumerate(texts_of_host(pages)):
        assert text.startswith(f"long story {n} w w")


def test_many_different_entries_are_not_left_for_a_teaser():
    names = [a + b for a in "abcdefghij" for b in "klmnopqrst"]
    pages = [f"<body><div class='entry {name}'>story of {name}</div><div class='teaser'>see also, at length, {name}</div>" for name in names]
    for size in (5, 100):
        for name, text in zip(names, texts_of_host(pages[:size]), strict=False):
            assert text == f"story of {name} see also, at length, {name}"


def test_repeated_parts_are_all_taken():
    pages = [f"<body><div class=post>one {n}</div><div class=post>two {n}</div>" for n in range(4)]
    assert texts_of_host(pages) == [f"one {n} two {n}" for n in range(4)]


def test_constant_only_over_different_pages():
    assert texts_of_host(["<body><p>all of it</p><p>is here</p>"] * 5) == ["all of it is here"] * 5
    pages = [f"<body><div><p>item {n}</p></div>" + "<ul><li><h4>Same</h4></li></ul>" * 4 for n in (1, 2)]
    assert texts_of_host(pages) == [f"item {n} Same Same Same Same" for n in (1, 2)]
