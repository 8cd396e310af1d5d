from __future__ import annotations

import base64
import gzip
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from paperlake.llm import warc, wrappers

PAGE = "page_id long, url string, html string"
PAYLOADS = [
    "<p>one</p>", "<p>one</p>", "", None, "a\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nb", "é😀\r\n", "x" * 300_000, "<p>two</p>",
    "a\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nb", "\n\n", "ends with \r\n\r\n",
]


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def brute_revisits(rows, min_bytes):
    payloads = [(i, (h or "").encode()) for i, _, h in rows]
    out, seen = [], set()
    for i, p in sorted(payloads, key=lambda x: (x[0] is None, x[0] or 0)):
        known = (p in seen) and len(p) >= min_bytes
        first = next(j for j, q in sorted(payloads, key=lambda x: (x[0] is None, x[0] or 0)) if q == p)
        seen.add(p)
        out.append((i, len(p), digest(p), "revisit" if known else "response", first if known else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_archives_round_trip(spark, min_bytes):
    rows = [(i * 7 % 50, f"http://h/{i}", p) for i, p in enumerate(PAYLOADS)]
    rows += [rows[0], (None, None, "<p>two</p>"), (90, "bad\r\nurl", "only")]
    df = spark.createDataFrame(rows, PAGE).repartition(3).withColumns({c: F.lit(-7) for c in ("file", "offset", "value", "path")})
    got = warc.deduplicated_pages(df, min_bytes)
    assert sorted(map(tuple, got.collect()), key=str) == brute_revisits(rows, min_bytes)


def test_written_records_are_well_formed(spark, folder):
    df = spark.createDataFrame([(1, "http://a/", "é"), (2, "http://b/", "é"), (3, None, None)], PAGE)
    warc.write_pages(df.coalesce(1), f"{folder}/in")
    warc.deduplicate(spark, f"{folder}/in", f"{folder}/out")
    (file,) = [r["path"] for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/out").collect()]
    data = gzip.open(file.removeprefix("file:")).read()
    assert data.endswith(b"\r\n\r\n") and data.count(b"WARC/1.1\r\n") == 3
    records = {r.fields["x-page-id"]: r for r in warc.parse_records(data)}
    assert records["1"].payload == "é".encode() and records["2"].payload == b""
    assert records["2"].fields["x-refers-to-page-id"] == "1" and records["2"].fields["warc-type"] == "revisit"
    assert records["1"].fields["warc-payload-digest"] == f"sha1:{digest('é'.encode())}"
    assert len({r.fields["warc-record-id"] for r in records.values()}) == 3


def headers(spark, path):
    return sorted((tuple(r) for r in warc.read_records(spark, path).drop("file", "offset").collect()), key=str)


def test_archives_of_revisits_stay_as_they_are(spark, folder):
    df = spark.createDataFrame([(i, f"http://h/{i}", p) for i, p in enumerate(PAYLOADS)], PAGE)
    warc.write_pages(df.coalesce(2), f"{folder}/in")
    warc.deduplicate(spark, f"{folder}/in", f"{folder}/once", min_bytes=5)
    warc.deduplicate(spark, f"{folder}/once", f"{folder}/twice", min_bytes=5)
    once = headers(spark, f"{folder}/once")
    assert {r[2] for r in once} == {"response", "revisit"} and headers(spark, f"{folder}/twice") == once


def test_a_revisit_is_nobodys_original(spark, folder):
    """An archive with page 1's revisit only, then together with a later response of the same payload."""
    same = [(0, "http://h/0", "<p>one</p>"), (1, "http://h/1", "<p>one</p>")]
    warc.write_pages(spark.createDataFrame(same, PAGE).coalesce(1), f"{folder}/in")
    warc.deduplicate(spark, f"{folder}/in", f"{folder}/both")
    (content,) = [r["content"] for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/both").collect()]
    revisit = gzip.decompress(content)
    os.makedirs(f"{folder}/alone")
    with gzip.open(f"{folder}/alone/part-0.gz", "wb") as f:
        f.write(revisit[[r.offset for r in warc.parse_records(revisit) if r.fields["warc-type"] == "revisit"][0] :])
    warc.deduplicate(spark, f"{folder}/alone", f"{folder}/still")
    row = (1, "http://h/1", "revisit", 10, digest(b"<p>one</p>"), 0)
    assert headers(spark, f"{folder}/still") == [row]
    warc.write_pages(spark.createDataFrame([(9, "http://h/9", "<p>one</p>")], PAGE).coalesce(1), f"{folder}/more")
    for name in os.listdir(f"{folder}/more"):
        if name.startswith("part-"):
            os.link(f"{folder}/more/{name}", f"{folder}/alone/{name}")
    warc.deduplicate(spark, f"{folder}/alone", f"{folder}/found")
    assert headers(spark, f"{folder}/found") == [(*row[:5], 9), (9, "http://h/9", "response", 10, row[4], None)]


def test_empty_archives(spark):
    assert warc.deduplicated_pages(spark.createDataFrame([], PAGE)).collect() == []


# --- Wrappers -----------------------------------------------------------------

SOUP = (
    '<html><body><header class="site"><h2>Site</h2></header><div id="wrap"><div class="sidebar">links</div>'
    '<div class="content"><h1>T{0}</h1><p>Body {0} is &lt;long&gt; &amp;<br>goes   on</p><p>More{0}</p>'
    '<div class="share">Share</div><div class="note">Printed by the house</div></div></div>'
    '<div class="comments"><p>c{0}</p></div><form><p>f</p></form><footer>x</footer></body></html>'
)


def extract(spark, rows):
    df = spark.createDataFrame(rows, PAGE).withColumns({c: F.lit(-7) for c in ("host", "rule", "wrapper", "text", "n_chars")})
    return {r["page_id"]: r for r in wrappers.extract_main_text(df).collect()}


def test_the_varying_text_is_the_article(spark):
    got = extract(spark, [(i, f"http://a.b/{i}", SOUP.format(i)) for i in range(6)])
    for i, r in got.items():
        assert r["text"] == f"T{i}\nBody {i} is <long> & goes on\nMore{i}" and r["n_chars"] == len(r["text"])


def test_awkward_pages(spark):
    rows = [
        (1, None, None), (2, "::bad", ""), (3, "http://x/", "<p>only"), (4, "http://x/", "plain text & more"),
        (5, "http://y/", "<article><p>a<p>b</article><article class=comment><p>ccccccccc</p></article>"),
        (6, "http://y/", "<article><header><h1>T</h1></header><nav>m</nav><p>x <script>if (a<b) {}</script>y</p></article>"),
        (7, "http://z/", "<div>" * 3000 + "deep" + "</div>" * 3000), (8, "http://z/", "<p" * 20_000),
        (9, "http://w/", "<main><ul><li>1<li>2</ul><table><tr><td>c<td>d</table></main>"),
        (9, "http://w/", "<main><ul><li>1<li>2</ul><table><tr><td>c<td>d</table></main>"),
        (10, "http://v/", '<article><p title="a>b">q &am; &eacute;</p><!-- <p>no</p> --><aside>s</aside></article>'),
    ]
    got = extract(spark, rows)
    assert got[1]["text"] == got[2]["text"] == "" and got[3]["text"] == "only" and got[4]["text"] == "plain text & more"
    assert got[5]["text"] == "a\nb" and got[6]["text"] == "T\nx y" and got[7]["text"] == "deep"
    assert got[9]["text"] == "1\n2\nc\nd" and got[10]["text"] == "q &am; é"
    assert len(got) == 10


def wrapper_of(*pages):
    found = None
    for page in pages:
        found = wrappers.merge(found, wrappers.page_wrapper(wrappers.parse(page)))
    return found


def test_alignment_makes_optional_and_repeated_groups():
    w = wrapper_of("<ul><li>a<li>b</ul><h1>t</h1>", "<ul><li>c</ul><p>x</p><h1>t</h1>", "<ul><li>d</ul><h1>t</h1>")
    assert str(w) == '<>(<ul>(<li>(#TEXT)+) <p>("x")? <h1>("t"))'
    assert str(wrappers.Node.unpacked(json.loads(json.dumps(w.packed())))) == str(w)


def test_merging_parts_is_aligning_all():
    pages = [f"<div><h1>t{i}</h1>{'<p>x</p>' * (i % 3)}</div>" for i in range(9)]
    whole, halves = wrapper_of(*pages), wrappers.merge(wrapper_of(*pages[:4]), wrapper_of(*pages[4:]))
    assert str(whole) == str(halves) and whole.pages == halves.pages == 9


def test_wrappers_cover_all_pages_of_a_host(spark):
    rows = [(i, f"http://h{i % 2}.x/{i}", f"<body><h1>t{i}</h1><p>fixed</p></body>") for i in range(40)]
    df = spark.createDataFrame(rows, PAGE).repartition(6)
    got = {r["host"]: wrappers.Node.unpacked(json.loads(r["wrapper"])) for r in wrappers.host_wrappers(df).collect()}
    assert {h: w.pages for h, w in got.items()} == {"h0.x": 20, "h1.x": 20}
    assert str(got["h0.x"]) == '<>(<body>(<h1>(#TEXT) <p>("fixed")))'


def test_no_pages(spark):
    assert wrappers.extract_main_text(spark.createDataFrame([], PAGE)).collect() == []


ARTICLE_BODY = "<h1>Title</h1><p>First words of it.</p><h2 id='related-work'>Related work</h2><section id='search'><p>How we search.</p></section>"


@pytest.mark.parametrize("name", ["content has-sidebar", "no-sidebar", "header-wrap", "comments-open", "hasSidebar", "sidebar"])
def test_container_classes_do_not_empty_a_page(name):
    page = f"<body><nav>Menu</nav><div class='{name}'>{ARTICLE_BODY}<div class='comments'><p>Me too</p></div></div></body>"
    wanted = ["Title", "First words of it.", "Related work", "How we search."]
    assert wrappers.main_text(page, None).split("\n") == wanted
    assert wrappers.main_text("<body><div class='widget'><p>All there is</p></div></body>", None) == "All there is"


def test_texts_of_fewer_pages_than_template_are_kept():
    def page(i, more=""):
        return f"<body><div><p class='a'>Body number {i} {'x' * 50}</p>{more}<p class='c'>End number {i} {'y' * 50}</p></div></body>"

    def rule(pages):
        wrapper = None
        for p in pages:
            wrapper = wrappers.merge(wrapper, wrappers.page_wrapper(wrappers.parse(p)))
        return wrappers.main_rule(wrapper)

    note = "<ul class='b'><li>Said on some pages</li></ul>"
    for copies, kept in ((2, True), (3, False)):
        pages = [page(i, note if i < copies else "") for i in range(12)]
        for order in (pages, pages[::-1], pages[2:] + pages[:2]):
            assert ("Said on some pages" in wrappers.main_text(pages[0], rule(order))) == kept


OTHERS = ["comment-list", "comments-section", "reader-comments", "ad-slot", "cookie-banner", "share-buttons", "related-posts", "newsletter-signup", "site-footer"]


def article_page(i, more="", before=""):
    body = "".join(f"<p>Words {i} {j} {'w' * (40 + (i * j) % 7)}</p>" for j in range(6))
    return f"<body><nav>Menu</nav>{before}<article class='post'><h1>Title {i}</h1>{body}{more}</article></body>"


def article_text(i):
    return "\n".join([f"Title {i}", *(f"Words {i} {j} {'w' * (40 + (i * j) % 7)}" for j in range(6))])


@pytest.mark.parametrize("name", OTHERS)
def test_comments_and_adverts_inside_an_article_go(spark, name):
    """On a host of many pages and on a page alone, also where they hold more text than the article."""
    def more(i):
        return f"<div class='{name}'>" + "".join(f"<p>Reader {i} {j} says much about it</p>" for j in range(i % 9)) + "</div>"

    got = extract(spark, [(i, f"http://a.b/{i}", article_page(i, more(i))) for i in range(12)])
    assert {i: r["text"] for i, r in got.items()} == {i: article_text(i) for i in range(12)}
    assert wrappers.main_text(article_page(8, more(8)), None) == article_text(8)


def test_a_teaser_does_not_replace_the_article(spark):
    teasers = "<article class='teaser'><p>Read this next</p></article>" * 3
    got = extract(spark, [(i, f"http://a.b/{i}", article_page(i, before=teasers)) for i in range(8)])
    assert {i: r["text"] for i, r in got.items()} == {i: article_text(i) for i in range(8)}


def test_the_wrapper_decides_what_a_host_repeats_in_its_articles():
    """A line that all pages of a host have goes, found by its wrapper only; copies of one page keep theirs."""
    notice = "<div class='house'>Printed by the house</div>"
    pages = [article_page(i, notice) for i in range(8)]
    rule = wrappers.main_rule(wrapper_of(*pages))
    assert rule.template == {"Printed by the house"}
    assert wrappers.main_text(pages[3], rule) == article_text(3)
    assert wrappers.main_text(pages[3], wrappers.Rule(rule.paths)).endswith("Printed by the house")
    copies = [article_page(0, "<h2>The end</h2><blockquote>Said twice</blockquote>")] * 8
    kept = wrappers.main_text(copies[0], wrappers.main_rule(wrapper_of(*copies)))
    assert kept == article_text(0) + "\nThe end\nSaid twice"


@pytest.mark.parametrize("name", ["has-sidebar", "noSidebar", "comments-open", "post-with-comments", "nav-layout"])
def test_a_suspicious_container_of_the_article_stays(name):
    pages = [article_page(i).replace("<article class='post'>", f"<div class='{name}'><div class='text'>").replace("</article>", "</div></div>") for i in range(6)]
    rule = wrappers.main_rule(wrapper_of(*pages))
    assert wrappers.main_text(pages[2], rule) == wrappers.main_text(pages[2], None) == article_text(2)
