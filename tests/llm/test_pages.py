"""Archives, URL rules and page text."""

import base64
import fnmatch
import hashlib
import random
import re

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from panelmill.llm import warc_index
from panelmill.llm.html_tree import extract_pages, main_text
from panelmill.llm.url_automaton import ANY, IN_HOST, Automaton, Rule, UrlFilter, filter_urls
from panelmill.llm.warc_index import archive_pages, read_records

SCHEMA = "page_id bigint, url string, html string, file string, host int, text string"


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "f", 1, "t") for i, u, h in rows], SCHEMA)


# --- archives

ROWS = [(3, "http://a/1", "same"), (1, "http://a/2", "same"), (2, None, None), (4, "http://b\r\nWARC-Type: x", ""), (5, "u", "<p>é\r\n\r\n😀</p>"), (None, "n", "same"),
        (None, "n2", "only"), (7, "v", "x" * 300_000), (7, "v", "x" * 300_000), (8, "w", "xx"), (9, "w2", "xx")]


def sha(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def archived(rows, least):
    low = {}
    for i, _, h in rows:
        if i is not None:
            low[h or ""] = min(i, low.get(h or "", i))
    out = []
    for i, _, h in rows:
        n, first = len((h or "").encode()), low.get(h or "")
        refers = first if n >= least and first is not None and i != first else None
        out.append((i, n, sha(h), "revisit" if refers is not None else "response", refers))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 3])
def test_archives_come_back(spark, least):
    index, folder = archive_pages(pages_of(spark, ROWS), least_bytes=least)
    got = read_records(index, folder)
    assert sorted((tuple(r) for r in got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str) == archived(ROWS, least)
    for r in got.collect():
        assert (r.payload is None) == (r.record_type == "revisit")
        assert r.payload is None or (len(r.payload) == r.payload_bytes and base64.b32encode(hashlib.sha1(r.payload).digest()).decode() == r.payload_digest)


def test_members_stand_where_the_index_says(spark):
    index, folder = archive_pages(pages_of(spark, ROWS))
    where, root = warc_index.open_folder(folder)
    rows = sorted(index.collect(), key=lambda r: (r.file, r.offset))
    for name in {r.file for r in rows}:
        own, size = [r for r in rows if r.file == name], where.get_file_info(f"{root}/{name}").size
        assert own[0].offset == 0 and own[-1].offset + own[-1].length == size
        assert all(a.offset + a.length == b.offset for a, b in zip(own, own[1:]))
    some = read_records(index.where("page_id = 5"), folder).collect()
    assert [r.payload.decode() for r in some] == ["<p>é\r\n\r\n😀</p>"]
    assert isinstance(where, fs.FileSystem)


def test_small_ranges_and_rolled_files(spark, monkeypatch):
    monkeypatch.setattr(warc_index, "ROLL", 400)
    index, folder = archive_pages(pages_of(spark, ROWS).coalesce(1))
    monkeypatch.setattr(warc_index, "RANGE", 500)
    assert index.select("file").distinct().count() >= 1
    assert read_records(index, folder).count() == len(ROWS)


def test_a_changed_archive_raises(spark):
    index, folder = archive_pages(pages_of(spark, ROWS))
    with pytest.raises(Exception, match="does not match"):
        read_records(index.withColumn("digest", F.lit("A" * 32)), folder).count()


def test_no_pages(spark):
    index, folder = archive_pages(pages_of(spark, []))
    assert read_records(index, folder).count() == 0 and filter_urls(pages_of(spark, [])).count() == 0 and extract_pages(pages_of(spark, [])).count() == 0


# --- URL rules

def judged(url, rules, otherwise):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host):])[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = min(fit, key=lambda r: (-len(r.text), r.verdict != "block", r.text), default=None)
    return host, path, best and best.text, best.verdict if best else otherwise


def test_rules_against_brute_force(spark):
    rnd = random.Random(2)
    rules = tuple({(h, p): Rule(rnd.choice(["allow", "block"]), h, p) for h in ("com", "a.com", "b.a.com", "net", "é.org", "x" * 70 + ".net") for p in ("/", "/en/", "/en/x", "")
                   if rnd.random() < 0.8}.values())
    hosts = ["com", "a.com", "xa.com", "b.a.com", "c.b.a.com", "A.COM", "net", "x" * 70 + ".net", "É.org", "é.org", "", "u@a.com:80"]
    urls = [f"{s}://{h}{p}{q}" for s in ("http", "") for h in hosts for p in ("", "/", "/en/", "/en/xy", "/a.com/en/") for q in ("", "?x=/en/", "#://b")]
    urls += [None, "", "no scheme", "://", "a://b://a.com/", "http://a.com/" + "y" * 20_000, "http://a.com\n/en/"]
    rows = [(i, u, None) for i, u in enumerate(urls)] + [(None, "http://a.com/en/", None), (1, urls[1], None)]
    got = filter_urls(pages_of(spark, rows), rules, "block").collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, *judged(u, rules, "block")) for i, u, _ in rows), key=str)


def test_many_globs_over_many_words():
    rnd = random.Random(7)
    globs = ["".join(rnd.choice("ab*") for _ in range(rnd.randint(1, 12))) for _ in range(120)]
    machine = Automaton([(i, [ANY if c == "*" else ord(c) for c in g]) for i, g in enumerate(globs)])
    assert machine.words > 5
    strings = ["".join(rnd.choice("abc") for _ in range(rnd.randint(0, 15))) for _ in range(200)]
    states = machine.run([s.encode() for s in strings])
    for i, word, bit in machine.ends:
        assert ((states[:, word] & bit) != 0).tolist() == [fnmatch.fnmatchcase(s, globs[i]) for s in strings]
    gap = Automaton([(0, [ord("a"), IN_HOST, ord("b")])]).run([b"axxb", b"a/b", b"ab"])
    assert [bool(s[0] >> 2 & 1) for s in gap.astype(object)] == [True, False, True]
    assert UrlFilter((), "allow").judge(["", "a"]).tolist() == [0, 0]


# --- page text

BODY = "".join(f"<p>Sentence number {i}, with a comma, and some more words to count.</p>" for i in range(4))
TEXT = "\n".join(f"Sentence number {i}, with a comma, and some more words to count." for i in range(4))


@pytest.mark.parametrize("html, text", [
    ("", ""), ("   \n", ""), ("just words", "just words"), ("<p>a &amp; b&nbsp;c &#233; &lt;x&gt;</p>", "a & b c é <x>"),
    (f"<nav><a href=/>Home</a></nav><article><h1>Title</h1>{BODY}</article><footer>foot</footer>", "Title\n" + TEXT),
    (f"<body><header>Site</header><div id=main><h1>Title</h1>{BODY}</div><div class='side-bar sidebar'>{BODY}</div></body>", "Title\n" + TEXT),
    (f"<article>{BODY}<section class=comments><p>First, second, third, comment.</p></section><form><p>x</p></form></article>", TEXT),
    (f"<div class=cookie-notice><p>We use, all, of, the, cookies, here.</p></div><main>{BODY}</main>", TEXT),
    (f"<article>{BODY}<aside><p>more, more, more</p></aside><div style='display: none'><p>hidden</p></div></article>", TEXT),
    (f"<script>var p = '<p>no</p>';</script><style>p{{}}</style><!-- <p>no</p> --><article>{BODY}</article>", TEXT),
    ("<article><p>one <b>bold<br>line</b>\n\t two<p>three", "one bold line two\nthree"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table><pre>e\n  f</pre></article>", "a\nb\nc\nd\ne f"),
    (f"<body><ul><li><a href=a>One</a><li><a href=b>Two</a><li><a href=c>Three</a></ul>{BODY}<ul><li>see <a href=d>this</a></ul></body>", TEXT + "\nsee this"),
    (f"<article><h1>Title</h1><section>{BODY * 9}</section><section><p>short end</p></section></article>", "\n".join(["Title", *[TEXT] * 9, "short end"])),
    ("<div>a<div>b</div>c</div>", "a\nb\nc"), ("<p>cut off in a ta<", "cut off in a ta<"), ("<p>cut<a href='x", "cut"),
    ("<ARTICLE><P CLASS=Lead>Upper</P></ARTICLE>", "Upper"), ("<script>never closed <p>x</p>", ""), ("a</p></div></zzz>b", "ab"),
])
def test_main_text(html, text):
    assert main_text(html) == text


def test_deep_and_long_pages():
    assert main_text("<div>" * 20_000 + "<p>deep</p>") == "deep"
    long = "<article>" + "".join(f"<p>Paragraph {i}.</p>" for i in range(20_000)) + "</article>"
    assert main_text(long).count("\n") == 19_999


def test_articles_of_the_test_pages(spark):
    got = {r.page_id: r for r in extract_pages(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")).collect()}
    for row in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)(?:</article>|<footer|$)", row.html, re.S)[1]
        parts = [" ".join(re.sub("<[^>]*>", "", x.replace("<br>", " ")).replace("&amp;", "&").replace("&quot;", '"').split()) for x in re.split("</?(?:p|h1)>", inner)]
        assert got[row.page_id].text == "\n".join(p for p in parts if p)
        assert got[row.page_id].n_chars == len(got[row.page_id].text)


def test_odd_page_rows(spark):
    rows = [(1, "u", None), (None, None, "<p>x</p>"), (1, "u", None)]
    assert sorted((tuple(r) for r in extract_pages(pages_of(spark, rows)).collect()), key=str) == sorted([(1, "u", "", 0), (None, None, "x", 1), (1, "u", "", 0)], key=str)


def test_article_names_outweigh_names_of_what_is_beside():
    text = "This is the body of the article, with commas, and with enough words to count as a paragraph of it."
    for names in ('class="content has-sidebar"', 'id="main-content" class="no-sidebar"', 'class="post with-comments"', 'class="layout has-sidebar"', 'class="post widget-area"'):
        html = f'<body><div {names}><h1>Title</h1><p>{text}</p><p>{text}</p><div class="sidebar"><p>{text} Aside.</p></div></div></body>'
        assert main_text(html) == f"Title\n{text}\n{text}", names
    for names in ('class="post-comments"', 'class="content sidebar"', 'class="main-menu"', 'id="comments"', 'class="entry-footer"'):
        html = f'<body><article><p>{text}</p><div {names}><p>{text} Not this.</p></div></article></body>'
        assert main_text(html) == text, names


def test_small_parts_beside_the_best_container_stay():
    text = "This is the text, with commas, and with enough words, to count as a paragraph, of the page, and more of it."
    box = f"<div>{f'<p>{text}</p>' * 8}</div>"
    html = f"<body><h1>Title</h1>{box}between <b>bold</b> words<div>{f'<p>{text}</p>' * 3}</div><p>The end.</p><div><a href='x'>One</a> <a href='y'>Two</a></div></body>"
    assert main_text(html) == "\n".join(["Title", *[text] * 8, "between bold words", *[text] * 3, "The end."])


TEXT = "This sentence is long enough, with commas, to be taken for a part of an article by its length alone, and says nothing else."


@pytest.mark.parametrize(("inner", "found"), [
    ('<h2 id="related-work">Related work</h2>', "Related work"),
    ('<h2 id="market-share">Market share</h2>', "Market share"),
    (f'<section id="share-prices"><p>{TEXT}</p></section>', TEXT),
    ("<ul><li><a href=1>First reference</a></li><li><a href=2>Second reference</a></li><li><a href=3>Third</a></li></ul>", "First reference\nSecond reference\nThird"),
    ("<p>Value <math><mi>x</mi><annotation>tex</annotation></math> is set</p>", "Value x is set"),
    ("<p>Press <label>the field</label> here</p>", "Press the field here"),
    ("<fieldset><p>Kept words</p></fieldset>", "Kept words"),
    ('<div class="header"><h1>The title</h1></div>', "The title"),
    ('<p class="notice-period">Three months</p>', "Three months"),
    ('<div class="share">Share this</div>', ""), ('<div class="comments">' + f"<p>{TEXT}</p>" * 5 + "</div>", ""), ('<div class="ad">Buy now</div>', ""),
    ('<div class="related"><a href=1>' + "Another page " * 30 + "</a></div>", ""), ("<form><p>Name</p></form>", ""),
])
@pytest.mark.parametrize("outer", ["<article>{}</article>", '<div class="post">{}</div>'])
def test_an_article_keeps_what_is_its_own(outer, inner, found):
    html = "<nav><a href=0>Home</a></nav>" + outer.format(f"<p>{TEXT}</p>{inner}<p>{TEXT}</p>") + "<footer>Imprint</footer>"
    assert main_text(html) == "\n".join(x for x in (TEXT, found, TEXT) if x)


def test_pages_of_known_blocks_with_boilerplate_around_and_between():
    rnd = random.Random(12)
    words = "ash birch cedar elm fir hazel larch maple oak pine rowan yew".split()

    def sentence():
        return " ".join(rnd.choice(words) for _ in range(rnd.randint(8, 40))) + ", " + rnd.choice(words) + "."

    def wrap(tag, text):
        return f'<{tag} id="{rnd.choice(("share", "related", "comment", "ad", "x"))}-{rnd.choice(words)}">{text}</{tag}>'

    noise = [
        lambda: '<nav><ul><li><a href="/">Home</a></li><li><a href="/b">Blog</a></li></ul></nav>', lambda: "<script>var a = '<p>no</p>';</script>",
        lambda: '<div class="ad"><p>Buy now</p></div>', lambda: "<style>p { color: red }</style>", lambda: "<aside><p>Beside</p></aside>",
        lambda: '<form><label>Mail</label><input name=m><button>Send</button></form>', lambda: '<div class="cookie-consent">We use cookies</div>',
        lambda: '<div class="share"><a href=1>one</a> <a href=2>two</a></div>', lambda: "<!-- <p>gone</p> -->",
    ]
    for k in range(200):
        kept, body = [], []
        for _ in range(rnd.randint(3, 25)):
            if rnd.random() < 0.4:
                body.append(rnd.choice(noise)())
            kind = rnd.choice(["p", "h2", "li", "blockquote", "links"])
            texts = [sentence()] if kind != "links" else [rnd.choice(words) for _ in range(4)]
            kept += texts
            body.append(wrap(kind, texts[0]) if kind in ("p", "h2", "blockquote") else "<ul>" + "".join(
                wrap("li", f"<a href=1>{t}</a>" if kind == "links" else t) for t in texts) + "</ul>")
        edge = "".join(rnd.choice(noise)() for _ in range(4))
        outer = ("<article>{}</article>", "<main>{}</main>", '<div id="content">{}</div>')[k % 3]
        html = f"<html><head><title>T</title></head><body>{edge}{outer.format(''.join(body))}{edge}<footer><p>Imprint</p></footer></body></html>"
        assert main_text(html) == "\n".join(kept), k
