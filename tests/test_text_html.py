"""Text cleaning and HTML."""

import random
import re
from html import unescape
from html.entities import html5
from html.parser import HTMLParser

from pyspark.sql import functions as F

from adledger.functions import entities, html, text
from adledger.operators.features import text_sequence, text_vocab
from adledger.operators.filters import price_leak_flag
from adledger.operators.sets import union_links


def python_clean(raw):
    """The published cleaning steps, run by Python."""
    t = re.sub(r"(?im)^\s*image_url\s*:\s*.*$", " ", raw)
    t = re.sub(r"https?://\S+", " ", t)
    t = re.sub(r"(?im)^\s*(price|asking price|listed price)\s*[:\-]\s*.*$", " ", t)
    t = re.sub(r"\$\s*\d{1,3}(?:,\d{3})+(?:\.\d+)?", " ", t)
    t = re.sub(r"\$\s*\d+(?:\.\d+)?", " ", t)
    return re.sub(r"\s+", " ", t.lower()).strip()


def test_clean_listing_text(apply):
    rows = ["Price:\n\nGreat car\nb", "$1,50", "see https://x.y/z now", "a\n  IMAGE_URL : x\nb", "PRICE - 5\r\nx", "$ 1,234,567.89!",
            "a  b\x1cc", "my price: 5", "Listed Price: \n7\n8", "ÉTÉ\x0b$9", "price", "", "  \n ", "a price: 5\nb"]
    assert apply(text.clean_listing_text, rows) == [python_clean(r) for r in rows]
    assert apply(text.clean_listing_text, [None]) == [""]


def test_small_text_functions(apply):
    assert apply(text.clean_text_value, [None, "  A \n b "]) == ["", "a b"]
    assert apply(text.text_excerpt, ["a  b" + "x" * 300]) == ["a b" + "x" * 247]
    assert apply(text.looks_like_path, ["in scrapes/1", "a.txt", "x", None]) == [True, True, False, False]
    line = lambda c: text.append_image_line(F.lit("t\n"), c)
    assert apply(line, ["http://i", "", None]) == ["t\n\nimage_url: http://i\n", "t\n", "t\n"]


def test_combined_text_fallback(frame):
    df = frame("t string, d string", [("A", "B  c"), (None, "x"), (None, None)])
    got = [r[0] for r in df.select(text.combined_text_fallback("t", "d")).collect()]
    assert got == ["a b c", "x", ""]
    assert df.select(text.combined_text_fallback(None, "d")).first()[0] == "b c"


def test_price_leak(frame):
    df = frame("price_num double, combined_text string", [
        (12500.0, "for 12,500"), (12500.0, "112500x"), (12500.0, "none"), (None, "12500"), (900.7, "just $900"), (5.0, None)])
    assert [r[-1] for r in price_leak_flag(df).collect()] == [True, True, False, False, True, False]


class Visible(HTMLParser):
    """Text nodes outside dead blocks, as an HTML parser sees them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.dead, self.nodes = 0, []

    def handle_starttag(self, tag, attrs):
        self.nodes.append("\n")
        self.dead += tag in ("script", "style", "noscript", "template")

    def handle_endtag(self, tag):
        self.nodes.append("\n")
        self.dead -= tag in ("script", "style", "noscript", "template")

    def handle_comment(self, data):
        self.nodes.append("\n")

    def handle_data(self, data):
        if not self.dead:
            self.nodes.append(data)


def python_visible(page):
    parser = Visible()
    parser.feed(page)
    parser.close()
    lines = [x.strip() for x in "".join(parser.nodes).splitlines()]
    lines = [x for x in lines if x]
    kept = [x for i, x in enumerate(lines) if i == 0 or x != lines[i - 1]]
    return "\n".join(kept) + "\n"


PAGES = [
    "<!DOCTYPE html><html><head><title>T &amp; U</title><style>p{}</style></head><body><p>a<b>b</b>c</p>"
    "<script>var t='</p>';</script><!-- gone <b>x</b> --><noscript>no</noscript><template><i>x</i></template></body></html>",
    "<p>one</p>\n\n <p> one </p><p>two</p><p>one</p>",
    "x &lt;b&gt; y &copy;&nbsp;z&#33;",
    '<a title="a>b" href=\'c>d\'>link</a> tail',
    "a<br>b<br/>c<SCRIPT>d</SCRIPT>e\r\nf\x0bg h",
    "",
    "   \n\t ",
    "5 < 6 and 7 > 2",
    "<p>same<p>same<p>same<p>other",
    "<style>a</style><p> padded </p>",
]


def test_visible_text(apply):
    assert apply(html.visible_text, PAGES) == [python_visible(p) for p in PAGES]


def test_many_equal_lines(apply):
    page = "<p>same</p>" * 20000 + "<p>end</p>"
    assert apply(html.visible_text, [page]) == ["same\nend\n"]


def test_links(frame):
    page = """<a href="//h/a/1.html">x</a><a href='/b/2.html'>y</a>
      <li class="cl-search-result big"><a class="titlestring" href="https://h/3.htm">z</a></li>
      <a href="/c/4.html?x=1">n</a><a href="/d/5.htm">n</a><a class="result-title hdrlnk" href="/e/6.htm">t</a>
      <li class="result-row"><a href=/f/7.htm>r</a></li><li class="cl-search-resulty"><a href="/g/8.htm">n</a></li>
      <link href="/h/9.html"><!-- <a href='/i/10.html'>c</a> --><a href="rel/11.html">r</a><a href="/b/2.html">again</a>"""
    rows = union_links(frame("page_id long, html string", [(1, page)]), "https://s").collect()
    assert {r.url for r in rows} == {"https://h/a/1.html", "https://s/b/2.html", "https://h/3.htm", "https://s/e/6.htm",
                                     "https://s/f/7.htm", "https://s/h/9.html", "rel/11.html"}
    assert {r.post_id for r in rows} == {"1", "2", "3", "6", "7", "9", "11"}
    assert len(rows) == 7


def test_first_image(apply):
    image = lambda c: html.first_image_url(c, "img.example.com")
    rows = ['<img src="/logo.png"><img alt=x data-src="https://img.example.com/1.jpg">', "<p>none</p>",
            "<div data-x='https://img.example.com/2.jpg'>", '<!-- <img src="https://img.example.com/3.jpg"> -->',
            "<img src=https://img.example.com/4.jpg data-src='https://img.example.com/5.jpg'>"]
    assert apply(image, rows) == ["https://img.example.com/1.jpg", "", "https://img.example.com/2.jpg",
                                  "https://img.example.com/3.jpg", "https://img.example.com/4.jpg"]


def test_post_ids(apply):
    assert apply(html.post_id_from_url, ["/a/12.html", "/12.htm", "/12.html?x", "/x.html"]) == ["12", "12", "", ""]
    assert apply(html.post_id_from_path, ["scrapes/r/77.txt", "a/.txt", "b.c/d"]) == ["77", ".txt", "d"]


def test_adjacent_distinct(apply):
    got = apply(html.adjacent_distinct, [["a", "a", "b", "a"], [], None, ["x"], [None, None, "y"]], "array<string>")
    assert got == [["a", "b", "a"], [], None, ["x"], [None, "y"]]


def test_vocabulary_and_sequence(frame):
    df = frame("id long, t string", [(1, "Red red, CAR!"), (2, "car blue " * 100), (3, None), (4, "zzz red")])
    vocab = text_vocab(df.where("id < 4"), "t", max_tokens=4)
    assert [(r.token, r.id) for r in vocab.orderBy("id").collect()] == [("car", 2), ("blue", 3)]
    got = {r.id: r.token_ids for r in text_sequence(df, vocab, "t").collect()}
    assert got[1] == [1, 1, 2] + [0] * 147
    assert got[2] == [2, 3] * 75
    assert got[3] == [0] * 150 and got[4][:3] == [1, 1, 0]
    assert all(len(v) == 150 for v in got.values())


def test_links_in_any_item(apply):
    """Items of any element, nested ones included; all entities of a link decoded."""
    page = ('<div class="result-row x"><p><div><a href="/d/5.htm">a</a></div></p><a href="/d/6.htm"></a></div><a href="/d/7.htm">out</a>'
            '<ul><li class="result-row"><ul><li>inner</li></ul><img src=x><a href="/d/8.htm">b</a></li><li><a href="/d/9.htm">no</a></li></ul>'
            '<span class="cl-search-result"><br><a href="/q?a=1&#38;b=2&amp;c=&quot;/10.htm">c</a></span><a href=\'//h.org/x&#x26;y/11.html\'>d</a>')
    assert apply(lambda c: html.extract_links(c, "https://b.org"), [page, "", None]) == [[
        "https://h.org/x&y/11.html", "https://b.org/d/5.htm", "https://b.org/d/6.htm", "https://b.org/d/8.htm",
        'https://b.org/q?a=1&b=2&c="/10.htm'], [], None]


def test_links_with_line_breaks(apply):
    """A link is one link whatever its href holds, and none is made up from its parts."""
    page = ('<a href="/d/a\n/2.html">x</a><a href="/d/a&#10;/d/7.html">y</a><div class="result-row"><a href="/k/\n/3.htm">z</a></div>'
            "<a href='/q/\r\n4.html'>no digits behind a slash</a><a>none</a><a href=''>empty</a>")
    assert apply(lambda c: html.extract_links(c, "https://b"), [page]) == [[
        "https://b/d/a\n/2.html", "https://b/d/a\n/d/7.html", "https://b/k/\n/3.htm", "https://b/d/a&#10;/d/7.html"]]


def test_items_of_any_shape(apply):
    page = ('<li class="result-row"><a href="/1.htm">a</a><li class="result-row"><a href="/2.htm">b</a></li><a href="/3.htm">c</a></li><a href="/4.htm">out</a>'
            '<p title="<li class=result-row>"><a href="/5.htm">out</a></p><img class="result-row"><a href="/6.htm">out</a><div class="result-row"/><a href="/7.htm">out</a>'
            '<a class="result-row" href="/8.htm"><b>item</b><a href="/9.htm">in</a></a><SECTION CLASS=RESULT-ROW><A HREF=/10.htm>in, never closed')
    assert apply(lambda c: html.extract_links(c, "https://b"), [page]) == [[f"https://b/{n}.htm" for n in (1, 2, 3, 9, 10)]]


def test_entities_equal_the_library(apply):
    r = random.Random(4)
    names = list(html5)
    texts = ["&" + n for n in names] + ["&" + n.rstrip(";") + "zz" for n in names] + [f"a&#{n};b" for n in (*range(300), *range(0xD7FE, 0xE002), *range(0xFDCE, 0xFDF2), 0xFFFE, 0x1FFFF, 0x10FFFF, 0x110000, 10**30)]
    texts += [f"&#x{r.randrange(0x120000):X}" for _ in range(300)] + ["&", "&&amp;&", "& b", "&notit;", "&#;", "&#x;", "&#X41;z", "&#0000065;", "&" + "a" * 40 + ";", "", "x", "&é;"]
    texts += ["".join(r.choice(["&", "#", "x", "1", "amp", "lt", ";", "not", "in", " ", "é", "\n", "<"]) for _ in range(r.randrange(12))) for _ in range(500)]
    assert apply(entities.unescaped, texts) == list(map(unescape, texts))
    assert apply(entities.unescaped, [None]) == [None]


def test_image_urls_are_decoded(apply):
    image = lambda c: html.first_image_url(c, "img.example.com")
    rows = ['<img src="https://img.example.com/a&#38;b&amp;c&quot;d&eacute;.jpg">', "<img data-src='https&colon;//img.example.com/x&sol;1.jpg'>"]
    assert apply(image, rows) == ['https://img.example.com/a&b&c"dé.jpg', "https://img.example.com/x/1.jpg"]


def test_many_anchors_in_one_item(apply):
    page = '<ul class="result-row">' + "".join(f'<a href="/{i}.htm">x</a>' for i in range(20000)) + "</ul>"
    got = apply(lambda c: html.extract_links(c, "https://b"), [page])[0]
    assert len(got) == 20000 and got[-1] == "https://b/19999.htm"
