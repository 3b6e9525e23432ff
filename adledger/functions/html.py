"""HTML: links, image URLs, visible text.

Tags are found by native regular expressions in one left-to-right pass, and character
references are decoded by `entities`: no row leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .entities import bound, unescaped
from .listing import DEFAULT_IMAGE_HOST, image_pattern
from .numbers import _col
from .text import strip

# One attribute list, quoted values may hold '>'.
ATTRS = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
COMMENT = r"<!--.*?-->"
DEAD = r"<(script|style|noscript|template)\b[^>]*>.*?(?:</\1\s*>|\z)"
DECLARATION = r"<[!?][^>]*>"
TAG = rf"</?[a-z]{ATTRS}>"
MARKUP = rf"(?is){COMMENT}|{DEAD}|{DECLARATION}|{TAG}"
LINE_BREAK = r"[\n\r\x0b\x0c\x1c-\x1e\u0085\u2028\u2029]"

# A listing page ends in its numeric id.
POST_PAGE = r"/(\d+)\.html?$"
RAW_POST_LINK = r'href="([^"]+?/\d+\.html)"'
#: Anchors that count in any spelling: result titles, and all inside a result item,
#: whatever element that is.
# The attributes of a tag before its class.
BEFORE_CLASS = r"""(?is)^<[a-z][^\s/>]*+(?:[\s/]++(?!class\s*=)[^\s"'>/=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?+)*+[\s/]++"""
IN_CLASS = r"""class\s*=\s*["']?[^"'>]*(?<![\w-])"""
TITLE_CLASS = rf"{BEFORE_CLASS}{IN_CLASS}result-title(?![\w-])"
ITEM_CLASS = rf"{BEFORE_CLASS}{IN_CLASS}(?:cl-search-result|result-row)(?![\w-])"
# Elements without an end tag.
VOID = "^(area|base|br|col|embed|hr|img|input|link|meta|source|track|wbr)$"


def attribute(tag: Column, name: str) -> Column:
    """Value of one attribute of a tag: double-quoted, single-quoted or bare; '' if absent."""
    pattern = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.concat(*[F.regexp_extract(tag, pattern, g) for g in (1, 2, 3)])


def anchors_in_items(tags: Column) -> Column:
    """Links of anchors inside result items, of all tags (tag, url) of a page in order.

    An item of any element lasts until its own end tag, elements of the same name inside it
    counted. Of the tags only anchors and those of an item's element matter; one walk over them
    gives the intervals the items cover, and the anchors are cut out of these.
    """
    tag_name = lambda t: F.lower(F.regexp_extract(t, r"^</?([a-zA-Z][a-zA-Z0-9-]*)", 1))
    opens = lambda t: ~t.startswith("</") & F.lower(t).rlike("result-row|cl-search-result") & t.rlike(ITEM_CLASS)
    none = F.array().cast("array<string>")

    def read(names: Column) -> Column:
        told = F.transform(tags, lambda t: F.struct(tag_name(t["tag"]).alias("name"), t["tag"].startswith("</").alias("closing"), t["tag"].alias("tag"), t["url"].alias("url")))
        return F.filter(told, lambda t: (t["name"] == "a") | F.array_contains(names, t["name"]))

    def walk(state: Column, t: Column) -> Column:
        open_ = state["item"] != ""
        lasting = ~t["closing"] & ~t["name"].rlike(VOID) & ~t["tag"].endswith("/>")
        same = t["name"] == state["item"]
        depth = F.when(open_ & same & t["closing"], state["depth"] - 1).when(open_ & same & lasting, state["depth"] + 1).otherwise(state["depth"])
        return bound(F.struct(depth.alias("depth"), (~open_ & lasting & opens(t["tag"])).alias("starts"), (open_ & (depth == 0)).alias("ends")), lambda now: F.struct(
            F.when(now["starts"], t["name"]).when(now["ends"], F.lit("")).otherwise(state["item"]).alias("item"),
            F.when(now["starts"], F.lit(1)).otherwise(now["depth"]).alias("depth"),
            F.when(now["starts"], state["at"]).otherwise(state["since"]).alias("since"), (state["at"] + 1).alias("at"),
            F.when(now["ends"], F.concat(state["found"], F.array(F.struct(state["since"].alias("since"), state["at"].alias("until"))))).otherwise(state["found"]).alias("found")))

    start = F.struct(F.lit("").alias("item"), F.lit(0).alias("depth"), F.lit(0).alias("since"), F.lit(0).alias("at"),
                     F.array().cast("array<struct<since:int,until:int>>").alias("found"))
    # an item without an end tag lasts to the end of the page
    finish = lambda s: F.when(s["item"] == "", s["found"]).otherwise(F.concat(s["found"], F.array(F.struct(s["since"].alias("since"), s["at"].alias("until")))))

    def inside(kept: Column) -> Column:
        intervals = F.aggregate(kept, start, walk, finish)
        cut = F.flatten(F.transform(intervals, lambda v: F.slice(kept, v["since"] + 2, v["until"] - v["since"] - 1)))
        return F.transform(F.filter(cut, lambda t: (t["name"] == "a") & t["url"].isNotNull()), lambda t: t["url"])

    def of(items: Column) -> Column:
        names = F.array_distinct(F.transform(items, lambda t: tag_name(t["tag"])))
        return F.when(F.size(items) > 0, bound(names, lambda n: bound(read(n), inside))).otherwise(none)

    return bound(F.filter(tags, lambda t: opens(t["tag"])), of)


def _absolute(url: Column, base: str) -> Column:
    return (
        F.when(url.startswith("//"), F.concat(F.lit("https:"), url))
        .when(url.startswith("/"), F.concat(F.lit(base), url))
        .otherwise(url)
    )


def live_markup(page: Column | str) -> Column:
    """The page without comments and dead blocks, whose anchors do not count."""
    return F.regexp_replace(_col(page), rf"(?is){COMMENT}|{DEAD}", " ")


def extract_links(page: Column | str, base: str, live: Column | str | None = None) -> Column:
    """Distinct absolute listing URLs of a search page, in order of discovery.

    ``live`` may name a column already holding `live_markup` of the page.
    """
    page = _col(page)
    live = live_markup(page) if live is None else _col(live)

    def read(tag: Column) -> Column:
        url = F.when(tag.rlike(r"(?i)^<a\s"), unescaped(attribute(tag, "href")))
        return F.struct(tag.alias("tag"), url.alias("url"))

    def candidates(tags: Column) -> Column:
        anchors = F.filter(tags, lambda t: t["url"].isNotNull())
        titles = F.filter(anchors, lambda t: F.lower(t["tag"]).contains("result-title") & t["tag"].rlike(TITLE_CLASS))
        urls = lambda x: F.transform(x, lambda t: t["url"])
        # A raw link that ends in .html needs its references decoded to be told from others.
        plain = F.filter(urls(anchors), lambda u: u.endswith(".html"))
        return F.concat(plain, urls(titles), anchors_in_items(tags), F.regexp_extract_all(page, F.lit(RAW_POST_LINK), F.lit(1)))

    found = bound(F.transform(F.regexp_extract_all(live, F.lit(rf"(?is){TAG}"), F.lit(0)), read), candidates)
    absolute = F.transform(found, lambda u: _absolute(u, base))
    return F.when(page.isNotNull(), F.array_distinct(F.filter(absolute, lambda u: u.rlike(POST_PAGE))))


def post_id_from_url(url: Column | str) -> Column:
    """Trailing digits of a listing URL; '' when it is no listing page."""
    return F.regexp_extract(_col(url), POST_PAGE, 1)


def post_id_from_path(path: Column | str) -> Column:
    """File name without folder and last extension."""
    name = F.regexp_extract(_col(path), r"([^/]*)$", 1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def adjacent_distinct(items: Column | str) -> Column:
    """Collapse runs of equal neighbours of an array."""
    items = _col(items)
    before = F.slice(F.concat(F.array(F.lit(None)), items), 1, F.size(items))
    pairs = F.arrays_zip(items.alias("x"), before.alias("before"))
    kept = F.filter(pairs, lambda p, i: (i == 0) | ~p["x"].eqNullSafe(p["before"]))
    return F.transform(kept, lambda p: p["x"])


def markup_to_breaks(page: Column | str) -> Column:
    """Every tag, comment and dead block becomes a line break."""
    return F.regexp_replace(_col(page), MARKUP, "\n")


def tidy_lines(text: Column | str) -> Column:
    """Lines trimmed, blank ones dropped, equal neighbours collapsed."""
    lines = F.transform(F.split(_col(text), LINE_BREAK), strip)
    kept = lambda x: F.filter(x, lambda line, i: (i == 0) | (line != F.get(x, i - 1)))
    return F.array_join(bound(F.filter(lines, lambda line: line != ""), kept), "\n")


def visible_text(page: Column | str) -> Column:
    """Text a reader sees, one text node per line, with a closing newline."""
    return F.concat(tidy_lines(unescaped(markup_to_breaks(page))), F.lit("\n"))


def first_image_url(page: Column | str, host: str = DEFAULT_IMAGE_HOST) -> Column:
    """First ``img`` whose src or data-src is on the host, else the first such URL
    anywhere in the page, else ''."""
    page = _col(page)
    live = F.regexp_replace(page, rf"(?is){COMMENT}|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\z)", " ")
    tags = F.regexp_extract_all(live, F.lit(rf"(?is)<img\b{ATTRS}>"), F.lit(0))
    written = F.flatten(F.transform(tags, lambda t: F.array(attribute(t, "src"), attribute(t, "data-src"))))
    sources = F.transform(written, unescaped)
    on_host = F.filter(sources, lambda u: u.contains(host))
    return F.coalesce(F.get(on_host, F.lit(0)), F.regexp_extract(page, image_pattern(host), 0))
