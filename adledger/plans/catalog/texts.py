"""Text cleaning, HTML and token queries, over whole documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import html, text
from ...operators import features, filters, sets
from .common import L, NL, derive, listings, table

# ---- documents with lines that must go --------------------------------------

DIRTY = f"""
SELECT doc_id, 'Price:' || {NL} || {NL} || 'Great car' || {NL} || text || {NL}
  || 'see https://x.example.org/z?q=' || CAST(doc_id AS STRING) || ' now $1,50 or $ 12,500.75 or $9' || {NL}
  || '  Asking price - ' || CAST(doc_id AS STRING) || {NL} || '  IMAGE_URL : https://images.example.org/a.jpg' || {NL}
  || 'gs://bucket' AS raw
FROM {{documents}}"""
D_CTE = f"d AS ({DIRTY.format(documents='documents')})"


def clean_sql(column: str) -> str:
    out = column
    for pattern in (r"(?im)^\s*image_url\s*:\s*.*$", r"https?://\S+",
                    r"(?im)^\s*(price|asking price|listed price)\s*[:-]\s*.*$",
                    r"\$\s*\d{1,3}(?:,\d{3})+(?:\.\d+)?", r"\$\s*\d+(?:\.\d+)?"):
        out = f"regexp_replace({out}, '{pattern}', ' ', 'g')"
    return rf"trim(regexp_replace(lower({out}), '\s+', ' ', 'g'))"


def dirty(spark, folder):
    return derive(spark, folder, DIRTY, "documents")


def _clean_listing_text(spark, folder):
    return dirty(spark, folder).select("doc_id", text.clean_listing_text("raw").alias("combined_text"))


def _clean_text_value(spark, folder):
    raw = F.when(F.col("lang") != "es", F.col("text"))
    return table(spark, folder, "documents").select("doc_id", text.clean_text_value(raw).alias("cleaned"))


def _combined_text_fallback(spark, folder):
    title = F.when(F.col("lang") != "de", F.col("source"))
    return table(spark, folder, "documents").select(
        "doc_id", text.combined_text_fallback(title, "text").alias("combined_text"))


def _text_len(spark, folder):
    body = F.when(F.col("lang") != "fr", F.col("text"))
    return table(spark, folder, "documents").select(
        "doc_id", text.text_len(body).alias("combined_text_len"), text.has_text(body).alias("has_combined_text"))


def _text_excerpt(spark, folder):
    return table(spark, folder, "documents").select("doc_id", text.text_excerpt("text").alias("text_excerpt"))


def _append_image_line(spark, folder):
    url = F.when(F.col("lang") == "en", F.concat(F.lit("https://images.example.org/"), "source")).otherwise("")
    return table(spark, folder, "documents").select("doc_id", text.append_image_line("text", url).alias("text"))


def _path_like_filter(spark, folder):
    return filters.path_like_filter(dirty(spark, folder), "raw").select("doc_id", F.length("raw").cast("bigint").alias("n"))




def _price_leak_flag(spark, folder):
    priced = listings(spark, folder).join(
        table(spark, folder, "orders").select(F.col("o_orderkey").alias("listing_id"), "o_totalprice"), "listing_id")
    target = priced.withColumn("price_num", F.floor(F.col("o_totalprice") / 10).cast("double"))
    return filters.price_leak_flag(target, "price_num", "text").select("listing_id", "price_appears_in_text")


# ---- pages ------------------------------------------------------------------

SEARCH_PAGES = """
SELECT page_id, url, html || '<a class="x" href="' || url || '">p</a><a href=''/b/' || CAST(page_id AS STRING)
  || '.html''>q</a><li class="cl-search-result z"><a class="titlestring" href="//h.example.org/c/' || CAST(page_id AS STRING)
  || '.htm">r</a></li><a href="/d/' || CAST(page_id AS STRING) || '.htm">s</a><link href="/e/' || CAST(page_id AS STRING)
  || '.html"><a href="/f/1.html?x=1">t</a><div class="a result-row"><p><a href="/k/' || CAST(page_id AS STRING)
  || '.htm">u</a></p><b><a href="&#47;n/' || CAST(page_id AS STRING) || '.htm">v</a></b></div><ul><li class="result-row"><ul><li>in</li></ul><a href="/m/'
  || CAST(page_id AS STRING) || '.htm">w</a></li></ul><!-- <a href="/g/' || CAST(page_id AS STRING) || '.html"> -->'
  || CASE WHEN page_id % 4 = 0 THEN '<img src="/logo.png"><img data-src="https://images.example.org/' || CAST(page_id AS STRING) || '.jpg">'
       WHEN page_id % 4 = 1 THEN '<div data-bg="https://images.example.org/bg' || CAST(page_id AS STRING) || '.jpg">' ELSE '' END AS html
FROM {pages}"""
S_CTE = f"s AS ({SEARCH_PAGES.format(pages='pages')})"
BASE = "https://cars.example.org"
LINKS_SQL = rf"""{S_CTE}, bare AS (SELECT page_id, html, regexp_replace(html, '(?s)<!--.*?-->', ' ', 'g') AS live FROM s),
raw AS (
  SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+?/\d+\.html)"', 1)) AS u FROM bare
  UNION SELECT page_id, unnest(regexp_extract_all(live, '(?is)<a\s[^>]*?href=["'']([^"''>]+/\d+\.html)["'']', 1)) FROM bare
  UNION SELECT page_id, '/' || x || '/' || page_id || '.htm' FROM pages, (VALUES ('k'), ('m'), ('n')) v(x)
  UNION SELECT page_id, unnest(regexp_extract_all(live, '(?is)<li class="cl-search-result[^>]*><a class="titlestring" href="([^"]+/\d+\.html?)"', 1)) FROM bare),
links AS (SELECT DISTINCT page_id, CASE WHEN starts_with(u, '//') THEN 'https:' || u WHEN starts_with(u, '/') THEN '{BASE}' || u ELSE u END AS url FROM raw)"""


def search_pages(spark, folder):
    return derive(spark, folder, SEARCH_PAGES, "pages")


def _extract_links(spark, folder):
    return search_pages(spark, folder).select("page_id", F.explode_outer(html.extract_links("html", BASE)).alias("url")).where("url IS NOT NULL")


def _union_links(spark, folder):
    return sets.union_links(search_pages(spark, folder), BASE).drop("position")


def _visible_text(spark, folder):
    return table(spark, folder, "pages").select("page_id", html.visible_text("html").alias("text"))


def _first_image_url(spark, folder):
    return search_pages(spark, folder).select("page_id", html.first_image_url("html").alias("image_url"))


def _adjacent_distinct(spark, folder):
    # Words of a document, equal neighbours collapsed.
    words = F.split(F.lower("text"), r"[^a-z]+")
    return table(spark, folder, "documents").select(
        "doc_id", F.concat_ws(" ", html.adjacent_distinct(words)).alias("words"))


VISIBLE_SQL = r"""
WITH a AS (SELECT page_id, regexp_replace(html,
  '(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<noscript\b[^>]*>.*?</noscript\s*>|<template\b[^>]*>.*?</template\s*>|<[!?][^>]*>|</?[a-z](?:[^>"'']|"[^"]*"|''[^'']*'')*>',
  chr(10), 'g') AS t FROM pages),
b AS (SELECT page_id, replace(replace(replace(replace(t, '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&') AS t FROM a),
c AS (SELECT page_id, list_filter(list_transform(string_split(t, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS l FROM b)
SELECT page_id, array_to_string(list_filter(l, lambda x, i: i = 1 OR x <> l[i - 1]), chr(10)) || chr(10) AS text FROM c"""

# ---- tokens -----------------------------------------------------------------


def _text_vocab(spark, folder):
    return features.text_vocab(table(spark, folder, "documents"), "text")


def _text_sequence(spark, folder):
    docs = table(spark, folder, "documents")
    out = features.text_sequence(docs, features.text_vocab(docs, "text"), "text")
    return out.select("doc_id", F.concat_ws(",", F.col("token_ids").cast("array<string>")).alias("token_ids"))


TOKENS_SQL = r"""toks AS (SELECT doc_id, list_filter(regexp_split_to_array(
  regexp_replace(lower(text), '[!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~'']', '', 'g'), '\s+'), lambda t: t <> '') AS l FROM documents),
one AS (SELECT unnest(l) AS token FROM toks),
vocab AS (SELECT token, CAST(count(*) AS BIGINT) AS count, CAST(row_number() OVER (ORDER BY count(*) DESC, token) + 1 AS INTEGER) AS id
  FROM one GROUP BY token ORDER BY count(*) DESC, token LIMIT 4998)"""

QUERIES = {
    "clean_listing_text": _clean_listing_text,
    "clean_text_value": _clean_text_value,
    "combined_text_fallback": _combined_text_fallback,
    "text_len": _text_len,
    "text_excerpt": _text_excerpt,
    "append_image_line": _append_image_line,
    "path_like_filter": _path_like_filter,
    "price_leak_flag": _price_leak_flag,
    "extract_links": _extract_links,
    "union_links": _union_links,
    "visible_text": _visible_text,
    "first_image_url": _first_image_url,
    "adjacent_distinct": _adjacent_distinct,
    "text_vocab": _text_vocab,
    "text_sequence": _text_sequence,
}

ORACLES = {
    "clean_listing_text": f"WITH {D_CTE} SELECT doc_id, {clean_sql('raw')} AS combined_text FROM d",
    "clean_text_value": r"SELECT doc_id, CASE WHEN lang <> 'es' THEN trim(regexp_replace(lower(text), '\s+', ' ', 'g')) ELSE '' END AS cleaned FROM documents",
    "combined_text_fallback": r"""SELECT doc_id, trim(regexp_replace(lower(
  CASE WHEN lang <> 'de' THEN source ELSE '' END || ' ' || text), '\s+', ' ', 'g')) AS combined_text FROM documents""",
    "text_len": """SELECT doc_id, CASE WHEN lang <> 'fr' THEN length(text) ELSE 0 END AS combined_text_len,
  lang <> 'fr' AND length(text) > 0 AS has_combined_text FROM documents""",
    "text_excerpt": r"SELECT doc_id, substr(regexp_replace(text, '\s+', ' ', 'g'), 1, 250) AS text_excerpt FROM documents",
    "append_image_line": """SELECT doc_id, text || CASE WHEN lang = 'en' THEN
  chr(10) || 'image_url: https://images.example.org/' || source || chr(10) ELSE '' END AS text FROM documents""",
    "path_like_filter": rf"WITH {D_CTE} SELECT doc_id, length(raw) AS n FROM d WHERE regexp_matches(raw, 'scrapes/|gs://|\.txt')",
    "price_leak_flag": f"""WITH {L}, x AS (SELECT listing_id, lower(text) AS t, CAST(floor(o_totalprice / 10) AS BIGINT) AS p
  FROM l JOIN orders ON listing_id = o_orderkey)
SELECT listing_id, contains(t, CAST(p AS VARCHAR)) OR contains(t, format('{{:,}}', p))
  OR contains(t, '$' || p) OR contains(t, '$' || format('{{:,}}', p)) AS price_appears_in_text FROM x""",
    "extract_links": f"WITH {LINKS_SQL} SELECT page_id, url FROM links",
    "union_links": rf"WITH {LINKS_SQL} SELECT page_id, url, regexp_extract(url, '/(\d+)\.html?$', 1) AS post_id FROM links",
    "visible_text": VISIBLE_SQL,
    "first_image_url": """SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'https://images.example.org/' || page_id || '.jpg'
  WHEN 1 THEN 'https://images.example.org/bg' || page_id || '.jpg' ELSE '' END AS image_url FROM pages""",
    "adjacent_distinct": r"""WITH w AS (SELECT doc_id, regexp_split_to_array(lower(text), '[^a-z]+') AS l FROM documents)
SELECT doc_id, array_to_string(list_filter(l, lambda x, i: i = 1 OR x <> l[i - 1]), ' ') AS words FROM w""",
    "text_vocab": f"WITH {TOKENS_SQL} SELECT token, count, id FROM vocab",
    "text_sequence": f"""WITH {TOKENS_SQL}, pos AS (SELECT doc_id, unnest(l[1:150]) AS token, generate_subscripts(l[1:150], 1) AS i FROM toks),
ids AS (SELECT doc_id, list(coalesce(id, 1) ORDER BY i) AS v FROM pos LEFT JOIN vocab USING (token) GROUP BY doc_id)
SELECT doc_id, array_to_string(list_concat(coalesce(v, []), list_resize(CAST([] AS INTEGER[]), 150 - len(coalesce(v, [])), 0)), ',') AS token_ids
FROM toks LEFT JOIN ids USING (doc_id)""",
}
