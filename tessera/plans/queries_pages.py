"""Queries of pages, blocks, model answers and documents assembled from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.operators import layout, models, pages
from tessera.plans.registry import query, read

#: A conversation is a document, a turn a page, a line of it a block.
_BLOCKS = """
WITH p AS (SELECT conv_id, turn, role, string_split(text, chr(10)) AS lines FROM conversations),
b AS (SELECT conv_id, turn, role, unnest(lines) AS text, unnest(range(len(lines))) AS ln FROM p)
"""


def _lines(spark, sf) -> DataFrame:
    c = read(spark, sf, "conversations")
    return c.select("conv_id", "turn", "role", F.posexplode(F.split("text", "\n")).alias("at", "text"))


@query(_BLOCKS + """
SELECT conv_id, turn, text, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, ln) AS INTEGER) AS "index",
       CAST(row_number() OVER (PARTITION BY conv_id, turn ORDER BY ln) AS INTEGER) AS page_index FROM b
""")
def block_numbering(spark, sf):
    """WIN1, WIN2, PRJ5, SET2."""
    return layout.numbered(_lines(spark, sf), "conv_id", "turn", "at").select("conv_id", "turn", "text", "index", "page_index")


@query("SELECT conv_id, role AS category, count(*) AS blocks FROM conversations GROUP BY ALL")
def block_category_counts(spark, sf):
    """AGG1, AGG2."""
    c = read(spark, sf, "conversations").withColumn("category", layout.category(F.col("role")))
    return layout.category_counts(c, "conv_id").select("conv_id", "category", "blocks")


@query("SELECT role AS category, count(*) AS blocks FROM conversations GROUP BY ALL ORDER BY category")
def category_listing(spark, sf):
    """SRT4."""
    return layout.category_counts(read(spark, sf, "conversations").withColumn("category", F.col("role"))).orderBy("category")


_PAGES = """
WITH p AS (SELECT d.source AS doc_id, d.doc_id AS page, CASE WHEN l.toxic = 1 THEN 'error' ELSE 'ok' END AS status, CASE WHEN l.toxic = 1 THEN 0 ELSE d.n_chars END AS block_count
           FROM documents d LEFT JOIN labels l USING (doc_id))
"""


def _page_rows(spark, sf) -> DataFrame:
    d, l = read(spark, sf, "documents"), read(spark, sf, "labels")  # noqa: E741
    bad = F.coalesce(F.col("toxic") == 1, F.lit(False))
    return d.join(l, "doc_id", "left").select(F.col("source").alias("doc_id"), F.col("doc_id").alias("page"), F.when(bad, "error").otherwise("ok").alias("status"), F.when(bad, 0).otherwise(F.col("n_chars")).alias("block_count"))


@query(_PAGES + """
SELECT doc_id, CAST(sum(block_count) AS BIGINT) AS block_count, count(*) AS parsed_page_count, coalesce(string_agg(CASE WHEN status <> 'ok' THEN page::VARCHAR END, ',' ORDER BY page), '') AS failed_pages,
       CASE WHEN bool_and(status = 'ok') THEN 'ok' ELSE 'partial' END AS status, bool_and(status = 'ok') AS success FROM p GROUP BY doc_id
""")
def document_rollup(spark, sf):
    """AGG4, ERR2."""
    r = pages.rollup(_page_rows(spark, sf))
    return r.withColumn("failed_pages", F.array_join(F.transform("failed_pages", lambda x: x.cast("string")), ","))


@query(_PAGES + ", f AS (SELECT *, min(CASE WHEN status <> 'ok' THEN page END) OVER (PARTITION BY doc_id) AS first FROM p) SELECT doc_id, page, status FROM f WHERE first IS NULL OR page <= first")
def stop_on_first_error(spark, sf):
    """WIN9, ERR3."""
    return pages.fail_fast(_page_rows(spark, sf)).select("doc_id", "page", "status")


@query(_PAGES + "SELECT doc_id, page FROM p WHERE status = 'ok'")
def good_pages(spark, sf):
    """FLT5."""
    return _page_rows(spark, sf).where("status = 'ok'").select("doc_id", "page")


@query("""
WITH s AS (SELECT conv_id, n, CASE conv_id % 4 WHEN 0 THEN 'all' WHEN 1 THEN '1' WHEN 2 THEN '2-' || n || ', 1' ELSE '1,1-2' END AS spec
           FROM (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id)),
e AS (SELECT conv_id, n, unnest(generate_series(1, n)) AS page, spec FROM s)
SELECT conv_id, CAST(page AS INTEGER) AS page FROM e
WHERE CASE conv_id % 4 WHEN 0 THEN true WHEN 1 THEN page = 1 WHEN 2 THEN n >= 2 ELSE page <= 2 AND n >= 2 END
""")
def page_spec_expand(spark, sf):
    """STR3, SET1, SRT1: a range that runs back or leaves the document selects nothing here."""
    n = read(spark, sf, "conversations").groupBy("conv_id").agg(F.count("*").cast("int").alias("pages"))
    k = F.col("conv_id") % 4
    spec = F.when(k == 0, "all").when(k == 1, "1").when(k == 2, F.concat(F.lit("2-"), F.col("pages").cast("string"), F.lit(", 1"))).otherwise("1,1-2")
    return pages.selected(n.withColumn("spec", spec)).select("conv_id", "page")


_ESC = "replace(replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"
_ISLANDS = """
WITH l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS ln FROM (SELECT doc_id, string_split(regexp_replace(text, '\\n$', ''), chr(10)) AS lines FROM documents)),
t AS (SELECT doc_id, ln, regexp_replace(line, '^\\s+|\\s+$', '', 'g') AS s FROM l),
k AS (SELECT *, CASE WHEN s = '' THEN 0 WHEN s LIKE '- %' OR s LIKE '* %' THEN 2 ELSE 1 END AS kind FROM t),
g AS (SELECT *, CASE WHEN kind = lag(kind) OVER (PARTITION BY doc_id ORDER BY ln) THEN 0 ELSE 1 END AS brk FROM k),
i AS (SELECT *, sum(brk) OVER (PARTITION BY doc_id ORDER BY ln ROWS UNBOUNDED PRECEDING) AS isl FROM g),
p AS (SELECT doc_id, isl, CASE WHEN min(kind) = 1 THEN '<p>' || {esc1} || '</p>' ELSE '<ul>' || chr(10) || string_agg('<li>' || {esc2} || '</li>', chr(10) ORDER BY ln) || chr(10) || '</ul>' END AS html
      FROM i WHERE kind > 0 GROUP BY doc_id, isl)
""".replace("{esc1}", _ESC.format("string_agg(s, ' ' ORDER BY ln)")).replace("{esc2}", _ESC.format("regexp_replace(substr(s, 3), '^\\s+|\\s+$', '', 'g')"))


@query(_ISLANDS + "SELECT d.doc_id, coalesce(string_agg(p.html, chr(10) ORDER BY isl), '<p></p>') AS html FROM documents d LEFT JOIN p USING (doc_id) GROUP BY d.doc_id")
def markdown_to_html(spark, sf):
    """STR4, STR5, AGG9."""
    return read(spark, sf, "documents").select("doc_id", layout.markdown_to_html(F.col("text")).alias("html"))


_KINDS = ("Table", "Formula", "Title", "Section-header", "Picture", "Caption", "Footnote", "Page-header", "Page-footer")


@query("""
WITH b AS (SELECT item_id, ['Table', 'Formula', 'Title', 'Section-header', 'Picture', 'Caption', 'Footnote', 'Page-header', 'Page-footer'][item_id % 9 + 1] AS kind, {esc} AS t, text FROM benchmark),
a AS (SELECT *, '<span class="block-anchor">#' || item_id || ' ' || kind || '</span>' AS anchor FROM b)
SELECT item_id, CASE kind WHEN 'Table' THEN '<div class="block block-table">' || anchor || chr(10) || CASE WHEN lower(text) LIKE '%<table%' THEN text ELSE '<p>' || t || '</p>' END || '</div>'
  WHEN 'Formula' THEN '<div class="block formula">' || anchor || '<code>' || t || '</code></div>' WHEN 'Title' THEN '<div class="block">' || anchor || '<h1>' || t || '</h1></div>'
  WHEN 'Section-header' THEN '<div class="block">' || anchor || '<h2>' || t || '</h2></div>' WHEN 'Picture' THEN '<div class="block picture">' || anchor || '<em>[figure]</em></div>'
  ELSE '<div class="block ' || lower(kind) || '">' || anchor || '<p>' || t || '</p></div>' END AS html FROM a
""".replace("{esc}", _ESC.format("text")))
def block_html(spark, sf):
    """STR6."""
    kinds = F.array(*[F.lit(k) for k in _KINDS])
    b = read(spark, sf, "benchmark").withColumn("kind", F.element_at(kinds, (F.col("item_id") % 9 + 1).cast("int")))
    return b.select("item_id", layout.block_to_html(F.col("item_id"), F.col("kind"), F.col("text")).alias("html"))


@query(_BLOCKS + """
, n AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn, ln) AS i, {esc} AS t FROM b),
h AS (SELECT conv_id, turn, string_agg('<div class="block"><span class="block-anchor">#' || i || ' Title</span><h1>' || t || '</h1></div>', chr(10) ORDER BY i) AS body, count(*) AS k FROM n GROUP BY ALL),
s AS (SELECT conv_id, string_agg('<section class="page" data-page="' || turn || '">' || chr(10) || '<div class="page-marker">PAGE ' || turn || ' · ' || k || ' block' || CASE WHEN k = 1 THEN '' ELSE 's' END || '</div>' || chr(10) || body || chr(10) || '</section>', chr(10) ORDER BY turn) AS body FROM h GROUP BY conv_id)
SELECT conv_id::VARCHAR AS doc_id, md5(body) AS body_md5 FROM s
""".replace("{esc}", _ESC.format("text")))
def document_html(spark, sf):
    """STR7, STR8, AGG9: the sections of each document, in order."""
    c = read(spark, sf, "conversations")
    block = F.transform(F.split("text", "\n"), lambda t, k: F.struct((k + 1).cast("int").alias("index"), F.lit("Title").alias("category"), F.lit(None).cast("array<double>").alias("bbox"), F.lit("markdown").alias("text_format"), t.alias("text")))
    p = c.select(F.col("conv_id").cast("string").alias("doc_id"), F.col("turn").alias("page"), F.lit("ok").alias("status"), F.lit(None).cast("string").alias("error"), F.size(block).alias("block_count"), block.alias("blocks"))
    html = pages.pages_to_html(p)
    return html.select("doc_id", F.md5(F.regexp_extract("html", r"(?s)<body>\n(.*)\n<hr>", 1)).alias("body_md5"))


@query("""
SELECT vec_id, round_even(embedding[1]::double * 100, 2) AS x1, round_even(embedding[2]::double * 100, 2) AS y1, vec_id % 3 = 0 AS dropped
FROM embeddings
""")
def bbox_normalise(spark, sf):
    """PRJ2: boxes of three numbers or with a word in them are null."""
    e = read(spark, sf, "embeddings")
    four = F.transform(F.slice("embedding", 1, 4), lambda v: (v.cast("double") * 100).cast("string"))
    bad = F.when(F.col("vec_id") % 2 == 0, F.slice(four, 1, 3)).otherwise(F.concat(F.slice(four, 1, 3), F.array(F.lit("wide"))))
    got = e.select("vec_id", S.bbox(four).alias("box"), S.bbox(F.when(F.col("vec_id") % 3 == 0, bad).otherwise(four)).isNull().alias("dropped"))
    return got.select("vec_id", F.col("box")[0].alias("x1"), F.col("box")[1].alias("y1"), "dropped")


@query("""
SELECT item_id, CASE item_id % 4 WHEN 3 THEN 0 WHEN 2 THEN 1 ELSE 2 END AS block_count, CASE WHEN item_id % 4 = 3 THEN 'error' ELSE 'ok' END AS status,
       CASE item_id % 4 WHEN 3 THEN NULL ELSE 'Title' END AS first_category, CASE item_id % 4 WHEN 3 THEN NULL ELSE text END AS first_text FROM benchmark
""")
def answer_parse(spark, sf):
    """JSN1, JSN2, JSN3, PRJ1, FLT4, ERR1: bare, fenced, cut-off and missing lists."""
    b = read(spark, sf, "benchmark")
    one = F.to_json(F.struct(F.array(F.lit(1), F.lit(2), F.lit(3), F.lit(4)).alias("bbox"), F.lit("Title").alias("category"), F.col("text")))
    two = F.concat(F.lit("["), one, F.lit(', {"bbox": [1, 2], "text": "second"}]'))
    k = F.col("item_id") % 4
    answer = F.when(k == 0, two).when(k == 1, F.concat(F.lit("Here it is:\n```json\n"), two, F.lit("\n```\nthat is all"))).when(k == 2, F.concat(F.lit("["), one, F.lit(', {"bbox": [1, 2'))).otherwise("there is nothing")
    p = pages.parsed(b.select("item_id", answer.alias("answer"), F.lit(None).cast("string").alias("error")))
    return p.select("item_id", "block_count", "status", F.try_element_at("blocks", F.lit(1))["category"].alias("first_category"), F.try_element_at("blocks", F.lit(1))["text"].alias("first_text"))


@query("SELECT conv_id::VARCHAR AS doc_id, count(*) FILTER (WHERE turn % 5 <> 3) * 2 AS block_count, count(*) AS parsed_page_count, bool_and(turn % 5 <> 3) AS success FROM conversations GROUP BY conv_id")
def parse_pdf(spark, sf):
    """MDL2 to MDL4, ERR1, AGG4, WIN1: a whole run with a model that fails on every fifth page."""
    image = F.concat(F.when(F.col("turn") % 5 == 3, "bad ").otherwise("page "), F.col("turn").cast("string"))
    p = read(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("doc_id"), F.col("turn").alias("page"), image.alias("image"))
    done = pages.parsed(models.answered(p, models.ModelSpec("fake pages", lambda name: models.FakePageModel())))
    return pages.rollup(done).select("doc_id", "block_count", "parsed_page_count", "success")


@query("SELECT doc_id, doc_id || ' Text' AS label, n_chars::DOUBLE AS x1 FROM documents WHERE doc_id % 3 <> 1")
def layout_overlay(spark, sf):
    """SNK6: blocks without a box are not drawn; every third one has none."""
    d = read(spark, sf, "documents")
    box = F.when(F.col("doc_id") % 3 != 1, F.array(F.lit(0.0), F.lit(0.0), F.col("n_chars").cast("double"), F.lit(9.0)))
    b = layout.overlay(d.select("doc_id", F.col("doc_id").alias("index"), F.lit("Text").alias("category"), box.alias("bbox")))
    return b.select("doc_id", "label", F.element_at("bbox", 3).alias("x1"))


@query("SELECT source AS doc_id, max(n_chars) AS width, sum(n_chars)::BIGINT AS height FROM documents GROUP BY source")
def canvas_size(spark, sf):
    """AGG12."""
    d = read(spark, sf, "documents")
    return layout.canvas(d.select(F.col("source").alias("doc_id"), F.col("n_chars").alias("width"), F.col("n_chars").alias("height")))


