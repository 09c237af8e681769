"""Layout blocks: normalising items, counting categories, and HTML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalars import bbox, html_escape, strip, text_lines

# Fixed values that results must agree on.
CATEGORIES = ("Caption", "Footnote", "Formula", "List-item", "Page-footer", "Page-header", "Picture", "Section-header", "Table", "Text", "Title")
SMALL_PRINT = ("Caption", "Footnote", "Page-header", "Page-footer")

STYLE = "body{font-family:sans-serif;line-height:1.6;margin:32px} table{border-collapse:collapse} th,td{border:1px solid} .formula{white-space:pre-wrap} .block{margin-bottom:8px}"


def category(c: Column) -> Column:
    return F.coalesce(F.nullif(strip(c.cast("string")), F.lit("")), F.lit("Text"))


def text_format(c: Column) -> Column:
    return F.when(c == "Table", "html").when(c == "Formula", "latex").otherwise("markdown")


def blocks(items: Column) -> Column:
    """Items as numbered blocks; unknown categories pass, a missing box is null (PRJ1)."""
    return F.transform(
        items,
        lambda x, k: F.struct((k + 1).cast("int").alias("index"), category(x["category"]).alias("category"), bbox(x["bbox"]).alias("bbox"), text_format(category(x["category"])).alias("text_format"), F.coalesce(x["text"], F.lit("")).alias("text")),
    )


def category_counts(blocks_: DataFrame, *keys: str) -> DataFrame:
    """Blocks of each category (AGG1, AGG2), a row each; partial counts before the shuffle."""
    return blocks_.groupBy(*keys, "category").agg(F.count("*").alias("blocks"))


def markdown_to_html(text: Column) -> Column:
    """The Markdown that prose blocks have: paragraphs and bullets, else escaped text (STR5).

    One fold over the lines; its state is the HTML so far, the open paragraph and whether a list
    is open.
    """
    done = lambda s: F.when(s["p"] != "", F.concat(s["out"], F.array(F.concat(F.lit("<p>"), html_escape(s["p"]), F.lit("</p>"))))).otherwise(s["out"])
    closed = lambda s, out: F.when(s["list"], F.concat(out, F.array(F.lit("</ul>")))).otherwise(out)

    def step(s: Column, line: Column) -> Column:
        t = strip(line)
        bullet = t.startswith("- ") | t.startswith("* ")
        item = F.concat(F.lit("<li>"), html_escape(strip(F.substring(t, 3, 1 << 30))), F.lit("</li>"))
        opened = F.when(s["list"], done(s)).otherwise(F.concat(done(s), F.array(F.lit("<ul>"))))
        state = lambda out, p, is_list: F.struct(out.alias("out"), p.alias("p"), is_list.alias("list"))
        joined = F.when(s["p"] == "", t).otherwise(F.concat(s["p"], F.lit(" "), t))
        return (
            F.when(t == "", state(closed(s, done(s)), F.lit(""), F.lit(False)))
            .when(bullet, state(F.concat(opened, F.array(item)), F.lit(""), F.lit(True)))
            .otherwise(state(closed(s, s["out"]), joined, F.lit(False)))
        )

    start = F.struct(F.expr("cast(array() as array<string>)").alias("out"), F.lit("").alias("p"), F.lit(False).alias("list"))
    html = F.aggregate(text_lines(text), start, step, lambda s: F.array_join(closed(s, done(s)), "\n"))
    return F.coalesce(F.nullif(html, F.lit("")), F.lit("<p></p>"))


def block_to_html(index: Column, kind: Column, text: Column) -> Column:
    """The fragment of one block by its category, with its anchor (STR6)."""
    anchor = F.concat(F.lit('<span class="block-anchor">#'), index.cast("string"), F.lit(" "), html_escape(kind), F.lit("</span>"))
    safe = html_escape(text)
    wrap = lambda cls, *inner: F.concat(F.lit(f'<div class="block{cls}">'), anchor, *inner, F.lit("</div>"))
    table = F.when(F.lower(text).contains("<table"), text).otherwise(F.concat(F.lit("<p>"), safe, F.lit("</p>")))
    out = F.when(kind == "Table", wrap(" block-table", F.lit("\n"), table))
    out = out.when(kind == "Formula", wrap(" formula", F.lit("<code>"), safe, F.lit("</code>")))
    out = out.when(kind == "Title", wrap("", F.lit("<h1>"), safe, F.lit("</h1>")))
    out = out.when(kind == "Section-header", wrap("", F.lit("<h2>"), safe, F.lit("</h2>")))
    out = out.when(kind == "Picture", wrap(" picture", F.lit("<em>[figure]</em>")))
    for name in SMALL_PRINT:
        out = out.when(kind == name, wrap(f" {name.lower()}", F.lit("<p>"), safe, F.lit("</p>")))
    return out.otherwise(wrap("", F.lit("\n"), markdown_to_html(text)))


def standalone(title: Column, body: Column, footer: Column, style: str = STYLE) -> Column:
    """A whole HTML page around a body (STR7)."""
    return F.concat(
        F.lit('<!DOCTYPE html>\n<html lang="en">\n<head>\n<meta charset="utf-8">\n<title>'), html_escape(title), F.lit(f"</title>\n<style>{style}</style>\n</head>\n<body>\n"), body,
        F.lit('\n<hr>\n<p class="page-footer">'), footer, F.lit("</p>\n</body>\n</html>\n"),
    )


def in_order(order: list[str], value: str, glue: str = "\n") -> Column:
    """Texts of a group joined in the order of their keys, never in order of arrival (AGG9)."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, value))), lambda x: x[value]), glue)


def blocks_to_html(blocks_: DataFrame, doc: str = "doc_id", model: str = "") -> DataFrame:
    """(doc, html) from block rows (doc, index, category, text)."""
    parts = blocks_.select(doc, "index", block_to_html(F.col("index"), F.col("category"), F.col("text")).alias("html"))
    body = parts.groupBy(doc).agg(in_order(["index"], "html").alias("body"))
    name = F.col(doc).cast("string")
    footer = F.concat(F.lit("parsed from <code>"), html_escape(name), F.lit("</code> with <code>"), html_escape(F.lit(model)), F.lit("</code>"))
    return body.select(doc, standalone(name, F.col("body"), footer).alias("html"))


def overlay(blocks_: DataFrame) -> DataFrame:
    """What an overlay draws: the box and label of each block that has a box (SNK6)."""
    label = F.concat(F.col("index").cast("string"), F.lit(" "), F.col("category"))
    return blocks_.where(F.col("bbox").isNotNull()).select("*", label.alias("label"))


def canvas(pages: DataFrame, doc: str = "doc_id") -> DataFrame:
    """The sheet for pages under one another: greatest width, sum of heights (AGG12)."""
    return pages.groupBy(doc).agg(F.max("width").alias("width"), F.sum("height").alias("height"))


def numbered(blocks_: DataFrame, doc: str, page: str, position: str) -> DataFrame:
    """Blocks numbered over their document and in their page, from 1 (WIN1, WIN2, PRJ5).

    Both numbers come from one exchange by document.
    """
    whole = Window.partitionBy(doc).orderBy(page, position)
    inside = Window.partitionBy(doc, page).orderBy(position)
    return blocks_.withColumn("index", F.row_number().over(whole)).withColumn("page_index", F.row_number().over(inside))
