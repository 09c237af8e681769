"""Pages of documents: selection, answers to blocks, numbering, failures and rollup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.answers import page_error, parse_answers
from tessera.functions.scalars import html_escape, strip
from tessera.operators import layout, scans


def page_list(spec: Column, pages: Column) -> Column:
    """The pages that a specification selects, ascending and once each; null where it is wrong.

    ``all``, ``*`` and nothing select every page; else numbers and ranges, by comma.  Wrong are
    other words, a range that runs back, pages outside the document, and a list without a page.
    Only ASCII digits count.
    """
    text = F.lower(strip(F.coalesce(spec, F.lit(""))))
    chunks = F.filter(F.transform(F.split(text, ","), strip), lambda c: c != "")
    number = lambda c, g: F.regexp_extract(c, r"^(\d{1,9})(?:-(\d{1,9}))?\z", g)
    first = lambda c: number(c, 1).cast("int")
    last = lambda c: F.coalesce(F.nullif(number(c, 2), F.lit("")), number(c, 1)).cast("int")
    good = F.forall(chunks, lambda c: c.rlike(r"^\d{1,9}(-\d{1,9})?\z") & F.coalesce((first(c) >= 1) & (first(c) <= last(c)) & (last(c) <= pages), F.lit(False)))
    listed = F.array_sort(F.array_distinct(F.flatten(F.transform(chunks, lambda c: F.sequence(first(c), last(c))))))
    every = F.when(pages >= 1, F.sequence(F.lit(1), pages)).otherwise(F.expr("cast(array() as array<int>)"))
    return F.when(text.isin("", "all", "*"), every).when(good & (F.size(chunks) > 0), listed)


def selected(docs: DataFrame, spec: str = "spec", pages: str = "pages") -> DataFrame:
    """A row for each selected page; filters before any page is made or read (STR3, SET1, SRT1)."""
    return docs.withColumn("page", F.explode(page_list(F.col(spec), F.col(pages))))


def parsed(answers: DataFrame, blank_page_ok: bool = False) -> DataFrame:
    """Answers (..., answer, error) to pages with status, error and blocks (JSN3, ERR1, ERR5).

    A page whose call failed, or whose answer has no items, is an error and has no blocks; the
    others are not touched by it.
    """
    items = answers.withColumn("items", parse_answers("answer"))
    empty = F.lit(False) if blank_page_ok else F.size("items") == 0
    error = F.when(F.col("error").isNotNull(), F.col("error")).when(empty, page_error(F.col("answer")))
    done = items.withColumn("error", error).withColumn("status", F.when(F.col("error").isNull(), "ok").otherwise("error"))
    none = F.filter(layout.blocks(F.col("items")), lambda b: F.lit(False))
    done = done.withColumn("blocks", F.when(F.col("status") == "ok", layout.blocks(F.col("items"))).otherwise(none))
    return done.withColumn("block_count", F.size("blocks")).drop("items")


def fail_fast(pages: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Pages up to and with the first that failed (WIN9, ERR3).

    The pages are written once; a document's first failure is a minimum that every task prepares, and
    the join with it is one that Spark splits, so no task holds a document.
    """
    pages = scans.kept(pages, "pages")
    first = pages.where(F.col("status") != "ok").groupBy(doc).agg(F.min("page").alias("_first")).withColumnRenamed(doc, "_doc")
    both = pages.join(first, F.col(doc).eqNullSafe(F.col("_doc")), "left")
    return both.where(F.col("_first").isNull() | (F.col("page") <= F.col("_first"))).drop("_first", "_doc")


def merged(pages: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Block rows of all good pages, numbered over the document (SET2, PRJ5, WIN1)."""
    rows = pages.where(F.col("status") == "ok").select(doc, "page", F.posexplode("blocks").alias("at", "b"))
    out = layout.numbered(rows, doc, "page", "at")
    return out.select(doc, "index", "page", "page_index", "b.category", "b.bbox", "b.text_format", "b.text")


def rollup(pages: DataFrame, doc: str = "doc_id") -> DataFrame:
    """A row for each document: failed pages in order, status, counts (AGG4, ERR2)."""
    failed = F.array_sort(F.collect_list(F.when(F.col("status") != "ok", F.col("page"))))
    out = pages.groupBy(doc).agg(failed.alias("failed_pages"), F.sum("block_count").alias("block_count"), F.count("*").alias("parsed_page_count"))
    ok = F.size("failed_pages") == 0
    return out.withColumn("status", F.when(ok, "ok").otherwise("partial")).withColumn("success", ok)


def exit_code(rolled: DataFrame) -> int:
    """0 where every document succeeded, else 1 (ERR2)."""
    return int(not rolled.where(~F.col("success")).isEmpty())


def page_section(page: Column, status: Column, error: Column, count: Column, body: Column) -> Column:
    """One page of a multi-page document: its marker, then its blocks or its error (STR8)."""
    plural = F.when(count == 1, F.lit("")).otherwise(F.lit("s"))
    n = page.cast("string")
    head = F.concat(F.lit('<section class="page" data-page="'), n, F.lit('">\n<div class="page-marker">PAGE '), n, F.lit(" · "), count.cast("string"), F.lit(" block"), plural, F.lit("</div>\n"))
    bad = F.concat(F.lit('<div class="page-error">'), html_escape(error), F.lit("</div>"))
    return F.concat(head, F.when(status == "ok", body).otherwise(bad), F.lit("\n</section>"))


def pages_to_html(pages: DataFrame, doc: str = "doc_id", model: str = "") -> DataFrame:
    """(doc, html): every page in order; failed ones show their error (STR8, FLT5)."""
    blocks = merged(pages, doc).select(doc, "page", "index", layout.block_to_html(F.col("index"), F.col("category"), F.col("text")).alias("html"))
    bodies = blocks.groupBy(doc, "page").agg(layout.in_order(["index"], "html").alias("body"))
    full = pages.join(bodies, [doc, "page"], "left")
    section = page_section(F.col("page"), F.col("status"), F.coalesce("error", F.lit("")), F.col("block_count"), F.coalesce("body", F.lit("")))
    out = full.select(doc, "page", section.alias("section")).groupBy(doc).agg(layout.in_order(["page"], "section").alias("body"), F.count("*").alias("n"))
    name = F.col(doc).cast("string")
    footer = F.concat(F.lit("parsed from <code>"), html_escape(name), F.lit("</code> ("), F.col("n").cast("string"), F.lit(" pages) with <code>"), html_escape(F.lit(model)), F.lit("</code>"))
    return out.select(doc, layout.standalone(name, F.col("body"), footer).alias("html"))
