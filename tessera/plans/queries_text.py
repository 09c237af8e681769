"""Queries of identifiers, names and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.operators import asr, layout
from tessera.plans.registry import query, read
from tessera.sources import catalog


@query("""
WITH r AS (SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'owner' || page_id || '/data.set' WHEN 1 THEN 'https://huggingface.co/datasets/own/d' || page_id || '/tree/main'
  WHEN 2 THEN 'https://example.org/datasets/own/x' WHEN 3 THEN ' imdb' || page_id || ' ' WHEN 4 THEN 'https://WWW.huggingface.co/datasets/single?x=1' ELSE '-bad/name' END AS raw FROM pages)
SELECT page_id, CASE page_id % 6 WHEN 0 THEN raw WHEN 1 THEN 'own/d' || page_id WHEN 3 THEN trim(raw) WHEN 4 THEN 'single' END AS dataset,
  '/data/' || CASE page_id % 6 WHEN 0 THEN replace(raw, '/', '--') WHEN 1 THEN 'own--d' || page_id WHEN 3 THEN trim(raw) WHEN 4 THEN 'single' END AS local_dir FROM r
""")
def hub_id_parse(spark, sf):
    """SRC9, SRC11, STR1."""
    k, n = F.col("page_id") % 6, F.col("page_id").cast("string")
    raw = F.when(k == 0, F.concat(F.lit("owner"), n, F.lit("/data.set"))).when(k == 1, F.concat(F.lit("https://huggingface.co/datasets/own/d"), n, F.lit("/tree/main"))).when(k == 2, F.lit("https://example.org/datasets/own/x")).when(k == 3, F.concat(F.lit(" imdb"), n, F.lit(" "))).when(k == 4, F.lit("https://WWW.huggingface.co/datasets/single?x=1")).otherwise("-bad/name")
    return catalog.datasets(read(spark, sf, "pages").select("page_id", raw.alias("raw")), "/data").select("page_id", "dataset", "local_dir")


@query("""
SELECT doc_id, raw, regexp_full_match(raw, '[A-Za-z0-9_-]{11}') AS is_valid FROM (
  SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN left(md5(text), 11) WHEN 1 THEN left(md5(text), 10) || '_' WHEN 2 THEN left(md5(text), 12) ELSE text END AS raw FROM documents)
""")
def video_id_validate(spark, sf):
    """SRC6, STR2."""
    k, m = F.col("doc_id") % 4, F.md5(F.col("text").cast("binary"))
    raw = F.when(k == 0, F.left(m, F.lit(11))).when(k == 1, F.concat(F.left(m, F.lit(10)), F.lit("_"))).when(k == 2, F.left(m, F.lit(12))).otherwise(F.col("text"))
    return catalog.video_ids(read(spark, sf, "documents").select("doc_id", raw.alias("raw")))


@query("SELECT doc_id, " + "replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')" + " AS html FROM documents")
def html_escape(spark, sf):
    """STR4."""
    return read(spark, sf, "documents").select("doc_id", S.html_escape(F.col("text")).alias("html"))


@query("""
SELECT doc_id, '/m/clip.' || doc_id || '.asr.json' AS transcript, '/m/clip.' || doc_id || '.doc.html' AS page, 'page-' || lpad((doc_id % 10000)::VARCHAR, 4, '0') || '.png' AS image, lpad(doc_id::VARCHAR, 8, '0') || '.jpg' AS frame FROM documents
""")
def default_names(spark, sf):
    """SNK10, SRC20."""
    d = read(spark, sf, "documents").select("doc_id", F.concat(F.lit("/m/clip."), F.col("doc_id").cast("string"), F.lit(".mp4")).alias("path"))
    return d.select("doc_id", S.output_name(F.col("path"), ".asr.json").alias("transcript"), S.output_name(F.col("path"), ".doc.html").alias("page"), S.page_name(F.col("doc_id") % 10000).alias("image"), S.frame_name(F.col("doc_id")).alias("frame"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE round(value, 6) END AS score, round(event_id / 30.0::double, 6) AS t FROM events")
def score_rounding(spark, sf):
    """PRJ6, MTH7: NaN is null."""
    e = read(spark, sf, "events")
    v = F.when(F.col("event_id") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return e.select("event_id", S.null_nan(v, 6).alias("score"), S.timestamp_seconds(F.col("event_id"), F.lit(30.0)).alias("t"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'Text' ELSE source END AS category, CASE WHEN doc_id % 3 = 0 THEN 'markdown' WHEN source = 'src1' THEN 'markdown' ELSE 'markdown' END AS text_format FROM documents")
def block_categories(spark, sf):
    """PRJ1: blank categories are Text, unknown ones pass."""
    d = read(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.lit(" \t")).otherwise(F.col("source")).alias("c"))
    return d.select("doc_id", layout.category(F.col("c")).alias("category"), layout.text_format(layout.category(F.col("c"))).alias("text_format"))


@query("SELECT item_id, text, CAST(len(string_split(text, chr(10))) AS INTEGER) AS lines FROM benchmark")
def json_documents(spark, sf):
    """PRJ3, SNK1, MAP1: documents out to JSON and back in by a declared schema."""
    b = read(spark, sf, "benchmark").select("item_id", asr.json_text(F.struct("item_id", "text", F.split("text", "\n").alias("lines"))).alias("j"))
    back = F.from_json("j", "item_id long, text string, lines array<string>")
    return b.select(back.alias("d")).select("d.item_id", "d.text", F.size("d.lines").alias("lines"))


@query("SELECT user_id, count(*) AS events, sum(CASE WHEN regexp_matches(props, '\"k\": [0-9]+') THEN 1 ELSE 0 END)::BIGINT AS with_key FROM events GROUP BY user_id")
def dynamic_values(spark, sf):
    """PRJ3: values of unknown shape as variants."""
    e = read(spark, sf, "events").withColumn("v", F.try_variant_get(F.try_parse_json("props"), "$.k", "long"))
    return e.groupBy("user_id").agg(F.count("*").alias("events"), F.count("v").alias("with_key"))


