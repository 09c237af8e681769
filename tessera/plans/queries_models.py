"""Queries of model inference and sinks, with the deterministic fakes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.functions.answers import items
from tessera.functions.registered import register
from tessera.operators import asr, models, pages, sinks
from tessera.plans import programs
from tessera.plans.registry import query, read


@query("""
SELECT conv_id::VARCHAR || '.mp4' AS source, CASE WHEN conv_id % 3 = 0 THEN '' ELSE 'speech of ' || conv_id || '.mp4' END AS text,
       CASE WHEN conv_id % 3 = 0 THEN NULL ELSE 'fr' END AS language, CASE WHEN conv_id % 3 = 0 THEN 0 ELSE 1 END AS segments FROM conversations GROUP BY conv_id
""")
def transcribe_media(spark, sf):
    """MDL1, FLT1, PRJ4: every third medium is silent."""
    c = read(spark, sf, "conversations").select("conv_id").distinct()
    media = c.select(F.concat(F.col("conv_id").cast("string"), F.lit(".mp4")).alias("source"), F.lit(2.0).alias("duration_seconds"), F.when(F.col("conv_id") % 3 == 0, False).alias("audio_present"))
    out = asr.transcribed(media, "fake", models.transcriber(models.ModelSpec("fake speech", lambda name: models.FakeTranscriber()), "fr"))
    return out.select("source", "text", "language", F.size("segments").alias("segments"))


@query("SELECT item_id, 8 AS dims, 1.0::DOUBLE AS norm FROM benchmark")
def embed_texts(spark, sf):
    """MDL5, MDL6, WIN7, PRJ7."""
    e = models.embedded(read(spark, sf, "benchmark"), models.ModelSpec("fake encoder", lambda name: models.FakeEncoder()), "text")
    return e.select("item_id", F.size("embedding").alias("dims"), F.round(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")), 4).alias("norm"))


_VIDEOS = "WITH v AS (SELECT user_id::VARCHAR AS video, count(*) AS n FROM events GROUP BY user_id)"


def _videos(spark, sf):
    n = read(spark, sf, "events").groupBy("user_id").agg(F.count("*").cast("int").alias("frame_count"))
    return n.select(F.col("user_id").cast("string").alias("video"), F.lit(640).alias("width"), F.lit(480).alias("height"), F.lit(0.0).alias("fps"), "frame_count")


def _hands(spark, sf):
    return programs.estimate_hands(_videos(spark, sf), models.ModelSpec("fake tracker", lambda name: models.FakeTracker()), models.ModelSpec("fake pose", lambda name: models.FakePose()))


@query(_VIDEOS + "SELECT video, (n + 1) // 2 AS left_frames, n AS right_frames FROM v")
def track_hands(spark, sf):
    """MDL7, FLT2, FLT3, AGG5: the left hand is seen in even frames."""
    return _hands(spark, sf)[1]


@query(_VIDEOS + """
SELECT video, f::INTEGER AS frame_index, CASE WHEN f = n - 1 AND f % 2 = 1 THEN 1 ELSE 2 END AS hands, f % 2 = 1 AND f < n - 1 AS interpolated, f + 5.0::DOUBLE AS x, round(f / 30.0::DOUBLE, 6) AS t
FROM (SELECT video, n, unnest(generate_series(0, n - 1)) AS f FROM v)
""")
def pose_frames(spark, sf):
    """MDL8, WIN4 to WIN6, JOIN1, JOIN2, PRJ6: records of whole videos."""
    frames = _hands(spark, sf)[0]
    some = F.exists("hands", lambda h: h["bbox_interpolated"])
    return frames.select("video", "frame_index", F.size("hands").alias("hands"), some.alias("interpolated"), F.element_at("hands", -1)["keypoints_2d"][0][0].alias("x"), F.col("timestamp_seconds").alias("t"))


@query("SELECT item_id || '.txt' AS name, octet_length(encode(text)) AS bytes FROM benchmark")
def write_text_files(spark, sf):
    """SNK1 to SNK4, SNK10: a file for each row, staged by tasks and committed together."""
    rows = read(spark, sf, "benchmark").select(F.concat(F.col("item_id").cast("string"), F.lit(".txt")).alias("name"), F.col("text").alias("content"))
    return sinks.write_files(sinks.unique_names(rows, "name"), sinks.workspace(spark))


@query("""
SELECT conv_id::VARCHAR || '.json' AS name, count(*) AS turns, sum(length(text))::BIGINT AS chars, string_agg(role[1], '' ORDER BY turn) AS roles
FROM conversations GROUP BY conv_id
""")
def conversation_documents(spark, sf):
    """SNK1 to SNK3: an indented JSON document for each conversation, committed together, read from the files."""
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    rows = read(spark, sf, "conversations").groupBy("conv_id").agg(turns.alias("turns")).withColumn("name", F.concat(F.col("conv_id").cast("string"), F.lit(".json")))
    root = sinks.workspace(spark)
    sinks.write_json_documents(rows, root, "name", F.struct("conv_id", "turns"))
    told = F.from_json(F.col("content").cast("string"), "conv_id long, turns array<struct<turn: long, role: string, text: string>>")
    found = spark.read.format("binaryFile").load(f"{root}/*.json").select("path", told.alias("d"))
    chars = F.aggregate("d.turns", F.lit(0).cast("long"), lambda n, t: n + F.char_length(t["text"]))
    roles = F.array_join(F.transform("d.turns", lambda t: F.substring(t["role"], 1, 1)), "")
    return found.select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"), F.size("d.turns").cast("long").alias("turns"), chars.alias("chars"), roles.alias("roles"))


@query("""
SELECT doc_id, CASE WHEN text IS NULL THEN 0 ELSE 1 END AS blocks, CASE WHEN text IS NOT NULL THEN 'Title' END AS category,
       length(regexp_replace(text, '[^A-Za-z0-9 ]', '', 'g')) AS chars FROM documents
""")
def registered_function(spark, sf):
    """UDF1: the answer parse from SQL, on answers that are cut in their second object."""
    register(spark)
    read(spark, sf, "documents").createOrReplaceTempView("tessera_docs")
    answers = """SELECT doc_id, concat('Found: [{"category": "Title", "text": "', regexp_replace(text, '[^A-Za-z0-9 ]', ''), '"}, {"cat') AS answer FROM tessera_docs"""
    return spark.sql(f"SELECT doc_id, size(p) AS blocks, get(p, 0).category AS category, length(get(p, 0).text) AS chars FROM (SELECT doc_id, parse_answer(answer) AS p FROM ({answers}))")


@query("""
SELECT conv_id, turn, status FROM (
  SELECT conv_id::VARCHAR AS conv_id, turn, CASE WHEN turn % 4 IN (2, 3) THEN 'error' ELSE 'ok' END AS status,
         min(CASE WHEN turn % 4 IN (2, 3) THEN turn END) OVER (PARTITION BY conv_id) AS first FROM conversations)
WHERE first IS NULL OR turn <= first
""")
def stop_on_first_failure(spark, sf):
    """ERR3: no page behind the first that fails, by its call or by an answer without items, is asked."""
    k = F.col("turn") % 4
    image = F.concat(F.when(k == 3, "bad ").when(k == 2, "cites [1] ").otherwise("page "), F.col("turn").cast("string"))
    p = read(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("conv_id"), "turn", image.alias("image"))
    spec = models.ModelSpec("fake pages", lambda name: models.FakePageModel())
    asked = models.answered_until_failure(p.withColumnRenamed("turn", "page"), spec, lambda a: bool(items(a)), doc="conv_id")
    return pages.parsed(asked).select("conv_id", F.col("page").alias("turn"), "status")


@query("""
SELECT conv_id, turn, role, round(100.0 * length(text), 2)::DOUBLE AS x FROM conversations
""")
def zipped_pages(spark, sf):
    """JOIN4, MAP1, ARR1: pages and their images by position, then looked up by key."""
    c = read(spark, sf, "conversations")
    parts = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.length("text").alias("n")))).alias("m"))
    both = parts.select("conv_id", F.arrays_zip(F.transform("m", lambda x: x["turn"]).alias("turn"), F.transform("m", lambda x: x["role"]).alias("role")).alias("z"), F.map_from_entries(F.transform("m", lambda x: F.struct(x["turn"], x["n"]))).alias("sizes"))
    rows = both.select("conv_id", F.explode("z").alias("z"), "sizes").select("conv_id", "z.turn", "z.role", "sizes")
    return rows.select("conv_id", "turn", "role", F.round(F.try_element_at("sizes", F.col("turn")) * 100.0, 2).alias("x"))




@query("""
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn)::INTEGER AS index, role AS category, length(text)::INTEGER AS chars FROM conversations
""")
def answer_blocks_sql(spark, sf):
    """UDF1: answers to block rows by a table function in SQL; each conversation is an answer that ends in its last turn's text."""
    register(spark)
    read(spark, sf, "conversations").createOrReplaceTempView("tessera_turns")
    return spark.sql("""
        WITH a AS (SELECT conv_id, concat('The blocks: ', to_json(array_sort(collect_list(struct(turn, role AS category, text)))), ' and so on') AS answer FROM tessera_turns GROUP BY conv_id)
        SELECT a.conv_id, b.index, b.category, length(b.text) AS chars FROM a, LATERAL answer_blocks(a.answer, 'index, category, text') b
    """)


@query("""
WITH p AS (SELECT i.vec_id AS image_id, t.vec_id AS pos, list_cosine_similarity(i.embedding::double[], t.embedding::double[]) AS c
           FROM embeddings i JOIN embeddings t ON i.vec_id // 4 = t.vec_id // 4 AND i.vec_id % 4 = 0 AND t.vec_id % 4 <> 0),
x AS (SELECT *, exp(100.0 * (c - max(c) OVER (PARTITION BY image_id))) AS e FROM p), s AS (SELECT image_id, pos, round(e / sum(e) OVER (PARTITION BY image_id), 6) AS score FROM x)
SELECT image_id, arg_min(pos, (-score, pos)) AS pos, max(score) AS score FROM s GROUP BY image_id
""")
def softmax_best_sql(spark, sf):
    """UDF1, AGG8, AGG10: the best text of each image by grouped aggregates in SQL."""
    register(spark)
    e = read(spark, sf, "embeddings").withColumn("request", F.floor(F.col("vec_id") / 4))
    images = e.where("vec_id % 4 = 0").select("request", F.col("vec_id").alias("image_id"), F.col("embedding").alias("i"))
    texts = e.where("vec_id % 4 <> 0").select("request", F.col("vec_id").alias("pos"), F.col("embedding").alias("t"))
    images.join(texts, "request").select("image_id", "pos", S.cosine(F.col("i"), F.col("t")).alias("c")).createOrReplaceTempView("tessera_pairs")
    return spark.sql("SELECT image_id, softmax_best(c, pos) AS pos, softmax_score(c) AS score FROM tessera_pairs GROUP BY image_id")
