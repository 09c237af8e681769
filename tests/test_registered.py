"""Functions in SQL give what the DataFrame forms give."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import registered
from tessera.functions.answers import parse_answers
from tessera.operators import consistency

ANSWERS = [
    (1, 'Found: [{"category": "Title", "bbox": [1, 2, 3, "4"], "text": "a"}, {"category": "Text", "text": 7}, 5]'), (2, "nothing"), (3, None), (4, '{"layout": [{"category": ""}]}'),
    (5, '```json\n[{"text": "one"}]\n``` and [{"text": "two"}]'), (6, '[{"category": "Table", "text": "cut'), (7, '[{"category": "A", "text": "x"}, {"cat'),
]


@pytest.fixture(scope="module")
def answers(spark):
    registered.register(spark)
    df = spark.createDataFrame(ANSWERS, "id int, answer string")
    df.createOrReplaceTempView("test_answers")
    return df


def test_answers_to_rows(spark, answers):
    got = spark.sql("SELECT a.id, b.* FROM test_answers a, LATERAL answer_blocks(a.answer) b")
    assert got.columns == ["id", "index", "category", "bbox", "text"]
    want = answers.select("id", F.posexplode(parse_answers("answer")).alias("pos", "x")).select("id", F.col("pos") + 1, "x.category", "x.bbox", "x.text")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_columns_are_planned(spark, answers):
    got = spark.sql("SELECT a.id, b.* FROM test_answers a, LATERAL answer_blocks(a.answer, 'text, index') b WHERE id = 1 ORDER BY index")
    assert got.columns == ["id", "text", "index"] and [tuple(r) for r in got.collect()] == [(1, "a", 1), (1, "7", 2)]
    assert spark.sql("SELECT * FROM answer_blocks(CAST(NULL AS STRING))").count() == 0
    for bad, message in (("'colour'", "not colour"), ("'text, text'", "once"), ("3", "constant text")):
        with pytest.raises(Exception, match=message):
            spark.sql(f"SELECT b.* FROM test_answers a, LATERAL answer_blocks(a.answer, {bad}) b").schema  # noqa: B018
    with pytest.raises(Exception, match="takes a text"):
        spark.sql("SELECT * FROM answer_blocks(5)").schema  # noqa: B018


def test_best_of_a_softmax(spark):
    registered.register(spark)
    rows = [("a", 1, 0.5), ("a", 2, 0.9), ("a", 0, 0.9), ("b", 3, None), ("b", 4, 0.1), ("c", 9, None), ("d", 5, -1.0)]
    df = spark.createDataFrame(rows, "image_id string, pos long, c double")
    df.createOrReplaceTempView("test_scores")
    got = {r.image_id: (r.pos, r.score) for r in spark.sql("SELECT image_id, softmax_best(c, pos) AS pos, softmax_score(c) AS score FROM test_scores GROUP BY image_id").collect()}
    scored = df.withColumn("consistency_score", F.bround(consistency.softmax(F.col("c"), ["image_id"]), 6))
    want = {r.image_id: (r.pos, r.consistency_score) for r in consistency.best_match(scored).collect()}
    assert got == {**want, "c": (None, None)} and got["a"] == (0, 0.5)
