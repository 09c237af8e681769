"""Functions for SQL texts: the parse of answers, answers to block rows, and the best of a softmax (UDF1).

``parse_answer(text)``                      the items of an answer, as an array
``answer_blocks(text [, 'index, text'])``   a table function: a row for each item, with LATERAL; the
                                            columns are chosen by a constant, while the query is planned
``softmax_best(score, pos)``                the ``pos`` with the greatest rounded softmax, of equals the
                                            least; null where no score is a number
``softmax_score(score)``                    that softmax, to six places
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql.functions import pandas_udf, udtf
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from tessera.functions.answers import ITEM, _item, _parse, items
from tessera.operators.consistency import SCALE

COLUMNS = {"index": IntegerType(), "category": StringType(), "bbox": ArrayType(DoubleType()), "text": StringType()}


class AnswerBlocks:
    """Rows of the items of one answer, numbered from 1; an answer without items gives none."""

    @staticmethod
    def analyze(answer: AnalyzeArgument, columns: AnalyzeArgument | None = None) -> AnalyzeResult:
        if not isinstance(answer.dataType, StringType) and not answer.dataType.simpleString() == "void":
            raise ValueError("answer_blocks takes a text")
        if columns is not None and (not columns.isConstantExpression or not isinstance(columns.value, str)):
            raise ValueError("the columns of answer_blocks are a constant text")
        wanted = [c.strip() for c in columns.value.split(",")] if columns is not None else list(COLUMNS)
        if unknown := [c for c in wanted if c not in COLUMNS]:
            raise ValueError(f"answer_blocks has {', '.join(COLUMNS)}, not {', '.join(unknown)}")
        if len(set(wanted)) < len(wanted):
            raise ValueError("answer_blocks gives each column once")
        schema = StructType()
        for c in wanted:
            schema = schema.add(c, COLUMNS[c])
        return AnalyzeResult(schema)

    def __init__(self, planned: AnalyzeResult | None = None):
        self.names = [f.name for f in planned.schema.fields] if planned is not None else list(COLUMNS)

    def eval(self, answer: str, columns: str | None = None):
        for k, x in enumerate(items(answer)):
            item = _item(x) | {"index": k + 1}
            yield tuple(item[c] for c in self.names)


def _softmax(scores: pd.Series) -> np.ndarray:
    """Rounded to six places; null where the score is."""
    x = scores.to_numpy(np.float64, na_value=np.nan)
    if np.isnan(x).all():
        return x
    e = np.exp(SCALE * (x - np.nanmax(x)))
    return np.round(e / np.nansum(e), 6)


def _best(scores: pd.Series, pos: pd.Series) -> int:
    found = _softmax(scores)
    if np.isnan(found).all():
        return None
    at = pos.to_numpy()[found == np.nanmax(found)]
    return int(at.min())


def _score(scores: pd.Series) -> float:
    found = _softmax(scores)
    return None if np.isnan(found).all() else float(np.nanmax(found))


def register(spark: SparkSession) -> None:
    """Make the functions known to ``spark.sql``; the rest of the package are built-in expressions."""
    spark.udf.register("parse_answer", pandas_udf(_parse, ITEM))
    spark.udf.register("softmax_best", pandas_udf(_best, "long"))
    spark.udf.register("softmax_score", pandas_udf(_score, "double"))
    spark.udtf.register("answer_blocks", udtf(AnswerBlocks))
