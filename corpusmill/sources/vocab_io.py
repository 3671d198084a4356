"""Vocabulary files: tab-separated piece and score, one line per id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.text import CONTROL_PIECES, FIRST_BYTE_ID, FIRST_MERGE_ID


def write_vocab(vocab: DataFrame, path: str) -> None:
    """Write ``piece<TAB>score`` in id order.

    A vocabulary has at most 65,536 rows, so it goes into one file.
    """
    ordered = vocab.repartition(1).sortWithinPartitions("id")
    ordered.select(F.concat_ws("\t", "piece", F.col("score").cast("string")).alias("line")).write.text(path)


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """Read a piece file back; the id is the line number, from 0.

    The file is small by definition and read as one value, so line numbers do
    not depend on splits.
    """
    whole = spark.read.text(path, wholetext=True).where("value <> ''")
    lines = whole.select(F.posexplode(F.split(F.rtrim(F.col("value"), F.lit("\n")), "\n")).alias("id", "line"))
    # a piece may itself be a tab, so the score is what follows the last one
    parts = [F.regexp_extract("line", r"(?s)^(.*)\t(-?[0-9]+)$", group) for group in (1, 2)]
    n_control = len(CONTROL_PIECES)
    kind = (
        F.when(F.col("id") < n_control, "control")
        .when(F.col("id") < FIRST_BYTE_ID, "user")
        .when(F.col("id") < FIRST_MERGE_ID, "byte")
        .when(F.length("piece") > 1, "merge")
        .otherwise("char")
    )
    return lines.select("id", parts[0].alias("piece"), parts[1].cast("int").alias("score")).select("id", "piece", "score", kind.alias("kind"))
