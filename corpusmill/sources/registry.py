"""Named text sources: a registry entry says where a source lies and which
field holds its text.

Documents are ordered by an integer id.  A source whose id is no integer, or
that has none, is numbered by file and place in the file, counting all rows as
they lie there; the numbered rows are written once, so every reader sees the
same numbers.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from corpusmill.functions.text import is_non_empty
from corpusmill.operators.offsets import keep_heads, running_start
from corpusmill.session import materialize


@dataclass(frozen=True)
class SourceSpec:
    """A source: files of one format, optionally a subset of their rows; ``id_field`` may be None."""

    path: str
    format: str = "parquet"
    text_field: str = "text"
    id_field: str | None = "doc_id"
    subset: str | None = None
    schema: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)


def scan_source(spark: SparkSession, registry: Mapping[str, SourceSpec], name: str) -> DataFrame:
    """Rows (source, doc_id, text) of a named source; empty text is dropped."""
    return raw_source(spark, registry, name).where(is_non_empty(F.col("text")))


def number_rows(rows: DataFrame) -> DataFrame:
    """Add ``doc_id``: the row's number in order of file name and place in the file, from 0.

    ``rows`` come straight from files.  A split of a file is read by one task in
    order, so a row's number inside its split is known there; splits are put in
    order by name and start, one row for each.
    """
    read = rows.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_row"),
    )
    written = materialize(read, "numbered-rows")
    splits = written.groupBy("_file", "_split").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.orderBy("_file", "_split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("_file", "_split", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    placed = written.join(splits, ["_file", "_split"])
    return placed.withColumn("doc_id", F.col("_base") + F.col("_row") - F.col("_first")).select(*rows.columns, "doc_id")


def raw_source(spark: SparkSession, registry: Mapping[str, SourceSpec], name: str) -> DataFrame:
    if name not in registry:
        raise KeyError(f"unknown source {name!r}; known: {', '.join(sorted(registry))}")
    spec = registry[name]
    reader = spark.read.format(spec.format).options(**spec.options)
    rows = (reader.schema(spec.schema) if spec.schema else reader).load(spec.path)
    id_field = spec.id_field
    if id_field is None or not isinstance(rows.schema[id_field].dataType, IntegralType):
        wanted = {spec.text_field, *([] if spec.subset is None else rows.columns)}
        rows = number_rows(rows.select(*[F.col(c).alias("_own_id" if c == "doc_id" else c) for c in rows.columns if c in wanted]))
        id_field = "doc_id"
    if spec.subset:
        rows = rows.where(spec.subset)
    return rows.select(
        F.lit(name).alias("source"),
        F.col(id_field).cast("bigint").alias("doc_id"),
        F.col(spec.text_field).alias("text"),
    )


def union_sources(spark: SparkSession, registry: Mapping[str, SourceSpec], names: Iterable[str]) -> DataFrame:
    """All named sources in one frame."""
    return reduce(DataFrame.unionByName, [scan_source(spark, registry, name) for name in names])


def take_docs(docs: DataFrame, n: int) -> DataFrame:
    """The first ``n`` raw rows of each source by doc_id, then the non-empty ones.

    A row's place is a running count over key ranges, so one huge source does
    not end up in one sort; ranges after the n-th row are not read again.
    """
    heads = keep_heads(docs, "source", "doc_id", F.lit(1), n)
    placed = running_start(heads, ["source"], "doc_id", F.lit(1))
    return placed.where((F.col("start") < n) & is_non_empty(F.col("text"))).select("source", "doc_id", "text")


def split_bucket(doc_id: Column) -> Column:
    """A stable number 0..999 per document."""
    return F.conv(F.substring(F.md5(doc_id.cast("string")), 1, 8), 16, 10).cast("bigint") % 1000


def split_train_eval(docs: DataFrame, eval_per_mille: int) -> DataFrame:
    """Add ``split``: the same documents are held out on every run."""
    held_out = split_bucket(F.col("doc_id")) < eval_per_mille
    return docs.withColumn("split", F.when(held_out, "eval").otherwise("train"))


def write_corpus_text(docs: DataFrame, path: str) -> None:
    """Text files with one newline-ended record per document."""
    docs.select("text").write.text(path)


def quality_filter(docs: DataFrame, labels: DataFrame, threshold: int) -> DataFrame:
    """Documents whose label reaches the threshold, with it; documents without a label go.

    Of several labels of a document the highest counts, so no row is repeated.
    """
    good = labels.where(F.col("quality") >= threshold).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    return docs.join(good, "doc_id").select(*docs.columns, "quality")
