"""Named queries over the standard tables, one per operator.

The ``lang`` column of ``documents`` stands for the source and ``doc_id`` for
the order of arrival.  Token arrays are shown as comma-joined text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.bpe import bpe_decoder, bpe_encoder, byte_decode
from corpusmill.functions.text import FIRST_MERGE_ID, byte_ids, byte_tokens, is_non_empty
from corpusmill.operators import batches, dedup, evaluate, metrics, mix, sampling, shards, vocab
from corpusmill.operators.packing import token_offsets as offsets_of
from corpusmill.plans import corpus
from corpusmill.session import freed_shuffles, materialize, remove_table, scratch_path, spread
from corpusmill.sources import registry, token_shards, vocab_io
from corpusmill.streaming import dedup as stream_dedup_ops
from corpusmill.streaming import metrics as stream_metrics_ops
from corpusmill.streaming import pack as stream_pack_ops
from corpusmill.streaming import scan as stream_scan_ops
from corpusmill.streaming.files import part_of, write_arrivals

SOURCES = ("en", "fr", "de", "es")
WEIGHTS = {"en": 0.60, "fr": 0.20, "de": 0.10, "es": 0.10}
MIX_WEIGHTS = {**WEIGHTS, "it": 0.25}  # a configured source without shards
PACK_BLOCK = 2048
FEED_BLOCK = 512
DEDUP_BLOCK = 64
SHARD_TOKENS = 100_000
CAP_TOKENS = 300_001
SAMPLE_BYTES = 1_000_000
TAKE_DOCS = 50
EVAL_PER_MILLE = 100
EVAL_SHARD_TOKENS = 20_000
EVAL_BATCHES = 30
COVERAGE = 0.9999
VOCAB_SIZE = 2000  # the reference trains 32,000 pieces
BEST_PAIRS = 1000  # a report of the top
EPOCH, SEED = 1, 7
SEQ_LEN, MICRO_BATCH = 128, 4
SMOOTHING = 0.5
MIN_SHINGLES = 10  # lsh_bands leaves poorer blocks out
GRAD_ACCUM, LOG_EVERY, TOKENS_PER_STEP = 4, 10, 4096
ARRIVALS = 5  # micro-batches of a streaming query
LATE_EVERY, WINDOW_WIDTH, WINDOW_DELAY = 97, "1 day", "12 hours"
RUN_TOKENS, STEP_TOKENS = 2_000_000, SEQ_LEN * MICRO_BATCH * 2  # two micro-batches a step


def _sources(sf_dir: str) -> dict[str, registry.SourceSpec]:
    path = f"{sf_dir}/documents.parquet"
    return {name: registry.SourceSpec(path, subset=f"lang = '{name}'") for name in SOURCES}


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return rows.select(F.col("lang").alias("source"), "doc_id", "text").where(is_non_empty(F.col("text")))


def _joined(column: str) -> Column:
    return F.array_join(column, ",").alias(column)


# --- sources ----------------------------------------------------------------


def scan_source(spark, sf_dir):
    return registry.scan_source(spark, _sources(sf_dir), "en")


def scan_json(spark, sf_dir):
    """JSON files without an integer id: documents are numbered as they lie there."""
    path = scratch_path(spark, "json-source")
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id")
    rows.select(F.concat(F.lit("d"), "doc_id").alias("id"), F.col("text").alias("body"), "lang").write.json(path)
    spec = registry.SourceSpec(path, "json", "body", "id", "lang <> 'de'", "id string, body string, lang string")
    return registry.scan_source(spark, {"web": spec}, "web")


def corpus_text(spark, sf_dir):
    """Text files of one record per document, read back as lines: a record of several lines counts for each."""
    path = scratch_path(spark, "corpus-text")
    registry.write_corpus_text(_docs(spark, sf_dir), path)
    return spark.read.text(path).groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


def union_sources(spark, sf_dir):
    return registry.union_sources(spark, _sources(sf_dir), SOURCES)


def non_empty_text(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "text")
    )
    return lines.where(is_non_empty(F.col("text")))


def take_docs(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return registry.take_docs(rows.select(F.col("lang").alias("source"), "doc_id", "text"), TAKE_DOCS)


def split_train_eval(spark, sf_dir):
    return registry.split_train_eval(_docs(spark, sf_dir), EVAL_PER_MILLE).select("source", "doc_id", "split")


def tokenizer_sample(spark, sf_dir):
    return sampling.byte_budget_prefix(_docs(spark, sf_dir), WEIGHTS, SAMPLE_BYTES)


# --- tokens and blocks ------------------------------------------------------


def byte_tokens_query(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", byte_tokens(F.col("text")).alias("tokens")).select("doc_id", _joined("tokens"))


def decode_tokens(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", byte_decode(byte_tokens(F.col("text"))).alias("text"))


def token_offsets(spark, sf_dir):
    docs = _docs(spark, sf_dir).select("source", "doc_id", F.octet_length("text").alias("n_tokens"))
    return offsets_of(docs).select("source", "doc_id", "n_tokens", "start")


def pack_blocks(spark, sf_dir):
    return corpus.byte_blocks(_docs(spark, sf_dir), PACK_BLOCK).select("source", "block_id", _joined("tokens"))


def cap_tokens(spark, sf_dir):
    blocks = corpus.byte_blocks(_docs(spark, sf_dir), FEED_BLOCK, max_tokens=CAP_TOKENS)
    return blocks.select("source", "block_id", _joined("tokens"))


def chop_blocks(spark, sf_dir):
    arrays = _docs(spark, sf_dir).select("doc_id", byte_tokens(F.col("text")).alias("tokens"))
    return shards.chop_blocks(arrays, FEED_BLOCK).select("doc_id", "block_in_shard", _joined("tokens"))


def _shards(spark, sf_dir, block=FEED_BLOCK, cap=None, as_bytes=False) -> DataFrame:
    return corpus.tokenize_to_shards(_docs(spark, sf_dir), block, SHARD_TOKENS, cap, as_bytes=as_bytes)


def shard_index(spark, sf_dir):
    return _shards(spark, sf_dir).select("source", "block_id", "shard_id", "block_in_shard")


def block_keys(spark, sf_dir):
    key = shards.block_key(F.col("source"), F.col("split"), F.col("shard_id"), F.col("block_in_shard"))
    return _shards(spark, sf_dir).select("source", "block_id", key.alias("key"))


def tokenize_to_shards(spark, sf_dir):
    return _shards(spark, sf_dir).drop("block_id").withColumn("tokens", F.array_join("tokens", ","))


def shard_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "shards")
    token_shards.write_token_shards(_shards(spark, sf_dir, as_bytes=True), path, byte_ids)
    return token_shards.read_token_shards(spark, path, FEED_BLOCK).select(
        "source", "split", "shard_id", "block_in_shard", _joined("tokens")
    )


def shard_manifest(spark, sf_dir):
    path = scratch_path(spark, "shards")
    token_shards.write_token_shards(_shards(spark, sf_dir, as_bytes=True), path, byte_ids)
    return token_shards.list_shards(spark, path).select("source", "split", "shard_id", "n_tokens")


# --- mixing and the training feed -------------------------------------------


def _shard_table(spark, sf_dir) -> DataFrame:
    docs = _docs(spark, sf_dir).select("source", F.octet_length("text").alias("n_tokens"))
    return shards.shard_counts(docs, FEED_BLOCK, SHARD_TOKENS)


def shard_report(spark, sf_dir):
    return shards.shard_report(_shard_table(spark, sf_dir))


def weighted_mix(spark, sf_dir):
    return mix.weighted_mix(_shard_table(spark, sf_dir), MIX_WEIGHTS).select("source", "shard_id", "copy", "n_tokens")


def missing_sources(spark, sf_dir):
    return mix.missing_sources(_shard_table(spark, sf_dir), MIX_WEIGHTS)


def mix_report(spark, sf_dir):
    report = mix.mix_report(_shard_table(spark, sf_dir), MIX_WEIGHTS)
    for share in ("share_shards", "share_tokens"):
        report = report.withColumn(share, F.round(share, 9))
    return report


def budget_report(spark, sf_dir):
    return mix.budget_report(_shard_table(spark, sf_dir), MIX_WEIGHTS, RUN_TOKENS, STEP_TOKENS)


def _epoch(spark, sf_dir) -> DataFrame:
    return batches.epoch_order(mix.weighted_mix(_shard_table(spark, sf_dir), MIX_WEIGHTS), EPOCH, SEED)


def epoch_order(spark, sf_dir):
    return _epoch(spark, sf_dir)


def next_token_labels(spark, sf_dir):
    docs = _docs(spark, sf_dir).withColumn("n_tokens", F.octet_length("text"))
    rows = batches.next_token_labels(docs, FEED_BLOCK, byte_tokens(F.col("text")))
    return rows.select("source", "block_id", _joined("input_ids"), _joined("labels"))


def batch_windows(spark, sf_dir):
    # the texts' shuffle files go as soon as the blocks are written
    with freed_shuffles(spark):
        blocks = materialize(_shards(spark, sf_dir, as_bytes=True), "blocks", codec="zstd")
    rows = batches.batch_windows(blocks, _epoch(spark, sf_dir), FEED_BLOCK, SEQ_LEN, MICRO_BATCH, byte_ids)
    return rows.select("batch_id", "row", _joined("input_ids"), _joined("labels"))


# --- near duplicates --------------------------------------------------------


def _ordered_blocks(spark, sf_dir) -> DataFrame:
    """Blocks with their place; tokens are bytes, and ids are made where they are worked on."""
    blocks = corpus.byte_blocks(_docs(spark, sf_dir), DEDUP_BLOCK, as_bytes=True)
    return blocks.withColumn("ord", dedup.block_order(list(SOURCES), F.col("source"), F.col("block_id")))


def _dedup_blocks(spark, sf_dir) -> DataFrame:
    """As :func:`_ordered_blocks`, written once."""
    return spread(materialize(_ordered_blocks(spark, sf_dir), "dedup-blocks"), "ord")


def _with_ids(blocks: DataFrame) -> DataFrame:
    return blocks.withColumn("tokens", byte_ids(F.col("tokens")))


def _sketches_of(blocks: DataFrame) -> DataFrame:
    return dedup.sketch_blocks(_with_ids(blocks))


def _sketches(spark, sf_dir) -> DataFrame:
    return _sketches_of(_dedup_blocks(spark, sf_dir))


def shingle_counts(spark, sf_dir):
    return _sketches(spark, sf_dir).select("source", "block_id", "n_shingles")


def minhash_signature(spark, sf_dir):
    # read once, so the blocks need not be written: they are sketched in the tasks that cut them
    return _sketches_of(_ordered_blocks(spark, sf_dir)).select("source", "block_id", _joined("signature"))


def lsh_bands(spark, sf_dir):
    return dedup.lsh_bands(dedup.block_bands(_sketches(spark, sf_dir), MIN_SHINGLES)).select("band", "n_blocks", "first_ord")


def dedup_flags(spark, sf_dir):
    return dedup.dedup_flags(_sketches(spark, sf_dir))


def dedup_report(spark, sf_dir):
    blocks = _dedup_blocks(spark, sf_dir)
    report = dedup.dedup_report(blocks, dedup.dedup_flags(_sketches_of(blocks)))
    return report.withColumn("rate", F.round("rate", 9))


def drop_flagged(spark, sf_dir):
    blocks = _dedup_blocks(spark, sf_dir)
    kept = dedup.drop_flagged(blocks, dedup.dedup_flags(_sketches_of(blocks)))
    return _with_ids(kept).select("source", "block_id", _joined("tokens"))


def match_jaccard(spark, sf_dir):
    blocks = _dedup_blocks(spark, sf_dir)
    pairs = dedup.match_jaccard(blocks, dedup.dedup_flags(_sketches_of(blocks)), decode=byte_ids)
    return pairs.withColumn("jaccard", F.round("jaccard", 9))


def duplicate_keys(spark, sf_dir):
    """Sorted keys of duplicate blocks, found in stored shards."""
    path = scratch_path(spark, "dedup-shards")
    token_shards.write_token_shards(_shards(spark, sf_dir, DEDUP_BLOCK, as_bytes=True), path, byte_ids)
    stored = token_shards.read_token_shards(spark, path, DEDUP_BLOCK)
    # the shards are on disk already: they are read again, not written a second time
    blocks = dedup.stored_blocks(stored, token_shards.list_shards(spark, path))
    flags = dedup.dedup_flags(dedup.sketch_blocks(blocks.select("ord", "tokens")))
    keys = scratch_path(spark, "duplicate-keys")
    dedup.write_duplicate_keys(dedup.duplicate_keys(blocks, flags), keys)
    return spark.read.text(keys).withColumnRenamed("value", "key")


# --- vocabulary -------------------------------------------------------------


def word_counts(spark, sf_dir):
    return vocab.word_counts(spread(_docs(spark, sf_dir), "doc_id"))


def char_coverage(spark, sf_dir):
    return vocab.char_coverage(vocab.char_counts(spread(_docs(spark, sf_dir), "doc_id")), COVERAGE)


def pair_counts(spark, sf_dir):
    chunks = materialize(vocab.chunk_counts(spread(_docs(spark, sf_dir), "doc_id")), "chunk-counts")
    chars = vocab.covered_of(vocab.chunk_chars(chunks), COVERAGE, vocab.MAX_TOKEN_ID)
    return vocab.pair_counts(vocab.covered_words(vocab.chunk_words(chunks), chars))


def best_pairs(spark, sf_dir):
    """The most frequent pairs in the order in which they would be merged."""
    return vocab.best_pairs(pair_counts(spark, sf_dir), BEST_PAIRS)


def _vocabulary(spark, sf_dir) -> DataFrame:
    return vocab.train_vocab(spread(_docs(spark, sf_dir), "doc_id"), VOCAB_SIZE, COVERAGE)


def train_bpe(spark, sf_dir):
    return _vocabulary(spark, sf_dir).where("kind = 'merge'").select((F.col("id") - FIRST_MERGE_ID).alias("rank"), "piece")


def vocab_table(spark, sf_dir):
    return _vocabulary(spark, sf_dir)


def vocab_file(spark, sf_dir):
    path = scratch_path(spark, "vocab")
    vocab_io.write_vocab(_vocabulary(spark, sf_dir), path)
    return vocab_io.read_vocab(spark, path)


def bpe_encode(spark, sf_dir):
    tokens = corpus.encode_table(_docs(spark, sf_dir), bpe_encoder(_vocabulary(spark, sf_dir)))
    return tokens.select("source", "doc_id", "n_tokens", _joined("tokens"))


def bpe_blocks(spark, sf_dir):
    encoder = bpe_encoder(_vocabulary(spark, sf_dir))
    blocks = corpus.tokenize_to_shards(_docs(spark, sf_dir), FEED_BLOCK, SHARD_TOKENS, encoder=encoder)
    return blocks.drop("block_id").withColumn("tokens", F.array_join("tokens", ","))


def bpe_roundtrip(spark, sf_dir):
    table = _vocabulary(spark, sf_dir)
    tokens = corpus.encode_table(_docs(spark, sf_dir), bpe_encoder(table))
    return tokens.select("doc_id", bpe_decoder(table)(F.col("tokens")).alias("text"))


def tokenizer_stats(spark, sf_dir):
    ids = byte_tokens(F.col("text"))
    texts = _docs(spark, sf_dir).select("source", "text", F.size(ids).alias("n"), byte_decode(ids).alias("decoded"))
    return texts.groupBy("source").agg(
        F.count("*").alias("n_texts"),
        F.sum((F.col("text") == F.col("decoded")).cast("bigint")).alias("n_equal"),
        F.sum("n").cast("bigint").alias("n_tokens"),
        F.sum(F.octet_length("text")).cast("bigint").alias("n_bytes"),
    )


# --- evaluation and metrics -------------------------------------------------


def _split_blocks(spark, sf_dir, split) -> DataFrame:
    docs = registry.split_train_eval(_docs(spark, sf_dir), EVAL_PER_MILLE).where(F.col("split") == split)
    return shards.shard_index(corpus.byte_blocks(docs, SEQ_LEN), SEQ_LEN, EVAL_SHARD_TOKENS)


def eval_limit(spark, sf_dir):
    rows = evaluate.eval_limit(_split_blocks(spark, sf_dir, "eval"), EVAL_BATCHES)
    return rows.select("source", "shard_id", "block_id")


def bigram_perplexity(spark, sf_dir):
    # read twice below: as pairs and as totals of their first token
    train = materialize(evaluate.bigram_counts(_split_blocks(spark, sf_dir, "train")), "bigram-counts")
    rows = _split_blocks(spark, sf_dir, "eval")
    scores = evaluate.bigram_scores(train, evaluate.bigram_counts(rows, ["source"]), FIRST_MERGE_ID, SMOOTHING)
    return evaluate.perplexity(scores, ["source"]).select(
        "source", F.round("total_nll", 4).alias("total_nll"), "n_tokens", F.round("perplexity", 6).alias("perplexity")
    )


def perplexity(spark, sf_dir):
    scores = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_type", (F.col("value") / 100).alias("nll"), F.lit(1).cast("bigint").alias("n")
    )
    return evaluate.perplexity(scores, ["event_type"]).select(
        "event_type", "n_tokens", F.round("perplexity", 6).alias("perplexity")
    )


def eval_report(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("source").alias("task"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = docs.join(labels, "doc_id", "left").groupBy("task")
    # a metric is missing only where nothing is scored
    results = scored.agg(
        F.round(F.avg("quality"), 6).alias("acc"),
        F.round(F.avg(1 - F.col("toxic")), 6).alias("acc_norm"),
    ).unpivot("task", ["acc", "acc_norm"], "metric", "value")
    return evaluate.eval_report(results)


def quality_filter(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "n_chars")
    return registry.quality_filter(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), 1)


def _micro_steps(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("event_id").alias("micro_step"),
        (F.col("value") / 100).alias("loss"),
        "ts",
        (F.col("user_id") / 1e6).alias("lr"),
    )


def _shown_metrics(rows: DataFrame, *names: str) -> DataFrame:
    for name in names:
        rows = rows.withColumn(name, F.round(name, 6))
    return rows.withColumn("loss", F.round("loss", 9))


def metrics_rollup(spark, sf_dir):
    micro = _micro_steps(spark.read.parquet(f"{sf_dir}/events.parquet"))
    rows = metrics.metrics_rollup(metrics.step_losses(micro, GRAD_ACCUM), LOG_EVERY, TOKENS_PER_STEP)
    return _shown_metrics(rows, "ppl", "tok_per_sec")


# --- streaming --------------------------------------------------------------


def _document_stream(spark, sf_dir, root) -> DataFrame:
    """Documents in order of id as several arrivals, each a micro-batch."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    files = write_arrivals(rows, f"{root}/arrivals", part_of(rows, "doc_id", ARRIVALS), ARRIVALS)
    spec = registry.SourceSpec(f"{root}/arrivals", schema="doc_id bigint, text string, lang string")
    return stream_scan_ops.stream_source(spark, spec, source_field="lang", max_files=files)


def stream_scan(spark, sf_dir):
    root = scratch_path(spark, "stream-scan")
    stream = _document_stream(spark, sf_dir, root)
    sink = stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/log")
    sink.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/out")


def _packed_stream(spark, sf_dir, max_tokens=None):
    root = scratch_path(spark, "stream-pack")
    handler = stream_pack_ops.PackStream(
        root, FEED_BLOCK, encode=lambda text: F.encode(text, "UTF-8"), max_tokens=max_tokens, sources=SOURCES, decode=byte_ids
    )
    stream_scan_ops.run_to_end(_document_stream(spark, sf_dir, root), handler, f"{root}/log")
    return spark.read.parquet(f"{root}/blocks").select("source", "block_id", _joined("tokens"))


def stream_pack(spark, sf_dir):
    return _packed_stream(spark, sf_dir)


def stream_cap(spark, sf_dir):
    return _packed_stream(spark, sf_dir, CAP_TOKENS)


def stream_dedup(spark, sf_dir):
    root = scratch_path(spark, "stream-dedup")
    table = scratch_path(spark, "dedup-blocks")
    with freed_shuffles(spark):
        _ordered_blocks(spark, sf_dir).select("ord", "tokens").write.option("compression", "zstd").parquet(table)
        blocks = spread(spark.read.parquet(table), "ord")
        files = write_arrivals(blocks, f"{root}/arrivals", part_of(blocks, "ord", ARRIVALS), ARRIVALS)
    remove_table(spark, table)  # all of it lies among the arrivals
    stream = spark.readStream.schema("ord bigint, tokens binary").option("maxFilesPerTrigger", files).parquet(f"{root}/arrivals")
    handler = stream_dedup_ops.DedupStream(root, decode=byte_ids)
    stream_scan_ops.run_batches(stream, handler, f"{root}/log").awaitTermination()
    return spark.read.schema(stream_dedup_ops.FLAGS).parquet(f"{root}/flags/*")


def stream_windows(spark, sf_dir):
    """Mean loss per day of event time; every 97th event arrives late by half of the run."""
    root = scratch_path(spark, "stream-windows")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    n = events.count()
    steps = _micro_steps(events).withColumn("ts", F.col("ts").cast("timestamp"))
    arrival = F.col("micro_step") + F.when(F.col("micro_step") % LATE_EVERY == 5, n // 2).otherwise(0)
    part = F.least(F.lit(ARRIVALS - 1), F.floor(arrival * ARRIVALS / max(n, 1))).cast("int")
    files = write_arrivals(steps, f"{root}/arrivals", part, ARRIVALS)
    stream = spark.readStream.schema(steps.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/arrivals")
    windows = stream_metrics_ops.windowed_metrics(stream, WINDOW_WIDTH, WINDOW_DELAY)
    sink = windows.writeStream.outputMode("append").format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/log")
    sink.trigger(availableNow=True).start().awaitTermination()
    closed = spark.read.schema("window_start timestamp, n_steps bigint, loss double, ppl double").parquet(f"{root}/out")
    return _shown_metrics(closed.withColumn("window_start", F.unix_seconds("window_start")), "ppl")


def stream_metrics(spark, sf_dir):
    root = scratch_path(spark, "stream-metrics")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    stream = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events*.parquet")
    steps = _micro_steps(stream).withColumn("step", F.col("micro_step") + 1)
    live = stream_metrics_ops.live_metrics(steps, LOG_EVERY, TOKENS_PER_STEP)

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/rows/batch_id={batch_id}")

    writer = live.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{root}/log")
    writer.trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(f"{root}/rows").groupBy("step").agg(F.max_by(F.struct("n_steps", "loss", "ppl", "tokens_seen"), "batch_id").alias("r"))
    return _shown_metrics(rows.select("step", "r.*"), "ppl")


QUERIES = {
    "scan_source": scan_source,
    "scan_json": scan_json,
    "corpus_text": corpus_text,
    "union_sources": union_sources,
    "non_empty_text": non_empty_text,
    "take_docs": take_docs,
    "split_train_eval": split_train_eval,
    "tokenizer_sample": tokenizer_sample,
    "byte_tokens": byte_tokens_query,
    "decode_tokens": decode_tokens,
    "token_offsets": token_offsets,
    "pack_blocks": pack_blocks,
    "cap_tokens": cap_tokens,
    "chop_blocks": chop_blocks,
    "shard_index": shard_index,
    "block_keys": block_keys,
    "tokenize_to_shards": tokenize_to_shards,
    "shard_roundtrip": shard_roundtrip,
    "shard_manifest": shard_manifest,
    "shard_report": shard_report,
    "weighted_mix": weighted_mix,
    "missing_sources": missing_sources,
    "mix_report": mix_report,
    "budget_report": budget_report,
    "epoch_order": epoch_order,
    "next_token_labels": next_token_labels,
    "batch_windows": batch_windows,
    "shingle_counts": shingle_counts,
    "minhash_signature": minhash_signature,
    "lsh_bands": lsh_bands,
    "dedup_flags": dedup_flags,
    "dedup_report": dedup_report,
    "drop_flagged": drop_flagged,
    "match_jaccard": match_jaccard,
    "duplicate_keys": duplicate_keys,
    "word_counts": word_counts,
    "char_coverage": char_coverage,
    "pair_counts": pair_counts,
    "best_pairs": best_pairs,
    "train_bpe": train_bpe,
    "vocab_table": vocab_table,
    "vocab_file": vocab_file,
    "bpe_encode": bpe_encode,
    "bpe_blocks": bpe_blocks,
    "bpe_roundtrip": bpe_roundtrip,
    "tokenizer_stats": tokenizer_stats,
    "eval_limit": eval_limit,
    "bigram_perplexity": bigram_perplexity,
    "perplexity": perplexity,
    "eval_report": eval_report,
    "metrics_rollup": metrics_rollup,
    "stream_scan": stream_scan,
    "stream_pack": stream_pack,
    "stream_cap": stream_cap,
    "quality_filter": quality_filter,
    "stream_dedup": stream_dedup,
    "stream_metrics": stream_metrics,
    "stream_windows": stream_windows,
}
