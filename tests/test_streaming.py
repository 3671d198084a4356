import datetime as dt
import random
from pathlib import Path

from pyspark.sql import functions as F

from corpusmill.functions.text import byte_ids
from corpusmill.operators import dedup
from corpusmill.operators.packing import capped_blocks
from corpusmill.plans.corpus import byte_blocks
from corpusmill.session import scratch_root
from corpusmill.sources.registry import SourceSpec
from corpusmill.streaming.dedup import FLAGS, DedupStream, merged_runs
from corpusmill.streaming.files import part_of, write_arrivals
from corpusmill.streaming.metrics import live_metrics, windowed_metrics
from corpusmill.streaming.pack import PackStream
from corpusmill.streaming.scan import run_batches, run_to_end, stream_source

SCHEMA = "source string, doc_id bigint, text string"


def arrivals(spark, rows, schema, folder, parts):
    """One file per part, in order of arrival."""
    size = -(-len(rows) // parts)
    for i in range(parts):
        part = rows[i * size : (i + 1) * size]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)


def documents():
    rng = random.Random(2)
    text = lambda: "".join(rng.choice("abc éx ") for _ in range(rng.randrange(0, 40)))
    # the second source is absent from the middle of the stream
    return [("b" if i % 3 == 0 and not 10 < i < 30 else "a", i, text()) for i in range(40)]


def test_stream_packing_equals_batch(spark, tmp_path):
    rows, folder = documents(), str(tmp_path / "in")
    arrivals(spark, rows, SCHEMA, folder, 4)
    spec = SourceSpec(folder, schema=SCHEMA)
    batch = byte_blocks(spark.createDataFrame(rows, SCHEMA), 16)
    root = str(tmp_path / "out")
    docs = stream_source(spark, spec, source_field="source", max_files=1)
    run_batches(docs, PackStream(root, 16, max_tokens=70), f"{root}/log").awaitTermination()
    expected = batch.where(F.col("block_id") < capped_blocks(70, 16))
    got = spark.read.parquet(f"{root}/blocks").select("source", "block_id", "tokens")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    # running a batch again changes nothing
    again = PackStream(str(tmp_path / "again"), 16)
    parts = [spark.createDataFrame([r for r in rows[i * 10 : (i + 1) * 10] if r[2]], SCHEMA) for i in range(4)]
    for i in (0, 1, 2, 2, 3):
        again(parts[i], i)
    got = spark.read.parquet(f"{again.root}/blocks").select("source", "block_id", "tokens")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_stream_dedup_equals_batch(spark, tmp_path):
    rng = random.Random(6)
    fresh = lambda: [rng.randrange(200) for _ in range(60)]
    blocks = []
    for i in range(36):
        kind = rng.random()
        if blocks and kind < 0.6:
            tokens = list(rng.choice(blocks)[1])
            if kind < 0.4:
                tokens[rng.randrange(60)] = rng.randrange(200)
        else:
            tokens = fresh()
        blocks.append((i, tokens))
    schema = "ord bigint, tokens array<int>"
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    arrivals(spark, blocks, schema, folder, 3)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    run_batches(stream, DedupStream(root), f"{root}/log").awaitTermination()
    got = {r["ord"] for r in spark.read.schema(FLAGS).parquet(f"{root}/flags/*").collect()}
    batch = dedup.dedup_flags(dedup.sketch_blocks(spark.createDataFrame(blocks, schema)))
    assert got == {r["ord"] for r in batch.collect()} and len(got) > 5


def test_live_metrics(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i + 1, 1.0 + i, t0 + dt.timedelta(seconds=i), 0.1) for i in range(25)]
    schema = "step bigint, loss double, ts timestamp, lr double"
    folder = str(tmp_path / "in")
    arrivals(spark, rows, schema, folder, 3)
    source = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)

    writer = live_metrics(source(), 10, 100).writeStream.outputMode("update").format("memory").queryName("live")
    writer.trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "a")).start().awaitTermination()
    final = {r["step"]: (r["n_steps"], r["loss"]) for r in spark.table("live").groupBy("step").agg(F.max(F.struct("n_steps", "loss")).alias("r")).select("step", "r.*").collect()}
    assert final == {10: (10, 5.5), 20: (10, 15.5), 30: (5, 23.0)}

    writer = windowed_metrics(source(), "5 seconds", "1 second").writeStream.outputMode("append").format("memory").queryName("windows")
    writer.trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "b")).start().awaitTermination()
    closed = {r["window_start"]: r["n_steps"] for r in spark.table("windows").collect()}
    assert closed and set(closed.values()) == {5}


def test_runs_are_joined_like_a_counter():
    runs, written = [], 0
    for batch_id in range(200):
        runs, joined = merged_runs(runs, batch_id)
        written += 1 + sum(last - first + 1 for first, last in joined)
        assert len(runs) <= batch_id.bit_length() + 1
        assert [i for first, last in runs for i in range(first, last + 1)] == list(range(batch_id + 1))
    assert written <= 200 * 9


def test_stream_dedup_state_is_small_and_repeatable(spark, tmp_path):
    """Eight batches, one of them run twice: as the batch result; runs that were joined are gone."""
    rng = random.Random(12)
    base = [[rng.randrange(200) for _ in range(60)] for _ in range(12)]
    blocks = [(i, list(rng.choice(base))) for i in range(40)]
    schema = "ord bigint, tokens array<int>"
    handler = DedupStream(str(tmp_path / "out"), buckets=4)
    for batch_id in (0, 1, 2, 3, 3, 4, 5, 6, 7):
        handler(spark.createDataFrame(blocks[batch_id * 5 : batch_id * 5 + 5], schema), batch_id)
        assert len(list((tmp_path / "out/kept").iterdir())) <= 5
    assert handler.runs_before(spark, 8) == [(0, 7)]
    got = {r["ord"] for r in spark.read.schema(FLAGS).parquet(f"{handler.root}/flags/*").collect()}
    assert got == {r["ord"] for r in dedup.dedup_flags(dedup.sketch_blocks(spark.createDataFrame(blocks, schema))).collect()}


def test_stream_ends_itself_at_the_cap(spark, tmp_path):
    """The second batch reaches the cap; of any later one no row is read."""
    rows, folder = [("a", i, "x" * 20) for i in range(40)], str(tmp_path / "in")
    arrivals(spark, rows, SCHEMA, folder, 8)
    root = str(tmp_path / "out")
    seen = []
    handler = PackStream(root, 16, max_tokens=100, sources=["a"])

    class Watched:
        finished = property(lambda self: handler.finished)

        def __call__(self, batch, batch_id):
            seen.append((batch_id, handler.finished))
            handler(batch, batch_id)

    docs = stream_source(spark, SourceSpec(folder, schema=SCHEMA), source_field="source", max_files=1)
    run_to_end(docs, Watched(), f"{root}/log")
    assert handler.finished and seen[0] == (0, False) and sum(not done for _, done in seen) == 2
    got = spark.read.parquet(f"{root}/blocks")
    assert got.count() == capped_blocks(100, 16)
    before = len(seen)
    handler(spark.createDataFrame(rows, SCHEMA).select("source", "doc_id", F.raise_error(F.lit("read")).alias("text")), before)
    assert spark.read.parquet(f"{root}/blocks").count() == capped_blocks(100, 16)


def test_stream_dedup_of_bytes_with_adaptive_rounds(spark, tmp_path):
    """blocks arrive as bytes, and the rounds run in the session that adapts its shuffles, not in the stream's."""
    rng = random.Random(7)
    base = [bytes(rng.randrange(97, 123) for _ in range(60)) for _ in range(6)]
    rows, schema = [(i, rng.choice(base)) for i in range(16)], "ord bigint, tokens binary"
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    arrivals(spark, rows, schema, folder, 2)
    handler, adaptive = DedupStream(root, decode=byte_ids), []

    def watched(batch, batch_id):
        adaptive.append(handler._bands(batch).sparkSession.conf.get("spark.sql.adaptive.enabled"))
        handler(batch, batch_id)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    run_batches(stream, watched, f"{root}/log").awaitTermination()
    assert adaptive == ["true", "true"]
    got = {r["ord"] for r in spark.read.schema(FLAGS).parquet(f"{root}/flags/*").collect()}
    assert got == {i for i, (_, tokens) in enumerate(rows) if tokens in [t for _, t in rows[:i]]}


def test_stream_packing_of_bytes_equals_batch(spark, tmp_path):
    """tokens are carried as bytes, in the tail too, and the next state reads only the documents behind the last block."""
    rows = documents()
    batch = byte_blocks(spark.createDataFrame(rows, SCHEMA), 16)
    handler = PackStream(str(tmp_path / "out"), 16, encode=lambda text: F.encode(text, "UTF-8"), decode=byte_ids)
    parts = [spark.createDataFrame([r for r in rows[i * 10 : (i + 1) * 10] if r[2]], SCHEMA) for i in range(4)]
    for i in (0, 1, 2, 2, 3):
        handler(parts[i], i)
    assert dict(spark.read.parquet(handler._path("state", 3)).dtypes)["tail"] == "binary"
    got = spark.read.parquet(f"{handler.root}/blocks").select("source", "block_id", "tokens")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_arrivals_are_written_by_several_tasks(spark, tmp_path):
    """as many files as there are cores, the same number in every arrival, none with rows of another."""
    rows = spark.range(5 * 4096 * 3)
    files = write_arrivals(rows, str(tmp_path / "in"), part_of(rows, "id", 5), 5)
    assert files == 3
    per_file = spark.read.parquet(str(tmp_path / "in")).groupBy(F.input_file_name()).agg(F.min("id"), F.max("id"))
    shares = [row[1] // (4096 * 3) == row[2] // (4096 * 3) for row in per_file.collect()]
    assert len(shares) == 15 and all(shares)


def test_stream_dedup_leaves_only_its_state(spark, tmp_path):
    """slices give the batch result; a batch's own tables go with it, and a large part of the state is not written again."""
    rng = random.Random(21)
    base = [[rng.randrange(200) for _ in range(40)] for _ in range(7)]
    blocks = [(i, list(rng.choice(base))) for i in range(18)]
    schema, scratch = "ord bigint, tokens array<int>", Path(scratch_root(spark).removeprefix("file:"))
    before = {p.name for p in scratch.iterdir()} if scratch.exists() else set()
    handler = DedupStream(str(tmp_path / "out"), buckets=4, part_rows=1, slice_rows=20)
    for batch_id in (0, 1, 1):
        handler(spark.createDataFrame(blocks[batch_id * 9 : batch_id * 9 + 9], schema), batch_id)
    assert handler.runs_before(spark, 2) == [(0, 1)] and handler._slices(81) == 4
    assert sorted(p.name for p in (tmp_path / "out/kept").iterdir()) == ["run=0-0", "run=1-1"]
    left = {p.name.rsplit("-", 1)[0] for p in scratch.iterdir() if p.name not in before}
    assert not left & {"stream-bands", "stream-met", "bands", "band-sets"}
    got = {r["ord"] for r in spark.read.schema(FLAGS).parquet(f"{handler.root}/flags/*").collect()}
    assert got == {i for i, tokens in blocks if tokens in [t for _, t in blocks[:i]]}


def test_an_empty_arrival_has_no_files(spark, tmp_path):
    """one arrival without rows does not leave a single file, written by a single task, to each of the others."""
    rows = spark.range(3 * 4096)
    part = F.when(F.col("id") < 3 * 2048, 0).otherwise(2)
    assert write_arrivals(rows, str(tmp_path / "in"), part, 3) == 1
    assert write_arrivals(spark.range(6 * 4096), str(tmp_path / "more"), F.when(F.col("id") < 3 * 4096, 0).otherwise(2), 3) == 3
    files = [p for p in (tmp_path / "more").iterdir() if p.name.startswith("part-")]
    assert len(files) == 6 and spark.read.parquet(str(tmp_path / "more")).count() == 6 * 4096
    write_arrivals(rows.where("id < 0"), str(tmp_path / "none"), part, 3)
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0
