import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import mix
from corpusmill.operators.sampling import byte_budget_prefix
from corpusmill.plans.corpus import byte_blocks
from corpusmill.sources import registry, token_shards
from corpusmill.sources.token_shards import list_shards, read_token_shards, write_token_shards

# --- fixed values: the published source weights -------------------------------
STAGE_A_WEIGHTS = {"web": 0.60, "qa": 0.20, "math": 0.10, "synthetic": 0.10}
STAGE_B_WEIGHTS = {"web": 0.40, "synthetic": 0.30, "math": 0.20, "qa": 0.10}
# ----------------------------------------------------------------------------
BLOCK = "source string, split string, shard_id bigint, block_in_shard bigint, tokens array<int>"


def test_scan_and_unknown_source(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.createDataFrame([(0, "a"), (1, ""), (2, None), (3, "  "), (4, "b")], "id bigint, body string").write.json(path)
    known = {"web": registry.SourceSpec(path, "json", text_field="body", id_field="id", schema="id bigint, body string")}
    rows = registry.scan_source(spark, known, "web").orderBy("doc_id").collect()
    assert [(r["doc_id"], r["text"]) for r in rows] == [(0, "a"), (3, "  "), (4, "b")]
    taken = registry.take_docs(registry.raw_source(spark, known, "web"), 3)
    assert [r["doc_id"] for r in taken.collect()] == [0]  # counted before the empty filter
    with pytest.raises(KeyError):
        registry.scan_source(spark, known, "code")


def test_split_is_stable_and_disjoint(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"))
    once = registry.split_train_eval(docs, 50)
    held = once.where("split = 'eval'").count()
    assert 50 < held < 170
    assert once.exceptAll(registry.split_train_eval(docs.repartition(3), 50)).isEmpty()


def test_corpus_text_is_one_record_per_document(spark, tmp_path):
    docs = spark.createDataFrame([("one",), ("two",)], "text string")
    registry.write_corpus_text(docs, str(tmp_path / "out"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()) == ["one", "two"]


def test_byte_budget_keeps_the_crossing_document(spark):
    docs = spark.createDataFrame(
        [("a", 0, "é" * 5), ("a", 1, "x" * 3), ("a", 2, "y"), ("b", 0, "z" * 99), ("c", 0, "w")],
        "source string, doc_id bigint, text string",
    )
    kept = byte_budget_prefix(docs, {"a": 0.11, "b": 0.0}, 100)
    assert sorted((r["source"], r["doc_id"], r["bytes_before"]) for r in kept.collect()) == [
        ("a", 0, 0), ("a", 1, 10), ("b", 0, 0),
    ]


def test_repeats_and_shares(spark):
    weights = {**STAGE_A_WEIGHTS, "quarter": 0.25, "more": 0.35, "tiny": 0.02}
    table = mix.weight_table(spark, weights).withColumn("n", mix.repeats(F.col("weight")))
    got = {r["source"]: r["n"] for r in table.collect()}
    assert got == {"web": 6, "qa": 2, "math": 1, "synthetic": 1, "quarter": 2, "more": 4, "tiny": 1}
    assert {k: max(1, round(v * 10)) for k, v in STAGE_B_WEIGHTS.items()} == {"web": 4, "synthetic": 3, "math": 2, "qa": 1}
    counts = {"web": 15, "qa": 5, "math": 3, "synthetic": 3}
    shards = spark.createDataFrame([(s, i, 10) for s, n in counts.items() for i in range(n)], "source string, shard_id bigint, n_tokens bigint")
    shares = {r["source"]: round(r["share_shards"], 4) for r in mix.mix_report(shards, STAGE_A_WEIGHTS).collect()}
    assert shares == {"web": 0.8491, "qa": 0.0943, "math": 0.0283, "synthetic": 0.0283}
    assert mix.weighted_mix(shards, STAGE_A_WEIGHTS).count() == 106
    assert [r["source"] for r in mix.missing_sources(shards, {"web": 0.5, "news": 0.5}).collect()] == ["news"]
    with pytest.raises(ValueError):
        mix.require_shards(mix.weighted_mix(shards, {"news": 1.0}))


def test_budget_report(spark):
    shards = spark.createDataFrame([("web", 0, 700), ("web", 1, 700)], "source string, shard_id bigint, n_tokens bigint")
    rows = mix.budget_report(shards, {"web": 0.6, "qa": 0.4}, 2_000, 300).orderBy("source").collect()
    assert [tuple(r) for r in rows] == [("qa", 0.4, 300, 6, 800, 0, False), ("web", 0.6, 300, 6, 1_200, 1_400, True)]


def test_shard_files_round_trip(spark, tmp_path):
    path = str(tmp_path / "shards")
    rows = [("web", "train", s, b, [s * 100 + b * 10 + i for i in range(10)]) for s in range(3) for b in range(5)]
    rows.append(("qa", "eval", 0, 0, [0, 65535] * 5))
    blocks = spark.createDataFrame(rows, BLOCK)
    write_token_shards(blocks, path)
    assert (tmp_path / "shards/web/train/shard_00002.bin").stat().st_size == 100
    assert (tmp_path / "shards/qa/eval/shard_00000.bin").read_bytes()[:4] == b"\x00\x00\xff\xff"
    back = read_token_shards(spark, path, 10).drop("path")
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    assert read_token_shards(spark, path, 10, split="eval").count() == 1
    assert read_token_shards(spark, path, 20, split="train").count() == 6  # remainders dropped
    assert read_token_shards(spark, path, 20, split="train", keep_tail=True).count() == 9
    listed = list_shards(spark, path, "train").orderBy("shard_id").collect()
    assert [(r["source"], r["shard_id"], r["n_tokens"]) for r in listed] == [("web", i, 50) for i in range(3)]
    with pytest.raises(Exception, match="not empty"):
        write_token_shards(blocks, path)


def test_shard_files_reject_bad_input(spark, tmp_path):
    odd = tmp_path / "b/web/train"
    odd.mkdir(parents=True)
    (odd / "shard_00000.bin").write_bytes(b"abc")
    with pytest.raises(Exception, match="odd number"):
        read_token_shards(spark, str(tmp_path / "b"), 2, committed=False).count()
    with pytest.raises(Exception, match="no .bin shards"):
        read_token_shards(spark, str(tmp_path / "b"), 2, split="eval", committed=False).count()


def test_failed_write_leaves_nothing_to_read(spark, tmp_path):
    path = tmp_path / "a"
    blocks = spark.createDataFrame([("web", "train", i, 0, [i, 65536 if i == 7 else 1]) for i in range(9)], BLOCK)
    with pytest.raises(Exception, match="token id outside"):
        write_token_shards(blocks, str(path))
    assert not [p for p in path.rglob("*") if p.is_file()]
    for read in (lambda: read_token_shards(spark, str(path), 2).count(), lambda: list_shards(spark, str(path))):
        with pytest.raises(Exception, match="_COMMITTED"):
            read()
    write_token_shards(blocks.where("shard_id <> 7"), str(path))  # the folder holds nothing, so it may be used
    assert read_token_shards(spark, str(path), 2).count() == 8
    assert json.loads((path / "_COMMITTED").read_text()) == {"n_shards": 8, "n_tokens": 16}
    assert not (path / "_staged").exists()


def test_unfinished_write_is_not_read(spark, tmp_path):
    """Files moved by a driver that then stopped: without the marker they do not count."""
    path = tmp_path / "a"
    write_token_shards(spark.createDataFrame([("web", "train", 0, 0, [1, 2])], BLOCK), str(path))
    (path / "_COMMITTED").unlink()
    with pytest.raises(Exception, match="_COMMITTED"):
        read_token_shards(spark, str(path), 2).count()
    assert read_token_shards(spark, str(path), 2, committed=False).count() == 1


def test_repeated_attempt_counts_once(tmp_path):
    writer = token_shards.TokenShardWriter({"path": str(tmp_path / "a")})
    rows = pa.table({"source": ["w"] * 4, "split": ["train"] * 4, "shard_id": [0, 0, 1, 1], "tokens": [[1, 2], [3], [], [4]]}).to_batches()
    lost, first = writer.write(iter(rows)), writer.write(iter(rows))
    assert len(lost.files) == 2
    writer.commit([first, None])
    assert sorted(p.name for p in (tmp_path / "a").rglob("*.bin")) == ["shard_00000.bin", "shard_00001.bin"]
    assert (tmp_path / "a/w/train/shard_00000.bin").read_bytes() == b"\x01\x00\x02\x00\x03\x00"
    with pytest.raises(ValueError, match="two tasks"):
        again = token_shards.TokenShardWriter({"path": str(tmp_path / "b")})
        again.commit([again.write(iter(rows)), again.write(iter(rows))])
    assert not list((tmp_path / "b").rglob("*.bin"))


def test_sources_without_integer_ids_are_numbered(spark, tmp_path):
    for name, lines in {"b.txt": ["third", "", "fifth"], "a.txt": ["first", "second"]}.items():
        (tmp_path / "text").mkdir(exist_ok=True)
        (tmp_path / "text" / name).write_text("\n".join(lines) + "\n")
    specs = {
        "lines": registry.SourceSpec(str(tmp_path / "text"), "text", "value", None),
        "named": registry.SourceSpec(str(tmp_path / "json"), "json", "body", "doc_id", "body <> 'one'", "doc_id string, body string"),
    }
    got = [(r["doc_id"], r["text"]) for r in registry.scan_source(spark, specs, "lines").orderBy("doc_id").collect()]
    assert got == [(0, "first"), (1, "second"), (2, "third"), (4, "fifth")]
    (tmp_path / "json").mkdir()
    (tmp_path / "json/x.json").write_text("".join(json.dumps({"doc_id": f"k{i}", "body": t}) + "\n" for i, t in enumerate(["zero", "one", "two"])))
    got = [(r["source"], r["doc_id"], r["text"]) for r in registry.scan_source(spark, specs, "named").orderBy("doc_id").collect()]
    assert got == [("named", 0, "zero"), ("named", 2, "two")]
    packed = byte_blocks(registry.scan_source(spark, specs, "lines"), 4)
    assert packed.count() == (len("firstsecondthirdfifth") + 4) // 4


def test_numbers_do_not_depend_on_splits(spark, tmp_path):
    (tmp_path / "one").mkdir()
    (tmp_path / "one/a.txt").write_text("".join(f"line {i}\n" for i in range(5000)))
    spec = {"x": registry.SourceSpec(str(tmp_path / "one"), "text", "value", None)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        rows = registry.scan_source(spark, spec, "x").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r["doc_id"]: r["text"] for r in rows} == {i: f"line {i}" for i in range(5000)}


def test_repeated_labels_repeat_no_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (1, 2), (2, 0), (1, 1)], "doc_id bigint, quality int")
    assert [tuple(r) for r in registry.quality_filter(docs, labels, 1).collect()] == [(1, "a", 2)]
