import random

import pytest
from pyspark.sql import functions as F

from corpusmill.operators.batches import batch_windows, epoch_order, next_token_labels
from corpusmill.operators.offsets import keep_heads, range_bits, running_start
from corpusmill.operators.packing import capped_blocks, pack_blocks
from corpusmill.operators.shards import chop_blocks, shard_counts, shard_index, shard_table

DOC = "source string, doc_id bigint, tokens array<int>"


def frame(spark, docs, source="web"):
    rows = [(source, i, tokens) for i, tokens in enumerate(docs)]
    return spark.createDataFrame(rows, DOC).withColumn("n_tokens", F.size("tokens"))


def literal_pack(docs, block, eos):
    flat = [t for tokens in docs if tokens for t in [*tokens, eos]]
    return [flat[i : i + block] for i in range(0, len(flat) - block + 1, block)]


def packed(df):
    return [r["tokens"] for r in df.orderBy("source", "block_id").collect()]


@pytest.mark.parametrize(
    "docs, block, eos, expected",
    [
        ([[1, 2, 3, 4, 5], [6, 7, 8]], 4, 2, [[1, 2, 3, 4], [5, 2, 6, 7]]),
        ([[1, 1, 1], [2, 2, 2]], 4, 99, [[1, 1, 1, 99], [2, 2, 2, 99]]),
        ([[7, 7, 7, 7], [8, 8, 8]], 4, 2, [[7, 7, 7, 7], [2, 8, 8, 8]]),  # EOS opens a block
        ([[], [5], []], 2, 2, [[5, 2]]),  # no EOS after an empty document
        ([], 4, 2, []),
    ],
)
def test_literal_fixtures(spark, docs, block, eos, expected):
    assert packed(pack_blocks(frame(spark, docs), block, eos_id=eos)) == expected


def test_block_counts(spark):
    assert len(packed(pack_blocks(frame(spark, [list(range(100))] * 10), 32))) == 31
    assert len(packed(pack_blocks(frame(spark, [list(range(1000))]), 64))) == 15


def test_random_packing_over_many_ranges(spark):
    """Tiny ranges, so that most blocks cross several of them."""
    for seed in range(4):
        rng = random.Random(seed)
        sources = {s: [[rng.randrange(300) for _ in range(rng.randrange(0, 12))] for _ in range(rng.randrange(1, 60))] for s in "ab"}
        rows = [(s, i * 3, t) for s, docs in sources.items() for i, t in enumerate(docs)]
        df = spark.createDataFrame(rows, DOC).withColumn("n_tokens", F.size("tokens"))
        block = rng.choice([1, 3, 7, 40])
        cap = rng.choice([None, 1, 25])
        got = packed(pack_blocks(df, block, max_tokens=cap, bits=(1, 2)))
        limit = None if cap is None else capped_blocks(cap, block)
        assert got == [b for s in "ab" for b in literal_pack(sources[s], block, 2)[:limit]]


def test_running_start_with_sparse_and_negative_keys(spark):
    keys = [-(2**40), -5, -1, 0, 1, 7, 1024, 1025, 2**26, 2**40 + 3, 2**62]
    df = spark.createDataFrame([("s", k, i + 1) for i, k in enumerate(keys)], "source string, k bigint, n int")
    got = [r["start"] for r in running_start(df, ["source"], "k", "n").orderBy("k").collect()]
    assert got == [sum(range(1, i + 1)) for i in range(len(keys))]


def test_shard_index_against_literal_loop(spark):
    for block, shard, n in [(3, 10, 40), (4, 8, 17), (16, 5, 9), (5, 5, 6), (7, 100, 50)]:
        expected, current, index, written = [], [], 0, 0
        for b in range(n):
            current.append(b)
            written += block
            if written - index * shard >= shard:
                expected += [(x, index, i) for i, x in enumerate(current)]
                current, index = [], index + 1
        expected += [(x, index, i) for i, x in enumerate(current)]
        rows = shard_index(spark.range(n).select(F.col("id").alias("block_id")), block, shard).orderBy("block_id").collect()
        assert [tuple(r) for r in rows] == expected


def test_cap_keeps_the_block_that_reaches_it():
    assert [capped_blocks(c, 10) for c in (0, 1, 10, 11, 20, 21)] == [1, 1, 1, 2, 2, 3]


def test_labels_cross_documents_and_blocks(spark):
    rows = next_token_labels(frame(spark, [[10, 11, 12], [13, 14]]), 3).orderBy("block_id").collect()
    assert [(r["input_ids"], r["labels"]) for r in rows] == [([10, 11, 12], [11, 12, 2]), ([2, 13, 14], [13, 14, 2])]


def test_chop_drops_the_remainder(spark):
    rows = spark.createDataFrame([("a", list(range(7))), ("b", [1]), ("c", [])], "name string, tokens array<int>")
    got = [tuple(r) for r in chop_blocks(rows, 3).orderBy("name", "block_in_shard").collect()]
    assert got == [("a", 0, [0, 1, 2]), ("a", 1, [3, 4, 5])]


def test_batches_of_two_shards(spark):
    """Two shards of (0..255) x 4, windows of 16 + 1 tokens."""
    tokens = list(range(256)) * 4
    rows = [("web", s, b, tokens[b * 64 : (b + 1) * 64]) for s in range(2) for b in range(16)]
    blocks = spark.createDataFrame(rows, "source string, shard_id bigint, block_in_shard bigint, tokens array<int>")
    order = epoch_order(shard_table(blocks, 64).withColumn("copy", F.lit(1)), epoch=0, seed=1)
    got = batch_windows(blocks, order, 64, seq_len=8, micro_batch=2).orderBy("batch_id", "row").collect()
    assert len(got) == 127 * 2
    assert got[0]["input_ids"] == list(range(8)) and got[0]["labels"] == list(range(1, 9))
    assert got[1]["input_ids"] == list(range(8, 16)) and got[1]["labels"] == list(range(9, 17))
    stream = tokens * 2
    for r in got:
        at = r["batch_id"] * 16 + r["row"] * 8
        assert r["input_ids"] == stream[at : at + 8] and r["labels"] == stream[at + 1 : at + 9]


def test_epochs_differ_but_repeat(spark):
    mix = spark.range(40).select(F.lit("web").alias("source"), F.col("id").alias("shard_id"), F.lit(1).alias("copy"), F.lit(8).alias("n_tokens"))
    order = lambda epoch: [r["shard_id"] for r in epoch_order(mix, epoch, 5).orderBy("place").collect()]
    assert order(1) == order(1) != order(2)
    assert sorted(order(1)) == list(range(40))


def test_heads_stop_at_the_range_that_reaches_the_limit(spark):
    df = spark.range(-5, 100).select(F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("s"), F.col("id").alias("k"))
    kept = keep_heads(df, "s", "k", F.lit(1), F.when(F.col("s") == "a", 3).otherwise(10), bits=(2, 2))
    ends = {r["s"]: r["last"] for r in kept.groupBy("s").agg(F.max("k").alias("last")).collect()}
    assert ends == {"a": 2, "b": 15}  # the end of the range of the last row needed


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


KEYS = {
    "hashed": lambda n: [random.Random(i).getrandbits(64) - 2**63 for i in range(n)],
    "dense": lambda n: list(range(-7, n - 7)),
    "both": lambda n: list(range(n - 50)) + [2**62 + i * 2**40 for i in range(50)],
}


@pytest.mark.parametrize("kind", KEYS)
def test_ranges_are_bounded_for_any_keys(spark, kind):
    keys = sorted(set(KEYS[kind](3000)))
    rows = spark.createDataFrame([("a" if i % 3 else "b", k, i % 5) for i, k in enumerate(keys)], "s string, k bigint, n bigint")
    bits = range_bits(rows, ["s"], "k", most=100)
    assert sum(bits) <= 63 and all(b <= 16 for b in bits[1:])
    span = max(keys) - min(keys)
    assert span / 2.0 ** sum(bits) < 2**16
    fullest = rows.groupBy("s", F.shiftright("k", bits[0])).count().agg(F.max("count")).first()[0]
    assert fullest <= 100
    got = {(r["s"], r["k"]): r["start"] for r in running_start(rows, ["s"], "k", "n", bits).collect()}
    total = {"a": 0, "b": 0}
    for i, k in enumerate(keys):
        source = "a" if i % 3 else "b"
        assert got[source, k] == total[source]
        total[source] += i % 5


@pytest.mark.parametrize(("key", "message"), [(3, "repeated order key"), (None, "null in the order key")])
def test_bad_order_keys_are_refused(spark, key, message):
    rows = spark.createDataFrame([("a", 3, 1), ("a", key, 1), ("a", 9, 1)], "source string, doc_id bigint, n_tokens int")
    with pytest.raises(Exception, match=message):
        running_start(rows, ["source"], "doc_id", "n_tokens").collect()
    if key is None:
        with pytest.raises(Exception, match=message):
            keep_heads(rows, "source", "doc_id", "n_tokens", 2).collect()


def test_epoch_and_batches_move_tokens_once(spark):
    rows = [("web", s, b, list(range(64))) for s in range(3) for b in range(4)]
    blocks = spark.createDataFrame(rows, "source string, shard_id bigint, block_in_shard bigint, tokens array<int>")
    order = epoch_order(shard_table(blocks, 64).withColumn("copy", F.lit(1)), epoch=0, seed=1)
    lines = plan(order).splitlines()
    single = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    # only the range totals, at most 4,096 rows, meet in one task
    assert len(single) <= 1 and all("HashAggregate" in lines[i + 1] and "rng" in lines[i + 1] for i in single)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tree = plan(batch_windows(blocks, cut(order), 64, seq_len=8, micro_batch=2))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    exchanges = [line for line in tree.splitlines() if "Exchange hashpartitioning" in line]
    # by shard once, where the order joins; then only windows across shards move, by their number
    assert sum("shard_id" in line for line in exchanges if "Reused" not in line) <= 3
    assert sum("window_id" in line for line in exchanges) == 1


def cut(df):
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def test_shard_counts_follow_from_totals(spark):
    rng = random.Random(4)
    for block, shard, cap in [(4, 10, None), (7, 7, 30), (9, 5, None), (3, 100, 50), (50, 60, None)]:
        docs = [(s, i, [1] * rng.randrange(0, 30)) for s, n in (("a", 25), ("b", 3), ("c", 0)) for i in range(n)] + [("d", 0, [])]
        df = spark.createDataFrame(docs, DOC).withColumn("n_tokens", F.size("tokens"))
        want = shard_table(shard_index(pack_blocks(df, block, max_tokens=cap), block, shard), block)
        got = shard_counts(df, block, shard, cap)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        assert "collect_list" not in plan(got)


def test_blocks_as_bytes_and_batches_of_them(spark):
    """blocks travel as one byte a token and give the same ids; long, short and multi-byte texts."""
    from corpusmill.functions.text import byte_ids
    from corpusmill.plans.corpus import byte_blocks

    texts = ["x" * 500, "é", "", "ab", "ÿ" * 90, "日本" * 40, "c"] * 3
    docs = spark.createDataFrame([("s", i, t) for i, t in enumerate(texts)], "source string, doc_id long, text string")
    stream = [id_ for t in texts if t for id_ in [*(6 + b for b in t.encode()), 2]]
    packed = byte_blocks(docs, 16, as_bytes=True)
    assert dict(packed.dtypes)["tokens"] == "binary"
    rows = packed.select("block_id", byte_ids(F.col("tokens")).alias("ids")).orderBy("block_id").collect()
    assert [r["ids"] for r in rows] == [stream[i : i + 16] for i in range(0, len(stream) - 15, 16)]
    assert [r["tokens"] for r in byte_blocks(docs, 16).orderBy("block_id").collect()] == [r["ids"] for r in rows]


@pytest.mark.parametrize("block,seq_len,micro_batch", [(4, 3, 2), (6, 3, 1), (4, 5, 5)])
def test_windows_of_copies_are_cut_from_blocks_in_order(spark, block, seq_len, micro_batch):
    """copies, shards shorter than a window, windows over several shards; no window inside a shard is put together."""
    rng, ids = random.Random(block), iter(range(10**6))
    shards = {("a", s): [next(ids) for _ in range(block * rng.choice([1, 2, 3, 9]))] for s in range(6)}
    rows = [(*key, at // block, tokens[at : at + block]) for key, tokens in shards.items() for at in range(0, len(tokens), block)]
    rng.shuffle(rows)
    blocks = spark.createDataFrame(rows, "source string, shard_id bigint, block_in_shard bigint, tokens array<int>")
    copies = shard_table(blocks, block).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(3))))
    order = cut(epoch_order(copies, epoch=0, seed=3))
    stream = [i for r in sorted(order.collect(), key=lambda r: r["place"]) for i in shards[r["source"], r["shard_id"]]]
    step = seq_len * micro_batch
    want = [
        (w, m, stream[at : at + seq_len], stream[at + 1 : at + seq_len + 1])
        for w in range((len(stream) - 1) // step) for m in range(micro_batch) for at in [w * step + m * seq_len]
    ]
    got = batch_windows(blocks, order, block, seq_len, micro_batch)
    assert sorted(tuple(r)[1:] for r in got.collect()) == want
    gathered = [line for line in plan(got).splitlines() if "collect_list" in line]
    assert gathered and not any("shard_id" in line for line in gathered)
