import io
import random
from array import array
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import bpe
from corpusmill.functions.bpe import bpe_decoder, bpe_encoder, byte_decode, merge_segment
from corpusmill.functions.segments import chunk_segments, training_lines
from corpusmill.functions.text import USER_SYMBOLS, byte_tokens, marked
from corpusmill.operators import vocab
from corpusmill.plans import catalog
from corpusmill.plans.corpus import encode_table, encoded_blocks
from corpusmill.sources.vocab_io import read_vocab, write_vocab

TEXTS = [
    "Hello world! This is a test of the tokenizer, and of the tests.",
    "the the  the   other others  1234 and 56 äöü éé — “quoted” text",
    "tab\there\nnew line\n\nthe end",
    "  leading and trailing  ",
    "a",
    "日本語 テキスト and 漢字かな",
]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(0)
    words = "the of and to in other there then these lower lowest newer wider new 12 3 état".split()
    texts = TEXTS + [" ".join(rng.choice(words) for _ in range(40)) for _ in range(60)]
    return spark.createDataFrame([("web", i, t) for i, t in enumerate(texts)], "source string, doc_id bigint, text string")


@pytest.fixture(scope="module")
def table(spark, docs):
    return vocab.train_vocab(docs, 262 + 120, coverage=0.999).cache()


def test_byte_tokens_and_back(spark, docs):
    rows = docs.select("text", byte_tokens(F.col("text")).alias("t"), byte_decode(byte_tokens(F.col("text"))).alias("back"))
    for r in rows.collect():
        assert r["t"] == [6 + b for b in r["text"].encode()] and r["back"] == r["text"]
    empty = spark.createDataFrame([("",)], "text string").select(byte_tokens(F.col("text")).alias("t")).first()
    assert empty["t"] == []


def test_word_segments(spark):
    one = spark.createDataFrame([("it's  a 42 <|pad|>x\n" + "z" * 5000,)], "text string")
    got = {r["word"]: r["n"] for r in vocab.word_counts(one).collect()}
    # digits alone, no mixed scripts, symbols left out, lines of any length read
    assert got == {"▁it": 1, "'": 1, "s": 1, "▁▁a": 1, "▁": 2, "4": 1, "2": 1, "x": 1, "▁" + "z" * 5000: 1}


def test_character_coverage_stops_at_the_share(spark):
    counts = spark.createDataFrame([("a", 90), ("b", 6), ("c", 3), ("d", 1)], "ch string, n bigint")
    assert [r["ch"] for r in vocab.char_coverage(counts, 0.96).orderBy("rank").collect()] == ["a", "b"]
    assert vocab.char_coverage(counts, 0.961).count() == 3


def test_batched_training_equals_single_merges(spark, docs):
    words = vocab.word_counts(docs).cache()
    chars = [r["ch"] for r in vocab.char_counts(docs).select("ch").collect()]
    assert vocab.train_bpe(words, chars, 25) == vocab.train_bpe(words, chars, 25, one_by_one=True)


def test_uncovered_characters_are_barriers(spark):
    words = spark.createDataFrame([("▁abXab", 3)], "word string, n bigint")
    pairs = vocab.pair_counts(vocab.covered_words(words, ["▁", "a", "b"]))
    assert {(r["left"], r["right"]): r["n"] for r in pairs.collect()} == {("▁", "a"): 3, ("a", "b"): 6}


def test_vocabulary_layout(table):
    rows = table.orderBy("id").collect()
    assert [r["id"] for r in rows] == list(range(262 + 120))
    assert [r["piece"] for r in rows[:6]] == ["<pad>", "<unk>", "</s>", "<|im_start|>", "<|im_end|>", "<|pad|>"]
    assert (rows[6]["piece"], rows[261]["piece"]) == ("<0x00>", "<0xFF>")
    pieces = [r["piece"] for r in rows]
    assert len(set(pieces)) == len(pieces)
    merges = [r for r in rows if r["kind"] == "merge"]
    assert merges and all(r["score"] == 262 - r["id"] for r in rows[262:])
    assert not any(any(ch.isascii() and ch.isdigit() for ch in r["piece"]) for r in merges)


def test_vocab_too_small(docs):
    with pytest.raises(ValueError):
        vocab.train_vocab(docs, 262 + 5)


def test_queries_train_a_vocabulary_of_their_size(spark, docs, tmp_path, monkeypatch):
    assert catalog.VOCAB_SIZE >= 2000
    monkeypatch.setattr(catalog, "VOCAB_SIZE", 262 + 100)
    rows = docs.select("doc_id", "text", F.lit("en").alias("lang"))
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    kinds = {r["kind"]: r["count"] for r in catalog.vocab_table(spark, str(tmp_path)).groupBy("kind").count().collect()}
    assert sum(kinds.values()) == 262 + 100


def test_pair_counts_never_cuts_characters(spark, docs, tmp_path, monkeypatch):
    rows = docs.select("doc_id", "text", F.lit("en").alias("lang"))
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(vocab, "MAX_TOKEN_ID", 5)
    with pytest.raises(ValueError):
        catalog.pair_counts(spark, str(tmp_path))


def test_vocab_file(spark, table, tmp_path):
    write_vocab(table, str(tmp_path / "v"))
    assert sorted(map(tuple, read_vocab(spark, str(tmp_path / "v")).collect())) == sorted(map(tuple, table.collect()))


def test_encode_decode_round_trip(spark, docs, table):
    extra = spark.createDataFrame([("web", 1000 + i, t) for i, t in enumerate(["<|im_start|>user\nhi<|im_end|>", "Ж", " x", "🙂 ok"])], docs.schema)
    both = docs.unionByName(extra)
    tokens = encode_table(both, bpe_encoder(table))
    back = tokens.select("doc_id", bpe_decoder(table)(F.col("tokens")).alias("back")).join(both, "doc_id")
    assert all(r["back"] == r["text"] for r in back.collect())
    symbols = tokens.where("doc_id = 1000").first()["tokens"]
    assert 3 in symbols and 4 in symbols and 16 in symbols  # two user symbols, newline as a byte
    blocks = encoded_blocks(both, bpe_encoder(table), 16)
    total = tokens.agg(F.sum(F.col("n_tokens") + 1)).first()[0]
    assert blocks.count() == total // 16


def test_merges_take_the_lowest_id_leftmost():
    ids = {"a": 300, "b": 301, "c": 302, "bc": 262, "ab": 263, "aa": 264}
    assert merge_segment("abc", ids) == [300, 262]
    assert merge_segment("aaa", ids) == [264, 300]
    assert merge_segment("é", ids) == [6 + 0xC3, 6 + 0xA9]


def test_encoding_equals_sentencepiece(spark, docs):
    """A model trained by the public library, its pieces in our table."""
    spm = pytest.importorskip("sentencepiece")
    texts = [r["text"] for r in docs.orderBy("doc_id").collect()]
    lines = [line for text in texts for line in text.split("\n") if line]
    model = io.BytesIO()
    spm.SentencePieceTrainer.train(
        sentence_iterator=iter(lines), model_writer=model, vocab_size=262 + 110, model_type="bpe", byte_fallback=True,
        character_coverage=0.99, normalization_rule_name="identity", split_by_whitespace=True, split_digits=True,
        allow_whitespace_only_pieces=True, remove_extra_whitespaces=False, user_defined_symbols=list(USER_SYMBOLS),
        pad_id=0, unk_id=1, bos_id=-1, eos_id=2, num_threads=1, minloglevel=2,
    )
    sp = spm.SentencePieceProcessor(model_proto=model.getvalue())
    pieces = [(i, sp.id_to_piece(i)) for i in range(sp.get_piece_size())]
    table = spark.createDataFrame(pieces, "id int, piece string")
    for r in encode_table(docs, bpe_encoder(table)).collect():
        assert r["tokens"] == sp.encode_as_ids(texts[r["doc_id"]])
    # our trainer finds the same first merges on the same lines
    chars = [p for i, p in pieces if i >= 262 and len(p) == 1]
    theirs = [p for i, p in pieces if i >= 262 and len(p) > 1]
    ours = vocab.train_bpe(vocab.word_counts(docs), chars, len(theirs))
    assert len(set(ours[:30]) & set(theirs[:30])) >= 27


def test_every_script_is_a_run_of_its_own(spark):
    docs = spark.createDataFrame([(1, "ខ្មែរ! ગુજરાતી, abc日本のテキスト12«ру»")], "doc_id bigint, text string")
    words = {r["word"]: r["n"] for r in vocab.word_counts(docs).collect()}
    assert words == dict.fromkeys(["▁ខ្មែរ", "!", "▁ગુજરાતી", ",", "▁abc", "日本のテキスト", "1", "2", "«", "ру", "»"], 1)


def test_patterns_meet_distinct_chunks_only(spark):
    """F11 to F18: counted chunks give the segments and characters of whole lines; copies reach no pattern twice."""
    odd = "  two  marks▁▁x <|im_start|>user<|im_end|> 42 ünï<|pad|>,日本 \n\n ▁ \nend "
    docs = spark.createDataFrame([(i, odd) for i in range(5)] + [(9, None), (10, "")], "doc_id bigint, text string")
    chunks = vocab.chunk_counts(docs)
    assert chunks.count() == len({c for r in chunks.collect() for c in [r["chunk"]]}) and chunks.agg(F.min("n")).first()[0] >= 5
    lines = docs.select(F.explode(training_lines(F.col("text"))).alias("line"))
    whole = lines.select(F.explode(chunk_segments(marked(F.col("line")))).alias("word"), F.lit(1).alias("n")).groupBy("word").agg(F.sum("n"))
    assert sorted(map(tuple, vocab.word_counts(docs).collect())) == sorted(map(tuple, whole.collect()))
    chars = Counter(c for line in odd.split("\n") if line for c in "▁" + line.replace(" ", "▁"))
    assert {r["ch"]: r["n"] for r in vocab.char_counts(docs).collect()} == {c: 5 * n for c, n in chars.items()}


def test_short_segments_merge_as_long_ones():
    rng = random.Random(3)
    letters = lambda most: "".join(rng.choice("abcé▁") for _ in range(rng.randrange(1, most)))
    for _ in range(300):
        ids = dict(zip(sorted({letters(5) for _ in range(30)}), rng.sample(range(262, 400), 30)))
        text = letters(30)
        assert bpe._merged_short(text, ids) == bpe._merged_parts(text, ids)
        encoded = bpe.text_encoder(ids)
        assert encoded(text) == encoded(text) == b"".join(array("i", merge_segment(s, ids)).tobytes() for s in bpe._SEGMENT.findall("▁" + text))
