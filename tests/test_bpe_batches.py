"""Batched and incremental merging equals merging one pair at a time."""

import collections
import random
from collections import Counter

import numpy as np

from corpusmill.functions.bpe import _merged_parts
from corpusmill.operators import vocab
from corpusmill.operators.bpe_rounds import MASK, SHIFT, count_pairs, merge_chunk, pair_code
from corpusmill.operators.vocab import Pair, safe_batch


def _counts(words):
    counts = Counter()
    for symbols, n in words:
        for left, right in zip(symbols, symbols[1:]):
            counts[left, right] += n
    ranked = [Pair(left, right, n) for (left, right), n in counts.items()]
    return sorted(ranked, key=lambda p: (-p.n, p.piece, p.left))


def _merge(symbols, pair):
    out, i = [], 0
    while i < len(symbols):
        if symbols[i : i + 2] == [pair.left, pair.right]:
            out.append(pair.piece)
            i += 2
        else:
            out.append(symbols[i])
            i += 1
    return out


def _train(words, known, batched, limit, top_pairs):
    known, merged, rounds = set(known), [], 0
    while len(merged) < limit:
        ranked = _counts(words)
        if not ranked:
            break
        top = ranked[:top_pairs]
        batch = safe_batch(top, known, len(top) < len(ranked)) if batched else top[:1]
        rounds += 1
        for pair in batch:
            words = [(_merge(symbols, pair), n) for symbols, n in words]
            if pair.piece not in known:
                known.add(pair.piece)
                merged.append(pair.piece)
    return merged[:limit], rounds


def test_batches_keep_the_one_by_one_order():
    saved = 0
    for seed in range(400):
        rng = random.Random(seed)
        alphabet = "abcdefghij"[: rng.randint(2, 10)]
        words = [
            (list("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 9)))), rng.choice([1, 1, 2, 3, rng.randint(1, 60)]))
            for _ in range(rng.randint(1, 40))
        ]
        limit = rng.randint(1, 80)
        top_pairs = rng.choice([3, 10, 4096])
        serial, serial_rounds = _train(words, alphabet, False, limit, top_pairs)
        batched, rounds = _train(words, alphabet, True, limit, top_pairs)
        assert batched == serial, seed
        saved += serial_rounds - rounds
    assert saved > 0


def _one_by_one(segment, ids):
    parts = list(segment)
    while True:
        ranked = [(ids[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ids]
        if not ranked:
            return parts
        _, at = min(ranked)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


def test_heap_merges_like_one_by_one():
    rng = random.Random(7)
    for _ in range(300):
        pieces = {"".join(rng.choice("abc") for _ in range(rng.randrange(2, 6))) for _ in range(25)}
        ids = {piece: 262 + i for i, piece in enumerate(rng.sample(sorted(pieces), len(pieces)))}
        segment = "".join(rng.choice("abcd") for _ in range(rng.randrange(0, 40)))
        assert _merged_parts(segment, ids) == _one_by_one(segment, ids)
    assert _merged_parts("ab" * 200_000, {"ab": 300, "abab": 299}) == ["abab"] * 100_000


def test_chunks_merge_and_count_like_words():
    rng = random.Random(8)
    for _ in range(100):
        words = [([rng.randrange(1, 5) for _ in range(rng.randrange(1, 9))], rng.randrange(1, 9)) for _ in range(rng.randrange(1, 12))]
        equal = rng.random() < 0.5
        pairs = {(1, 1): 7} if equal else {(1, 2): 7, (3, 4): 8, (1, 4): 9}
        flat = np.array([s for word, _ in words for s in [*word, 0]])
        counts = np.array([n for _, n in words])
        codes = np.array(sorted(pair_code(*p) for p in pairs))
        after, changed, change = merge_chunk(flat, counts, codes, np.array([pairs[c >> SHIFT, c & MASK] for c in codes]))

        def merged(word):
            out, i = [], 0
            while i < len(word):
                to = pairs.get(tuple(word[i : i + 2]))
                out.append(word[i] if to is None else to)
                i += 1 if to is None else 2
            return out

        def pair_totals(rows):
            total = collections.Counter()
            for word, n in rows:
                for p in zip(word, word[1:]):
                    total[pair_code(*p)] += n
            return total

        new = [(merged(word), n) for word, n in words]
        assert list(after) == [s for word, _ in new for s in [*word, 0]]
        difference = pair_totals(new)
        difference.subtract(pair_totals(words))
        assert dict(zip(changed.tolist(), change.tolist())) == {p: n for p, n in difference.items() if n}
        found, total = count_pairs(after, counts)
        assert dict(zip(found.tolist(), total.tolist())) == pair_totals(new)


def test_small_pair_table_is_fetched_again(spark, monkeypatch):
    """Few pairs at a time, so the table runs out, and pieces that exist already raise its bound."""
    rng = random.Random(9)
    words = collections.Counter("".join(rng.choice("aabbc") for _ in range(rng.randrange(1, 12))) for _ in range(100))
    table = spark.createDataFrame(list(words.items()), "word string, n bigint")
    want = vocab.train_bpe(table, ["a", "b", "c"], 40, one_by_one=True)
    fetched = []
    whole = vocab.PairTable.fetch
    monkeypatch.setattr(vocab.PairTable, "fetch", lambda self, pairs: (setattr(self, "limit", 5), whole(self, pairs), fetched.append(1))[1])
    assert vocab.train_bpe(table, ["a", "b", "c"], 40) == want and len(want) == 40
    assert len(fetched) > 3


def test_training_matches_plain_python(spark):
    rng = random.Random(10)
    words = collections.Counter("".join(rng.choice("aabbcd") for _ in range(rng.randrange(1, 10))) for _ in range(300))
    state, want = {tuple(w): n for w, n in words.items()}, []
    while len(want) < 40:
        totals = collections.Counter()
        for word, n in state.items():
            for p in zip(word, word[1:]):
                totals[p] += n
        left, right = min(totals, key=lambda p: (-totals[p], p[0] + p[1], p[0]))
        if left + right not in want:
            want.append(left + right)
        after = collections.Counter()
        for word, n in state.items():
            out, i = [], 0
            while i < len(word):
                joined = word[i : i + 2] == (left, right)
                out.append(left + right if joined else word[i])
                i += 2 if joined else 1
            after[tuple(out)] += n
        state = after
    table = spark.createDataFrame(list(words.items()), "word string, n bigint")
    assert vocab.train_bpe(table, list("abcd"), 40) == want
