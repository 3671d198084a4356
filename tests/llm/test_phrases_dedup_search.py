"""Operators 11 to 13 and the meeting of holders, against brute force."""

from __future__ import annotations

import itertools
import math
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest

from corpusmill.llm import collocations, lexical_search, meet, ngram_jaccard, setsketch, text
from corpusmill.llm.components import connected_components
from corpusmill.session import cut_lineage

DOCS = "doc_id bigint, text string, lang string, n int, key string, component string, score string"


def frame(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, lang, 7, "k", "c", "s") for i, t, lang in rows], DOCS)


def ascii_lower(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")


# --- 11 ----------------------------------------------------------------------


def phrases(rows, top, least):
    counts, total = defaultdict(Counter), Counter()
    for _, t, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", ascii_lower(t)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in (1, 2, 3):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = {}
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        ranked = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in found.items()):
                continue
            cuts = [(1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            ranked.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out[lang, rank] = (p.decode(), -a, left, right, total[lang], -score)
    return out


def got_phrases(found):
    return {(r["lang"], r["rank"]): tuple(r[c] for c in ("phrase", "a", "l", "r", "n", "score")) for r in found.collect()}


@pytest.mark.parametrize("shards", [1, 3])
def test_collocations_match_brute_force(spark, shards):
    random = np.random.default_rng(5)
    words = ["Ab", "cd", "é", "x", "ZZ", "to", "日本"]
    rows = []
    for i in range(60):
        n = random.integers(0, 60)
        joined = "".join(words[min(int(random.exponential(2)), 6)] + str(random.choice([" ", "  ", ". ", "\t", "\n"], p=[0.7, 0.1, 0.1, 0.05, 0.05])) for _ in range(n))
        rows.append((i if i % 7 else None, joined, [None, "und", "en"][i % 3]))
    rows += rows[:5] + [(90, None, "en"), (91, "", None), (92, "a", "only")]
    found = collocations.collocations(frame(spark, rows), top=12, shards=shards, least=4)
    want = phrases(rows, 12, 4)
    assert len(want) == 24 and got_phrases(found) == want


def test_common_phrases_are_told_by_few_tasks(spark, monkeypatch):
    """Phrases of every text are spelled in the first scans; the later ones tell nothing of them."""
    told = spark.sparkContext.accumulator(0)
    spell = collocations._spell

    def counted(shared):
        run = spell(shared)

        def tell(batches):
            for batch in run(batches):
                told.add(batch.num_rows)
                yield batch

        return tell

    monkeypatch.setattr(collocations, "_spell", counted)
    spark.conf.set("spark.sql.files.openCostInBytes", "64m")  # at most two files a task
    try:
        rows = [(i, f"a b c d e f g h i j. k{i}", "en") for i in range(400)]
        found = got_phrases(collocations.collocations(frame(spark, rows).repartition(8)))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found == phrases(rows, 2000, 10)
    # 17 phrases; 8 files in each of 4 shards, two a task, of which those of the first tell
    assert told.value <= 17 * 8


def test_collocations_long_text_and_empty_table(spark, monkeypatch):
    monkeypatch.setattr(collocations, "HASH_BYTES", 64)
    random = np.random.default_rng(6)
    long = " ".join(random.choice(["aa", "bb", "cc", "d.", "ee\n"], 600)) + " " + "w" * 200 + " aa bb cc"
    batch = list(collocations._grams([long, "aa bb", long], np.zeros(3, np.uint64)))
    assert len(batch) > 20
    for k in range(3):
        here = Counter(key for g in batch for key in g.keys[k][g.at[k]])
        (whole,) = [g for g in collocations_whole(long)]
        once = Counter(whole.keys[k][whole.at[k]])
        again = list(collocations._grams(["aa bb"], np.zeros(1, np.uint64)))[0]
        assert here == once + once + Counter(again.keys[k][again.at[k]])
    assert collocations.collocations(frame(spark, [(1, "a b", "en")]).limit(0)).count() == 0


def collocations_whole(long):
    before, collocations.HASH_BYTES = collocations.HASH_BYTES, 1 << 20
    try:
        return list(collocations._grams([long], np.zeros(1, np.uint64)))
    finally:
        collocations.HASH_BYTES = before


# --- 12 ----------------------------------------------------------------------


def components(rows, width, percent):
    sets = []
    for _, t, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0d]+", ascii_lower(t))
        sets.append({tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set())
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            group[root(i)] = root(j)
    out = []
    for i, (doc_id, *_) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        component = min(ids, default=None) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), component))
    return sorted(out, key=str)


def family(random, size, edits, words=150, shared=None):
    base = shared or [f"w{x}" for x in random.integers(0, 10**6, words)]
    for k in range(size):
        copy = list(base)
        for at in random.integers(0, len(copy), edits if isinstance(edits, int) else random.choice(edits)):
            copy[at] = f"v{random.integers(0, 10**6)}"
        yield " ".join(copy)


@pytest.fixture(scope="module")
def near(spark):
    """Families of near copies, a passage that many share, copies, odd rows."""
    random = np.random.default_rng(11)
    texts = list(family(random, 150, [0, 1, 2, 3, 4, 6]))
    passage = [f"p{x}" for x in range(100)]
    texts += [" ".join(passage + [f"q{x}" for x in random.integers(0, 10**6, 12)]) for _ in range(120)]
    texts += [texts[3]] * 10 + ["one", "One", "two words", None, "", " \n"] + [" ".join(f"s{x}" for x in range(9000))] * 2
    rows = [(int(i), t, "en") for i, t in zip(random.permutation(len(texts)), texts)] + [(None, texts[5], "en"), (None, "three words here", "en")]
    return rows + rows[-4:]


def test_setsketch_matches_brute_force(spark, near):
    rows = setsketch.near_duplicates(frame(spark, near)).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows), key=str) == components(near, 5, 85)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    assert setsketch.near_duplicates(frame(spark, near[:1]).limit(0)).count() == 0


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_jaccard_join_matches_brute_force_in_families(spark, near, width, percent):
    rows = ngram_jaccard.near_duplicate_components(frame(spark, near), width, percent).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows), key=str) == components(near, width, percent)


def test_copies_too_far_apart_never_meet(spark, monkeypatch):
    """Copies just above and just below the threshold to a hub make no pairs, and the same components."""
    random = np.random.default_rng(5)
    base = [f"w{x}" for x in random.integers(0, 10**6, 400)]
    texts = [" ".join(base), *family(random, 60, 1, shared=base[:-12]), *family(random, 60, 7, shared=base)]
    rows = [(i, t, "en") for i, t in enumerate(texts)]
    found = []
    remaining = meet.remaining_pairs

    def counted(*args):
        pairs = cut_lineage(remaining(*args))
        found.append(pairs.count())
        return pairs

    monkeypatch.setattr(meet, "remaining_pairs", counted)
    got = setsketch.near_duplicates(frame(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == components(rows, 5, 85)
    assert found and max(found) <= len(rows)


def test_components_leave_no_shuffle_files(spark):
    """Rounds of joins delete the shuffle files of the rounds before."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def held():
        files = disk.getAllFiles()
        names = (files.apply(i).getName() for i in range(files.size()))
        return {name for name in names if name.startswith("shuffle_") and name.endswith(".data")}

    before = held()
    links = spark.range(1, 40).selectExpr("id as a", "id - 1 as b")
    assert {tuple(r) for r in connected_components(links).collect()} == {(i, 0) for i in range(40)}
    left = held() - before
    for _ in range(50):
        if len(left) <= 10:
            break
        time.sleep(0.1)  # files go in the background
        left = held() - before
    assert len(left) <= 10


def test_registers_merge_and_estimate():
    random = np.random.default_rng(3)
    pool = random.integers(0, 2**63, 4000, dtype=np.uint64)
    for similarity in (0.0, 0.3, 0.6, 0.85, 0.95):
        errors = []
        for _ in range(20):
            pool = random.integers(0, 2**63, 4000, dtype=np.uint64)
            both = int(2000 * similarity)
            a, b = pool[: both + 1000], np.concatenate((pool[:both], pool[both + 1000 : both + 2000 - 500]))
            true = both / len(np.union1d(a, b))
            ra, rb, union = setsketch.registers([a, b, np.union1d(a, b)])
            assert (setsketch.merge(ra, rb) == union).all()
            errors.append(setsketch.similarity(ra[None], rb[None], np.array([float(len(a))]), np.array([float(len(b))]))[0] - true)
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.06
    assert (setsketch.registers([pool[:0]]) == 0).all()


def test_long_text_is_hashed_in_pieces(monkeypatch):
    random = np.random.default_rng(4)
    long = " \n".join(f"w{x}" for x in random.integers(0, 500, 4000)) + " " + "y" * 5000 + " end"
    whole = list(ngram_jaccard.shingle_sets([long], 5))[0]
    for module in (text, ngram_jaccard):
        monkeypatch.setattr(module, "HASH_BYTES", 1000)
    monkeypatch.setattr(text.cut_pieces, "__defaults__", (1000,))
    for width in (1, 3, 5):
        monkeypatch.setattr(ngram_jaccard, "HASH_BYTES", 1 << 30)
        whole = list(ngram_jaccard.shingle_sets([long], width))[0]
        monkeypatch.setattr(ngram_jaccard, "HASH_BYTES", 1000)
        assert (list(ngram_jaccard.shingle_sets([long], width))[0] == whole).all()


# --- 13 ----------------------------------------------------------------------


def ranked(rows, items, top):
    docs = [re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", ascii_lower(t)) for _, t, *_ in rows]
    n_docs, n_all = sum(map(bool, docs)), sum(map(len, docs))
    counts = [Counter(d) for d in docs]
    df = Counter(t for c in counts for t in c)
    out = []
    for item_id, t in items:
        scored = []
        for (doc_id, *_), d, c in zip(rows, docs, counts):
            score = 0
            for term in re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", ascii_lower(t)):
                if c[term]:
                    m = 25 + 75 * len(d) * n_docs // n_all
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += w * (1000000000 * c[term] // (1000 * c[term] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, r, None if no else i, -s) for r, (s, no, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def test_search_matches_brute_force(spark):
    random = np.random.default_rng(8)
    words = ["Alpha", "beta", "ÉTÉ", "été", "7", "x-ray", "delta", "日本", "eps", "zeta"]
    rows = [
        (int(i) if i % 11 else None, " ".join(words[min(int(random.exponential(3)), 9)] for _ in range(random.integers(0, 40))), "en")
        for i in range(300)
    ]
    rows += rows[:20] + [(400, None, "en"), (401, " -- ", "en"), (402, "delta " * 300, "en")]
    items = [(1, "alpha BETA beta"), (2, "été 日本, zeta; zeta"), (2, "été 日本, zeta; zeta"), (None, "eps"), (4, None), (5, "?"), (6, "unknown words"), (7, "x ray 7")]
    docs, table = frame(spark, rows), spark.createDataFrame(items, "item_id bigint, text string")
    want = ranked(rows, items, 10)
    for block_bytes in (4 << 20, 100):
        got = lexical_search.rank_documents(docs, table, block_bytes=block_bytes).collect()
        assert sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got), key=str) == want
    assert lexical_search.rank_documents(docs.limit(0), table).count() == 0
    assert lexical_search.rank_documents(docs, table.limit(0)).count() == 0


def test_search_leaves_masks_that_cannot_enter():
    random = np.random.default_rng(9)
    gains = np.where(random.random((12, 5000)) < 0.3, random.integers(1, 1000, (12, 5000)), 0)
    repeats, ids, no_id = random.integers(1, 4, 12), np.arange(5000), np.zeros(5000, bool)
    best = lexical_search.Best(10)
    scored = lexical_search.search_block(gains, ids, no_id, np.arange(12), repeats, best)
    scores = repeats @ gains
    order = np.lexsort((ids, -scores))[:10]
    assert (best.ids == order).all() and (best.scores == scores[order]).all() and scored < 2500


def test_lengths_past_64_bits():
    sizes = np.array([10**12, 3])
    norms = lexical_search.length_norms(sizes, 10**10, 10**13)
    assert list(norms) == [25 + 75 * 10**12 * 10**10 // 10**13, 25 + 75 * 3 * 10**10 // 10**13]
