"""The pipeline's stages against plain Python, and the filters on columns with clashing names."""

from __future__ import annotations

import collections
import itertools
import random
import re
import tracemalloc

import pytest

import corpus_pipeline
from corpusmill.llm import language_id, ngram_jaccard, quality_rules
from corpusmill.llm.decontaminate import Windows, contamination, drop_contaminated, find_windows, hits_by_document

EN = "the river ran past old mill and every evening someone walked along its bank to look at water while birds sang over quiet fields".split()
FR = "la rivière passait devant le vieux moulin et chaque soir quelqu'un marchait sur sa rive pour regarder les oiseaux dans champs calmes".split()


def prose(rng, words, n):
    return " ".join(rng.choice(words) + str(rng.randrange(30)) * (rng.random() < 0.3) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng, rows = random.Random(3), []
    items = [(i, " ".join(f"q{i}x{k}" for k in range(14))) for i in range(5)]
    for i in range(240):
        words, lang = ((EN, "en"), (FR, "fr"))[i % 2]
        text = prose(rng, words, 120)
        if i % 20 == 3:
            text = "too short"
        if i % 20 == 7:
            text = "$$ ## " * 100
        if i % 20 == 9 and rows:
            text = rows[i - 8][1]  # a copy
        if i % 20 == 11:
            copy = rows[i - 10][1].split()
            copy[50] = "changed"
            text = " ".join(copy)
        if i % 20 == 13:
            text = text + " " + items[i % 5][1] + " " + prose(rng, words, 5)
        rows.append((i, text, lang, "s", len(text)))
    rows += [(900, None, "en", "s", 0), (901, "", None, None, None), rows[0]]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def test_stages_keep_what_plain_python_keeps(spark, tables):
    path, rows, items = tables
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = corpus_pipeline.quality(spark, docs, path)
    text = {r[0]: r[1] for r in rows}

    def good(t):
        words = (t or "").split()
        windows = collections.Counter(zip(words, words[1:], words[2:]))
        repeat = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
        return len(words) >= 50 and 100 * len(repeat) <= 50 * len(words) and 10 * len(re.findall(r"[#*$%&|<>]", t)) <= len(words)

    ids = sorted(r["doc_id"] for r in kept.collect())
    assert ids == sorted(r[0] for r in rows if good(r[1])) and 200 < len(ids) < len(rows)

    known = corpus_pipeline.language(spark, kept, path)
    assert sorted(r["doc_id"] for r in known.collect()) == ids  # clean texts of languages it has learned

    unique = corpus_pipeline.near_duplicates(spark, known, path)
    sets = {i: set(zip(*[spaced(text[i])[k:] for k in range(5)])) for i in ids}
    group = {i: i for i in sets}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, j in itertools.combinations(sorted(sets), 2):
        if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            group[max(root(i), root(j))] = min(root(i), root(j))
    want = sorted({root(i) for i in sets})
    assert sorted(r["doc_id"] for r in unique.collect()) == want and len(want) < len(ids)

    clean = corpus_pipeline.decontaminate(spark, unique, path)
    lines = [tuple(t.split()[k : k + 10]) for _, t in items for k in range(5)]
    hit = {i for i in want if any(" ".join(line) in " ".join(re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text[i].lower())) for line in lines)}
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(set(want) - hit) and hit
    assert clean.columns == docs.columns

    done = corpus_pipeline.run(spark, path)
    assert sorted(r["doc_id"] for r in done.collect()) == sorted(set(want) - hit)


def test_stages_on_an_empty_table(spark, tables):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, tables[0]).count() == 0


def test_filters_keep_columns_with_their_own_names(spark):
    long = " ".join(f"w{i}" for i in range(80))
    row = (1, long, "mine", "id", "p", "md5", 3.5)
    docs = spark.createDataFrame([row], "doc_id bigint, text string, text_md5 string, _id string, _p string, _corpusmill_md5 string, n double")
    items = spark.createDataFrame([(1, "none of these words")], "item_id bigint, text string")
    for kept in (drop_contaminated(docs, items), ngram_jaccard.keep_first(docs, 5, 80), quality_rules.keep_good(docs)):
        assert [tuple(r) for r in kept.collect()] == [row] and kept.columns == docs.columns


def test_order_of_rules_never_changes_what_is_kept(spark):
    rng = random.Random(5)
    texts = [prose(rng, EN, rng.randrange(1, 90)) + " $" * rng.randrange(0, 30) + "\na\na" * rng.randrange(0, 40) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    names = [rule.name for rule in quality_rules.production_rules()]
    kept = set()
    for order in (names, names[::-1], names[3:] + names[:3]):
        judged = quality_rules.apply_rules(docs, order=order)
        kept.add(tuple(sorted(r["doc_id"] for r in judged.where("failed_rule is null").collect())))
    assert len(kept) == 1 and kept == {tuple(sorted(r["doc_id"] for r in quality_rules.keep_good(docs).collect()))}


@pytest.mark.parametrize("window", [5, 10, 30])
def test_broadcast_and_shuffled_windows_find_the_same(spark, window):
    rng = random.Random(window)
    words = [f"t{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(words) for _ in range(40))) for i in range(4)] + [(7, "lone"), (8, "t1 t2"), (9, None)]
    rows = []
    for i in range(40):
        mine = [rng.choice(words) for _ in range(50)]
        source = items[i % 6][1].split()
        at = rng.randrange(0, max(1, len(source) - window))
        mine[20:20] = source[at : at + window + i % 3]
        rows.append((i, " ".join(mine)))
    docs, table = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    want = {}
    for doc_id, t in rows:
        mine, hit, found = t.split(), set(), set()
        for item_id, it in items:
            whole = (it or "").split()
            for k in range(max(1, len(whole) - window + 1) if whole else 0):
                part = whole[k : k + window]
                for at in range(len(mine) - len(part) + 1):
                    if mine[at : at + len(part)] == part:
                        hit |= set(range(at, at + len(part)))
                        found.add(item_id)
        want[doc_id] = (len(hit), found)
    for small in (True, False):
        windows = Windows(docs, table, window)
        windows.small = small
        got = {r["doc_id"]: (r["n_hit"], set(r["item_ids"])) for r in hits_by_document(find_windows(docs, windows)).collect()}
        assert got == {i: w for i, w in want.items() if w[0]}
    rows = contamination(docs, table, window).collect()
    assert {r["doc_id"]: (r["n_hit"], set(r["item_ids"])) for r in rows} == want


def test_network_holds_states_of_few_segments():
    """The pipeline's language stage went over its memory: a worker's states stay in a few megabytes."""
    network = language_id.ByteNetwork(["de", "en", "fr"])
    items = [bytes([97 + i % 26]) * 31 for i in range(4096)]
    tracemalloc.start()
    network.position_sums(items)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10_000_000
