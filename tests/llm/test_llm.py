"""Small cases and brute-force comparisons of the llm operators."""

from __future__ import annotations

import collections
import hashlib
import math

import pytest

from corpusmill.llm import bpe_chunks, language_id, licenses, lm_scoring, ngram_jaccard, quality_classifier
from corpusmill.llm import quality_rules, sharding, token_counts
from corpusmill.llm.decontaminate import contamination, drop_contaminated

LONG = " ".join(f"w{i}" for i in range(9000))
PROSE = "The river ran past the old mill and every evening someone walked along its bank to look at the water. " * 1
ROWS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "One two"), (5, PROSE), (5, PROSE), (6, PROSE + "Then night fell."),
    (None, "A line without an id\nA line without an id"), (7, "É " + PROSE.upper()), (8, LONG), (9, LONG + " end"), (10, "日本語のテキスト 😀"),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and long texts, repeated rows and columns with clashing names."""
    return spark.createDataFrame(
        [(i, t, "en" if i and i % 2 else "fr", "w", 3, "x") for i, t in ROWS],
        "doc_id bigint, text string, lang string, n_words string, n int, text_md5 string",
    )


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def by_id(rows):
    return {r["doc_id"]: r for r in rows}


def test_quality_rules(docs, empty):
    rows = quality_rules.quality_report(docs).collect()
    assert len(rows) == len(ROWS) and quality_rules.quality_report(empty).count() == 0
    got = by_id(rows)
    assert (got[1]["n_words"], got[1]["base_failed"], got[1]["kept"]) == (0, True, False)
    assert got[None]["n_dup_lines"] == 1 and got[8]["n_words"] == 9000 and got[8]["kept"]
    assert set(quality_rules.keep_good(docs).columns) == set(docs.columns)


def test_repeated_windows_match_brute_force(spark):
    texts = ["a b c a b c", "a a a a", "x y z", "p q r s p q r t p q", "a b c d e f g"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for row in quality_rules.quality_report(frame).collect():
        words = texts[row["doc_id"]].split()
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
        assert row["n_repeat_words"] == len(inside)


def test_licenses(spark, docs, empty):
    assert licenses.license_scan(docs).count() == len(ROWS) and licenses.license_scan(empty).count() == 0
    frame = spark.createDataFrame(
        [(1, "Code under the MIT license, under the MIT-License."), (2, "Licensed under the APACHE License, Version 2.0."), (3, None)],
        "doc_id bigint, text string",
    )
    got = by_id(licenses.license_scan(frame).collect())
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["last_word"], got[1]["base_labels"]) == (2, 1, 5, "mit")
    assert got[2]["labels"] == "apache-2" and got[2]["score"] == 1.0
    assert (got[3]["n_base"], got[3]["first_word"], got[3]["labels"], got[3]["score"]) == (0, None, "", 0.0)


def test_wrapped_license_notices(spark):
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are\nmet:"
    mit = "# Permission is hereby granted, free of charge, to any\n# person obtaining a copy of this software\n# and associated documentation files"
    texts = [
        bsd, mit, "One two.\n" * 50 + mit + "\nmore", "Licensed\nunder\nthe Apache\nLicense,\nVersion 2.0",
        "Redistribution and use\n" + "other words here " * 20 + "\nin source and binary forms, with or without modification",
        "released\nunder one of the hills,\nfar from the licence",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = licenses.license_scan(frame).collect()
    got = by_id(rows)
    assert len(rows) == len(texts)
    assert [got[i]["labels"] for i in range(len(texts))] == ["bsd", "mit", "mit", "apache-2", "", ""]
    assert [got[i]["score"] for i in range(len(texts))] == [1.0, 1.0, 1.0, 1.0, 0.0, 0.0]
    # every line and every window, counted one by one
    for doc_id, text in enumerate(texts):
        words, best = licenses.notice_words(text), 0.0
        for number, _, known in licenses.template_words():
            span = len(licenses.notice_words(licenses.TEMPLATES[number][1]))
            blocks = [licenses.notice_words(line) for line in text.split("\n")]
            blocks += [words[i : i + span] for i in range(max(1, len(words) - span + 1))]
            best = max([best, *(len({*known} & {*b}) / len(known) for b in blocks)])
        assert got[doc_id]["score"] == (best if best >= licenses.THRESHOLD else 0.0)


@pytest.mark.parametrize("text", ["a b", "a b c", "a b c d"])
def test_lone_short_text_has_one_wide_shingle(text):
    long = " ".join(f"w{i}" for i in range(20))
    (alone,) = ngram_jaccard.shingle_sets([text], 5)
    assert len(alone) == 1 and list(alone) == list(list(ngram_jaccard.shingle_sets([long, text], 5))[1])


def _components(rows, width, percent):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set()))
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return sets, group


def test_near_duplicates_match_brute_force(spark, docs, empty):
    base = [f"t{i}" for i in range(60)]
    rows = [(i, t) for i, (_, t) in enumerate(ROWS)]
    for i in range(40):  # a family of near copies, chained by one word each
        words = list(base)
        words[i] = f"changed{i}"
        rows.append((100 + i, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    for width, percent in ((3, 90), (5, 80)):
        sets, group = _components(rows, width, percent)
        got = by_id(ngram_jaccard.near_duplicate_components(frame, width, percent).collect())
        for k, (doc_id, _) in enumerate(rows):
            want = min(rows[m][0] for m in range(len(rows)) if group[m] == group[k])
            assert (got[doc_id]["component_id"], got[doc_id]["n_shingles"]) == (want, len(sets[k]))
        kept = ngram_jaccard.keep_first(frame, width, percent)
        assert kept.count() == len({g for g, s in zip(group, sets) if s}) + sum(not s for s in sets)
    assert ngram_jaccard.near_duplicate_components(docs).count() == len(ROWS)
    assert ngram_jaccard.near_duplicate_components(empty).count() == 0


def test_sharding(docs, empty):
    rows = sharding.assign_shards(docs, 40).collect()
    assert len(rows) == len(ROWS) and sharding.assign_shards(empty, 40).count() == 0
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 40)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert by_id(rows)[1]["size"] == 16 and by_id(rows)[1]["text_crc32"] == 0


def test_quality_classifier(spark, docs, empty):
    labels = spark.createDataFrame([(4, 0), (5, 1), (None, 1), (6, None)], "doc_id bigint, quality int")
    rows = quality_classifier.classify(docs, labels).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert quality_classifier.classify(empty, labels.limit(0)).count() == 0


def test_bpe_chunks_give_the_library_s_ids(spark, empty):
    import public_tokenizers
    import tiktoken

    path = bpe_chunks.default_path()
    whole = tiktoken.Encoding(
        "t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_chunks.load_ranks(path), special_tokens={}
    )
    texts = [t for _, t in ROWS] + ["a" * 500 + " b" * 300, " " * 400 + "x", "it's  \n\n  so" * 60]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for chunk, overlap in ((bpe_chunks.CHUNK_CHARS, bpe_chunks.OVERLAP_CHARS), (64, 16)):
        coded = bpe_chunks.encode(frame, path, chunk, overlap).withColumn("decoded", bpe_chunks.decode_ids(path)("ids"))
        for r in bpe_chunks.digest(coded).collect():
            text = texts[r["doc_id"]] or ""
            ids = whole.encode_ordinary(text)
            assert r["n_tokens"] == len(ids)
            assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
            assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe_chunks.digest(bpe_chunks.encode_decode(empty)).count() == 0


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_scores_match_brute_force(spark, empty, order):
    texts = [t for _, t in ROWS]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    words = [(t or "").encode().lower().split() for t in texts]
    grams = lambda ws, n: collections.Counter(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1))
    everywhere = [sum((grams(w, n) for w in words), collections.Counter()) for n in range(1, order + 1)]
    total = sum(map(len, words))
    got = by_id(lm_scoring.lm_scores(frame, order, block_bytes=20_000).collect())
    for k, ws in enumerate(words):
        own, score = [grams(ws, n) for n in range(1, order + 1)], 0.0
        outside = lambda g: everywhere[len(g) - 1][g] - own[len(g) - 1][g]  # noqa: E731, B023
        for i in range(len(ws)):
            longest = min(order, i + 1)
            for n in range(longest, 0, -1):
                g = tuple(ws[i - n + 1 : i + 1])
                if n == 1:
                    score += math.log((outside(g) or lm_scoring.UNSEEN) / max(1, total - len(ws)))
                elif outside(g):
                    score += math.log(outside(g) / outside(g[:-1]))
                else:
                    score += math.log(lm_scoring.BACKOFF)
                    continue
                break
        assert got[k]["n_words"] == len(ws) and got[k]["log_score"] == pytest.approx(score, rel=1e-9)
    assert lm_scoring.lm_scores(empty).count() == 0


def test_decontamination(spark, docs, empty):
    item = "every evening someone walked along its bank to look at the water"
    items = spark.createDataFrame([(1, item), (2, "one TWO"), (3, ""), (4, None), (5, "absent words")], "item_id bigint, text string")
    got = by_id(contamination(docs, items).collect())
    assert (got[5]["n_hit"], got[5]["item_ids"]) == (12, [1]) and got[4]["n_hit"] == 2
    assert got[1]["n_words"] == 0 and got[8]["n_hit"] == 0
    assert contamination(docs, items).count() == len(ROWS) and contamination(empty, items).count() == 0
    assert contamination(docs, items.limit(0)).where("n_hit > 0").count() == 0
    assert drop_contaminated(docs, items).columns == docs.columns


def test_token_counts_match_the_library(docs, empty):
    from tokenizers import Tokenizer

    path = token_counts.default_path()
    library = Tokenizer.from_file(path)
    for r in token_counts.token_counts(docs, path).collect():
        texts = {t or "" for i, t in ROWS if i == r["doc_id"]}
        assert r["n_tokens"] in {len(library.encode(t, add_special_tokens=False).ids) for t in texts}
    assert token_counts.token_counts(empty, path).count() == 0


def test_language_id(spark, docs, empty):
    words = {"en": "the and of with this from that which", "de": "der und nicht eine auch werden über ist"}
    rows = [(i, " ".join(words[lang].split()[(i + k) % 8] for k in range(30)), lang) for i in range(200) for lang in [("en", "de")[i % 2]]]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    network = language_id.train(frame, 200, 4000)
    got = language_id.predict(frame, network).where("held_out").collect()
    assert got and all(r["lang_pred"] == ("en", "de")[r["doc_id"] % 2] for r in got)
    odd = by_id(language_id.predict(docs, network).collect())
    assert odd[1]["lang_pred"] == odd[2]["lang_pred"] == "und" and language_id.predict(empty, network).count() == 0
    assert language_id.train(empty) is None and language_id.predict(docs, None).count() == len(ROWS)
