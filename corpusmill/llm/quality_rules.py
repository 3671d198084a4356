"""Operator 1, quality rules: a short-circuit cascade ordered by measured cost and selectivity.

``rule_order`` runs every rule over a sample, takes its seconds and the share it
rejects, and sorts by rejections per second.  ``first_failed`` is one CASE in
that order: a row leaves it at the first rule that rejects it, so later and
dearer rules are not evaluated for it.  The order changes the work and the rule
that is named, never which rows are kept.

Defined cases: a null or empty text has no words and fails ``few_words``; repeated
rows are judged one by one; extra columns pass through ``apply_rules``.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.text import SPACE_CHARS, once, space_words, whole

#: rows of the sample on which costs and selectivities are measured
SAMPLE_ROWS, SAMPLE_SEED = 2000, 17
MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"


def without(text: Column, chars: str) -> Column:
    """The text without some ASCII characters; plain byte searches, much cheaper than a pattern."""
    for char in chars:
        text = F.replace(text, F.lit(char), F.lit(""))
    return text


def n_words(text: Column) -> Column:
    return F.size(space_words(text)).cast("bigint")


def word_chars(text: Column) -> Column:
    return F.length(without(text, SPACE_CHARS)).cast("bigint")


def n_symbols(text: Column) -> Column:
    """The symbols are ASCII, so what their removal takes in bytes is their number."""
    return (F.octet_length(text) - F.octet_length(without(text, SYMBOLS))).cast("bigint")


def _full_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def n_lines(text: Column) -> Column:
    return F.size(_full_lines(text)).cast("bigint")


def n_dup_lines(text: Column) -> Column:
    lines = _full_lines(text)
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint")


def n_repeat_words(words: Column) -> Column:
    """Words inside three-word windows that the text has at least twice.

    Window hashes are compared first; only a text with equal ones sorts them
    with their places, so the work is n log n for any text.
    """

    def window(w: Column, i: Column) -> Column:
        return F.xxhash64(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1))

    def covered(ordered: Column) -> Column:
        def again(x: Column, k: Column) -> Column:
            same = lambda other: F.coalesce(F.get(ordered, other)["h"] == x["h"], F.lit(False))
            return same(k - 1) | same(k + 1)

        places = F.transform(F.filter(ordered, again), lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))
        return F.size(F.array_distinct(F.flatten(places)))

    def count(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(once(F.sort_array(pairs), covered))

    def hashed(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(w) - 2), lambda i: window(w, i))
        return F.when(F.size(w) < 4, 0).otherwise(once(hashes, count))

    return once(words, hashed).cast("bigint")


@dataclass(frozen=True)
class Rule:
    """``rejects`` is true for a row to be rejected; never null."""

    name: str
    rejects: Column


def statistics(text: Column) -> dict[str, Column]:
    """The counts that the rules compare, of a non-null text."""
    words = once(space_words(text), lambda w: F.struct(F.size(w).cast("bigint").alias("n"), n_repeat_words(w).alias("repeat")))
    return {
        "words": words,
        "word_chars": word_chars(text),
        "n_symbols": n_symbols(text),
        "n_dup_lines": n_dup_lines(text),
    }


def production_rules(text: Column | None = None, have: dict[str, Column] | None = None) -> list[Rule]:
    """Thresholds lie well outside what ordinary prose shows.

    ``have`` gives statistics that the caller has as columns already.
    """
    t = whole(F.col("text") if text is None else text)
    s = {"n_words": n_words(t), "n_repeat_words": n_repeat_words(space_words(t)), **statistics(t), **(have or {})}
    return [
        Rule("few_words", s["n_words"] < MIN_WORDS),
        Rule("repeated_windows", 100 * s["n_repeat_words"] > 50 * s["n_words"]),
        Rule("symbols", 10 * s["n_symbols"] > s["n_words"]),
        Rule("repeated_lines", 2 * s["n_dup_lines"] > n_lines(t)),
        Rule("word_length", (s["word_chars"] < 2 * s["n_words"]) | (s["word_chars"] > 20 * s["n_words"])),
        Rule("capitals", 10 * F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")) > 4 * s["word_chars"]),
    ]


def rule_order(docs: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[tuple[str, float, float]]:
    """(rule, seconds, share rejected) over about ``sample_rows`` random rows, best rejection per second first."""
    share = min(1.0, sample_rows / max(1, docs.count()))
    sample = docs.sample(share, seed=SAMPLE_SEED).cache()
    try:
        rows = sample.count()
        measured = []
        for rule in rules:
            seconds = float("inf")
            for _ in range(2):  # the first run also compiles
                began = time.perf_counter()
                rejected = sample.agg(F.count_if(rule.rejects)).first()[0]
                seconds = min(seconds, time.perf_counter() - began)
            measured.append((rule.name, seconds, rejected / max(1, rows)))
    finally:
        sample.unpersist()
    return sorted(measured, key=lambda m: (-m[2] / max(m[1], 1e-9), m[1], m[0]))


def first_failed(rules: list[Rule], order: list[str]) -> Column:
    """Name of the first rule that rejects the row, null if none does."""
    by_name = {rule.name: rule for rule in rules}
    case = F
    for name in order:
        case = case.when(by_name[name].rejects, F.lit(name))
    return case.otherwise(F.lit(None).cast("string"))


def apply_rules(
    docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS, order: list[str] | None = None
) -> DataFrame:
    """``docs`` with ``failed_rule`` (replacing a column of that name)."""
    rules = production_rules() if rules is None else rules
    order = order or [name for name, _, _ in rule_order(docs, rules, sample_rows)]
    return docs.withColumn("failed_rule", first_failed(rules, order))


def quality_report(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: its counts, the base verdict and the cascade's.

    The counts are wanted for every row here, so the rules read them as columns
    and the cascade saves what the remaining rules would cost.
    """
    docs = docs.select("doc_id", "text")
    order = [name for name, _, _ in rule_order(docs, production_rules(), sample_rows)]
    counted = docs.withColumns({f"_{k}": v for k, v in statistics(whole(F.col("text"))).items()})
    have = {"n_words": F.col("_words.n"), "n_repeat_words": F.col("_words.repeat")}
    have |= {k: F.col(f"_{k}") for k in ("word_chars", "n_symbols", "n_dup_lines")}
    judged = apply_rules(counted, production_rules(have=have), order=order)
    base_failed = (have["n_words"] < MIN_WORDS) | (100 * have["n_repeat_words"] > 50 * have["n_words"])
    return judged.select(
        "doc_id", *[v.alias(k) for k, v in have.items()],
        base_failed.alias("base_failed"), F.col("failed_rule").isNull().alias("kept"),
    )


def keep_good(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that no rule rejects, with their own columns."""
    order = [name for name, _, _ in rule_order(docs.select("text"), production_rules(), sample_rows)]
    text = whole(F.col("text"))

    def failed(words: Column) -> Column:
        return first_failed(production_rules(have={"n_words": words["n"], "n_repeat_words": words["repeat"]}), order)

    return docs.where(once(statistics(text)["words"], failed).isNull())
