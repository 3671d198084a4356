"""Operator 9, token counts: whole tokens are looked up, only the rest is merged.

``prove_whole_tokens`` encodes every vocabulary string alone, once, on the
driver: those that come back as the single id of their own are whole tokens
(bounded by the vocabulary).  In a text, words between ASCII white space are
encoded independently of each other, as no pre-token crosses white space and
normalisation does not look over it.  So a word that is a whole token counts as
one, and any other is encoded by the library once per worker and remembered.

Defined cases: a null text counts as empty, 0 tokens; a text that holds a
special token's string goes to the library whole, since such strings are cut
out before anything else; repeated rows are counted one by one; columns beside
(doc_id, text) are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.text import in_pieces, whole

TOKEN_LIMIT = 2048
#: words remembered by a worker before it forgets them all
MEMO_WORDS = 400_000
_LOADED: dict[str, tuple] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def prove_whole_tokens(path: str) -> list[str]:
    """Strings that the tokenizer turns into exactly one token which stands for just that string."""
    tokenizer = _tokenizer(path)
    vocabulary = tokenizer.get_vocab()
    special = {token.content for token in tokenizer.get_added_tokens_decoder().values()}
    candidates = [piece.removesuffix("</w>") for piece in vocabulary if piece.endswith("</w>") and piece not in special]
    # only ASCII strings stand for themselves in a byte-level vocabulary; others are merged like any word
    candidates = [c for c in candidates if c and c.isascii() and c.isprintable() and " " not in c]
    encoded = tokenizer.encode_batch(candidates, add_special_tokens=False)
    return sorted(c for c, e in zip(candidates, encoded) if len(e.ids) == 1 and e.ids[0] == vocabulary[c + "</w>"])


def _tokenizer(path: str):
    """As the file has it, but without truncation or padding."""
    if path not in _LOADED:
        from tokenizers import Tokenizer

        loaded = Tokenizer.from_file(path)
        loaded.no_truncation()
        loaded.no_padding()
        special = [token.content for token in loaded.get_added_tokens_decoder().values()]
        _LOADED[path] = (loaded, special, {})
    return _LOADED[path][0]


def count_tokens(path: str, whole_tokens: list[str]):
    """Column function: number of tokens of a non-null text."""

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = _tokenizer(path)
        _, special, memo = _LOADED[path]
        certain = dict.fromkeys((w.encode() for w in whole_tokens), 1)
        if not memo:
            memo.update(certain)

        def merged(items: list[str]) -> list[int]:
            return [len(e.ids) for e in tokenizer.encode_batch(items, add_special_tokens=False)]

        for texts in batches:
            out: list[int] = []
            raw = [t.encode() for t in texts]
            for first, last in in_pieces(raw):
                odd = {i for i in range(first, last) if any(s in texts.iloc[i] for s in special)}
                own = {i: raw[i].split() for i in range(first, last) if i not in odd}
                found = dict.fromkeys(w for words in own.values() for w in words)
                new = [w for w in found if w not in memo]
                if len(memo) + len(new) > MEMO_WORDS:
                    memo.clear()
                    memo.update(certain)
                    new = [w for w in found if w not in memo]
                if new:
                    memo.update(zip(new, merged([w.decode() for w in new])))
                for i in range(first, last):
                    out.append(merged([texts.iloc[i]])[0] if i in odd else sum(map(memo.__getitem__, own[i])))
            yield pd.Series(out, dtype="int64")

    return count


def token_counts(docs: DataFrame, path: str | None = None, limit: int = TOKEN_LIMIT) -> DataFrame:
    """Rows (doc_id, n_bytes, n_tokens, over_limit), one per document."""
    path = path or default_path()
    text: Column = whole(F.col("text"))
    counted = docs.select(
        "doc_id", F.octet_length(text).cast("bigint").alias("n_bytes"),
        count_tokens(path, prove_whole_tokens(path))(text).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
