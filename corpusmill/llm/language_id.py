"""Operator 10, language ID: a bidirectional gated recurrent network over bytes.

Two gated recurrences, one from either side, read the bytes of a segment; each
position is labelled by a softmax over both states, and a document's
probabilities are the mean over its positions.  A segment is a word with the
space before it, cut every ``MAX_STEPS`` bytes; states start anew with it.  So
equal segments have equal labels, and a worker runs the network once for each
that it remembers.  Training is backpropagation through time in numpy on a
bounded sample of labelled documents.

Defined cases: a text that is null or has no letter is ``und`` with score 0, as
is every text if there is nothing to learn from; rows with a null doc_id are
held out; repeated rows are predicted one by one; columns beside (doc_id, text,
lang) are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.text import ROW, in_pieces, whole

UNKNOWN = "und"
#: bounds of the sample: documents, and segments drawn from them
TRAIN_DOCS, TRAIN_SEGMENTS = 4000, 60_000
HIDDEN, MAX_STEPS, EPOCHS, BATCH, RATE = 16, 32, 3, 256, 0.01
#: segments the network labels at once: their states are held for all positions
RUN_SEGMENTS = 512
#: segments remembered by a worker before it forgets them all
MEMO_SEGMENTS = 400_000
#: in the pipeline, documents of less certain language go
MIN_SCORE = 0.3


def held_out(doc_id: Column) -> Column:
    """Ids whose CRC-32 as text is divisible by 5; null ids are never learned from."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(True))


def segments(text: bytes) -> list[bytes]:
    """Words of a text, each with one space before it, in pieces of MAX_STEPS bytes."""
    out = []
    for word in text.split():
        if len(word) < MAX_STEPS:
            out.append(word)
        else:
            out += [word[i : i + MAX_STEPS - 1] for i in range(0, len(word), MAX_STEPS - 1)]
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class ByteNetwork:
    """Weights per direction: input [256, 3H] with bias, recurrent [H, 2H] and [H, H]; output [2H, K]."""

    def __init__(self, classes: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng, h = np.random.default_rng(seed), hidden
        self.classes, self.h = classes, h
        self.w: dict[str, np.ndarray] = {}
        for side in "fb":
            self.w[f"x{side}"] = rng.normal(0, 0.3, (256, 3 * h))
            self.w[f"g{side}"] = rng.normal(0, h**-0.5, (h, 2 * h))
            self.w[f"c{side}"] = rng.normal(0, h**-0.5, (h, h))
        self.w["out"] = rng.normal(0, (2 * h) ** -0.5, (2 * h, len(classes)))
        self.w["bias"] = np.zeros(len(classes))
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}

    def _run(self, x: np.ndarray, side: str, keep: list | None = None) -> np.ndarray:
        """States [T, B, H] of sequences x [T, B]."""
        wx, wg, wc, n = self.w[f"x{side}"], self.w[f"g{side}"], self.w[f"c{side}"], self.h
        state = np.zeros((x.shape[1], n), np.float32)
        states = np.empty((*x.shape, n), np.float32)
        for t in range(len(x)):
            inputs = wx[x[t]]
            gates = _sigmoid(inputs[:, : 2 * n] + state @ wg)
            update, reset = gates[:, :n], gates[:, n:]
            held = reset * state
            fresh = np.tanh(inputs[:, 2 * n :] + held @ wc)
            if keep is not None:
                keep.append((state, update, reset, held, fresh))
            state = state + update * (fresh - state)
            states[t] = state
        return states

    def _labels(self, x: np.ndarray, keep: tuple[list, list] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities [T, B, K] and both states; all sequences of a batch have the same length."""
        forward = self._run(x, "f", keep and keep[0])
        backward = self._run(x[::-1], "b", keep and keep[1])[::-1]
        both = np.concatenate((forward, backward), axis=2)
        scores = both @ self.w["out"] + self.w["bias"]
        scores = np.exp(scores - scores.max(axis=2, keepdims=True))
        return scores / scores.sum(axis=2, keepdims=True), both

    def position_sums(self, items: list[bytes]) -> np.ndarray:
        """[n, K + 1]: probabilities summed over a segment's positions, and their number."""
        out = np.empty((len(items), len(self.classes) + 1), np.float32)
        lengths = np.fromiter(map(len, items), np.int64, len(items))
        order = np.argsort(lengths, kind="stable")
        for run in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
            for at in range(0, len(run), RUN_SEGMENTS):
                some = run[at : at + RUN_SEGMENTS]
                x = np.frombuffer(b"".join(b" " + items[i] for i in some), np.uint8).reshape(len(some), -1).T
                out[some, :-1] = self._labels(x)[0].sum(axis=0)
                out[some, -1] = len(x)
        return out

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy over all positions, by backpropagation through time."""
        kept: tuple[list, list] = ([], [])
        p, both = self._labels(x, kept)
        n, grads = self.h, {k: np.zeros_like(v) for k, v in self.w.items()}
        d = p.copy()
        d[:, np.arange(len(y)), y] -= 1
        d /= x.size
        grads["out"] = both.reshape(-1, 2 * n).T @ d.reshape(-1, d.shape[2])
        grads["bias"] = d.sum(axis=(0, 1))
        d_both = d @ self.w["out"].T
        for side, steps, xs, ds in (("f", kept[0], x, d_both[:, :, :n]), ("b", kept[1], x[::-1], d_both[::-1, :, n:])):
            wg, wc = self.w[f"g{side}"], self.w[f"c{side}"]
            d_state = np.zeros((x.shape[1], n), np.float32)
            for t in range(len(xs) - 1, -1, -1):
                state, update, reset, held, fresh = steps[t]
                d_state = d_state + ds[t]
                d_fresh = d_state * update * (1 - fresh**2)
                d_update = d_state * (fresh - state) * update * (1 - update)
                d_held = d_fresh @ wc.T
                d_reset = d_held * state * reset * (1 - reset)
                d_gates = np.concatenate((d_update, d_reset), axis=1)
                grads[f"c{side}"] += held.T @ d_fresh
                grads[f"g{side}"] += state.T @ d_gates
                np.add.at(grads[f"x{side}"], xs[t], np.concatenate((d_gates, d_fresh), axis=1))
                d_state = d_state * (1 - update) + d_held * reset + d_gates @ wg.T
        return grads

    def fit(self, items: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> ByteNetwork:
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        by_length: dict[int, list[int]] = {}
        for i, item in enumerate(items):
            by_length.setdefault(len(item), []).append(i)
        step = 0
        for epoch in range(epochs):
            batches = []
            for places in by_length.values():
                places = rng.permutation(places)
                batches += [places[i : i + BATCH] for i in range(0, len(places), BATCH)]
            for k in rng.permutation(len(batches)):
                some, step = batches[k], step + 1
                x = np.frombuffer(b"".join(b" " + items[i] for i in some), np.uint8).reshape(len(some), -1).T
                rate = RATE * (1 - epoch / epochs) * np.sqrt(len(some) / BATCH)
                for name, g in self.gradients(x, labels[some]).items():
                    first[name] = 0.9 * first[name] + 0.1 * g
                    second[name] = 0.99 * second[name] + 0.01 * g * g
                    scale = np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                    self.w[name] -= (rate * scale * first[name] / (np.sqrt(second[name]) + 1e-7)).astype(np.float32)
        return self


def _draw_segments(most: int):
    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            drawn = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                own = segments(text.encode())
                if len(own) > most:
                    rng = np.random.default_rng(abs(int(doc_id)))
                    own = [own[i] for i in rng.choice(len(own), most, replace=False)]
                drawn.append(own)
            yield pd.DataFrame({"rank": batch["rank"], "doc_id": batch["doc_id"], "lang": batch["lang"], "segments": drawn})

    return draw


def training_sample(docs: DataFrame, n_docs: int = TRAIN_DOCS, n_segments: int = TRAIN_SEGMENTS) -> tuple[list[bytes], list[str]]:
    """At most ``n_segments`` segments of at most ``n_docs`` labelled documents.

    Documents are drawn by a hash of the id, segments from all over their whole
    texts; only those come to the driver.
    """
    usable = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = usable.select("doc_id").count()
    rank = F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(1 << 30))
    drawn = usable.select(rank.alias("rank"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    drawn = drawn.where(F.col("rank") <= int(min(1.0, 1.2 * n_docs / max(1, rows)) * (1 << 30)))
    pieces = drawn.mapInPandas(
        _draw_segments(max(1, n_segments // n_docs)), "rank bigint, doc_id bigint, lang string, segments array<binary>"
    )
    items, labels = [], []
    for row in pieces.orderBy("rank", "doc_id", "lang", "segments").limit(n_docs).collect():
        items += [bytes(s) for s in row["segments"]]
        labels += [row["lang"]] * len(row["segments"])
    return items, labels


def train(docs: DataFrame, n_docs: int = TRAIN_DOCS, n_segments: int = TRAIN_SEGMENTS) -> ByteNetwork | None:
    """The network fitted to (text, lang) of the rows that are not held out; None without such rows."""
    items, labels = training_sample(docs, n_docs, n_segments)
    classes = sorted(set(labels))
    if not classes:
        return None
    number = {c: i for i, c in enumerate(classes)}
    return ByteNetwork(classes).fit(items, np.array([number[x] for x in labels]))


def identify(network: ByteNetwork | None):
    """Column function: struct (lang_pred, score) of a non-null text."""

    @F.pandas_udf("lang_pred string, score double")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known: dict[bytes, int] = {}
        sums = np.zeros((1024, len(network.classes) + 1 if network else 1), np.float32)
        for texts in batches:
            langs, scores = [], []
            raw = [t.encode() if network and any(map(str.isalpha, t)) else None for t in texts]
            for first, last in in_pieces([t or b"" for t in raw]):
                owns = [t and segments(t) for t in raw[first:last]]
                found = dict.fromkeys(s for own in owns if own for s in own)
                new = [s for s in found if s not in known]
                if len(known) + len(new) > MEMO_SEGMENTS:
                    known.clear()
                    new = list(found)
                if new:
                    at = len(known)
                    if at + len(new) > len(sums):
                        sums = np.concatenate((sums, np.zeros((at + len(new), sums.shape[1]), np.float32)))
                    sums[at : at + len(new)] = network.position_sums(new)
                    known.update(zip(new, range(at, at + len(new))))
                for own in owns:
                    if not own:
                        langs.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    places = np.fromiter(map(known.__getitem__, own), np.int64, len(own))
                    total = sums[places].sum(axis=0, dtype=np.float64)
                    pooled = total[:-1] / total[-1]
                    best = int(pooled.argmax())
                    langs.append(network.classes[best])
                    scores.append(float(min(1.0, pooled[best])))
            yield pd.DataFrame({"lang_pred": pd.Series(langs, dtype=object), "score": pd.Series(scores, dtype="float64")})

    return label


def predict(docs: DataFrame, network: ByteNetwork | None) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score), one per document."""
    labelled = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), identify(network)(whole(F.col("text"))).alias("p"))
    return labelled.select("doc_id", "held_out", "p.lang_pred", "p.score")


def keep_known(docs: DataFrame, network: ByteNetwork | None, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents with a language of at least that score, with their own columns.

    Where nothing could be learned (no network), all documents stay.
    """
    if network is None:
        return docs
    labelled = docs.select(F.struct("*").alias(ROW), identify(network)(whole(F.col("text"))).alias("p"))
    return labelled.where((F.col("p.lang_pred") != UNKNOWN) & (F.col("p.score") >= min_score)).select(f"{ROW}.*")
