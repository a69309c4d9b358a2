"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word enters as two embeddings: one of the word and one of its characters, which is the
largest value, dimension by dimension, over the word's character n-grams. Two gated
recurrent networks read a window of words forwards and backwards; attention weighs the
words; a logistic unit scores the window. Windows overlap by half and cover the whole text;
a document's score is that of its worst window.

The network is trained in numpy, on the driver, on at most ``MAX_TOXIC`` and ``MAX_CLEAN``
labelled documents (those whose ids have the smallest hashes; of these the ones of at most
``MAX_TRAINING_CHARS`` characters). A document teaches through its highest window. Embeddings start from the
log-odds of their bucket in these documents. Only text is an input. Scoring is a map over
all documents; each task holds the network, well under a megabyte, and a bounded number of
words and windows.

Defined cases: a null or empty text has one empty window, so a score; without toxic or
without clean labelled documents the score is the share of toxic ones (0.5 with no
labels); rows with null ids count as crc32 of an empty text; repeated rows score alike;
other columns are ignored whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklane.llm.licenses import normalised
from tracklane.session import settle

MAX_TOXIC, MAX_CLEAN, MAX_TRAINING_CHARS = 1500, 2500, 12_000
WINDOW, STRIDE = 48, 24
WORD_BUCKETS, GRAM_BUCKETS = 1 << 13, 1 << 14
GRAMS = (3, 5, 7)
WORD_DIMS, CHAR_DIMS, STATES, ATTENTION = 8, 8, 10, 8
EPOCHS, BATCH, RATE = 6, 64, 0.01
#: Words a task remembers, and windows it scores at once.
CACHED_WORDS, WINDOWS_AT_ONCE = 100_000, 2048


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Words:
    """Distinct words as buckets: one of the word, and those of its character n-grams.

    N-grams are of the word's UTF-8 with both ends marked. They are hashed all at once, as
    windows over the words put one after the other.
    """

    def __init__(self, words: list[bytes]):
        self.word = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % WORD_BUCKETS
        marked = np.frombuffer(b"^" + b"$^".join(words) + b"$", np.uint8).astype(np.uint64)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 2)
        place = np.arange(len(marked))
        inside = np.searchsorted(ends, place, side="right")
        left = ends[inside] - place
        grams, owner = [np.zeros(len(words), np.int64)], [np.arange(len(words))]
        for n in GRAMS:
            at = np.flatnonzero(left >= n)
            number = np.full(len(at), n, np.uint64)
            for k in range(n):
                number = number * np.uint64(0x9E3779B97F4A7C15) + marked[at + k]
            number ^= number >> np.uint64(31)
            number *= np.uint64(0xBF58476D1CE4E5B9)
            grams.append((number >> np.uint64(33)).astype(np.int64) % (GRAM_BUCKETS - 1) + 1)
            owner.append(inside[at])
        # every word has bucket 0 besides, so that none is without
        order = np.argsort(np.concatenate(owner), kind="stable")
        self.grams, self.owner = np.concatenate(grams)[order], np.concatenate(owner)[order]
        self.starts = np.searchsorted(self.owner, np.arange(len(words)))


def windows_of(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping windows over a text's word numbers: numbers (-1 after the end), lengths."""
    starts = np.arange(0, max(1, len(ids) - STRIDE), STRIDE)
    at = starts[:, None] + np.arange(WINDOW)
    padded = np.append(ids, -1)
    return padded[np.minimum(at, len(ids))], np.minimum(WINDOW, len(ids) - starts)


class Network:
    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        inputs = WORD_DIMS + CHAR_DIMS

        def noise(*shape: int) -> np.ndarray:
            return rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

        self.p = {
            "word": rng.normal(0, 0.05, (WORD_BUCKETS, WORD_DIMS)).astype(np.float32),
            "char": rng.normal(0, 0.05, (GRAM_BUCKETS, CHAR_DIMS)).astype(np.float32),
            "attend": noise(2 * STATES, ATTENTION),
            "query": noise(ATTENTION),
            "out": noise(2 * STATES),
            "bias": np.zeros(1, np.float32),
        }
        for side in "fb":
            self.p[f"in_{side}"] = noise(inputs, 3 * STATES)
            self.p[f"re_{side}"] = noise(STATES, 3 * STATES)
            self.p[f"off_{side}"] = np.zeros(3 * STATES, np.float32)
        #: Score of everything where there was nothing to learn from.
        self.constant: float | None = None

    def inputs(self, words: Words) -> np.ndarray:
        chars = np.maximum.reduceat(self.p["char"][words.grams], words.starts, axis=0)
        return np.concatenate([self.p["word"][words.word], chars], axis=1)

    def projected(self, inputs: np.ndarray) -> np.ndarray:
        """What both directions add for each word at each step; computed once per word."""
        sides = [inputs @ self.p[f"in_{s}"] + self.p[f"off_{s}"] for s in "fb"]
        return np.concatenate(sides, axis=1)

    def _read(self, side: str, steps: np.ndarray, live: np.ndarray, kept: list | None):
        """States of one direction after every word; steps and live are (window, word, ..)."""
        w, s = self.p[f"re_{side}"], STATES
        count, length = live.shape
        out = np.empty((length, count, s), np.float32)
        h = np.zeros((count, s), np.float32)
        for t in range(length) if side == "f" else reversed(range(length)):
            x = steps[:, t]
            gates = _sigmoid(x[:, : 2 * s] + h @ w[:, : 2 * s])
            z, r = gates[:, :s], gates[:, s:]
            c = np.tanh(x[:, 2 * s :] + (r * h) @ w[:, 2 * s :])
            if kept is not None:
                kept.append((t, h, z, r, c))
            h = h + (z * live[:, t, None]) * (c - h)
            out[t] = h
        return out.transpose(1, 0, 2)

    def forward(self, steps: np.ndarray, lengths: np.ndarray, keep: bool = False):
        """Logits of windows; steps are projected words (window, word, both directions)."""
        live = (np.arange(steps.shape[1]) < lengths[:, None]).astype(np.float32)
        kept = {"f": [], "b": []} if keep else {"f": None, "b": None}
        s = 3 * STATES
        states = np.concatenate(
            [self._read("f", steps[:, :, :s], live, kept["f"]),
             self._read("b", steps[:, :, s:], live, kept["b"])], axis=2,
        )
        looked = np.tanh(states @ self.p["attend"])
        weight = looked @ self.p["query"] + (live - 1) * 1e9
        weight = np.exp(weight - weight.max(axis=1, keepdims=True)) * live
        weight /= np.maximum(weight.sum(axis=1, keepdims=True), 1e-9)
        pooled = np.einsum("wt,wts->ws", weight, states)
        logits = pooled @ self.p["out"] + self.p["bias"][0]
        return (logits, (live, kept, states, looked, weight, pooled)) if keep else logits

    def _read_back(self, side: str, kept: list, live: np.ndarray, down: np.ndarray, grads: dict):
        w, s = self.p[f"re_{side}"], STATES
        steps = np.zeros((*live.shape, 3 * s), np.float32)
        dw = np.zeros_like(w)
        dh = np.zeros((len(live), s), np.float32)
        for t, h, z, r, c in reversed(kept):
            dh = dh + down[:, t]
            m = live[:, t, None]
            dz = dh * (c - h) * m * z * (1 - z)
            dc = dh * z * m * (1 - c * c)
            back = dc @ w[:, 2 * s :].T
            dr = back * h * r * (1 - r)
            gates = np.concatenate([dz, dr], axis=1)
            dw[:, : 2 * s] += h.T @ gates
            dw[:, 2 * s :] += (r * h).T @ dc
            steps[:, t] = np.concatenate([gates, dc], axis=1)
            dh = dh * (1 - z * m) + back * r + gates @ w[:, : 2 * s].T
        grads[f"re_{side}"] = dw
        return steps

    def gradients(self, words: Words, ids: np.ndarray, lengths: np.ndarray, target: np.ndarray):
        """Gradients of the mean logistic loss over windows; ids are numbers of ``words``."""
        inputs = self.inputs(words)
        # windows end in -1, which no state reads
        logits, kept = self.forward(self.projected(inputs)[ids], lengths, keep=True)
        live, steps, states, looked, weight, pooled = kept
        error = (_sigmoid(logits) - target).astype(np.float32) / len(target)
        grads = {"out": pooled.T @ error, "bias": error.sum(keepdims=True)}
        up = error[:, None] * self.p["out"]
        down = weight[:, :, None] * up[:, None, :]
        by_weight = np.einsum("wts,ws->wt", states, up)
        by_weight = weight * (by_weight - (weight * by_weight).sum(axis=1, keepdims=True))
        grads["query"] = np.einsum("wta,wt->a", looked, by_weight)
        look = by_weight[:, :, None] * self.p["query"] * (1 - looked * looked)
        grads["attend"] = np.einsum("wts,wta->sa", states, look)
        down = down + look @ self.p["attend"].T
        to_inputs = np.zeros_like(inputs)
        for side, part in (("f", slice(0, STATES)), ("b", slice(STATES, None))):
            by_step = self._read_back(side, steps[side], live, down[:, :, part], grads)
            by_word = np.zeros((len(inputs), 3 * STATES), np.float32)
            np.add.at(by_word, ids.ravel(), by_step.reshape(-1, 3 * STATES))
            grads[f"in_{side}"] = inputs.T @ by_word
            grads[f"off_{side}"] = by_word.sum(axis=0)
            to_inputs += by_word @ self.p[f"in_{side}"].T
        grads["word"] = np.zeros_like(self.p["word"])
        np.add.at(grads["word"], words.word, to_inputs[:, :WORD_DIMS])
        # of a word's n-grams, the one with the largest value passes the gradient on
        top = self.p["char"][words.grams] == inputs[words.owner, WORD_DIMS:]
        grads["char"] = np.zeros_like(self.p["char"])
        np.add.at(grads["char"], words.grams, top * to_inputs[words.owner, WORD_DIMS:])
        return grads


def train(texts: list[str], toxic: list[int], epochs: int = EPOCHS, seed: int = 0) -> Network:
    net, rng = Network(seed), np.random.default_rng(seed)
    target = np.array(toxic, np.float32)
    if not len(target) or target.min() == target.max():
        net.constant = float(target.mean()) if len(target) else 0.5
        return net
    number: dict[bytes, int] = {}
    ids = [
        np.array([number.setdefault(w, len(number)) for w in normalised(t).split()], np.int64)
        for t in texts
    ]
    words = Words(list(number) or [b""])
    _start_from_odds(net, words, ids, target)
    windows = [windows_of(i) for i in ids]
    first: dict[str, np.ndarray] = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(ids))
        for start in range(0, len(order), BATCH):
            chosen = order[start : start + BATCH]
            all_ids = np.concatenate([windows[i][0] for i in chosen])
            lengths = np.concatenate([windows[i][1] for i in chosen])
            used, local = np.unique(all_ids, return_inverse=True)
            own = _some(words, np.maximum(used, 0))
            local = local.reshape(all_ids.shape)
            logits = net.forward(net.projected(net.inputs(own))[local], lengths)
            ends = np.cumsum([len(windows[i][1]) for i in chosen])
            top = np.array(
                [a + logits[a:b].argmax() for a, b in zip(np.append(0, ends[:-1]), ends, strict=True)]
            )
            grads = net.gradients(own, local[top], lengths[top], target[chosen])
            step += 1
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                size = RATE * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                net.p[k] -= (size * first[k] / (np.sqrt(second[k]) + 1e-7)).astype(np.float32)
    return net


def _some(words: Words, rows: np.ndarray) -> Words:
    part = object.__new__(Words)
    counts = np.append(words.starts[1:], len(words.grams)) - words.starts
    part.word = words.word[rows]
    lengths = counts[rows]
    part.starts = np.cumsum(lengths) - lengths
    part.owner = np.repeat(np.arange(len(rows)), lengths)
    at = np.repeat(words.starts[rows] - part.starts, lengths) + np.arange(lengths.sum())
    part.grams = words.grams[at]
    return part


def _start_from_odds(net: Network, words: Words, ids: list[np.ndarray], target: np.ndarray):
    """Log-odds of every bucket, from documents that have it, as a first dimension."""
    counts = {"word": np.zeros((2, WORD_BUCKETS)), "char": np.zeros((2, GRAM_BUCKETS))}
    for own, label in zip(ids, target.astype(int), strict=True):
        part = _some(words, np.unique(own))
        counts["word"][label, np.unique(part.word)] += 1
        counts["char"][label, np.unique(part.grams)] += 1
    documents = np.array([(target == 0).sum(), (target == 1).sum()])[:, None]
    for kind, found in counts.items():
        share = (found + 0.5) / (documents + 1.0)
        odds = np.log(share[1]) - np.log(share[0])
        # buckets that few documents have say little
        net.p[kind][:, 0] += np.clip(odds, -3, 6) * found.sum(axis=0) / (found.sum(axis=0) + 5) / 3


class Scorer:
    """Scores texts in one task."""

    def __init__(self, net: Network):
        self.net = net
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.steps = np.empty((0, 6 * STATES), np.float32)

    def _numbers(self, tokens: list[bytes]) -> np.ndarray:
        new = [w for w in dict.fromkeys(tokens) if w not in self.known]
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            fresh = self.net.projected(self.net.inputs(Words(new)))
            need = len(self.known)
            if need > len(self.steps):
                grown = np.zeros((need * 2, 6 * STATES), np.float32)
                grown[: need - len(new)] = self.steps[: need - len(new)]
                self.steps = grown
            self.steps[need - len(new) : need] = fresh
        return np.fromiter(map(self.known.__getitem__, tokens), np.int64, len(tokens))

    def logits(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        if not len(self.steps):
            self.steps = np.zeros((1, 6 * STATES), np.float32)
        return np.concatenate(
            [
                self.net.forward(self.steps[ids[k : k + WINDOWS_AT_ONCE]],
                                 lengths[k : k + WINDOWS_AT_ONCE])
                for k in range(0, len(ids), WINDOWS_AT_ONCE)
            ]
        )

    def scores(self, texts: Iterator[str | None]) -> np.ndarray:
        texts = list(texts)
        if self.net.constant is not None:
            return np.full(len(texts), self.net.constant)
        out, waiting, owners, many = np.full(len(texts), -np.inf), [], [], 0

        def run() -> None:
            nonlocal many
            ids = np.concatenate([w[0] for w in waiting])
            found = self.logits(ids, np.concatenate([w[1] for w in waiting]))
            owner = np.repeat(owners, [len(w[1]) for w in waiting])
            np.maximum.at(out, owner, found)
            waiting.clear()
            owners.clear()
            many = 0
            if len(self.known) > CACHED_WORDS:
                self._forget()

        for i, text in enumerate(texts):
            waiting.append(windows_of(self._numbers(normalised(text).split())))
            owners.append(i)
            many += len(waiting[-1][1])
            if many >= WINDOWS_AT_ONCE:
                run()
        if waiting:
            run()
        return _sigmoid(np.clip(out, -60, 60))


def _bucket(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary"))


def training_set(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, folds: int):
    """(text, label) of the documents that teach. They are chosen from the labels alone, so
    that only the chosen ids, at most MAX_TOXIC + MAX_CLEAN, go to the documents' tasks."""
    marked = labels.select(F.col(id_col).alias("label_id"), "toxic").where(
        _bucket(F.col("label_id")) % folds != 0
    )
    chosen = [
        marked.where(F.col("toxic") == label).orderBy(F.xxhash64("label_id"), "label_id").limit(most)
        for label, most in ((1, MAX_TOXIC), (0, MAX_CLEAN))
    ]
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = (
        texts.where(F.length("text") <= MAX_TRAINING_CHARS)
        .join(F.broadcast(settle(chosen[0].unionAll(chosen[1]))), F.col("doc_id") == F.col("label_id"))
        .select("doc_id", "text", "toxic")
        # rows that repeat a labelled id teach no more than the limits say
        .orderBy(F.col("toxic").desc(), F.xxhash64("doc_id"), "text")
        .limit(MAX_TOXIC + MAX_CLEAN)
    )
    return [(r.text, r.toxic) for r in found.collect()]


def score(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 5,
) -> DataFrame:
    """Per document: doc_id, held_out (its id's hash is 0 modulo ``folds``; it taught
    nothing), score, predicted."""
    taught = training_set(docs, labels, id_col, text_col, folds)
    net = train([t for t, _ in taught], [y for _, y in taught])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net)
        for batch in batches:
            found = scorer.scores(t.as_py() for t in batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(found, pa.float64()),
                    pa.array((found >= 0.5).astype(np.int32)),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (_bucket(F.col(id_col)) % folds == 0).alias("held_out"),
        F.col(text_col).alias("text"),
    ).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
