"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A document's features are the distinct hashes of its words and their stems (first ``STEMS``
bytes: inflected forms share them), of pairs of neighbouring words and of pairs with one word
between.  Features of fewer than ``MIN_DOCS`` training documents are not learned.
Per-coordinate learning rates and L1 keep nearly all weights at exactly zero; what remains is
broadcast, and one pass scores every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm._common import WORD_CACHE_ENTRIES, arrow_map, mixed, plain_words_table, scan_texts, sized_batches

#: Weights are a table of 2**BITS numbers: that bounds what is broadcast (12 bytes for each non-zero one).
BITS = 21
SIZE = 1 << BITS
#: Labelled documents that are learned from at most, those with the smallest hashes of their ids.
MAX_TRAIN_DOCS = 19_000
EPOCHS = 6
MIN_DOCS = 3
STEMS = (4, 5)
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 0.1
#: Hash multipliers for single words, neighbours, and words with one between.
_PAIR = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)
_TABLE = plain_words_table()


class _Words(dict):
    """Row numbers of words in a table of their hashes: the word, then its stems."""

    def __init__(self) -> None:
        super().__init__()
        self.table = np.empty((1 + len(STEMS), WORD_CACHE_ENTRIES), np.uint64)

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        self.table[0, at] = xxhash.xxh3_64_intdigest(word)
        for k, n in enumerate(STEMS, 1):
            self.table[k, at] = xxhash.xxh3_64_intdigest(word[:n], seed=n)
        return at

    def of(self, lists: list[list[bytes]]) -> np.ndarray:
        """The hashes of all words, a row for each kind."""
        if len(self) + (most := sum(map(len, lists))) > self.table.shape[1]:
            self.clear()
            if most > self.table.shape[1]:
                self.table = np.empty((1 + len(STEMS), most), np.uint64)
        return self.table[:, np.fromiter((self[w] for x in lists for w in x), np.int64, most)]


def _hashed(h: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Feature numbers by the position of their first word, with how far their last word is from it."""
    down = np.uint64(64 - BITS)
    kinds = [(0, row) for row in h]
    kinds += [(1, h[0, :-1] * _PAIR[0] + h[0, 1:] * _PAIR[1]), (2, h[0, :-2] * _PAIR[2] + h[0, 2:] * _PAIR[3])]
    return [(apart, (mixed(x) >> down).astype(np.int32)) for apart, x in kinds]


def features(text: bytes | None, words: _Words) -> np.ndarray:
    """Distinct feature numbers of a whole text; none for null or wordless texts."""
    own = text.translate(_TABLE).split() if text else []
    return np.unique(np.concatenate([x for _, x in _hashed(words.of([own]))])) if own else np.empty(0, np.int32)


class Ftrl:
    """FTRL-proximal with a coordinate for each feature and one, not under L1, for the bias."""

    def __init__(self) -> None:
        self.z = np.zeros(SIZE + 1)
        self.n = np.zeros(SIZE + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        pull = np.where(at == SIZE, 0.0, L1)
        return np.where(np.abs(z) <= pull, 0.0, (np.sign(z) * pull - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] += g * g


def _featurised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = _Words()
    for batch in sized_batches(batches, "text"):
        texts = batch.column(2).cast(pa.binary()).to_pylist()
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([features(t, words).tobytes() for t in texts], pa.binary())], names=["turn", "label", "at"])


def _learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [(label, np.frombuffer(at, np.int32)) for b in batches for label, at in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
    if not rows:
        return
    shared = np.zeros(SIZE, np.int32)
    for _, at in rows:
        shared[at] += 1
    for i, (label, at) in enumerate(rows):  # in place: the features read are freed as the learned ones are made
        rows[i] = (label, np.append(at[shared[at] >= MIN_DOCS], np.int32(SIZE)))
    model = Ftrl()
    for epoch in range(EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            model.learn(rows[i][1], rows[i][0])
    at = np.flatnonzero(np.abs(model.z) > 0)
    w = model.weights(at)
    at, w = at[w != 0], w[w != 0]
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(w, pa.float64())], names=["at", "w"])


def train(docs: DataFrame, labels: DataFrame, learn_from) -> dict[int, float]:
    """Non-zero weights, learned from at most ``MAX_TRAIN_DOCS`` labelled documents of ``docs``, in one task that holds their features.

    ``learn_from`` is a condition on ``doc_id``.  A doc_id with several labels takes the
    largest; null ids or labels are not learned from.  Without any, there are no weights.
    """
    chosen = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label")).where(learn_from).where("doc_id is not null and label is not null")
    chosen = chosen.groupBy("doc_id").agg(F.max("label").alias("label")).join(docs.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi")
    chosen = chosen.withColumn("turn", F.xxhash64("doc_id")).orderBy("turn", "doc_id").limit(MAX_TRAIN_DOCS)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    known = arrow_map(texts.select("turn", "label", "text"), _featurised, "turn long, label int, at binary")
    rows = arrow_map(known.repartition(1).sortWithinPartitions("turn", "at"), _learned, "at long, w double").collect()
    return {r["at"]: r["w"] for r in rows}


def _scorer(shared):
    def make():
        at, w = shared.value
        table = np.zeros(SIZE, np.float32)
        inner = at < SIZE
        table[at[inner]] = w[inner]
        bias = float(w[~inner].sum())
        known = len(w) > 0
        words = _Words()

        def work(texts: list[bytes | None], kept: list[pa.Array]) -> list[pa.Array]:
            scores = np.full(len(texts), bias)
            lists = [t.translate(_TABLE).split() if t else [] for t in texts]
            counts = np.array([len(x) for x in lists], np.int64)
            h = words.of(lists)
            of = np.repeat(np.arange(len(texts)), counts)
            found = []
            for apart, numbers in _hashed(h):
                hit = np.flatnonzero(table[numbers])
                if apart:
                    hit = hit[of[hit] == of[hit + apart]]  # both words in one document
                found.append(of[hit] * np.int64(SIZE) + numbers[hit])
            once = np.unique(np.concatenate(found))
            np.add.at(scores, once >> BITS, table[once & (SIZE - 1)])
            return [pa.array(1 / (1 + np.exp(-np.clip(scores, -35, 35))) if known else np.zeros(len(texts)))]

        return work

    return make


def toxicity_scores(docs: DataFrame, labels: DataFrame, learn_from=None, carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` (doc_id) as c0, c1, ... and score, 0 to 1, of each whole text.

    Null, empty or wordless texts get the score of the bias alone.  Without anything to learn
    from, every score is 0.  Rows repeat as they come; an empty table gives an empty result.
    """
    learn_from = F.lit(True) if learn_from is None else learn_from
    weights = train(docs, labels, learn_from)
    shared = docs.sparkSession.sparkContext.broadcast((np.array(list(weights), np.int64), np.array(list(weights.values()), np.float64)))
    return scan_texts(docs, _scorer(shared), pa.schema([("score", pa.float64())]), "score double", carry)


def fold(doc_id) -> "F.Column":
    """The crc32 of the id as text; null ids are in no fold."""
    return F.crc32(doc_id.cast("string").cast("binary"))
