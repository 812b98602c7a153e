"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the windows of ``window`` consecutive words of the benchmark items (an item
with fewer words is one window).  Patterns of equal length form one searcher: a shift table on
blocks of up to three words tells how far the end of the search position may move; where
the shift is zero, the bucket of the suffix block gives the patterns to try, and comparing
all their words confirms an occurrence.  Many stretches of the text are searched at once,
each with a position of its own that skips ahead by its own shift.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm._common import WORD_CACHE_ENTRIES, plain_words_table, scan_texts

#: Benchmark words that one broadcast searcher holds at most (about 20 numbers a word); more items go into further passes.
BLOCK_WORDS = 400_000
STRETCH = 256
_TABLE = plain_words_table()
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def plain_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words of letters, digits and bytes from 0x80 on; null has none."""
    return text.translate(_TABLE).split() if text else []


class Searcher:
    """Patterns of one length (in words), as numbers from 1 on."""

    def __init__(self, patterns: np.ndarray) -> None:
        self.patterns = patterns
        n, self.length = patterns.shape
        self.block = min(3, self.length)
        blocks = self.length - self.block + 1
        self.bits = int(np.clip(np.ceil(np.log2(8 * n * blocks + 1)), 10, 23))
        codes = np.stack([self._code([patterns[:, j + k] for k in range(self.block)]) for j in range(blocks)], axis=1)
        self.shift = np.full(1 << self.bits, blocks, np.int32)
        for j in range(blocks):
            np.minimum.at(self.shift, codes[:, j], blocks - 1 - j)
        suffix = codes[:, -1]
        self.order = np.argsort(suffix, kind="stable")
        self.starts = np.searchsorted(suffix[self.order], np.arange((1 << self.bits) + 1))

    def _code(self, parts: list[np.ndarray]) -> np.ndarray:
        total = np.zeros(len(parts[0]), np.uint64)
        for part, factor in zip(parts, _MIX, strict=False):
            total = (total ^ part.astype(np.uint64)) * factor
            total ^= total >> np.uint64(29)
        return (total >> np.uint64(64 - self.bits)).astype(np.int64)

    def _at(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self._code([ids[ends - self.block + 1 + k] for k in range(self.block)])

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Last positions and pattern numbers of all occurrences; number 0 in ``ids`` is in no pattern."""
        cursor = np.arange(0, len(ids), STRETCH)
        stop = np.minimum(cursor + STRETCH, len(ids))
        cursor = np.maximum(cursor, self.length - 1)
        found = []
        while True:
            going = cursor < stop
            cursor, stop = cursor[going], stop[going]
            if not len(cursor):
                break
            codes = self._at(ids, cursor)
            shift = self.shift[codes]
            if (zero := shift == 0).any():
                found.append((cursor[zero], codes[zero]))
            cursor = cursor + np.maximum(shift, 1)
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        ends, codes = (np.concatenate(x) for x in zip(*found, strict=True))
        out_ends, out_patterns = [], []
        tries = np.concatenate([[0], np.cumsum(self.starts[codes + 1] - self.starts[codes])])
        at = 0
        while at < len(ends):  # as many positions at a time as have about a million patterns to try
            to = min(max(at + 1, int(np.searchsorted(tries, tries[at] + 1_000_000))), len(ends))
            counts = np.diff(tries[at : to + 1])
            where = np.repeat(ends[at:to], counts)
            which = np.repeat(self.starts[codes[at:to]], counts) + np.arange(len(where)) - np.repeat(tries[at:to] - tries[at], counts)
            which = self.order[which]
            for k in range(self.length):
                same = ids[where - self.length + 1 + k] == self.patterns[which, k]
                where, which = where[same], which[same]
            out_ends.append(where)
            out_patterns.append(which)
            at = to
        return np.concatenate(out_ends), np.concatenate(out_patterns)


class Matcher:
    """All windows of a block of benchmark items."""

    def __init__(self, items: list[tuple[int | None, list[bytes]]], window: int) -> None:
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[int | None]] = defaultdict(set)
        for item, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            for at in range(max(1, len(ids) - window + 1)):
                owners[tuple(ids[at : at + window])].add(item)
        by_length: dict[int, list[tuple[int, ...]]] = defaultdict(list)
        for pattern in owners:
            by_length[len(pattern)].append(pattern)
        self.searchers = [(Searcher(np.array(p, np.int32)), [[x for x in owners[q] if x is not None] for q in p]) for _, p in sorted(by_length.items())]


class _Numbers(dict):
    """Numbers of benchmark words; other words get 0, and are kept until there are too many of them."""

    def __init__(self, vocabulary: dict[bytes, int]) -> None:
        super().__init__(vocabulary)
        self.vocabulary = vocabulary

    def __missing__(self, word: bytes) -> int:
        if len(self) >= len(self.vocabulary) + WORD_CACHE_ENTRIES:
            self.clear()
            self.update(self.vocabulary)
        self[word] = number = self.vocabulary.get(word, 0)
        return number


_REPORT = pa.schema([("words", pa.int64()), ("spans", pa.list_(pa.int32())), ("items", pa.list_(pa.int64()))])


def _search(shared, carried: bool):
    def make():
        matcher: Matcher = shared.value
        numbers = _Numbers(matcher.vocabulary)

        def work(texts: list[bytes | None], kept: list[pa.Array]) -> list[pa.Array]:
            counts, ids = [], [0]
            for text in texts:
                words = plain_words(text)
                counts.append(len(words))
                ids += map(numbers.__getitem__, words)
                ids.append(0)  # no window crosses documents
            ids = np.array(ids, np.int32)
            first = np.concatenate([[1], 1 + np.cumsum(np.array(counts, np.int64) + 1)])
            edge = np.zeros(len(ids) + 1, np.int32)
            items: list[set[int]] = [set() for _ in texts]
            if carried:
                for d, (spans, known) in enumerate(zip(kept[-2].to_pylist(), kept[-1].to_pylist(), strict=True)):
                    items[d].update(known)
                    edge[first[d] + np.array(spans[::2], np.int64)] += 1
                    edge[first[d] + np.array(spans[1::2], np.int64)] -= 1
            for searcher, owners in matcher.searchers:
                ends, which = searcher.find(ids)
                np.add.at(edge, ends - searcher.length + 1, 1)
                np.add.at(edge, ends + 1, -1)
                owner = np.searchsorted(first, ends, "right") - 1
                for d, p in set(zip(owner.tolist(), which.tolist(), strict=True)):
                    items[d].update(owners[p])
            hit = np.concatenate([[0], (np.cumsum(edge[:-1]) > 0).astype(np.int8), [0]])
            turns = np.diff(hit)
            starts, stops = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
            of = np.searchsorted(first, starts, "right") - 1
            spans: list[list[int]] = [[] for _ in texts]
            for d, x, y in zip(of.tolist(), starts.tolist(), stops.tolist(), strict=True):
                spans[d] += [x - int(first[d]), y - int(first[d])]
            return [pa.array(counts, pa.int64()), pa.array(spans, _REPORT.field(1).type), pa.array([sorted(x) for x in items], _REPORT.field(2).type)]

        return work

    return make


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    block, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        words = plain_words(row[1].encode()) if row[1] else []
        if not words:
            continue
        if block and size + len(words) > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append((row[0], words))
        size += len(words)
    if block or not size:
        yield block


def leaked_passages(docs: DataFrame, benchmark: DataFrame, window: int = 13, carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` (doc_id) as c0, c1, ... and words, spans, items of each document.

    ``words``: words of the whole text; ``spans``: starts and ends (exclusive) of the stretches
    of words inside any occurrence of a window, in order; ``items``: ids of the items with
    occurring windows, ascending.  Null or wordless texts have 0 words and empty lists.
    Items without words have no window; an item with a null id marks words but is not listed;
    repeated items count once.  An empty benchmark marks nothing, an empty table gives none.

    The benchmark is a stated query set: it is read in blocks of ``BLOCK_WORDS`` words, each
    broadcast and searched in one pass over the documents without any shuffle.
    """
    carry = ["doc_id"] if carry is None else carry
    spark = docs.sparkSession
    out = None
    for block in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(Matcher(block, window))
        if out is None:
            source, kept = docs, [*carry, "text"]
        else:
            source, kept = out.withColumnRenamed(f"c{len(carry)}", "text"), [*[f"c{i}" for i in range(len(carry))], "text", "spans", "items"]
        more = scan_texts(source, _search(shared, out is not None), _REPORT, "words long, spans array<int>, items array<bigint>", kept)
        out = more.select(*[f"c{i}" for i in range(len(carry) + 1)], "words", "spans", "items")
    return out.drop(f"c{len(carry)}")


def with_verdict(found: DataFrame) -> DataFrame:
    """Adds n_hit, n_items, items_sha256 and contaminated (n_hit > 0 and 20 * n_hit >= words)."""
    hit = F.aggregate(F.transform("spans", lambda x, i: F.when(i % 2 == 1, x.cast("long")).otherwise(-x.cast("long"))), F.lit(0).cast("long"), lambda a, x: a + x)
    found = found.withColumn("n_hit", hit).withColumn("n_items", F.size("items").cast("long"))
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.withColumn("items_sha256", F.sha2(F.concat_ws(",", ids), 256)).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("words")))
