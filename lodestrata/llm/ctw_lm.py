"""Context-tree weighting over byte contexts, and a unigram word base.

Counts of all runs of ``DEPTH`` + 1 bytes are gathered from the training texts.  A context is the
last d bytes, d from 0 to ``DEPTH``; a byte is eight binary decisions, so a node is a context
and a bit prefix.  A node's Krichevsky-Trofimov estimate of its counts a, b has the
probability Pkt(a, b); its weighted probability is Pw = (Pkt + product of its longer contexts' Pw) / 2,
and Pkt / (2 Pw) is how much its own estimate counts against those of longer contexts.
The next bit is predicted by this mixture over all depths; a longer context that has not been
seen yet has no counts, so it predicts one half and keeps the weight that its shorter ones leave it.  A
text's score is the sum of log10 probabilities of its bytes (A-Z lower-cased) and of an end
symbol, so scores are those of one distribution over all texts; in bits, divided by the bytes, they
give the code length.

All contexts are in the model.  Those of more than ``SPLIT`` bytes are weighed in tasks, each with
all that share their last ``SPLIT`` bytes; the driver weighs the shorter ones.  What is
broadcast is bounded: of each depth the contexts seen at least 2**t times, for the smallest t at which they
have no more than ``MAX_RUNS`` runs.  Bytes after other contexts are scored by a join with the tasks' trees.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm._common import CACHES, Scratch, arrow_map, mixed, scan_texts, sized_batches

DEPTH = 5
#: Byte that pads the context of a text's first bytes and ends it; no UTF-8 text holds it.
EDGE = 0xFF
#: Contexts that share so many last bytes are weighed in one task.
SPLIT = 3
#: Rows that a task weighs at a time, unless one context of ``SPLIT`` bytes has more.
CHUNK = 200_000
#: Runs broadcast of each depth, at most; a run takes about 75 bytes of a worker's memory.
MAX_RUNS = 1_000_000
#: Words whose counts are broadcast, at most (about 180 bytes each in a worker); counts of all others come by a join.
MAX_WORDS = 500_000
END = b"\n"  # stands for the end token: no word has white space


def run_codes(texts: list[bytes]) -> np.ndarray:
    """Every byte and end symbol of the texts with its ``DEPTH`` bytes before, the byte lowest."""
    pad = bytes([EDGE]) * DEPTH
    data = np.frombuffer(b"".join(x for t in texts for x in (pad, t, pad[:1])), np.uint8).astype(np.uint64)
    code = data.copy()
    for k in range(1, DEPTH + 1):
        code[k:] |= data[:-k] << np.uint64(8 * k)
    starts = np.cumsum([0, *(len(t) + DEPTH + 1 for t in texts[:-1])])
    inner = np.ones(len(data), bool)
    for k in range(DEPTH):
        inner[starts + k] = False
    return code[inner]


def _log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov probability of a zeros and b ones."""
    return _log_gamma_half(a) + _log_gamma_half(b) - _log_gamma(a + b + 1) - math.log(math.pi)


_SMALL = 256
_GAMMA = np.array([0.0] + [math.lgamma(x) for x in range(1, _SMALL)])
_GAMMA_HALF = np.array([math.lgamma(x + 0.5) for x in range(_SMALL)])


def _stirling(x: np.ndarray) -> np.ndarray:
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    return np.where(x < _SMALL, _GAMMA[np.minimum(x, _SMALL - 1).astype(np.int64)], _stirling(np.maximum(x, 2.0)))


def _log_gamma_half(x: np.ndarray) -> np.ndarray:
    return np.where(x < _SMALL, _GAMMA_HALF[np.minimum(x, _SMALL - 1).astype(np.int64)], _stirling(np.maximum(x, 2.0) + 0.5))


class _Level:
    """The nodes of one depth with the same number of prefix bits, in the order of their keys."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, bits: int) -> None:
        keys = codes >> np.uint64(8 - bits)
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        self.first = np.flatnonzero(new)  # the first run of each node
        self.keys = keys[self.first]
        self.total = np.add.reduceat(counts, self.first).astype(np.float64)
        one = ((codes >> np.uint64(7 - bits)) & np.uint64(1)).astype(bool)
        self.ones = np.add.reduceat(np.where(one, counts, 0), self.first).astype(np.float64)
        self.log_kt = _log_kt(self.total - self.ones, self.ones)
        self.kt = (self.ones + 0.5) / (self.total + 1)


class Tree(NamedTuple):
    """Runs, and the predictions (see ``_rarer``) at all their nodes, for a bit after which no longer context has been seen."""

    #: For each depth the sorted codes of its runs.
    codes: list[np.ndarray]
    #: For each depth and number of prefix bits: the first run of each node, and its prediction.
    nodes: list[list[tuple[np.ndarray, np.ndarray]]]
    #: log10 probability of the last byte of each run of the longest depth.
    values: np.ndarray
    #: Whether all contexts of the training texts are there.
    whole: bool = True

    @classmethod
    def of(cls, rows: list[tuple[np.ndarray, np.ndarray]], whole: bool = True) -> Tree:
        """From each depth's sorted codes and, for each code, the predictions at its eight nodes."""
        nodes = [[(first.astype(np.uint32), ones[first, bits]) for bits in range(8) for first in [_firsts(codes, bits)]] for codes, ones in rows]
        codes, ones = rows[-1]
        values = np.zeros(len(codes))
        for bits in range(8):
            values += _bit_log(codes, bits, ones[:, bits].astype(np.float64))
        return cls([codes for codes, _ in rows], nodes, values.astype(np.float32), whole)


def _firsts(codes: np.ndarray, bits: int) -> np.ndarray:
    keys = codes >> np.uint64(8 - bits)
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))


def _rarer(p: np.ndarray) -> np.ndarray:
    """A prediction as it is kept: the probability of the rarer bit, below zero if that is a zero.

    The probability of a one itself would be 1 in 32 bits after some 17 million ones, and a zero impossible.
    """
    return np.where(p < 0.5, p, p - 1).astype(np.float32)


def _bit_log(codes: np.ndarray, bits: int, rarer: np.ndarray) -> np.ndarray:
    """log10 probability of the codes' next bit by predictions as they are kept."""
    one = ((codes >> np.uint64(7 - bits)) & np.uint64(1)).astype(bool)
    p = np.abs(rarer)
    return np.log10(np.where(one == (rarer > 0), p, 1 - p))


class _Weighed(NamedTuple):
    """The nodes of some depths with the same number of prefix bits."""

    levels: list[_Level]
    #: For each depth the nodes' predictions.
    ones: list[np.ndarray]
    #: log Pw of the nodes of the shortest depth.
    log_pw: np.ndarray
    #: What all shorter contexts give the nodes of the longest depth: the sum of their estimates, and the weight left.
    done: np.ndarray
    left: np.ndarray


def _weigh(runs: list[tuple[np.ndarray, np.ndarray]], depth: int = 0, below: list[np.ndarray] | None = None, above: list[tuple] | None = None) -> list[_Weighed]:
    """Weigh the runs of the depths from ``depth`` on, for each number of prefix bits.

    ``below`` has log Pw of the nodes of the longest depth, if still longer contexts follow;
    ``above`` has keys, done and left for the nodes of the shortest one.
    """
    half, out = math.log(0.5), []
    for bits in range(8):
        levels = [_Level(codes, counts, bits) for codes, counts in runs]
        parents = []
        for d in range(1, len(levels)):
            mask = np.uint64((1 << (8 * (depth + d - 1) + bits)) - 1)
            parents.append(np.searchsorted(levels[d - 1].keys, levels[d].keys & mask))
        own: list[np.ndarray] = [np.empty(0)] * len(levels)
        log_pw = below[bits] if below else levels[-1].log_kt
        if below:
            own[-1] = np.exp(half + levels[-1].log_kt - log_pw)
        for d in range(len(levels) - 2, -1, -1):
            deeper = np.bincount(parents[d], log_pw, len(levels[d].keys))
            log_pw = np.logaddexp(half + levels[d].log_kt, half + deeper)
            own[d] = np.exp(half + levels[d].log_kt - log_pw)
        done, left = np.zeros(len(levels[0].keys)), np.ones(len(levels[0].keys))
        if above:
            keys, done, left = above[bits]
            at = np.searchsorted(keys, levels[0].keys)
            done, left = done[at], left[at]
        ones = []
        for d, level in enumerate(levels):
            last = depth + d == DEPTH
            ones.append(_rarer(done + left * (level.kt if last else own[d] * level.kt + (1 - own[d]) * 0.5)))
            if d + 1 < len(levels):
                done, left = (done + left * own[d] * level.kt)[parents[d]], (left * (1 - own[d]))[parents[d]]
        out.append(_Weighed(levels, ones, log_pw, done, left))
    return out


def _predicted(weighed: list[_Weighed], d: int, codes: np.ndarray) -> np.ndarray:
    """For each run of a depth the predictions at its eight nodes."""
    return np.stack([np.repeat(w.ones[d], np.diff(np.append(w.levels[d].first, len(codes)))) for w in weighed], axis=1)


def weighted_tree(runs: list[tuple[np.ndarray, np.ndarray]]) -> Tree:
    """The tree of runs (sorted codes and counts) of all depths from 0 on."""
    weighed = _weigh(runs)
    return Tree.of([(codes, _predicted(weighed, d, codes)) for d, (codes, _) in enumerate(runs)])


def computed(tree: Tree, codes: np.ndarray) -> np.ndarray:
    """log10 probability of the last byte of any runs: each bit by the mixture at the longest context that has seen its prefix."""
    out = np.zeros(len(codes))
    for bits in range(8):
        down = np.uint64(8 - bits)
        p = np.full(len(codes), 0.5)
        for d, known in enumerate(tree.codes):
            key = (codes & np.uint64((1 << (8 * (d + 1))) - 1)) >> down
            at = np.minimum(np.searchsorted(known, key << down), len(known) - 1)
            seen = np.flatnonzero(known[at] >> down == key)
            first, one = tree.nodes[d][bits]
            p[seen] = one[np.searchsorted(first, at[seen].astype(np.uint32))]
        out += _bit_log(codes, bits, p)
    return out


_FREE = np.uint64(2**64 - 1)


class Model:
    """log10 probabilities of bytes after their contexts; runs of the full depth are found in an open hash table."""

    def __init__(self, tree: Tree) -> None:
        self.tree = tree
        codes = tree.codes[-1]
        self.bits = max(10, (2 * len(codes)).bit_length())
        self.slots = np.full((1 << self.bits) + 256, _FREE)
        self.values = np.zeros(len(self.slots), np.float32)
        at, todo = self._slot(codes), np.arange(len(codes))
        while len(todo):
            free = self.slots[at[todo]] == _FREE
            spot, first = np.unique(at[todo[free]], return_index=True)
            put = todo[free][first]
            self.slots[spot], self.values[spot] = codes[put], tree.values[put]
            todo = todo[self.slots[at[todo]] != codes[todo]]
            at[todo] += 1
            if len(todo) and at[todo].max() >= len(self.slots) - 1:  # the last slot stays free
                self.slots = np.concatenate([self.slots, np.full(4096, _FREE)])
                self.values = np.concatenate([self.values, np.zeros(4096, np.float32)])

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return (mixed(codes) >> np.uint64(64 - self.bits)).astype(np.int64)

    def computed(self, codes: np.ndarray) -> np.ndarray:
        return computed(self.tree, codes)

    def _held(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the runs in the hash table, and which are not in it."""
        out = np.zeros(len(codes))
        at, todo, unknown = self._slot(codes), np.arange(len(codes)), [np.empty(0, np.int64)]
        while len(todo):
            held, wanted = self.slots[at], codes[todo]
            hit = held == wanted
            out[todo[hit]] = self.values[at[hit]]
            unknown.append(todo[~hit & (held == _FREE)])
            more = ~hit & (held != _FREE)
            todo, at = todo[more], at[more] + 1
        return out, np.concatenate(unknown)

    def scores(self, codes: np.ndarray) -> np.ndarray:
        codes = codes & np.uint64((1 << (8 * len(self.tree.codes))) - 1)
        out, which = self._held(codes)
        if len(which):
            distinct, back = np.unique(codes[which], return_inverse=True)
            out[which] = self.computed(distinct)[back]
        return out

    def near_scores(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of runs, and the places of those that need contexts which are not here; they have 0."""
        if self.tree.whole:
            return self.scores(codes), np.empty(0, np.int64)
        if len(self.tree.codes) <= DEPTH:
            return np.zeros(len(codes)), np.arange(len(codes))
        out, which = self._held(codes)
        distinct, back = np.unique(codes[which], return_inverse=True)
        known, low = self.tree.codes[-1], np.uint64(8)
        # A context's runs are all here or none, and with them those of its shorter contexts.
        at = np.minimum(np.searchsorted(known, distinct >> low << low), len(known) - 1)
        near = known[at] >> low == distinct >> low
        values = np.zeros(len(distinct))
        values[near] = self.computed(distinct[near])
        out[which] = values[back]
        return out, np.sort(which[~near[back]])


#: The model and word logarithms that this process made last, by the run's name.
_made: dict[str, tuple] = CACHES.setdefault("ctw", {})


def _summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[first], np.add.reduceat(counts, first)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct runs of a task with their counts, merged as they come."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = most = 0

    def out() -> pa.RecordBatch:
        codes, counts = _summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
        return pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), pa.array(counts)], names=["code", "n"])

    for batch in sized_batches(batches, "text", 1 << 20):
        texts = [t.lower() if t else b"" for t in batch.column(0).cast(pa.binary()).to_pylist()]
        held.append(np.unique(run_codes(texts), return_counts=True))
        size += len(held[-1][0])
        if size > max(600_000, 2 * most):
            held = [_summed(*(np.concatenate(x) for x in zip(*held, strict=True)))]
            size = most = len(held[0][0])
            if size > 800_000:
                yield out()
                held, size, most = [], 0, 0
    if held:
        yield out()


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    for batch in sized_batches(batches, "text"):
        texts = batch.column(0).cast(pa.binary()).to_pylist()
        held[END] += len(texts)
        for t in texts:
            if t:
                held.update(t.lower().split())
        if len(held) > 150_000:
            yield out()
            held.clear()
    if held:
        yield out()


class _Top(NamedTuple):
    """The contexts of up to ``SPLIT`` bytes, and what they give the nodes of the longest of them."""

    tree: Tree
    above: list[tuple[np.ndarray, np.ndarray, np.ndarray]]


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows (code, n, wanted), those of one context of ``SPLIT`` bytes together."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.shiftright("code", 8).bitwiseAND((1 << (8 * SPLIT)) - 1)
    return rows.withColumn("key", key).repartition(n, "key").sortWithinPartitions("key").select("code", "n", "wanted")


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]]:
    """Of whole contexts of ``SPLIT`` bytes: the runs of the depths from ``SPLIT`` on, and the codes wanted."""

    def out(codes: np.ndarray, counts: np.ndarray, wanted: np.ndarray):
        seen = counts > 0
        runs = [_summed(codes[seen], counts[seen])] if seen.any() else []
        for d in range(DEPTH - 1, SPLIT - 1, -1) if runs else []:
            runs.insert(0, _summed(runs[0][0] & np.uint64((1 << (8 * (d + 1))) - 1), runs[0][1]))
        return runs, codes[wanted]

    held, size, most = [], 0, CHUNK
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        held.append((columns[0].view(np.uint64), *columns[1:]))
        size += batch.num_rows
        if size > most:
            whole = [np.concatenate(x) for x in zip(*held, strict=True)]
            keys = (whole[0] >> np.uint64(8)) & np.uint64((1 << (8 * SPLIT)) - 1)
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield out(*(x[:cut] for x in whole))
            held, size = [tuple(x[cut:] for x in whole)], size - cut
            most = max(CHUNK, 2 * size)
    if held:
        yield out(*(np.concatenate(x) for x in zip(*held, strict=True)))


def _lower_weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """log Pw of the nodes of ``SPLIT`` bytes."""
    for runs, _ in _subtrees(batches):
        for bits, w in enumerate(_weigh(runs, SPLIT)):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(w.log_pw), bits, np.int32)), pa.array(w.levels[0].keys.view(np.int64)), pa.array(w.log_pw)], names=["bits", "node", "log_pw"])


def _often(runs: tuple[np.ndarray, np.ndarray], least: int) -> np.ndarray:
    """Which runs are of contexts seen at least 2**least times."""
    context = _Level(*runs, 0)
    return np.repeat(context.total >= 2**least, np.diff(np.append(context.first, len(runs[0]))))


def _common(top_of, least: list[int]):
    """The runs of long contexts that are broadcast, with their predictions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for runs, _ in _subtrees(batches):
            weighed = _weigh(runs, SPLIT, above=top_of.value.above)
            for i in range(1, len(runs)):
                kept, codes = _often(runs[i], least[SPLIT + i]), runs[i][0]
                ones = _predicted(weighed, i, codes)[kept]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ones), SPLIT + i, np.int32)), pa.array(codes[kept].view(np.int64)), *(pa.array(ones[:, k]) for k in range(8))], names=["depth", "code", *(f"p{k}" for k in range(8))]
                )

    return run


def _looked_up(top_of):
    """log10 probabilities of the codes wanted, by all contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for runs, wanted in _subtrees(batches):
            if not len(wanted):
                continue
            top = tree = top_of.value.tree
            if runs:
                weighed = _weigh(runs, SPLIT, above=top_of.value.above)
                lower = Tree.of([(codes, _predicted(weighed, i, codes)) for i, (codes, _) in enumerate(runs)])
                tree = Tree([*top.codes, *lower.codes[1:]], [*top.nodes, *lower.nodes[1:]], lower.values)
            values = computed(tree, wanted).astype(np.float32).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(wanted.view(np.int64)), pa.array(values)], names=["code", "value"])

    return run


def _sorted(table: pa.Table) -> list[np.ndarray]:
    """The columns of a table in the order of the first, which has codes."""
    codes, *rest = (c.to_numpy() for c in table.columns)
    order = np.argsort(codes)
    return [codes[order].view(np.uint64), *(x[order] for x in rest)]


def learned(docs: DataFrame, scratch: Scratch) -> tuple[Tree | None, _Top | None, DataFrame]:
    """Gather the runs of all texts of ``docs`` and weigh all contexts: the tree to broadcast, the short contexts, and all runs."""
    full = arrow_map(docs.select("text"), _runs, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    levels = [scratch.keep(full, f"runs-{DEPTH}")]
    for d in range(DEPTH - 1, -1, -1):
        shorter = levels[0].groupBy(F.col("code").bitwiseAND((1 << (8 * (d + 1))) - 1).alias("code")).agg(F.sum("n").alias("n"))
        levels.insert(0, scratch.keep(shorter, f"runs-{d}"))
    least = [0]  # grows with the depth, so that a kept context's shorter ones are kept too
    for level in levels[1:]:
        least.append(least[-1])
        contexts = level.groupBy(F.shiftright("code", 8).alias("context")).agg(F.sum("n").alias("total"), F.count("*").alias("runs"))
        by = contexts.groupBy(F.floor(F.log2("total")).cast("int").alias("size")).agg(F.sum("runs").alias("runs")).collect()
        room = MAX_RUNS
        for r in sorted(by, key=lambda r: -r["size"]):
            room -= r["runs"]
            if room < 0:
                least[-1] = max(least[-1], r["size"] + 1)
                break
    short = [tuple(_sorted(level.select("code", "n").toArrow())) for level in levels[: SPLIT + 1]]
    scratch.drop(*(f"runs-{d}" for d in range(DEPTH)))
    runs = levels[-1]
    if not len(short[0][0]):
        return None, None, runs
    all_runs = _dealt(runs.select("code", "n", F.lit(False).alias("wanted")))
    weights = arrow_map(all_runs, _lower_weights, "bits int, node long, log_pw double").toArrow()
    below = [_sorted(weights.filter(pc.equal(weights["bits"], bits)).select(["node", "log_pw"]))[1] for bits in range(8)]
    weighed = _weigh(short, below=below)
    rows = [(codes, _predicted(weighed, d, codes)) for d, (codes, _) in enumerate(short)]
    top = _Top(Tree.of(rows), [(w.levels[-1].keys, w.done, w.left) for w in weighed])
    kept = [(codes[often], ones[often]) for d, (codes, ones) in enumerate(rows) for often in [_often(short[d], least[d])]]
    top_of = docs.sparkSession.sparkContext.broadcast(top)
    common = scratch.keep(arrow_map(all_runs, _common(top_of, least), "depth int, code long, " + ", ".join(f"p{k} float" for k in range(8))), "common")
    for d in range(SPLIT + 1, DEPTH + 1):
        codes, *ones = _sorted(common.where(F.col("depth") == d).drop("depth").toArrow())
        kept.append((codes, np.stack(ones, axis=1)))
    top_of.destroy()
    scratch.drop("common")
    shown = next((d for d, (codes, _) in enumerate(kept) if not len(codes)), len(kept))
    return Tree.of(kept[:shown], not any(least)), top, runs


def train_tree(docs: DataFrame, scratch: Scratch) -> Tree | None:
    """The tree to broadcast."""
    return learned(docs, scratch)[0]


def _scorer(run: str, model_of, words_of):
    schema = pa.schema([("n_tokens", pa.int64()), ("n_known", pa.int64()), ("logs", pa.float64()), ("score", pa.float64()), ("tail", pa.list_(pa.binary())), ("far", pa.list_(pa.int64())), ("n_bytes", pa.int64())])

    def make():
        if run not in _made:
            _made.clear()
            tree, (names, counts, ends) = model_of.value, words_of.value
            logs = {n: math.log10(n + 1) for n in set(counts.tolist())}
            _made[run] = (Model(tree) if tree else None, dict(zip(names.to_pylist(), map(logs.get, counts.tolist()), strict=True)), ends)
        model, known, ends = _made[run]
        end_log = math.log10(ends + 1)

        def work(texts: list[bytes | None], kept: list[pa.Array]) -> list[pa.Array]:
            texts = [t.lower() if t else b"" for t in texts]
            n_tokens, n_known, logs, tails = [], [], [], []
            for t in texts:
                words = t.split()
                found = list(map(known.get, words))
                tail = []
                if None in found:
                    tail = [w for w, x in zip(words, found, strict=True) if x is None]
                    found = [x for x in found if x is not None]
                n_tokens.append(len(words) + 1)
                n_known.append(len(found) + (ends > 0))
                logs.append(math.fsum(found) + end_log)
                tails.append(tail)
            far: list[np.ndarray] = [np.empty(0, np.int64)] * len(texts)
            if model is None:
                score = np.array([-8 * (len(t) + 1) * math.log10(2) for t in texts])
            else:
                codes = run_codes(texts) if texts else np.empty(0, np.uint64)
                values, places = model.near_scores(codes)
                starts = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
                score = np.add.reduceat(values, starts) if texts else values
                if len(places):
                    far = np.split(codes[places].view(np.int64), np.searchsorted(places, starts[1:]))
            return [pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(logs), pa.array(score), pa.array(tails, schema.field(4).type), pa.array(far, schema.field(5).type), pa.array(list(map(len, texts)), pa.int64())]

        return work

    return make, schema


def scored_texts(docs: DataFrame, learn_from: Column) -> DataFrame:
    """Scores of all documents under models learned from those of the condition ``learn_from``.

    Columns: doc_id, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte.  Tokens are the
    lower-cased words (runs without ASCII white space) and one end; ``n_known`` counts those that
    occur in training texts.  ``base_score`` sums log10((c + 1) / (N + V + 1)) over the tokens,
    with their training counts c, N tokens and V distinct ones, the end among them; the one more is
    for all tokens not seen.  It is null if nothing was learned.  ``n_bytes`` counts the bytes of the text,
    and ``bits_per_byte`` is the model's code length: the score in bits over the bytes, over one for an empty text.  A null text is empty; its tokens are the end alone.  Without training texts the
    model gives every bit one half.  Rows repeat as they come.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "ctw")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    training = docs.where(learn_from)
    vocabulary = scratch.keep(arrow_map(training.select("text"), _words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    sums = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.coalesce(F.sum(F.when(F.col("word") == F.lit(END), F.col("n"))), F.lit(0)).alias("ends")).head()
    # The commonest words, by a power of two as the least count.
    by = vocabulary.where(F.col("word") != F.lit(END)).groupBy(F.floor(F.log2("n")).cast("int").alias("size")).agg(F.count("*").alias("words")).collect()
    least, room = 0, MAX_WORDS
    for r in sorted(by, key=lambda r: -r["size"]):
        room -= r["words"]
        if room < 0:
            least = r["size"] + 1
            break
    head = vocabulary.where((F.col("word") != F.lit(END)) & (F.col("n") >= 2**least)).toArrow()
    words_of = spark.sparkContext.broadcast((head["word"].combine_chunks(), head["n"].to_numpy(), int(sums["ends"])))
    del head
    tree, top, runs = learned(training, scratch)
    model_of = spark.sparkContext.broadcast(tree)
    whole = tree is None or tree.whole
    del tree
    make, schema = _scorer(scratch.base, model_of, words_of)
    first = scan_texts(docs, make, schema, "n_tokens long, n_known long, logs double, score double, tail array<binary>, far array<bigint>, n_bytes long", keep="ctw")
    first = scratch.keep(first.withColumn("row", F.monotonically_increasing_id()), "scored")
    words_of.destroy()
    model_of.destroy()
    rare = first.select("row", F.explode("tail").alias("word"))
    rare = rare.join(vocabulary, "word", "left").groupBy("row").agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("more_logs"), F.count("n").alias("more_known"))
    out = first.join(rare, "row", "left").withColumn("more_score", F.lit(0.0))
    if not whole:
        far = first.select("row", F.explode("far").alias("code")).groupBy("row", "code").agg(F.count("*").alias("times"))
        wanted = far.select("code").distinct().select("code", F.lit(0).cast("long").alias("n"), F.lit(True).alias("wanted"))
        rows = runs.select("code", "n", F.lit(False).alias("wanted")).unionByName(wanted)
        values = scratch.keep(arrow_map(_dealt(rows), _looked_up(spark.sparkContext.broadcast(top)), "code long, value double"), "far")
        more = far.join(values, "code").groupBy("row").agg(F.sum(F.col("value") * F.col("times")).alias("far_score"))
        out = out.join(more, "row", "left").withColumn("more_score", F.coalesce("far_score", F.lit(0.0)))
    total = F.lit(math.log10(sums["n"] + sums["v"] + 1)) if sums["n"] else F.lit(None).cast("double")
    score = F.col("score") + F.col("more_score")
    return out.select(
        F.col("c0").alias("doc_id"), "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(int(sums["n"])).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * total).alias("base_score"), score.alias("score"),
        "n_bytes", (-score * math.log2(10) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )
