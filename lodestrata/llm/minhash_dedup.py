"""Near-duplicate documents by b-bit MinHash.

Every document becomes a set of hashed word shingles.  Documents with equal sets are one
class.  Each class gets ``N_HASHES`` minima; runs of full minima make the band
keys, and of all minima only the low ``BITS`` bits are retained, packed into words by bit
plane.  The similarity of two classes is estimated from the bit count of the planes'
differences, corrected for the chance of equal low bits, and links are confirmed on the
full sets.

Candidates never are all pairs of a bucket.  First each member of a bucket meets the bucket's
smallest class only.  Of what that leaves in more than one component, the members outside the
bucket's largest component meet the members of other components, inside a sort-merge join
whose condition holds the estimate, so that only pairs near the threshold come out, each once.

Chance of losing a link at exactly the threshold: the bands (at 0.85, 40 of 8 minima each) miss
it with probability ``MISSED``, the estimate (4.5 standard deviations below) with 4e-6; both
fall fast above the threshold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm._common import Scratch, WordHashes, arrow_map, column_bytes, mixed, sized_batches, small_batches

N_HASHES = 1024
BITS = 2
MISSED = 3e-6
WORDS = N_HASHES // 64
#: Standard deviations of the estimate below the threshold at which a pair is still confirmed.
SLACK = 4.5

_random = np.random.default_rng(20_240_501)
_FACTORS = _random.integers(0, 2**32, N_HASHES, np.uint64).astype(np.uint32) | np.uint32(1)
_SHINGLE = _random.integers(0, 2**63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _random.integers(0, 2**63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_PROFILE = "doc_id long, node long, n_shingles long, signature array<bigint>, bands array<bigint>"


def banding(percent: int) -> tuple[int, int]:
    """Bands and minima in each, so that a pair at the threshold shares a band key but for ``MISSED``."""
    s = min(percent, 99) / 100
    rows = max(1, int(np.log(0.25) / np.log(s)))
    bands = int(np.ceil(np.log(MISSED) / np.log(1 - s**rows)))
    rows = min(rows, N_HASHES // bands)
    return bands, rows


def shingles(text: bytes | None, hashes: WordHashes, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's ``size``-word shingles.

    Fewer words make one shingle of all of them; a null text or one without words has none.
    """
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    w, n = hashes.of(words), len(words) - size + 1
    total = w[:n] * _SHINGLE[0]
    for k in range(1, size):
        total += w[k : k + n] * _SHINGLE[k]
    return np.unique(mixed(total))


def node_of(found: np.ndarray) -> int:
    """The class of a set: 64 bits of a digest of its sorted members."""
    return int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8).digest(), "little", signed=True)


def minima(found: np.ndarray) -> np.ndarray:
    """The minimum of each hash function over a non-empty set."""
    x = (found >> np.uint64(32)).astype(np.uint32)
    low = np.full(N_HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 256):
        np.minimum(low, (_FACTORS[:, None] * x[None, at : at + 256]).min(axis=1), out=low)
    return low


def packed(low: np.ndarray) -> np.ndarray:
    """The low bits of the (finalised) minima, one plane of ``WORDS`` words for each bit."""
    v = low ^ (low >> np.uint32(16))
    v = v * np.uint32(0x7FEB352D)
    v ^= v >> np.uint32(15)
    return np.concatenate([np.packbits((v >> np.uint32(b)).astype(np.uint8) & 1).view(np.int64) for b in range(BITS)])


def band_keys(low: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key for each band; keys of different bands differ."""
    taken = low[: bands * rows].reshape(bands, rows).astype(np.uint64)
    return mixed((taken * _BAND[:rows]).sum(axis=1, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)).view(np.int64)


def _profiles(size: int, bands_rows: tuple[int, int]):
    schema = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("n_shingles", pa.int64()), ("signature", pa.list_(pa.int64())), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in sized_batches(batches, "text"):
            nodes, counts, signs, bands = [], [], [], []
            for text in column_bytes(batch, "text"):
                found = shingles(text, hashes, size)
                low = minima(found) if len(found) else None
                counts.append(len(found))
                nodes.append(node_of(found) if len(found) else None)
                signs.append(None if low is None else packed(low))
                bands.append(None if low is None else band_keys(low, *bands_rows))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes, pa.int64()), pa.array(counts, pa.int64()), pa.array(signs, schema.field(3).type), pa.array(bands, schema.field(4).type)], schema=schema)

    return run


def _sets(size: int):
    """The full sets of documents that stand for a class, as packed hashes; other rows of the same id go."""
    schema = pa.schema([("node", pa.int64()), ("members", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in sized_batches(batches, "text"):
            out = []
            for node, text in zip(batch.column(1).to_pylist(), column_bytes(batch, "text"), strict=True):
                found = shingles(text, hashes, size)
                if len(found) and node_of(found) == node:
                    out.append((node, found.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary())], schema=schema)

    return run


def _confirmed(percent: int):
    """Pairs whose full sets meet the threshold: 100 * intersection >= percent * union."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 256):
            rows = batch.to_pydict()
            good = []
            for x, y in zip(rows["ma"], rows["mb"], strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], schema=schema).filter(pa.array(good, pa.bool_()))

    return run


def most_differences(percent: int) -> int:
    """How many of the hashes may differ in their low bits before a pair is no longer confirmed."""
    chance = 2.0**-BITS
    p = chance + (1 - chance) * percent / 100
    return int(np.ceil(N_HASHES * (1 - p) + SLACK * np.sqrt(N_HASHES * p * (1 - p))))


def differences(x: Column, y: Column) -> Column:
    """Hashes whose retained bits differ, by bit counts over the packed planes."""
    total = None
    for k in range(WORDS):
        word = None
        for b in range(BITS):
            plane = x[k + b * WORDS].bitwiseXOR(y[k + b * WORDS])
            word = plane if word is None else word.bitwiseOR(plane)
        total = F.bit_count(word) if total is None else total + F.bit_count(word)
    return total


def estimated_similarity(x: Column, y: Column) -> Column:
    """Similarity of two signatures, corrected for low bits that are equal by chance."""
    chance = 2.0**-BITS
    return F.greatest(F.lit(0.0), ((1 - differences(x, y) / N_HASHES) - chance) / (1 - chance))


def connected(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Components of links (a, b): a row (node, root) for each node of a link, root any one node of its component.

    Each round moves every node to its smallest neighbour and renames the links; links
    inside one node vanish.  Rounds go on until no link is left, so paths of any length work.
    """
    spark = scratch.spark
    links = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    links = scratch.keep(links, f"{name}-links-0")
    mapping = None
    turn = 0
    while links.head(1):
        turn += 1
        both = links.select(F.col("a").alias("node"), F.col("b").alias("to")).unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("to")))
        step = scratch.keep(both.groupBy("node").agg(F.least(F.col("node"), F.min("to")).alias("to")), f"{name}-step-{turn}")
        if mapping is None:
            mapping = step.select("node", F.col("to").alias("root"))
        else:
            mapping = mapping.join(step.select(F.col("node").alias("root"), "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        mapping = scratch.keep(mapping, f"{name}-map-{turn}")
        moved = links.join(step.select(F.col("node").alias("a"), F.col("to").alias("a2")), "a").join(step.select(F.col("node").alias("b"), F.col("to").alias("b2")), "b")
        moved = moved.where("a2 <> b2").select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct()
        links = scratch.keep(moved, f"{name}-links-{turn}")
        scratch.drop(f"{name}-links-{turn - 1}", f"{name}-step-{turn - 1}", f"{name}-map-{turn - 1}")
    if mapping is None:
        return spark.createDataFrame([], "node long, root long")
    return mapping


def near_duplicates(docs: DataFrame, percent: int = 85, size: int = 5) -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id, kept.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not read, whatever their names.
    Documents link when 100 * intersection >= percent * union of their shingle sets;
    ``component_id`` is the smallest doc_id reachable over links.  Null or empty texts have
    n_shingles 0 and link with nothing.  Rows with a null doc_id stay rows; their
    component_id is the smallest id reachable, or null.  Repeated rows are equal copies.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "minhash")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    profile = scratch.keep(arrow_map(docs, _profiles(size, banding(percent)), _PROFILE), "profile")

    slim = scratch.keep(profile.select("doc_id", "node", "n_shingles"), "slim")

    # A class is a set; its first document stands for it.
    classes = scratch.keep(profile.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first_id")), "classes")
    first = profile.where("node is not null").join(classes.select(F.col("node").alias("n2"), "first_id"), (F.col("node") == F.col("n2")) & F.col("doc_id").eqNullSafe(F.col("first_id")), "left_semi")
    first = first.select("node", "n_shingles", "signature", "bands")

    # Buckets of more than one class, and the links of each class with its buckets' smallest class.
    banded = first.select("node", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.min("node").alias("lead"), F.max("node").alias("last")).where("lead <> last").select("key", "lead")
    banded = scratch.keep(banded.join(buckets, "key"), "banded")
    nodes = banded.select("node").distinct()
    signed = scratch.keep(first.join(nodes, "node", "left_semi").dropDuplicates(["node"]), "signed")
    limit = most_differences(percent)
    pairs = banded.where("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    pairs = pairs.join(signed.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("signature").alias("sa")), "a").join(signed.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("signature").alias("sb")), "b")
    alike = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")  # sets of other sizes cannot meet the threshold
    pairs = scratch.keep(pairs.where(alike & (differences(F.col("sa"), F.col("sb")) <= limit)).select("a", "b"), "pairs-1")
    links = scratch.keep(_confirm(docs, classes, pairs, scratch, "1", percent, size), "links-1")
    part = connected(links, scratch, "part")

    # Buckets that hold more than one component still: exactly the pairs that no link joins yet.
    placed = banded.select("key", "node").distinct().join(part, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    placed = scratch.keep(placed, "placed")
    sizes = placed.groupBy("key", "root").agg(F.count("*").alias("n"))
    main = sizes.groupBy("key").agg(F.max_by("root", "n").alias("main"), F.count("*").alias("parts")).where("parts > 1").select("key", "main")
    open_ = placed.join(main, "key").join(signed, "node")
    open_ = scratch.keep(open_, "open")
    x = open_.where("root <> main").select("key", F.col("node").alias("a"), F.col("root").alias("ra"), F.col("main"), F.col("n_shingles").alias("na"), F.col("signature").alias("sa"), F.col("bands").alias("ba"))
    y = open_.select(F.col("key").alias("key2"), F.col("node").alias("b"), F.col("root").alias("rb"), F.col("n_shingles").alias("nb"), F.col("signature").alias("sb"), F.col("bands").alias("bb"))
    near = (F.col("key") == F.col("key2")) & (F.col("ra") != F.col("rb")) & ((F.col("rb") == F.col("main")) | (F.col("a") < F.col("b"))) & alike & (differences(F.col("sa"), F.col("sb")) <= limit)
    shared = F.coalesce(*[F.when(F.col("ba")[i] == F.col("bb")[i], F.col("ba")[i]) for i in range(banding(percent)[0])])
    near &= shared == F.col("key")  # once for each pair, at the first key that it shares
    more = x.join(y.hint("merge"), near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    more = scratch.keep(more.join(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"), "pairs-2")
    links = scratch.keep(links.unionByName(_confirm(docs, classes, more, scratch, "2", percent, size)), "links-2")
    roots = connected(links, scratch, "all")

    # Smallest document of each component, for each class that has a link.
    named = roots.join(classes, "node").select("node", "root", "first_id")
    least = named.groupBy("root").agg(F.min("first_id").alias("least_id"))
    label = named.join(least, "root").select("node", "least_id")
    label = scratch.keep(classes.join(label, "node", "left").select("node", F.coalesce("least_id", "first_id").alias("component_id")), "label")
    scratch.drop("profile", "banded", "placed", "open", "pairs-1", "pairs-2", "links-1", "links-2", "signed", "classes", "sets-1", "sets-2")
    out = slim.join(label, "node", "left").select("doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _confirm(docs: DataFrame, classes: DataFrame, pairs: DataFrame, scratch: Scratch, turn: str, percent: int, size: int) -> DataFrame:
    """The pairs of classes whose full sets link; only texts that stand in a pair are read into sets."""
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = wanted.join(classes, "node").select("node", F.col("first_id"))
    texts = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["first_id"])).select("doc_id", "node", "text")
    sets = scratch.keep(arrow_map(texts, _sets(size), "node long, members binary").dropDuplicates(["node"]), f"sets-{turn}")
    held = pairs.join(sets.select(F.col("node").alias("a"), F.col("members").alias("ma")), "a").join(sets.select(F.col("node").alias("b"), F.col("members").alias("mb")), "b")
    return arrow_map(held.select("a", "b", "ma", "mb"), _confirmed(percent), "a long, b long")
