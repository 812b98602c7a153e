"""Each operator against brute force on small tables, with nulls, ties, repeats, long texts, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, sources=None, ids=None):
    sources = sources or [f"s{i % 3}" for i in range(len(texts))]
    ids = ids or list(range(len(texts)))
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in zip(ids, texts, sources, strict=True)], DOCS)


def clashing(df, *names):
    """Extra columns whose names the operators use inside."""
    for name in names:
        df = df.withColumn(name, F.lit("x"))
    return df


def words(rng, n, vocabulary=200):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


# --- op1 ---------------------------------------------------------------------------------------------------------


def shingle_set(text, size=5):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def components(rows, percent):
    sets = [(i, shingle_set(t)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                root[find(a)] = find(b)
    groups = defaultdict(list)
    for k in range(len(sets)):
        groups[find(k)].append(sets[k][0])
    return sorted((sets[k][0], len(sets[k][1]), min(groups[find(k)])) for k in range(len(sets)))


@pytest.mark.parametrize("percent", [85, 80])
def test_near_duplicates_equal_brute_force(spark, percent):
    from lodestrata.llm.minhash_dedup import near_duplicates

    rng = random.Random(percent)
    rows = [None, "", "  \n", "one", "ONE", "two words", "Two  words", "a b c d", "a b c d e"]
    for _ in range(12):
        base = words(rng, rng.randrange(5, 120))
        rows.append(" ".join(base))
        for _ in range(rng.randrange(8)):  # chains of edits: links lead over several documents
            base = list(base)
            for _ in range(rng.randrange(3)):
                base[rng.randrange(len(base))] = f"e{rng.randrange(1000)}"
            rows.append(" ".join(base).upper() if rng.random() < 0.3 else " ".join(base))
    rows.append(" ".join(words(rng, 30_000)))
    rng.shuffle(rows)
    docs = clashing(docs_of(spark, rows), "node", "key", "signature", "kept", "component_id")
    got = sorted(tuple(r) for r in near_duplicates(docs, percent).select("doc_id", "n_shingles", "component_id", "kept").collect())
    assert [r[:3] for r in got] == components(list(enumerate(rows)), percent)
    assert all(kept == (i == c) for i, _, c, kept in got)


def test_dense_group_of_near_copies_is_exact(spark):
    from lodestrata.llm.minhash_dedup import near_duplicates

    rng = random.Random(5)
    base = words(rng, 100, 10_000)
    rows = []
    for _ in range(150):
        w = list(base)
        for _ in range(rng.randrange(6)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(40)}"
        rows.append(" ".join(w))
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(docs_of(spark, rows)).collect())
    assert got == components(list(enumerate(rows)), 85)


def test_near_duplicates_of_repeated_rows_null_ids_and_nothing(spark):
    from lodestrata.llm.minhash_dedup import near_duplicates

    docs = docs_of(spark, ["a b c d e f"] * 4, ids=[7, 7, None, 9])
    got = Counter(tuple(r) for r in near_duplicates(docs).select("doc_id", "component_id", "kept").collect())
    assert got == {(7, 7, True): 2, (None, 7, False): 1, (9, 7, False): 1}
    assert near_duplicates(docs.limit(0)).count() == 0


def test_packed_estimate_corrects_for_chance():
    from lodestrata.llm import minhash_dedup as M

    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 2**63, 1000).astype(np.uint64))
    b = np.concatenate([a[:800], np.unique(rng.integers(0, 2**63, 200).astype(np.uint64))])
    x, y = M.packed(M.minima(a)), M.packed(M.minima(np.sort(b)))
    diff = sum(int((x[k] ^ y[k] | x[k + M.WORDS] ^ y[k + M.WORDS]).astype(np.uint64)).bit_count() for k in range(M.WORDS))
    estimate = (1 - diff / M.N_HASHES - 0.25) / 0.75
    assert abs(estimate - 800 / 1200) < 0.06


# --- op2 ---------------------------------------------------------------------------------------------------------


def test_top_k_equals_brute_force(spark):
    from lodestrata.llm import voronoi_knn as V

    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(400)]
    rows += [(400 + i, [0.5] * 8) for i in range(60)]  # ties
    rows += [(50, [0.25] * 8), (900, None), (950, [1.0, None] * 4), (1000, [math.inf] * 8), (1050, [math.nan] * 8), (None, [1.0] * 8), (1100, [1.0])]
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "uid", "cell", "score", "rank")
    got = sorted(tuple(r) for r in V.top_k(df, F.col("vec_id") % 50 == 0).collect())
    assert got == nearest(rows, 50)


def nearest(rows, every, k=5):
    """Exact integers; the shorter of two vectors counts as filled up with zeros."""
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(good):
        if i % every == 0:
            best = sorted((-sum(x * y for x, y in zip(q, v, strict=False)), j) for b, (j, v) in enumerate(good) if b != a)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def test_top_k_of_large_components_and_other_lengths(spark):
    """Components of 2**30 and more, whose products need more than a double, and vectors of five lengths."""
    from lodestrata.llm.voronoi_knn import top_k

    rng = random.Random(12)
    rows = [(i, [rng.uniform(-1, 1) * rng.choice([1.0, 2.0**22, 9e6]) for _ in range(rng.choice([0, 1, 3, 4, 9]))]) for i in range(300)]
    rows += [(300 + i, [2.0**22 + rng.randrange(2) / 256, 1.0 + i / 256]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 20 == 0).collect()) == nearest(rows, 20)
    wide = [(i, [2.0**53 * (1 if i % 2 else -1), float(i)]) for i in range(12)]  # products beyond a long
    got = [tuple(r) for r in top_k(spark.createDataFrame(wide, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, 3).collect()]
    assert sorted(got) == [(0, 1, 2, 2**63 - 1), (0, 2, 4, 2**63 - 1), (0, 3, 6, 2**63 - 1)]


def test_top_k_of_many_groups_sends_one_at_a_time(spark, monkeypatch):
    """Five hundred groups of queries: each batch that leaves a task is for one group, and results stay exact."""
    from lodestrata.llm import voronoi_knn as V

    monkeypatch.setattr(V, "QUERY_ROWS", 1)
    monkeypatch.setattr(V, "CHUNK_ROWS", 200)
    rng = random.Random(13)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(1000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    assert sorted(tuple(r) for r in V.top_k(df, F.col("vec_id") % 2 == 0).collect()) == nearest(rows, 2)
    import pyarrow as pa

    q = [np.zeros(6, np.int64).tobytes()] * 400
    batch = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array(range(400)), pa.array([True] * 400), pa.array(q, pa.binary()), pa.array([0] * 400, pa.int32()), pa.array([0.0] * 400)], names=["vec_id", "uid", "is_query", "q", "cell", "distance"])
    out = list(V._sent(np.zeros((1, 6)), {0: (1.0, 0.0)}, [V._Group([0], t, 500, [0], 2) for t in range(500)])(iter([batch])))
    assert len(out) > 500 and max(b.num_rows for b in out) == 400 and all(len(set(b.column(3).to_pylist())) == 1 for b in out)


def test_top_k_prunes_but_stays_exact_on_clusters(spark):
    from lodestrata.llm import voronoi_knn as V

    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 4)) * 20
    rows = [(i, [float(x) for x in centres[i % 6] + rng.normal(size=4) * 0.1]) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.rank): r.score for r in V.top_k(df, F.col("vec_id") % 20 == 0).collect()}
    q = {i: np.floor(256 * np.array(v)).astype(np.int64) for i, v in rows}
    for i in range(0, 600, 20):
        best = sorted((int(q[i] @ q[j]) for j in q if j != i), reverse=True)[:5]
        assert [got[i, k + 1] for k in range(5)] == best


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0])], [(0, [1.0]), (1, [2.0])], [(1, [1.0])]])
def test_top_k_of_few(spark, rows):
    from lodestrata.llm.voronoi_knn import top_k

    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert top_k(df, F.col("vec_id") % 50 == 0).count() == (len(rows) - 1 if any(i == 0 for i, _ in rows) else 0)


# --- op3 ---------------------------------------------------------------------------------------------------------


def fold7(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


def test_scores_are_of_one_distribution_and_base_is_exact(spark, monkeypatch):
    from lodestrata.llm import ctw_lm as C
    from lodestrata.llm.toxicity import fold

    rng = random.Random(2)
    texts = [" ".join(rng.choice(["Red", "green", "blue", "éa", f"x{rng.randrange(30)}"]) for _ in range(rng.randrange(1, 60))) for _ in range(60)] + [None, "", "\n", "red " * 5000]
    docs = clashing(docs_of(spark, texts), "word", "n", "row", "tail", "score")
    for most in (500_000, 4):
        monkeypatch.setattr(C, "MAX_WORDS", most)
        rows = {r.doc_id: r for r in C.scored_texts(docs, ~(fold(F.col("doc_id")) % 7 == 2)).collect()}
        counts = Counter()
        for i, t in enumerate(texts):
            if not fold7(i):
                counts.update([*(t or "").encode().lower().split(), b"\n"])
        n, v = sum(counts.values()), len(counts)
        for i, t in enumerate(texts):
            tokens = [*(t or "").encode().lower().split(), b"\n"]
            assert (rows[i].n_tokens, rows[i].n_known, rows[i].train_tokens) == (len(tokens), sum(counts[w] > 0 for w in tokens), n)
            assert rows[i].base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens))
            assert rows[i].score < 0 and math.isfinite(rows[i].score)
            assert rows[i].n_bytes == len((t or "").encode()) and rows[i].bits_per_byte == pytest.approx(-rows[i].score * math.log2(10) / max(rows[i].n_bytes, 1))


def test_tree_predictions_sum_to_one_and_match_a_plain_context_tree():
    from lodestrata.llm import ctw_lm as C

    texts = [b"abracadabra", b"abba", b"cab"] * 3
    codes = C.run_codes(texts)
    full, n = np.unique(codes, return_counts=True)
    runs = [(full, n)]
    for d in range(C.DEPTH - 1, -1, -1):
        runs.insert(0, C._summed(runs[0][0] & np.uint64((1 << (8 * (d + 1))) - 1), runs[0][1]))
    model = C.Model(C.weighted_tree(runs))
    for context in (b"\xff" * 5, b"\xffabra", b"zzzzz", b"cadab"):
        base = int.from_bytes(context, "big") << 8
        every = np.array([base | b for b in range(256)], np.uint64)
        assert (10 ** model.scores(every)).sum() == pytest.approx(1)
        assert np.allclose(model.scores(every), model.computed(every), atol=1e-5)
    # The same by plain recursion: Pw with one more bit over Pw without, at every context and bit prefix.
    def tree_of(texts):
        seen = Counter()
        for t in texts:
            data = b"\xff" * C.DEPTH + t + b"\xff"
            for i in range(C.DEPTH, len(data)):
                for bits in range(8):
                    for d in range(C.DEPTH + 1):
                        seen[bits, data[i] >> (8 - bits), data[i - d : i], data[i] >> (7 - bits) & 1] += 1
        return seen

    seen = tree_of(texts)
    children = defaultdict(set)
    for bits, prefix, context, _ in seen:
        if context:
            children[bits, prefix, context[1:]].add(context)

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def log_pw(bits, prefix, context, more, path):
        """log Pw of a node when the nodes on ``path`` have also seen the bit ``more`` (None: they have not)."""
        extra = [int(more == x and path[len(path) - len(context) :] == context) for x in (0, 1)]
        own = kt(*(seen[bits, prefix, context, x] + extra[x] for x in (0, 1)))
        if len(context) == C.DEPTH:
            return own
        below = set(children[bits, prefix, context])
        if sum(extra):
            below.add(path[len(path) - len(context) - 1 :])
        return math.log(0.5) + np.logaddexp(own, sum(log_pw(bits, prefix, c, more, path) for c in below))

    for context in (b"\xffabra", b"\xff" * 5, b"zzzzz", b"cadab", b"zzzza", b"zzbra", b"\xff\xffzab"):
        base = int.from_bytes(context, "big") << 8
        for byte in (ord("a"), ord("b"), ord("d"), ord("z"), 0xFF):
            expected = sum(log_pw(bits, byte >> (8 - bits), b"", byte >> (7 - bits) & 1, context) - log_pw(bits, byte >> (8 - bits), b"", None, context) for bits in range(8))
            assert model.scores(np.array([base | byte], np.uint64))[0] == pytest.approx(expected / math.log(10), rel=1e-4, abs=1e-5)


def test_pruned_tree_is_still_a_distribution(spark, monkeypatch):
    from lodestrata.llm import ctw_lm as C
    from lodestrata.llm._common import Scratch

    monkeypatch.setattr(C, "MAX_RUNS", 300)
    rng = random.Random(1)
    docs = docs_of(spark, ["".join(rng.choice("abcdefgh ") for _ in range(400)) for _ in range(20)])
    tree = C.train_tree(docs, Scratch(spark, "t"))
    assert max(len(c) for c in tree.codes) <= 300
    model = C.Model(tree)
    for context in (b"abcde", b"\xff" * 5, b"a b c"):
        every = np.array([(int.from_bytes(context, "big") << 8) | b for b in range(256)], np.uint64)
        assert (10 ** model.scores(every)).sum() == pytest.approx(1)


def test_scores_do_not_depend_on_what_is_broadcast(spark, monkeypatch):
    """op3 scores by all contexts of the training texts, however few of them are broadcast."""
    from lodestrata.llm import ctw_lm as C
    from lodestrata.llm.toxicity import fold

    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdefgh éß") for _ in range(rng.randrange(300))) for _ in range(60)] + [None, "", "zq" * 50]
    docs, learn = docs_of(spark, texts), ~(fold(F.col("doc_id")) % 7 == 2)
    codes, n = np.unique(C.run_codes([(t or "").encode() for i, t in enumerate(texts) if not fold7(i)]), return_counts=True)
    runs = [(codes, n)]
    for d in range(C.DEPTH - 1, -1, -1):
        runs.insert(0, C._summed(runs[0][0] & np.uint64((1 << (8 * (d + 1))) - 1), runs[0][1]))
    model = C.Model(C.weighted_tree(runs))
    expected = [model.scores(C.run_codes([(t or "").encode()])).sum() for t in texts]
    for most, chunk in ((1_000_000, 200_000), (2000, 500), (300, 1), (1, 500)):
        monkeypatch.setattr(C, "MAX_RUNS", most)
        monkeypatch.setattr(C, "CHUNK", chunk)
        got = {r.doc_id: r.score for r in C.scored_texts(docs, learn).collect()}
        assert [got[i] for i in range(len(texts))] == pytest.approx(expected, rel=1e-6)


def test_a_bit_after_very_many_others_has_a_finite_score(spark):
    """In 32 bits a one is certain after some 17 million ones; the zero of a held-out text was then impossible."""
    from lodestrata.llm import ctw_lm as C
    from lodestrata.llm.toxicity import fold

    for n in (10**6, 10**8, 10**11):
        full = np.array([int.from_bytes(b"o" * C.DEPTH + b"o", "big")], np.uint64)
        runs = [(full & np.uint64((1 << (8 * (d + 1))) - 1), np.array([n])) for d in range(C.DEPTH + 1)]
        got = C.Model(C.weighted_tree(runs)).scores(full - np.uint64(1))[0]  # an n after nothing but o
        assert got == pytest.approx(math.log10(0.5 / (n + 1)), rel=1e-4)
    ids = [[i for i in range(60) if fold7(i) == held] for held in (False, True)]
    rows = [(i, "o" * 1_000_000) for i in ids[0][:36]] + [(ids[1][0], "ooooooonooo"), (ids[1][1], "ooo")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    score = {r.doc_id: r.score for r in C.scored_texts(docs, ~(fold(F.col("doc_id")) % 7 == 2)).collect()}
    assert len(score) == len(rows) and all(math.isfinite(x) and x < 0 for x in score.values())


def test_scores_without_training(spark):
    from lodestrata.llm.ctw_lm import scored_texts

    rows = scored_texts(docs_of(spark, ["ab", None]), F.lit(False)).orderBy("doc_id").collect()
    assert rows[0].base_score is None and rows[0].score == pytest.approx(-24 * math.log10(2)) and rows[1].train_tokens == 0
    assert scored_texts(docs_of(spark, ["a"]).limit(0), F.lit(True)).count() == 0


def test_model_learns_structure_of_unseen_texts(spark):
    """Held-out code length lies well under the entropy of single bytes."""
    from lodestrata.llm.ctw_lm import scored_texts
    from lodestrata.llm.toxicity import fold

    rng = random.Random(9)
    parts = ["an", "the", "er", "ing", "ous", "re", "st", "on"]
    texts = [" ".join("".join(rng.choice(parts) for _ in range(rng.randrange(2, 6))) for _ in range(80)) for _ in range(150)]
    held = [r for r in scored_texts(docs_of(spark, texts), ~(fold(F.col("doc_id")) % 7 == 2)).collect() if fold7(r.doc_id)]
    counts = Counter("".join(texts))
    entropy = -sum(n * math.log2(n / counts.total()) for n in counts.values()) / counts.total()
    bits = -sum(r.score for r in held) * math.log2(10) / sum(len(texts[r.doc_id]) + 1 for r in held)
    assert held and bits < 0.7 * entropy


# --- op4, op7 ----------------------------------------------------------------------------------------------------

TEXTS = ["Hello, world!", None, "", "It's 42 <|endoftext|> ok", "É é ﬁ 日本 🙂", "a" * 3000, "x " * 40_000, "Hello, world!", "tab\tand\nline", "don't <|STARTOFTEXT|> <|startoftext|>s", "word%%% (x),(y)"]


def library_ids(special=True):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.encode_special_tokens = not special
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def test_token_files_round_trip(spark, monkeypatch):
    from lodestrata.llm import elias_fano as E

    ids = [5, 3, 9, 1, 7, 2, 0, 9, 11, 4, 6]
    docs = clashing(docs_of(spark, TEXTS, ids=ids), "part", "tie", "start", "data")
    encode, start, expected = library_ids(), 0, []
    for i, t in sorted(zip(ids, TEXTS, strict=True), key=lambda x: x[0]):
        own = [*encode(t), 1]
        expected.append((i, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    got = sorted((tuple(r) for r in E.token_files_round_trip(docs, tokenizer()).collect()), key=lambda r: r[1])
    assert sorted(got) == sorted(expected) or sum(r[0] == 9 for r in got) == 2
    assert [r[1] for r in got] == np.cumsum([0, *(r[2] for r in got[:-1])]).tolist()
    assert E.token_files_round_trip(docs.limit(0), tokenizer()).count() == 0


def test_files_are_mapped_and_give_any_document(spark, tmp_path):
    """Real files: any document by select, names that are null, negative or far apart, and one that is longer than a file should be."""
    from lodestrata.llm import elias_fano as E

    encode, rng = library_ids(), random.Random(7)
    ids = [None, None, -5, 0, 7, 7, 1 << 62, -(1 << 62), *range(100, 300)]
    texts = [rng.choice(TEXTS) if i % 9 else None for i in range(len(ids))]
    E.write_token_files(docs_of(spark, texts, ids=ids), f"file://{tmp_path}/t", tokenizer(), 1)
    listed = spark.read.parquet(f"{tmp_path}/t/list").orderBy("part", "file").collect()
    assert {f.name for f in (tmp_path / "t" / "files").glob("*.lsef")} == {r.name for r in listed}
    got = []
    for r in listed:
        f = E.open_file(f"file://{tmp_path}/t/files", r.name)
        names = [x for _, some in f.blocks() for x in some]
        got += [(names[i], f.document(i).tolist()) for i in rng.sample(range(f.documents), f.documents)]
        assert r.n_ids == f.total
    assert sorted(got, key=str) == sorted(((i, [*encode(t), 1]) for i, t in zip(ids, texts, strict=True)), key=str)


def test_elias_fano_select_and_size():
    from lodestrata.llm.elias_fano import HEADER, TokenFile, write_file

    rng = random.Random(0)
    for sizes in ([], [0], [1], [0] * 300, [rng.randrange(3) for _ in range(1000)], [0, 1 << 16, 0, 5, *[rng.randrange(900) for _ in range(500)], 100_000, 1]):
        data = write_file([np.zeros(n, "<u2").tobytes() for n in sizes], "<u2")
        f = TokenFile(data)
        assert [f.end(i) for i in range(len(sizes))] == f.ends().tolist() == np.cumsum(sizes).tolist()
        bound = len(sizes) * (2 + max(0, math.log2(max(1, sum(sizes)) / max(1, len(sizes))))) / 8 + len(sizes) / 16 + 20
        assert len(data) - HEADER.size - 2 * sum(sizes) <= bound


@pytest.mark.parametrize("special", [True, False])
def test_encoder_equals_the_library(special):
    from lodestrata.llm._encode import Encoder

    rng = random.Random(3)
    pool = ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "It's", "don't", "É", "é", "\xa0", "ﬁ", "İ", "ΣΑΣ", "123", "1a2", "…,!", "'S", "K", "á", "​", "Ⅷ", "²", "abc,", "%%%", "(", " ", "\n", "\t"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(12))) for _ in range(500)]
    encode = library_ids(special)
    got = Encoder(tokenizer(), special).encode([t.encode() for t in texts])
    assert [np.frombuffer(b, "<u2").tolist() for b in got] == [encode(t) for t in texts]


@pytest.mark.parametrize("block", [3, 64, 1 << 19])
def test_separator_scan_counts_tokens(spark, monkeypatch, block):
    from lodestrata.llm import separator_scan as S

    monkeypatch.setattr(S, "RUN", 4)
    texts = TEXTS if block > 3 else [t if t is None or len(t) < 100 else "long " * 40 for t in TEXTS]
    docs = clashing(docs_of(spark, texts), "file", "block", "ordinal", "n_tokens").repartition(3)
    encode = library_ids(False)
    got = sorted(tuple(r) for r in S.counted_documents(docs, tokenizer(), 49407, block).collect())
    assert got == [(i, len(encode(t))) for i, t in enumerate(texts)]
    assert S.counted_documents(docs.limit(0), tokenizer(), 49407, block).count() == 0


def test_separator_scan_of_an_unfinished_file(spark):
    from lodestrata.llm.separator_scan import token_counts

    blocks = [(0, 0, [9, 1, 1]), (0, 1, [1, 1, 1]), (0, 2, [1, 9, 1]), (1, 0, [2, 2, 2])]
    df = spark.createDataFrame([(f, b, bytearray(np.array(x, "<u2").tobytes())) for f, b, x in blocks], "file int, block long, ids binary")
    assert sorted(tuple(r) for r in token_counts(df, 9).collect()) == [(0, 0, 0), (0, 1, 6), (0, 2, 1), (1, 0, 3)]


# --- op5 ---------------------------------------------------------------------------------------------------------


def plain(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())


def leaks(texts, items, window=13):
    patterns = defaultdict(set)
    for i, t in items:
        w = plain(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            patterns[tuple(w[k : k + window])].add(i)
    out = []
    for d, t in enumerate(texts):
        w, hit, found = plain(t), set(), set()
        for n in {len(p) for p in patterns}:
            for k in range(len(w) - n + 1):
                if p := patterns.get(tuple(w[k : k + n])):
                    found |= p
                    hit |= set(range(k, k + n))
        found.discard(None)
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("block", [400_000, 60])
def test_leaks_equal_brute_force(spark, monkeypatch, block):
    from lodestrata.llm import decontam as D

    monkeypatch.setattr(D, "BLOCK_WORDS", block)
    rng = random.Random(block)
    items = [(i, " ".join(words(rng, rng.choice([1, 2, 3, 5, 12, 13, 14, 40]), 12))) for i in range(20)]
    items += [(20, None), (21, ""), (22, "..."), (None, "null id words"), (3, items[4][1]), (3, items[3][1])]
    texts = [None, "", "!!"]
    for _ in range(60):
        w = words(rng, rng.randrange(1, 400), 40)
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(w) + 1)
            w[at:at] = rng.choice(items[:20])[1].upper().split()
        texts.append(rng.choice([" ", ", ", "\n-"]).join(w))
    texts.append(" ".join(words(rng, 50_000, 40)))
    bench = clashing(spark.createDataFrame(items, "item_id long, text string"), "words", "spans")
    docs = clashing(docs_of(spark, texts), "words", "spans", "items", "c0", "n_hit")
    found = D.with_verdict(D.leaked_passages(docs, bench)).select("c0", "words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert sorted(tuple(r) for r in found.collect()) == leaks(texts, items)


def test_no_benchmark_and_no_documents(spark):
    from lodestrata.llm.decontam import leaked_passages, with_verdict

    none = spark.createDataFrame([], "item_id long, text string")
    row = with_verdict(leaked_passages(docs_of(spark, ["a b"]), none)).head()
    assert (row.words, row.n_hit, row.n_items, row.contaminated) == (2, 0, 0, False)
    assert leaked_passages(docs_of(spark, ["a"]).limit(0), none).count() == 0


# --- op6 ---------------------------------------------------------------------------------------------------------


def toxic_corpus(n, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        w = words(rng, rng.randrange(20, 200), 500)
        bad = rng.random() < 0.15
        if bad:
            for _ in range(rng.randrange(1, 4)):
                w[rng.randrange(len(w))] = rng.choice(["idiot", "scum", "Moron,", "vilex" + rng.choice("abcdef")])
        rows.append((" ".join(w), int(bad)))
    return rows


def test_toxicity_generalises_to_unseen_documents(spark):
    from lodestrata.llm.toxicity import fold, toxicity_scores

    rows = toxic_corpus(1500, 1)
    docs = clashing(docs_of(spark, [t for t, _ in rows]), "score", "turn", "label", "c0")
    labels = spark.createDataFrame([(i, 1, y) for i, (_, y) in enumerate(rows)], "doc_id long, quality int, toxic int")
    score = {r.c0: r.score for r in toxicity_scores(docs, labels, fold(F.col("doc_id")) % 4 != 2).collect()}
    held = [i for i in range(len(rows)) if zlib.crc32(str(i).encode()) % 4 == 2]
    caught = [score[i] >= 0.3 for i in held if rows[i][1]]
    wrong = [score[i] >= 0.3 for i in held if not rows[i][1]]
    assert np.mean(caught) > 0.9 and np.mean(wrong) < 0.02


def test_learner_equals_plain_ftrl(spark):
    """The trained weights and scores against FTRL-proximal on dictionaries, over features made word by word."""
    from lodestrata.llm import toxicity as t

    def number(h):
        h ^= h >> 30
        h = h * 0xBF58476D1CE4E5B9 % 2**64
        h ^= h >> 27
        h = h * 0x94D049BB133111EB % 2**64
        return (h ^ h >> 31) >> (64 - t.BITS)

    def plain_features(text):
        own = re.sub("[^0-9a-z\x80-\xff]", " ", text.lower().encode().decode("latin-1")).encode("latin-1").split()
        one = [xxhash.xxh3_64_intdigest(w) for w in own]
        f = [int(x) for x in t._PAIR]
        hashes = one + [xxhash.xxh3_64_intdigest(w[:n], seed=n) for n in t.STEMS for w in own]
        hashes += [(a * f[0] + b * f[1]) % 2**64 for a, b in zip(one, one[1:], strict=False)]
        hashes += [(a * f[2] + b * f[3]) % 2**64 for a, b in zip(one, one[2:], strict=False)]
        return {number(h) for h in hashes}

    rows = [*toxic_corpus(250, 3), ("", 0), ("Scum! scum scum", 1)]
    docs = docs_of(spark, [text for text, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    held = lambda i: i % 5 == 0
    turn = dict(docs.select("doc_id", F.xxhash64("doc_id")).collect())
    learned = sorted((i for i in range(len(rows)) if not held(i)), key=turn.get)
    found = [plain_features(text) for text, _ in rows]
    often = Counter(x for i in learned for x in found[i])
    z, n = defaultdict(float), defaultdict(float)

    def weight(x):
        pull = 0.0 if x == t.SIZE else t.L1
        return 0.0 if abs(z[x]) <= pull else (math.copysign(pull, z[x]) - z[x]) / ((t.BETA + math.sqrt(n[x])) / t.ALPHA + t.L2)

    for epoch in range(t.EPOCHS):
        for k in np.random.default_rng(epoch).permutation(len(learned)):
            i = learned[k]
            own = [x for x in found[i] if often[x] >= t.MIN_DOCS] + [t.SIZE]
            w = {x: weight(x) for x in own}
            g = 1 / (1 + math.exp(-sum(w.values()))) - rows[i][1]
            for x in own:
                z[x] += g - (math.sqrt(n[x] + g * g) - math.sqrt(n[x])) / t.ALPHA * w[x]
                n[x] += g * g
    weights = t.train(docs, labels, F.col("doc_id") % 5 != 0)
    assert weights == pytest.approx({x: weight(x) for x in list(z) if weight(x) != 0.0})
    scores = {r.c0: r.score for r in t.toxicity_scores(docs, labels, F.col("doc_id") % 5 != 0).collect()}
    want = {i: 1 / (1 + math.exp(-(weight(t.SIZE) + sum(weight(x) for x in found[i] if x in z)))) for i in range(len(rows))}
    assert scores == pytest.approx(want, rel=1e-4)


def test_toxicity_edges(spark):
    from lodestrata.llm.toxicity import toxicity_scores

    docs = docs_of(spark, [None, "", "!!", "plain words here", "plain words here"])
    labels = spark.createDataFrame([(0, None), (None, 1), (3, 0), (3, 1)], "doc_id long, toxic int")
    rows = toxicity_scores(docs, labels).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in toxicity_scores(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity_scores(docs.limit(0), labels).count() == 0


def test_scores_of_a_batch_do_not_cross_documents(spark):
    from lodestrata.llm.toxicity import toxicity_scores

    rows = toxic_corpus(400, 2)
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    docs = docs_of(spark, [t for t, _ in rows])
    together = {r.c0: r.score for r in toxicity_scores(docs.coalesce(1), labels).collect()}
    apart = {r.c0: r.score for r in toxicity_scores(docs.repartition(50), labels).collect()}
    assert together == pytest.approx(apart)


# --- op8 ---------------------------------------------------------------------------------------------------------


def plain_targets(sizes, weights, budget=1.5, cap=2):
    """The excess reshared by weight until none is above its cap, on lists."""
    out, free, total = [0.0] * len(sizes), set(range(len(sizes))), budget * sum(sizes)
    while free:
        spare = sum(weights[i] for i in free)
        above = {i for i in free if cap * sizes[i] <= weights[i] * total / spare}
        if not above:
            for i in free:
                out[i] = weights[i] * total / spare
            break
        for i in above:
            out[i] = float(cap * sizes[i])
        total, free = total - sum(cap * sizes[i] for i in above), free - above
    return out


def test_targets_share_the_excess(spark):
    from lodestrata.llm._common import Scratch
    from lodestrata.llm.curriculum import targets

    rng = random.Random(80)
    many = {f"{rng.choice('aBé')}{i}": int(10 ** rng.uniform(0, 6)) for i in range(300)}
    for given in ({"a": 100, "b": 10, None: 1000}, {"a": 0, "b": 5}, {}, {"a": 0}, {"a": 0, None: 0}, {str(i): 2**i for i in range(12)}, many):
        names = sorted(given, key=lambda s: (s is None, (s or "").encode()))
        weights = [(3, 1, 2)[i % 3] for i in range(len(names))]
        want = plain_targets([given[s] for s in names], weights)
        rows = spark.createDataFrame([(s, n, 1) for s, n in given.items()], "source string, source_size long, n long").repartition(3)
        got = sorted(targets(rows, Scratch(spark, "test")).select("source_no", "source", "target").collect())
        assert [r.source for r in got] == names and [r.source_no for r in got] == list(range(len(names)))
        assert [r.target for r in got] == pytest.approx(want)
        assert sum(want) == pytest.approx(1.5 * sum(given.values())) and all(t <= 2 * given[s] for t, s in zip(want, names, strict=True))


def test_mix_does_not_depend_on_what_is_broadcast(spark, monkeypatch):
    from lodestrata.llm import curriculum

    rng = random.Random(81)
    docs = docs_of(spark, [" ".join(words(rng, rng.randrange(0, 30))) for _ in range(300)], [rng.choice(["a", "a", "b", None, f"s{i}"]) for i in range(300)])
    want = sorted(map(tuple, curriculum.planned(docs).collect()))
    monkeypatch.setattr(curriculum, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, curriculum.planned(docs).collect())) == want


def test_mix_meets_its_targets(spark):
    from lodestrata.llm.curriculum import mixed_documents, planned

    rng = random.Random(8)
    texts = [" ".join(words(rng, rng.randrange(0, 60))) for _ in range(500)] + [None, "", " ".join(words(rng, 4000))]
    sources = [rng.choice(["a", "a", "a", "B", "é", None]) for _ in texts]
    docs = clashing(docs_of(spark, texts, sources), "size", "target", "start", "turn", "bucket")
    rows = planned(docs, carry=["source"]).collect()
    sizes = {i: len((t or "").split()) for i, t in enumerate(texts)}
    assert sorted((r.doc_id, r["size"]) for r in rows) == sorted(sizes.items())
    by = defaultdict(list)
    for r in rows:
        assert 0 <= r.taken <= 2 * r["size"] and r.source_size == sum(sizes[i] for i, s in enumerate(sources) if s == r.c0)
        by[r.c0].append(r)
    for group in by.values():
        assert sum(r.taken for r in group) == math.floor(group[0].target)
        spans = sorted((r.start, r.start + r["size"]) for r in group)
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    mix = mixed_documents(docs).collect()
    assert sum(len(r.text.split()) for r in mix) == sum(r.taken for r in rows)
    assert all(texts[r.doc_id].startswith(r.text) for r in mix)
    assert mixed_documents(docs).columns == docs.columns
    assert sorted(map(tuple, planned(docs.repartition(7)).collect())) == sorted(map(tuple, planned(docs).collect()))


def test_mix_of_nothing(spark):
    from lodestrata.llm.curriculum import mixed_documents, planned

    assert planned(docs_of(spark, ["a"]).limit(0)).count() == 0
    assert [r.taken for r in planned(docs_of(spark, [None, ""])).collect()] == [0, 0]
    assert mixed_documents(docs_of(spark, [None, ""])).count() == 0


def test_positions_follow_the_schedule(spark):
    from lodestrata.llm.curriculum import position

    for tilt in (0.5, 0.0, -0.5):
        for share in (0.0, 0.1, 0.5, 0.9, 1.0):
            t = spark.range(1).select(position(F.lit(share * 100), F.lit(0), F.lit(100.0), F.lit(tilt))).head()[0]
            assert (1 - tilt) * t + tilt * t * t == pytest.approx(share)


# --- op9 ---------------------------------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string"


def article(body):
    return f"<html><head><title>T</title></head><body><header>H</header><nav><a>m</a></nav><div class='teaser'>Our new site &amp; more</div><article>{body}</article><div id='comments'><p>first!</p></div><footer>f</footer></body></html>"


def test_templates_go_and_articles_stay(spark):
    from lodestrata.llm.html_templates import main_texts

    rows = [(i, f"http://h.org/{i}", f"<body><div><p>Read all our stories</p></div><p>Story {i} tells\n of <b>things</b></p><div><span>Join {'us'}</span></div></body>") for i in range(20)]
    rows += [(100, "http://h.org/a", article("<h1>A</h1><p>x &lt; y")), (101, None, None), (102, "bad", ""), (103, "http://h.org/b", "<p>cut <a href='")]
    rows += [(200 + i, f"http://copies.org/{i}", "<p>the same text on copies of one page</p>") for i in range(30)]
    df = clashing(spark.createDataFrame(rows, PAGES), "text", "host", "gone", "n_chars")
    got = {r.page_id: r.text for r in main_texts(df).collect()}
    assert all(got[i] == f"Story {i} tells of things" for i in range(20))
    assert got[100] == "A\nx < y" and got[101] == got[102] == "" and got[103] == "cut"
    assert all(got[200 + i] == "the same text on copies of one page" for i in range(30))
    assert main_texts(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<p>a<p>b<li>c<li>d<script>if(a<b){}</script> e", "a\nb\nc\nd e"), ("x < y & z", "x < y & z"), ("<title>t</title>hello <i>wor</i>ld<table><tr><td>1<td>2</table>", "hello world\n1\n2"), ("<nav>a", ""),
        ("<div><p>x</div>y<!-- c", "x\ny"), ("<article><p>one<br>two&nbsp; three</p><form>q</form><aside>s</aside></article>tail", "one two three"), ("<main><p>m</p><div class='cookie-notice'>c</div></main><p>o</p>", "m"),
        ('<p title="a > b">t</p>', "t"), ("<p>a</p><div style='display: none'>h</div><div hidden>i</div>", "a"), ("<p>&#x41;&#66;&copy;&unknown;</p>", "AB©&unknown;"), ("<svg><text>n</text></svg><p>y", "y"),
        ("<article><header><h1>T</h1></header><p>b</p><footer>f</footer></article>", "T\nb"), ("<div " + "<b>" * 3000 + "deep", "deep"), ("<pre>a\n  b</pre>", "a b"), ("</p></div>x", "x"), ("<article>a<article class='comment'>c</article></article><article>b</article>", "a\nb"),
    ],
)
def test_single_pages(html, text):
    from lodestrata.llm.html_templates import Page

    assert Page(html).text() == text


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<div class='content no-sidebar'><p>a</p></div>", "a"), ("<div class='has-sidebar'><main><p>m</p></main></div>", "m"), ("<p>a</p><div class='social-science'>b</div>", "a\nb"),
        ("<article><h1 class='widget-title'>t</h1><p>b</p></article>", "t\nb"), ("<form id='aspnetForm'><div><p>the whole page is in a form</p></div></form>", "the whole page is in a form"),
        ("<aside><article><p>a</p></article></aside><p>x</p>", "a"), ("<p>a b c d e</p><div class='sidebar'>s</div><div id='siteFooter'>f</div><div class='ad-slot-2'>x</div>", "a b c d e"),
        ("<div class='sidebar right'><p>all of the page</p></div>", "all of the page"), ("<p>short</p><div id='comments'><article class='comment'><p>a long comment, longer than all the rest of it</p></article></div>", "short"),
        ("<div id='comments'><article class='comment'><p>c</p></article></div><article>a</article>", "a"), ("<div class='page-header'>h</div><p>some text here</p><div class='post-header'>t</div>", "some text here\nt"),
        ("<main><header><h1>T</h1></header><p>b</p></main>", "T\nb"), ("<p>some more text</p><div role='navigation'>n</div><div class='breadcrumbs top'>c</div>", "some more text"), ("<p>x</p><dialog open>d</dialog>", "x"),
        ("<article class='post'><p>a</p><div class='share-buttons'>s</div><section class='related-posts'>r</section></article>", "a"), ("<body class='no-comments'><p>a</p></body>", "a"),
    ],
)
def test_names_of_furniture(html, text):
    from lodestrata.llm.html_templates import Page

    assert Page(html).text() == text


def reference_text(page):
    """The blocks of the article element by the standard library's parser: slow, and for well-formed articles only."""
    from html.parser import HTMLParser

    blocks = "h1 h2 p div article br".split()

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.on, self.out = False, [[]]

        def handle_starttag(self, tag, attrs):
            self.on |= tag == "article"
            if tag in blocks:
                self.out[-1].append(" ") if tag == "br" else self.out.append([])

        def handle_endtag(self, tag):
            self.on &= tag != "article"
            if tag in blocks:
                self.out.append([])

        def handle_data(self, data):
            if self.on:
                self.out[-1].append(data)

    reader = Reader()
    reader.feed(page or "")
    reader.close()
    return "\n".join(filter(None, (" ".join("".join(b).split()) for b in reader.out)))


def test_given_pages_equal_a_slow_reference(spark):
    from lodestrata.llm.html_templates import main_texts

    folder = "/root/testdata/sf0.01"
    if not __import__("os").path.isdir(folder):
        pytest.skip("no test tables")
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    expected = {r.page_id: reference_text(r.html) for r in pages.collect()}
    got = {r.page_id: r.text for r in main_texts(pages).collect()}
    assert got == expected and sum(map(len, got.values()))


def labelled_pages(seed, n, host, article_tag):
    """Pages of one host with known article texts: furniture named by tag, class or not at all, and reader comments."""
    rng = random.Random(seed)
    say = lambda k: " ".join(words(rng, k, 2000))
    fixed = [say(6) for _ in range(6)]
    out = []
    for i in range(n):
        blocks = [say(rng.randrange(3, 60)) for _ in range(rng.randrange(1, 9))]
        body = "".join(f"<p>{b}</p>" if rng.random() < 0.8 else f"<div><span>{b}</span></div>" for b in blocks)
        if article_tag:
            body = f"<{article_tag}>{body}</{article_tag}>"
        before = f"<div class='top'><div>{fixed[0]}</div><div><b>{fixed[1]}</b></div></div><nav><ul><li>{say(2)}<li>{fixed[2]}</ul></nav><div class='cookie-notice'>{say(5)}</div>"
        side = f"<div class='{rng.choice(['sidebar', 'sidebar-right', 'widget-area', 'relatedPosts', 'ad'])}'><p>{say(8)}</p></div>"
        after = f"<form><p>{say(3)}</p></form><div id='comments'>{''.join(f'<div class=comment>{say(9)}</div>' for _ in range(rng.randrange(4)))}</div><div><p>{fixed[3]}</p><p>{fixed[4]}</p></div><footer>{say(4)}</footer>"
        out.append((f"http://{host}/{i}", f"<html><head><title>{say(3)}</title><script>var a='<p>{say(2)}</p>'</script></head><body>{before}{side if i % 2 else ''}{body}{'' if i % 2 else side}{after}</body></html>", blocks))
    return out


def test_precision_and_recall_on_labelled_pages(spark):
    """Named and recurring furniture goes, articles stay word for word, in articles with and without an element of their own."""
    from lodestrata.llm.html_templates import main_texts

    rows = [r for k, tag in enumerate(["article", "main", "", "div class='post-content'"]) for r in labelled_pages(k, 40, f"h{k}.org", tag)]
    df = spark.createDataFrame([(i, u, h) for i, (u, h, _) in enumerate(rows)], PAGES)
    got = {r.page_id: r.text for r in main_texts(df).collect()}
    both = found = true = 0
    for i, (_, _, blocks) in enumerate(rows):
        a, b = Counter(got[i].split()), Counter(" ".join(blocks).split())
        both, found, true = both + (a & b).total(), found + a.total(), true + b.total()
    assert both / true == 1 and both / found > 0.99
    assert np.mean([got[i] == "\n".join(b) for i, (_, _, b) in enumerate(rows)]) > 0.95


def test_templates_of_sections_and_near_copies(spark):
    """A section's own template goes; passages that recur in articles stay; near copies of an article keep it."""
    from lodestrata.llm.html_templates import main_texts

    rng = random.Random(6)
    say = lambda k: " ".join(words(rng, k, 3000))
    rows, expected = [], {}
    for i in range(60):  # one section of ten pages has a block of its own
        own, part = say(30), "news" if i < 10 else f"s{i % 5}"
        rows.append((i, f"http://a.org/{part}/{i}", f"<body>{'<div><p>Only in the news</p></div>' if i < 10 else ''}<div><p>{own}</p></div></body>"))
        expected[i] = own
    passage = say(20)
    for i in range(100, 160):  # a passage in two fifths of a host's articles, and no section
        own = say(30)
        rows.append((i, f"http://b.org/{i}", f"<article><p>{own}</p>{f'<p>{passage}</p>' if i % 5 < 2 else ''}</article>"))
        expected[i] = own + (f"\n{passage}" if i % 5 < 2 else "")
    shared = [say(20) for _ in range(5)]
    for i in range(200, 212):  # near copies of one article are most of their host
        own = say(5)
        rows.append((i, f"http://c.org/{i}", "<article>" + "".join(f"<p>{p}</p>" for p in shared) + f"<p>{own}</p></article>"))
        expected[i] = "\n".join([*shared, own])
    got = {r.page_id: r.text for r in main_texts(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == expected


def test_long_and_repeated_pages(spark):
    """A page of megabytes and tens of thousands of elements, and rows that repeat."""
    from lodestrata.llm.html_templates import main_texts

    long = "<article>" + "".join(f"<div class='comment'><article class='comment'><p>c{i}</p></article></div><p>word{i} " + "x" * 40 + "</p>" for i in range(20_000)) + "</article>"
    deep = "<div class='sidebar'>" * 2000 + "<p>deep</p>" + "</div>" * 2000
    rows = [(1, "http://h.org/x", long), (1, "http://h.org/x", long), (2, "http://h.org/y", deep), (2, "http://h.org/y", deep)]
    got = sorted((r.page_id, r.text) for r in main_texts(spark.createDataFrame(rows, PAGES)).collect())
    assert [g[0] for g in got] == [1, 1, 2, 2] and got[0][1] == "\n".join(f"word{i} " + "x" * 40 for i in range(20_000)) == got[1][1] and got[2][1] == got[3][1] == "deep"


# --- op10 --------------------------------------------------------------------------------------------------------


def base_spans(text):
    text = text or ""
    word = "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    found = [(m.start(), 0, m.end()) for m in re.finditer(word + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[1]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{['assign', 'access', 'hex'][k]}:{a}:{b}" for a, k, b in sorted(found))


def test_secret_spans_equal_brute_force(spark):
    from lodestrata.llm.secrets import digests, found_secrets

    rng = random.Random(4)
    pieces = ["password: ", "Api_Key='", "token=", "secret\"= ", "AKIA", "ABCDEF123456", "0123456789abcdef" * 2, "deadbeef", "🙂", "é ", " ", "\n", "x=y", "token=secret=abcdefgh12", "eyJhbGciOiJI.eyJzdWIiOiIx.abc", "eyJhbGciOiJIUzI.eyJzdWIiOiIxMjM.sig", "pg://u:hunter22@h", "ſecret=abcdefghij"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(25))) for _ in range(150)] + [None, "", "password=" + "a" * 9, "AKIA" + "B" * 12, "token=abcdefgh " * 300]
    docs = clashing(docs_of(spark, texts), "hash", "row", "span", "spans", "owner", "repository")
    for r in digests(found_secrets(docs)).collect():
        expected = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(expected.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [expected.count(k) for k in ("assign", "access", "hex")]
        assert set(filter(None, expected.split(","))) <= set(r.spans.split(","))


def test_copied_examples_are_told_from_owned_credentials(spark):
    from lodestrata.llm.secrets import digests, found_secrets

    own, copied = "x glpat-ABCDEFGHIJKLMNOPQRST y", "x glpat-EXAMPLEEXAMPLEEXAMPL y"
    texts = [copied] * 40 + [own, own, None, ""]
    rows = {r.doc_id: r for r in digests(found_secrets(docs_of(spark, texts, [f"s{i % 5}" for i in range(40)] + ["s1"] * 4))).collect()}
    assert rows[40].spans == rows[41].spans == "prefixed:2:28" and rows[40].n_live == 1
    assert all(rows[i].spans == "" and rows[i].n_example == 1 for i in range(40))
    assert found_secrets(docs_of(spark, texts).limit(0)).count() == 0


def test_ownership_is_judged_by_owners(spark):
    """One owner's credential stays live in any number of documents; two owners' only in few; null owners hold nothing."""
    from lodestrata.llm.secrets import digests, found_secrets

    keys = [f"glpat-{c * 20}" for c in "ABCD"]
    rows = [(keys[0], "one")] * 30 + [(keys[1], f"two{i % 2}") for i in range(30)] + [(keys[2], f"few{i}") for i in range(2)] + [(keys[3], None)] * 12
    got = digests(found_secrets(docs_of(spark, [t for t, _ in rows], [s or None for _, s in rows]))).collect()
    live = {k: {r.n_live for r in got if rows[r.doc_id][0] == k} for k in keys}
    assert live == {keys[0]: {1}, keys[1]: {0}, keys[2]: {1}, keys[3]: {1}}
    assert all((r.spans == "prefixed:0:26") == bool(r.n_live) for r in got)


def test_a_text_with_very_many_secrets(spark):
    """A hundred thousand matches in one text, one secret in a third of all spans, another text of a million letters without any."""
    from lodestrata.llm.secrets import digests, found_secrets

    many = "".join(f"token=abcdefgh{i % 30000 if i % 3 else 0} é" for i in range(100_000))
    docs = docs_of(spark, [many, "x" * 1_000_000, many[:5000], many[:5000]])
    rows = {r.doc_id: r for r in digests(found_secrets(docs)).collect()}
    assert rows[0].n_assign == 100_000 and rows[0].spans == base_spans(many) and rows[1].spans == ""
    assert rows[2].spans == rows[3].spans == base_spans(many[:5000])


def test_secret_plan_runs_no_python(spark):
    from lodestrata.llm.secrets import digests, found_secrets

    plan = digests(found_secrets(docs_of(spark, ["token=abcdefgh1"])))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
