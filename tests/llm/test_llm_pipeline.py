"""The pipeline's stages on a small corpus with planted cases."""

from __future__ import annotations

import random

import pytest


@pytest.fixture
def corpus(spark, tmp_path):
    rng = random.Random(0)

    def text(n):
        return " ".join(f"w{rng.randrange(3000)}" for _ in range(n))

    clean = [text(rng.randrange(40, 200)) for _ in range(300)]
    toxic = [t + " idiot scum" for t in (text(60) for _ in range(60))]
    bench = [text(40) for _ in range(5)]
    leaked = [text(20) + " " + b + " " + text(20) for b in bench]
    copies = [clean[0], clean[1] + " extra"]
    texts = clean + toxic + leaked + copies
    rows = [(i, t, "en", f"s{i % 4}", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(300 <= i < 360)) for i in range(0, 360, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(list(enumerate(bench)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages_catch_planted_cases_and_keep_clean_documents(spark, corpus):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, corpus).cache()
        assert docs.columns == columns
        kept[name] = {r.doc_id for r in docs.collect()}
    clean = set(range(300))
    assert not kept["toxicity"] & set(range(300, 360)) and clean <= kept["toxicity"]
    assert not kept["near_duplicates"] & {365, 366} and clean <= kept["near_duplicates"]
    assert not kept["decontamination"] & set(range(360, 365)) and clean <= kept["decontamination"]
    assert kept["mixing"] <= kept["decontamination"]


def test_passages_go_from_documents_of_any_length(spark, tmp_path):
    """A passage under a twentieth of its document, one window of it, and short items: these only if they are much of the document."""
    import corpus_pipeline as P

    rng = random.Random(11)
    say = lambda k: " ".join(f"w{rng.randrange(3000)}" for _ in range(k))
    item = say(40)
    spark.createDataFrame([(1, item), (2, "three short words")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    window = " ".join(item.split()[5:18])
    less = " ".join(item.split()[5:17])
    texts = [f"{say(1000)} {item} {say(1000)}", f"{say(600)} {window} {say(600)}", f"{say(600)} {less} {say(600)}", f"{say(200)} three short words {say(200)}", f"{say(20)} Three, short WORDS.", say(50), None, ""]
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id: r.text for r in P.without_benchmark(spark, docs, str(tmp_path)).collect()}
    assert kept == {i: texts[i] for i in (2, 3, 5, 6, 7)}


def test_stages_of_nulls_repeats_and_nothing(spark, corpus, tmp_path):
    """Null and empty texts, null ids, rows that repeat, columns with clashing names, and an empty table."""
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{corpus}/documents.parquet").limit(40)
    odd = spark.createDataFrame([(900, None, None, None, None), (901, "", "en", "s1", 0), (None, "words of a row without id", "en", None, 25), (None, None, None, None, None)], docs.schema)
    folder = tmp_path / "odd"
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{corpus}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    rows = docs.unionByName(docs.limit(3)).unionByName(odd)
    for c in ("score", "row", "component_id", "spans", "position", "tie", "copy"):
        rows = rows.withColumn(c, rows.doc_id.cast("string"))
    rows.write.parquet(f"{folder}/documents.parquet")
    kept = rows.select(*P.COLUMNS)
    for _, stage in P.STAGES[:3]:
        kept = stage(spark, kept, str(folder)).cache()
        assert kept.columns == list(P.COLUMNS) and {r.doc_id for r in kept.collect()} >= {900, 901, None}
    out = P.run(spark, str(folder)).collect()
    assert out and {900, 901}.isdisjoint(r.doc_id for r in out)
    rows.limit(0).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    assert P.run(spark, str(folder)).count() == 0


def test_run_lists_every_document_of_the_mix(spark, corpus):
    import corpus_pipeline as P

    rows = sorted((r.start, r.n_tokens) for r in P.run(spark, corpus).collect())
    assert rows and all(a[0] + a[1] == b[0] for a, b in zip(rows, rows[1:], strict=False))


def test_token_files_follow_the_curriculum(spark, corpus):
    import corpus_pipeline as P
    from lodestrata.llm._common import Scratch

    scratch = Scratch(spark, "order")
    docs = spark.read.parquet(f"{corpus}/documents.parquet").select(*P.COLUMNS)
    planned = [r.doc_id for r in P.mixed(spark, docs, corpus).collect()]
    mix = scratch.keep(P.mixed(spark, docs, corpus), "mix")
    got = [r.doc_id for r in sorted(P.token_files(spark, mix, corpus).collect(), key=lambda r: r.start)]
    assert got == planned and got != sorted(got) and len(got) > len(set(got))


def test_one_row_of_each_near_duplicate_group_stays(spark):
    """Repeated rows, null ids, and an id with two texts."""
    import corpus_pipeline as P

    rng = random.Random(3)
    a, b, c, d = (" ".join(f"w{rng.randrange(3000)}" for _ in range(80)) for _ in range(4))
    rows = [(1, a), (1, a), (2, a), (None, b), (None, b), (None, c), (3, c), (4, d), (4, a)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(((r.doc_id, r.text) for r in P.without_near_duplicates(spark, docs, "").collect()), key=str)
    assert kept == sorted([(1, a), (None, b), (3, c), (4, d)], key=str)
