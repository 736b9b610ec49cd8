"""The corpus pipeline, each stage held against brute force on its own input."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import quality, secrets, tokens
from tidemark.llm.text import load

SMALL = "/root/testdata/sf0.01"
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def test_every_stage(spark):
    docs = load(spark, SMALL, "documents").cache()
    stages = dict(corpus_pipeline.STAGES)
    rows = {r.doc_id: r for r in docs.collect()}

    v, model = quality.fitted(docs, load(spark, SMALL, "labels"))
    scores = {r.doc_id: r.score for r in quality.with_score(docs, v, model).collect()}
    good = stages["quality"](spark, docs, SMALL).cache()
    assert {r.doc_id for r in good.collect()} == {i for i, s in scores.items() if s >= 0.7} and good.columns == docs.columns

    held = {r.doc_id: shingles(r.text) for r in good.collect()}
    ids, parent = sorted(held), {i: i for i in held}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if held[a] and held[b] and 100 * len(held[a] & held[b]) >= 80 * len(held[a] | held[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    distinct = stages["near duplicates"](spark, good, SMALL).cache()
    assert sorted(r.doc_id for r in distinct.collect()) == [i for i in ids if find(i) == i]

    items = [words(r.text) for r in load(spark, SMALL, "benchmark").collect()]
    grams = {tuple(w[i : i + 13]) for w in items for i in range(len(w) - 12)} | {tuple(w) for w in items if 6 <= len(w) < 13}

    def exact(text):
        w = words(text)
        return any(tuple(w[i : i + n]) in grams for n in {len(g) for g in grams} for i in range(len(w) - n + 1))

    clean = stages["decontamination"](spark, distinct, SMALL).cache()
    gone = {r.doc_id for r in distinct.collect()} - {r.doc_id for r in clean.collect()}
    assert {r.doc_id for r in distinct.collect() if exact(r.text)} <= gone
    assert not any(exact(r.text) for r in clean.collect())

    redacted = stages["secrets"](spark, clean, SMALL).cache()
    coder = secrets.encoding(tokens.vocabulary("byte_bpe_50k.tiktoken"))
    for r in redacted.collect():
        before = rows[r.doc_id].text
        assert r.n_chars == len(r.text)
        if not secrets.base_spans(before) and not secrets.random_spans(before, coder):
            assert r.text == before
        assert not secrets.base_spans(r.text)

    from tokenizers import Tokenizer

    bpe, pieces = Tokenizer.from_file(tokens.vocabulary()), defaultdict(list)
    for p in stages["packing"](spark, redacted, SMALL).collect():
        pieces[p.doc_id].append(p)
    assert set(pieces) == {r.doc_id for r in redacted.collect()}
    for r in random.Random(0).sample(redacted.collect(), 50):
        ids, at = np.array([*bpe.encode(r.text, add_special_tokens=False).ids, 1], "<u4"), 0
        for p in sorted(pieces[r.doc_id], key=lambda p: p.start):
            assert p.start == at and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)


ODD = [(1, None), (None, ""), (None, None), (2, "word " * 500), (2, "word " * 500), (None, "nobody's own text of some more words here"), (3, "key A1b2C3d4E5f6G7h8I9j0K1l2M3 ends"), (4, "a b c d e f g"), (5, "long " * 30_000)]
CLASHING = ["quality_score", "own_md5", "own_id", "n_rows", "text_md5", "node", "root", "item", "seed", "words", "score", "label"]


def odd(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    return df.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text"), **{c: F.lit("x") for c in CLASHING}})


def test_run_over_odd_tables(spark, tmp_path):
    """Without labels no document is rejected; every stage takes what the one before kept."""
    for k, rows in enumerate(([], ODD)):
        odd(spark, rows).write.parquet(f"{tmp_path}/{k}/documents.parquet")
        spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/{k}/labels.parquet")
        spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/{k}/benchmark.parquet")
        got = corpus_pipeline.run(spark, f"{tmp_path}/{k}").collect()
        assert len({(r.doc_id, r.doc_tokens) for r in got}) == (7 if rows else 0)  # one of the repeated rows goes, null and empty texts without an id are like


def test_every_stage_takes_odd_rows(spark, tmp_path):
    """With labels, clashing columns, repeated rows, rows without an id or a text: each stage keeps what it says and all columns."""
    good = [(100 + k, f"Plain sentence number {k} about some {'river' if k % 2 else 'town'} and its people, written with care.") for k in range(40)]
    bad = [(200 + k, f"{k} !!!! $$$ {k}{k} CLICK CLICK CLICK #### {k}") for k in range(40)]
    docs = odd(spark, ODD + good + bad).cache()
    spark.createDataFrame([(i, int(i < 200)) for i, _ in good + bad] + [(None, 1), (1, None)], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(None, "a b c d e f g"), (7, None), (8, "")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages, before = dict(corpus_pipeline.STAGES), docs.count()
    ids = lambda df: sorted(str(r.doc_id) for r in df.select("doc_id").collect())
    kept = stages["quality"](spark, docs, f"{tmp_path}")
    assert kept.columns == docs.columns and 0 < kept.count() < before
    once = stages["near duplicates"](spark, docs, f"{tmp_path}")
    assert once.columns == docs.columns and ids(once.where("doc_id < 100 or doc_id is null")) == ["1", "2", "3", "4", "5", "None", "None", "None"]
    clean = stages["decontamination"](spark, docs, f"{tmp_path}")
    assert clean.columns == docs.columns and ids(clean) == sorted(x for x in ids(docs) if x != "4")
    shown = stages["secrets"](spark, docs, f"{tmp_path}")
    assert shown.columns == docs.columns and shown.count() == before and shown.where("doc_id = 3").first().text == "key <random> ends"
    assert stages["packing"](spark, docs, f"{tmp_path}").select("doc_id", "doc_tokens").distinct().count() >= before - 4
