"""The quality classifier's vectors, pooling and network against plain loops, and the SQL of substring dedup."""

import math
import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa

from tidemark.llm import quality, queries, substring_dedup
from tidemark.llm.text import hash_spans, utf8

SF = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
TEXTS = ["The cat sat on the mat, the Cat SAT.", "", None, "x", "é É ñandú 12 3,4 !! !!", "a " * 40, "UPPER lower Mixed1 -- -- 2024-01-01", "\t\n", "one two three four five six seven eight nine ten"]


def some_texts(n=60):
    r = random.Random(8)
    return TEXTS + [" ".join(r.choice(["the", "The", "THE", "of", "cat,", "99", "x1", "--", "élan", "longerword", "extraordinarily"]) for _ in range(r.randrange(30))) for _ in range(n)]


def plain_words(text):
    """(slot, shape's slot) of each word, by the rules stated for them."""
    out, last = [], None
    for w in WORD.findall((text or "").encode()):
        h = int(hash_spans(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]), fold=True)[0])
        upper = sum(65 <= c <= 90 for c in w)
        letters = sum(65 <= c <= 90 or 97 <= c <= 122 or c >= 128 for c in w)
        digits = sum(48 <= c <= 57 for c in w)
        marks = len(w) - letters - digits
        shape = (65 <= w[0] <= 90) + 2 * (upper > 1 and upper == letters) + 4 * (digits > 0) + 8 * min(marks, 3) + 32 * (h == last) + 64 * (letters == 0)
        shape += 128 * sum(len(w) >= k for k in (3, 6, 10))
        out.append((h % quality.WORDS, quality.WORDS + shape))
        last = h
    return out


def plain_vectors(texts):
    total = defaultdict(lambda: [0] * quality.SIZE)

    def add(slot, neighbour):
        for place, sign in zip(quality.PLACES[neighbour].tolist(), quality.SIGNS[neighbour].tolist(), strict=True):
            total[slot][place] += sign

    for text in texts:
        words = plain_words(text)
        for k, (word, shape) in enumerate(words):
            add(word, shape)
            for j in (k - 2, k - 1, k + 1, k + 2):
                if 0 <= j < len(words):
                    add(word, words[j][0])
            for j in (k - 1, k + 1):
                if 0 <= j < len(words):
                    add(shape, words[j][1])
    return {k: [x / n for x in v] for k, v in total.items() if (n := math.sqrt(sum(x * x for x in v)))}


def test_vectors_and_pooling_against_plain_loops(spark):
    texts = some_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got, want = quality.vectors(docs), plain_vectors(texts)
    assert got.shape == (quality.WORDS + quality.SHAPES, quality.SIZE)
    assert set(np.flatnonzero(np.abs(got).sum(1)).tolist()) == set(want)
    assert max(abs(a - b) for k, v in want.items() for a, b in zip(got[k].tolist(), v, strict=True)) < 1e-5
    features = quality.pooled(*utf8(pa.array(texts)), got)
    none = [0.0] * quality.SIZE
    for row, text in zip(features.tolist(), texts, strict=True):
        words = plain_words(text)
        if not words:
            assert row == [0.0] * len(row)
            continue
        n = len(words)
        mean = [sum(want.get(w[part], none)[d] for w in words) / n for part in (0, 1) for d in range(quality.SIZE)]
        plain = [*mean, math.log1p(n), len({w[0] for w in words}) / n, min(40, len(text.encode()) / n) / 10]
        assert max(abs(a - b) for a, b in zip(row, plain, strict=True)) < 1e-4


def test_network_learns_and_its_temperature_is_the_best_of_the_grid():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 6))
    y = (rng.random(1500) < 1 / (1 + np.exp(-6 * (x[:, 0] * x[:, 1] > 0) + 3))).astype(float)  # no linear rule fits this
    model = quality.Network().fit(x, y)
    p = model.probability(x)
    assert ((p > 0.5) == (x[:, 0] * x[:, 1] > 0)).mean() > 0.9
    w, b, u, c = (np.asarray(a).tolist() for a in model.w)
    for row, have in zip(x[:50].tolist(), p[:50].tolist(), strict=True):
        z = [(v - m) / s for v, m, s in zip(row, model.mean.tolist(), model.scale.tolist(), strict=True)]
        hidden = [math.tanh(sum(z[i] * w[i][k] for i in range(6)) + b[k]) for k in range(quality.HIDDEN)]
        plain = 1 / (1 + math.exp(-(sum(h * k for h, k in zip(hidden, u, strict=True)) + c[0]) / model.temperature))
        assert abs(have - (plain * model.seen + model.rate) / (model.seen + 1)) < 1e-9
    rest = np.random.default_rng(3).permutation(len(x))[: len(x) // 5]
    logits = model._logits((x[rest] - model.mean) / model.scale)
    loss = lambda t: (np.logaddexp(0, logits / t) - y[rest] * logits / t).mean()
    assert all(loss(model.temperature) <= loss(t) + 1e-12 for t in np.geomspace(1, 16, 61))


def test_sql_of_substring_dedup(spark):
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    got = queries.QUERIES["op2_substring_dedup"](spark, SF).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(map(tuple, got.collect())) == sorted(duck.execute(queries.ORACLES["op2_substring_dedup"]).fetchall())
    r = random.Random(3)
    rows = [(k, " ".join(r.choice("abc") for _ in range(r.choice([0, 5, 12, 13, 40])))) for k in range(60)] + [(60, None), (61, "")]
    duck.execute("drop view documents")
    duck.execute("create table documents (doc_id bigint, text varchar)")
    duck.executemany("insert into documents values (?, ?)", rows)
    own = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(map(tuple, own.collect())) == sorted(duck.execute(queries.ORACLES["op2_substring_dedup"]).fetchall())


def test_frame_checksums_against_bits():
    from tidemark.llm import media

    def bits(data):
        value = 0xFFFF
        for bit in "".join(format(x, "08b") for x in data):
            out = value >> 15 ^ int(bit)
            value = value << 1 & 0xFFFF ^ out * media.CRC_POLYNOMIAL
        return value

    r = random.Random(3)
    assert media.crc16(b"123456789") == bits(b"123456789") == 0xAEE7
    assert all(media.crc16(d) == bits(d) for d in (r.randbytes(r.randrange(40)) for _ in range(500)))
