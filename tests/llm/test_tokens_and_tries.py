"""Exact piece encoding, alignment of two tokenizers and the prefix trie, each against a plain brute-force version."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import alignment, pieces, prefix_trie, queries
from tidemark.llm.tokens import vocabulary

SF = "/root/testdata/sf0.001"
PIECES, BYTES = vocabulary("piece_bpe_32k.model"), vocabulary("byte_bpe_50k.json")
DOCS = "doc_id long, text string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def byte_tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTES)
    t.encode_special_tokens = True
    return t


def odd_texts(n: int, seed: int) -> list:
    rng = random.Random(seed)
    signs = "abcdeé ßI  ▁<s>0x1A>漢字ñ\n\t\r\x00𝔘😀  \u0085\x1c.,!'st12"
    some = ["".join(rng.choice(signs) for _ in range(rng.randrange(50))) for _ in range(n)]
    spaces = [" " * k + "x" * (k % 3) + " " * (k // 2) for k in range(0, 90, 3)]
    return [*some, *spaces, None, "", "▁", " ", "<s></s><unk>", "<|endoftext|> x", "don't 'll we'll", "ab" * 6000, "=-" * 3000, " " * 5000, "word " * 3000]


# --- encoding and decoding


def test_backtracking_gives_what_the_library_gives(library):
    coder = pieces.PieceEncoder(PIECES)
    texts = odd_texts(3000, 1)
    ids, bounds = coder.encode(*pieces.utf8(pieces.spaced(pa.array(texts))))
    back = coder.decode(ids.astype(np.int64), bounds).to_pylist()
    for k, text in enumerate(texts):
        got = ids[bounds[k] : bounds[k + 1]].tolist()
        assert got == library.encode(text or ""), text
        assert back[k] == library.decode(got)


def test_a_pair_fits_exactly_if_the_library_keeps_it(library):
    model, rng = pieces.PieceModel(PIECES), random.Random(5)
    ids = [i for i in model.ids.values() if model.texts[i][0] != " " and len(model.texts[i]) < 4]
    for _ in range(3000):
        a, b = rng.choice(ids), rng.choice(ids)
        whole = [library.piece_to_id(x) for x in library.encode("\n" + model.texts[a] + model.texts[b], out_type=str)][2:]
        assert model.fits(a, b) == (whole == [a, b])


def test_a_text_without_a_cut_goes_over_blocks(library, monkeypatch):
    monkeypatch.setattr(pieces, "BLOCK", 16)
    model = pieces.PieceModel(PIECES)
    for text in ("thequickbrownfoxjumpsover" * 40, "aaaaabaaaab" * 50, "漢字かな" * 30):
        assert model.encode(" " + text) == library.encode(text)


def test_decode_of_any_ids(spark, library):
    rng = random.Random(3)
    rows = [(k, [rng.randrange(32000) if rng.random() < 0.4 else rng.randrange(260) for _ in range(rng.randrange(12))]) for k in range(500)]
    got = pieces.decoded(spark.createDataFrame([*rows, (900, None)], "doc_id long, ids array<int>")).collect()
    assert {r["doc_id"]: r["text"] for r in got} == {k: library.decode(ids) for k, ids in rows} | {900: ""}


def test_op11_on_whole_table(spark, library):
    docs = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    want = []
    for doc_id, text in docs:
        ids = library.encode(text or "")
        want.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    got = queries.QUERIES["op11_sentencepiece"](spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_encoding_of_odd_tables(spark):
    assert pieces.encoded(spark.createDataFrame([], DOCS)).count() == 0
    table = spark.createDataFrame([(1, "a b", 5), (1, "a b", 6), (None, None, 7), (2, "", 8)], "doc_id long, text string, ids int")
    got = sorted(map(tuple, pieces.encoded(table, decode=True).collect()), key=str)
    ids = pieces.PieceModel(PIECES).encode(" a b")
    assert got == sorted([(1, ids, "a b"), (1, ids, "a b"), (None, [], ""), (2, [], "")], key=str)


# --- alignment


def brute_alignment(text, byte_tokenizer, library):
    if not text:
        return None
    byte_of = alignment.byte_of_sign()
    names = {i: t for t, i in byte_tokenizer.get_vocab().items()}
    a, b = byte_tokenizer.encode(" " + text, add_special_tokens=False).ids, library.encode(text)
    a_bytes = [bytes(byte_of[c] for c in names[i]) for i in a]
    b_bytes = [bytes([int(p[3:5], 16)]) if library.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [library.id_to_piece(i)]]
    if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
        return None
    owner_a, owner_b = [k for k, x in enumerate(a_bytes) for _ in x], [k for k, x in enumerate(b_bytes) for _ in x]
    links = sorted(set(zip(owner_a, owner_b, strict=True)))
    groups, last = [], 0
    for k in range(1, len(owner_a) + 1):
        if k == len(owner_a) or (owner_a[k] != owner_a[k - 1] and owner_b[k] != owner_b[k - 1]):
            x, y = (",".join(str(ids[j]) for j in sorted(set(owner[last:k]))) for ids, owner in ((a, owner_a), (b, owner_b)))
            groups.append(f"{x}|{y}")
            last = k
    return len(a), len(b), len(groups), [(a[i], b[j]) for i, j in links], ";".join(groups)


def brute_table(docs, byte_tokenizer, library):
    found = [(doc_id, brute_alignment(text, byte_tokenizer, library)) for doc_id, text in docs]
    count = Counter(p for _, x in found if x for p in set(x[3]))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for doc_id, x in found:
        if not x:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((doc_id, *x[:3], len(x[3]), sum(count[p] == best[p[0]] for p in x[3]), sum(count[p] for p in x[3]), sha(x[4])))
    return out


def digested(df):
    return df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)))


@pytest.mark.parametrize("broadcast_pairs", [1 << 22, 0])
def test_alignment_of_odd_texts(spark, byte_tokenizer, library, broadcast_pairs):
    docs = list(enumerate(odd_texts(300, 2)))
    docs += [(None, "a b"), (1, "the same id"), (1, "the same id")]
    got = alignment.aligned(spark.createDataFrame(docs, DOCS).repartition(5), broadcast_pairs=broadcast_pairs)
    assert sorted(map(tuple, digested(got).collect()), key=str) == sorted(brute_table(docs, byte_tokenizer, library), key=str)


def test_components_are_found_over_long_chains():
    rng = random.Random(8)
    n = 2000
    a = np.array([rng.randrange(n) for _ in range(1500)] + list(range(n, n + 500)))
    b = np.array([rng.randrange(n) for _ in range(1500)] + list(range(n + 1, n + 501)))
    got = alignment.components(n + 501, a, b)
    root = list(range(n + 501))
    for _ in range(n):
        before = list(root)
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            root[x] = root[y] = min(root[x], root[y])
        if before == root:
            break
    assert got.tolist() == root


def test_aligner_forgets_and_counts_on(spark, byte_tokenizer, library, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_WORDS", 40)
    own = alignment.Aligner(BYTES, PIECES)
    seen = Counter()
    texts = [f"{chr(97 + k % 26)}{k} word {k} the of" for k in range(300)]
    for k in range(0, 300, 10):
        _, _, _, row, found = own.align(pa.array(texts[k : k + 10]))
        _, pair, _ = own.doc_pairs(row, found)
        seen.update(own.pairs[pair].tolist())
    want = Counter(a << 32 | b for t in texts for a, b in set(brute_alignment(t, byte_tokenizer, library)[3]))
    assert seen == want


def test_op13_on_whole_table(spark, byte_tokenizer, library):
    docs = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    got = queries.QUERIES["op13_token_alignment"](spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(brute_table(docs, byte_tokenizer, library))
    assert alignment.aligned(spark.createDataFrame([], DOCS)).count() == 0


# --- prefix trie


def brute_trie(rows):
    convs = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            convs[conv_id].append(((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()), (role or "", text or "")))
    convs = {c: [x[1] for x in sorted(v, key=lambda x: x[0])] for c, v in convs.items()}
    built = {}
    for c, own in convs.items():
        h, base = zlib.crc32(str(c).encode()) % 4, c - (c % 20 if c >= 0 else -(-c % 20))
        built[c] = convs.get(base, [])[:h] + own[h:]
    held = defaultdict(list)
    for c, t in built.items():
        for d in range(len(t) + 1):
            held[tuple(t[:d])].append(c)
    children = Counter(p[:-1] for p in held if p)
    leaves, saved = Counter(), Counter()
    for p, cs in held.items():
        words = len(bytes(" ", "ascii").join(x for x in p[-1][1].encode().translate(bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")).split(b" ") if x).split(b" ")) if p and p[-1][1].strip(" \t\n\x0b\x0c\r") else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(cs) - 1) * words
    out = []
    for p, cs in held.items():
        ends = ",".join(map(str, sorted(c for c in cs if len(built[c]) == len(p))))
        out.append((min(cs), len(p), min(held[p[:-1]]) if p else None, len(cs), children[p], leaves[p], saved[p], sha(ends)))
    return sorted(out, key=str)


CONV = "conv_id long, turn long, role string, text string"


def random_conversations(seed: int, n: int, long: int, alphabet: str = "ab"):
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(-60, 200), n):
        for t in range(rng.choice([0, 1, 2, 3, 4, 5, 9])):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "user", None]), rng.choice(["", " ", *alphabet, "a b", None])))
    rows += [(40, t, "user", rng.choice("ab")) for t in range(long)]  # one conversation over many tasks
    rows += [(None, 1, "user", "x"), rows[0], rows[0]]
    return rows


@pytest.mark.parametrize(("seed", "bits", "tasks"), [(1, 64, 4), (2, 64, 23), (3, 7, 4)])
def test_trie_against_brute_force(spark, monkeypatch, seed, bits, tasks):
    monkeypatch.setattr(prefix_trie, "partitions", lambda _: tasks)
    monkeypatch.setattr(prefix_trie, "JOINED", 3)
    rows = random_conversations(seed, *((130, 300) if bits == 64 else (40, 6)))
    got = prefix_trie.trie(spark.createDataFrame(rows, CONV).withColumn("fp", F.lit("clash")), bits)
    assert sorted(map(tuple, got.collect()), key=str) == brute_trie(rows)


def test_scan_carries_on_anywhere():
    rng = np.random.default_rng(4)
    conv = np.sort(rng.integers(0, 60, 400))
    base = conv - conv % 20
    order = np.lexsort((conv, conv != base, base))
    conv, base = conv[order], base[order]
    h = np.where(conv == base, 0, conv % 4)
    hashes = rng.integers(0, 1 << 63, 400).astype(np.uint64)

    def scan(state, x, y):
        got = prefix_trie.scanned(state, conv[x:y], base[x:y], h[x:y], hashes[x:y])
        got["head"][np.arange(4) > got["b"][:, None]] = 0  # sums beyond the base's turns taken over mean nothing
        got["fp"][got["depth"] == 0] = got["before"][got["depth"] == 0] = 0  # nor do those of turns that aren't kept
        return got

    whole = scan(prefix_trie.Carried(), 0, 400)
    for cuts in ([0, 1, 2, 3, 200, 400], list(range(0, 401, 7)) + [400], sorted({0, 400, *rng.integers(1, 400, 60).tolist()})):
        state, parts, rows = prefix_trie.Carried(), [], []
        for k, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if x == y:
                continue
            parts.append(scan(state, x, y))
            alone = prefix_trie.Carried()
            scan(alone, x, y)
            as_long = lambda v: np.array(v, np.uint64).view(np.int64).tolist()
            rows.append({"part": k, "base0": base[x], "conv0": conv[x], "only_base": bool((base[x:y] == base[x]).all()), "only_conv": bool((conv[x:y] == conv[x]).all()), "base": alone.base, "base_n": alone.base_n, "base_sums": as_long(alone.base_sums), "conv": alone.conv, "n": alone.n, "total": int(np.array([alone.total]).view(np.int64)[0]), "own_sums": as_long(alone.own_sums)})
        for name in whole:
            assert (np.concatenate([p[name] for p in parts]) == whole[name]).all()
        before = prefix_trie.carried(rows)
        for r in rows:
            x, y = cuts[r["part"]], cuts[r["part"] + 1]
            again = scan(before[r["part"]], x, y)
            for name in whole:
                assert (again[name] == whole[name][x:y]).all()


def test_trie_of_odd_tables(spark, tmp_path):
    rows = [(7, None, None, None), (27, 0, "user", "x" * 200000), (47, 0, "user", "x" * 200000 + " y"), (47, 0, "user", ""), (None, None, None, None), (7, None, None, None), (60, 3, "", " ")]
    clashing = ["depth", "fp", "v", "pv", "base", "later", "h", "hash", "before", "words", "up", "n_convs", "parent_conv_id", "ids"]
    for k, part in enumerate(([], rows)):
        spark.createDataFrame(part, CONV).repartition(3).withColumns({c: F.lit("x") for c in clashing}).write.parquet(f"{tmp_path}/{k}/conversations.parquet")
        got = queries.QUERIES["op12_prefix_trie"](spark, f"{tmp_path}/{k}").collect()
        assert sorted(map(tuple, got), key=str) == brute_trie(part)


def test_op12_on_whole_table(spark):
    duck = duckdb.connect()
    duck.execute(f"create view conversations as select * from '{SF}/conversations.parquet'")
    got = queries.QUERIES["op12_prefix_trie"](spark, SF)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    found = sorted(map(tuple, got.collect()), key=str)
    assert found == brute_trie(duck.execute("select conv_id, turn, role, text from conversations").fetchall())
    assert found == sorted(duck.execute(queries.ORACLES["op12_prefix_trie"]).fetchall(), key=str)


def test_the_oracle_of_op12_on_random_rows():
    duck = duckdb.connect()
    duck.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    rows = random_conversations(9, 90, 20)
    duck.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    assert sorted(duck.execute(queries.ORACLES["op12_prefix_trie"]).fetchall(), key=str) == brute_trie(rows)
