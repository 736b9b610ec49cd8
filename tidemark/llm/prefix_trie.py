"""The trie of conversations' prefixes, by polynomial rolling fingerprints.

Turns are dealt to tasks by ranges of (base, conversation, turn), so no conversation has to meet in one task. A task
scans its rows with numpy: the fingerprint of the first d turns is the sum of hash(turn i) * B**i modulo 2**64, a prefix
sum, so a task needs of what stands before it a few numbers alone. These come from one row of sums for each task, folded
on the driver. A rebuilt conversation's fingerprint follows from two such sums and a power of B, without its base's text.

Rows with one depth and fingerprint form a group. Equal turns (role, text and the fingerprint before) are aggregated
first; if a group is left with more than one, each row is compared with its group's representative, the smallest
conversation, turn by turn, and those that differ move on to a group of their own, until all agree. What a subtree adds up to
is rolled up to its ancestors by doubling: round k adds what stands 2**k below, so a trie of depth D takes log2(D) rounds.
"""

from __future__ import annotations

import copy
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .text import U, partitions, randoms, settled

B = int(randoms(1, 29)[0])
B_INVERSE = pow(B, -1, 1 << 64)
#: Turns taken over from the base at most, conversations to a base, and ids that one row of a digest joins.
HEADS, BLOCK, JOINED = 3, 20, 4096
WORDS = r"[^\x20\x09-\x0D]+"
KEY = ["depth", "fp", "v"]


def power(n: np.ndarray, base: int = B) -> np.ndarray:
    """base**n modulo 2**64 for each n >= 0."""
    out, step, n = np.ones(len(n), U), base, n.astype(np.int64)
    while n.any():
        out[(n & 1).astype(bool)] *= U(step)
        n, step = n >> 1, step * step % (1 << 64)
    return out


def turns(conversations: DataFrame) -> DataFrame:
    """The scan's input: conversations' rows with their base, how many of its turns they take over, and a hash."""
    own = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    own = own.where("conv_id is not null").withColumn("base", F.expr(f"conv_id - conv_id % {BLOCK}"))
    heads = F.when(F.col("conv_id") == F.col("base"), 0).otherwise(F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEADS + 1))
    return own.withColumns({"later": F.col("conv_id") != F.col("base"), "h": heads.cast("int"), "hash": F.xxhash64("role", "text")})


class Carried:
    """What a scan knows of the rows before: the base's first sums, and the last conversation's place and sums."""

    def __init__(self):
        self.base: int | None = None
        self.base_n, self.base_sums = 0, np.zeros(HEADS + 1, U)
        self.conv: int | None = None
        self.n, self.total, self.own_sums = 0, U(0), np.zeros(HEADS + 1, U)  # sums after 0..3 turns


def scanned(state: Carried, conv: np.ndarray, base: np.ndarray, h: np.ndarray, hashes: np.ndarray) -> dict[str, np.ndarray]:
    """Place in the rebuilt conversation and fingerprints of each row, in order; state moves on to behind the last row.

    depth is 0 where the base's turns stand instead of the row; b is how many of the base's turns the row's conversation
    has, and head the fingerprints after 0 to 3 of these.
    """
    rows = len(conv)
    new = np.ones(rows, bool)
    new[1:] = conv[1:] != conv[:-1]
    new[0] = conv[0] != state.conv or base[0] != state.base
    seg = np.cumsum(new)
    starts = np.flatnonzero(new)
    first = np.concatenate([[0], starts])[seg]  # row where the row's conversation begins here
    pos = np.arange(rows) - first + 1
    running = np.full(rows, U(0))
    old = seg == 0
    pos[old] += state.n
    np.cumsum(hashes * power(pos), out=running)
    before = np.concatenate([[U(0)], running])[first]
    sums = running - before
    sums[old] += state.total
    own = np.zeros((len(starts) + 1, HEADS + 1), U)  # each conversation's sums after 0..3 turns (or all, if fewer)
    own[0] = state.own_sums
    early = pos <= HEADS
    own[seg[early], pos[early]] = sums[early]
    length = np.bincount(seg, minlength=len(starts) + 1)
    length[0] += state.n
    for j in range(1, HEADS + 1):
        own[length < j, j] = own[length < j, j - 1]
    base_of = np.concatenate([[state.base if state.base is not None else 0], base[starts]])
    conv_of = np.concatenate([[state.conv if state.conv is not None else 0], conv[starts]])
    opens = np.ones(len(base_of), bool)
    opens[1:] = base_of[1:] != base_of[:-1]
    opens[1:2] |= state.base is None
    block = np.cumsum(opens) - 1
    base_n, base_sums = np.zeros(block[-1] + 1, np.int64), np.zeros((block[-1] + 1, HEADS + 1), U)
    base_n[0], base_sums[0] = state.base_n, state.base_sums
    is_base = conv_of == base_of
    is_base[0] &= state.conv is not None
    base_n[block[is_base]], base_sums[block[is_base]] = np.minimum(length[is_base], HEADS), own[is_base]
    b = np.minimum(h, base_n[block[seg]])
    head = base_sums[block[seg]]
    depth = np.where(pos > h, pos - h + b, 0)
    at = power(depth)
    fp = head[np.arange(rows), b] + (sums - own[seg, h]) * power(h - b, B_INVERSE)
    state.base, state.base_n, state.base_sums = int(base[-1]), int(base_n[-1]), base_sums[-1]
    state.conv, state.n, state.total, state.own_sums = int(conv[-1]), int(pos[-1]), sums[-1], own[-1]
    return {"pos": pos, "depth": depth, "fp": fp, "before": fp - hashes * at, "b": b, "head": head}


def _columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    conv, base, h, hashes = (batch.column(c).to_numpy() for c in ("conv_id", "base", "h", "hash"))
    return [conv, base, h.astype(np.int64), hashes.view(U)]


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each task its number and, for its first conversation and from its last base on, what carried() needs."""
    state, first = Carried(), None
    only_conv, only_base = True, True
    for batch in batches:
        if not batch.num_rows:
            continue
        conv, base, h, hashes = _columns(batch)
        first = first or (int(base[0]), int(conv[0]))
        only_base &= bool((base == first[0]).all())
        only_conv &= bool((conv == first[1]).all())
        scanned(state, conv, base, h, hashes)
    if first:
        yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId(), "base0": first[0], "conv0": first[1], "only_base": only_base, "only_conv": only_conv, "base": state.base, "base_n": state.base_n, "base_sums": state.base_sums.view(np.int64).tolist(), "conv": state.conv, "n": state.n, "total": int(state.total.view(np.int64)), "own_sums": state.own_sums.view(np.int64).tolist()}], schema=SUMMARY_ARROW)


SUMMARY = "part int, base0 long, conv0 long, only_base boolean, only_conv boolean, base long, base_n long, base_sums array<long>, conv long, n long, total long, own_sums array<long>"
SUMMARY_ARROW = pa.schema([(c.split()[0], {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}[c.split()[1]]) for c in SUMMARY.split(", ")])


def _appended(n: int, sums: np.ndarray, more_n: int, more: np.ndarray) -> np.ndarray:
    """Sums after 0..3 turns of a conversation whose first n turns have `sums` and whose further more_n have `more`, counted from 0."""
    out = sums.copy()
    for j in range(n + 1, HEADS + 1):
        out[j] = sums[min(n, HEADS)] + more[min(j - n, more_n)] * power(np.array([n]))[0]
    return out


def carried(rows: list) -> dict[int, Carried]:
    """What stands before each task's rows, from all tasks' sums in order: one short row for each task."""
    out, now = {}, Carried()
    np.seterr(over="ignore")  # of scalars; sums are modulo 2**64
    for r in sorted(rows, key=lambda r: r["part"]):
        out[r["part"]], then = now, Carried()
        base_sums, own_sums = (np.array(r[c], np.int64).view(U) for c in ("base_sums", "own_sums"))
        then.base, then.conv, then.n, then.total = r["base"], r["conv"], r["n"], U(r["total"] % (1 << 64))
        then.base_n, then.base_sums, then.own_sums = r["base_n"], base_sums, own_sums
        same_base = now.base == r["base0"]
        if same_base and now.conv == r["conv0"] and r["only_conv"]:
            then.n, then.total, then.own_sums = now.n + r["n"], now.total + then.total * power(np.array([now.n]))[0], _appended(now.n, now.own_sums, r["n"], own_sums)
        if same_base and r["only_base"]:
            if r["conv0"] == r["base0"] == now.conv:  # the base's own turns go on here
                then.base_n, then.base_sums = min(HEADS, now.n + r["base_n"]), _appended(now.n, now.own_sums, r["base_n"], base_sums)
            elif r["conv0"] != r["base0"]:
                then.base_n, then.base_sums = now.base_n, now.base_sums
        now = then
    return out


def _scan(before, mask: int, text: bool):
    """A row for each turn that its rebuilt conversation keeps, for the turns taken over (without text), and for the root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = copy.deepcopy(before.value.get(TaskContext.get().partitionId(), Carried()))
        cut = lambda fp: (fp & U(mask)).view(np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            got = scanned(state, *_columns(batch))
            stay, begins = np.flatnonzero(got["depth"]), np.flatnonzero(got["pos"] == 1)
            conv = batch.column("conv_id").to_numpy()
            columns = {"conv_id": [conv[stay], conv[begins]], "depth": [got["depth"][stay], np.zeros(len(begins), np.int64)], "fp": [cut(got["fp"][stay]), np.zeros(len(begins), np.int64)], "before": [cut(got["before"][stay]), np.zeros(len(begins), np.int64)]}
            for d in range(1, HEADS + 1):
                some = begins[got["b"][begins] >= d]
                for name, values in (("conv_id", conv[some]), ("depth", np.full(len(some), d, np.int64)), ("fp", cut(got["head"][some, d])), ("before", cut(got["head"][some, d - 1]) if d > 1 else np.zeros(len(some), np.int64))):
                    columns[name].append(values)
            joined = {k: np.concatenate(v) for k, v in columns.items()}
            joined["before"][joined["depth"] == 1] = 0
            out = {k: pa.array(v) for k, v in joined.items()}
            if text:
                rest = len(joined["conv_id"]) - len(stay)
                for c in ("role", "text", "words"):
                    taken = batch.column(c).take(pa.array(stay))
                    out[c] = pa.concat_arrays([taken, pa.nulls(rest, taken.type)])
            yield pa.RecordBatch.from_pydict(out)

    return run


def members(ordered: DataFrame, before, mask: int, text: bool = True) -> DataFrame:
    """conv_id, depth, fp and the fp before of every turn of the rebuilt conversations; with text, role, text and words of those that aren't taken over from a base."""
    schema = "conv_id long, depth long, fp long, before long"
    columns = ["conv_id", "base", "h", "hash"]
    if text:
        schema += ", role string, text string, words long"
        ordered = ordered.withColumn("words", F.regexp_count("text", F.lit(WORDS)).cast("long"))
        columns += ["role", "text", "words"]
    return ordered.select(columns).mapInArrow(_scan(before, mask, text), schema)


def _split(rows: DataFrame) -> DataFrame:
    """rows with v and pv, marks of their class and the class before among prefixes that share depth and fingerprint, verified turn by turn.

    In each round a row is compared with its group's representative (the smallest conversation) in turn, fingerprint
    before and class before. From the first turn in which it differs, a conversation's marks change by a hash of that
    turn, which is the same for equal prefixes; so they stay together, and the rounds end when all agree.
    """
    own, bare = rows.where("depth > 0 and text is not null"), rows.where("depth > 0 and text is null").drop("role", "text", "words")
    base = F.expr(f"conv_id - conv_id % {BLOCK}")
    given = own.select(F.col("conv_id").alias("base"), "depth", "role", "text", "words").where(F.col("base") == F.expr(f"base - base % {BLOCK}"))
    rows = own.unionByName(bare.withColumn("base", base).join(given, ["base", "depth"]).drop("base")).withColumn("v", F.lit(0).cast("long"))
    turn, k = ["pv", "before", "role", "text"], 0
    while True:
        k += 1
        rows = settled(rows.withColumn("pv", F.coalesce(F.lag("v").over(Window.partitionBy("conv_id").orderBy("depth")), F.lit(0).cast("long"))))
        kinds = rows.groupBy(*KEY, F.struct(*turn).alias("t")).agg(F.min("conv_id").alias("conv_id"))
        odd = kinds.groupBy(KEY).agg(F.min_by("t", "conv_id").alias("own"), F.count("*").alias("kinds")).where("kinds > 1")
        odd = settled(kinds.join(odd, KEY).where("t <> own").select(*KEY, "t.*", F.xxhash64(F.lit(k), "t.before", "t.role", "t.text").alias("mark")))
        if odd.isEmpty():
            return rows
        first = rows.join(odd, [*KEY, *turn]).groupBy("conv_id").agg(F.min("depth").alias("since"), F.min_by("mark", "depth").alias("mark"))
        changed = F.when(F.col("depth") >= F.col("since"), F.col("v").bitwiseXOR(F.col("mark"))).otherwise(F.col("v"))
        rows = rows.join(first, "conv_id", "left").withColumn("v", changed).drop("since", "mark", "pv")


def _digests(ends: DataFrame) -> DataFrame:
    """ends_sha256 for each node (depth, fp, v) of ends(depth, fp, v, conv_id).

    Ids are sorted over ranges and joined JOINED at a time; the joined rows of a node then pass, in order, through one
    hash, which is sequential by its nature and holds no more than a row.
    """
    sorted_ids = ends.repartitionByRange(partitions(ends.sparkSession), *KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(c).to_numpy() for c in KEY]
            conv = batch.column("conv_id").to_numpy()
            new = np.ones(len(conv), bool)
            new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
            first = np.flatnonzero(new)[np.cumsum(new) - 1]
            new |= (np.arange(len(conv)) - first) % JOINED == 0
            at = np.flatnonzero(new)
            texts = [",".join(map(str, part.tolist())) for part in np.split(conv, at[1:])]
            yield pa.RecordBatch.from_pydict({**{c: k[at] for c, k in zip(KEY, keys, strict=True)}, "conv_id": conv[at], "ids": texts})

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, out = None, None, []
        for batch in batches:
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in [*KEY, "ids"]), strict=True):
                if key == now:
                    state.update(b"," + ids.encode())
                    continue
                if now:
                    out.append([*now, state.hexdigest()])
                now, state = key, hashlib.sha256(ids.encode())
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip([*KEY, "ends_sha256"], x, strict=True)) for x in out], schema=arrow)
                out = []
        if now:
            yield pa.RecordBatch.from_pylist([dict(zip([*KEY, "ends_sha256"], [*now, state.hexdigest()], strict=True))], schema=arrow)

    arrow = pa.schema([("depth", pa.int64()), ("fp", pa.int64()), ("v", pa.int64()), ("ends_sha256", pa.string())])
    joined = sorted_ids.mapInArrow(join, "depth long, fp long, v long, conv_id long, ids string")
    return joined.repartition(*KEY).sortWithinPartitions(*KEY, "conv_id").mapInArrow(digest, "depth long, fp long, v long, ends_sha256 string")


def rolled_up(nodes: DataFrame, depth: int, *figures: str) -> DataFrame:
    """nodes(conv_id, depth, parent_conv_id, figures) with each figure summed over the node's subtree, whose leaves are at most `depth` deep."""
    now = nodes.withColumns({"up": F.col("parent_conv_id"), "up_depth": F.col("depth") - 1})
    step = 1
    while step <= depth:
        below = now.where("up is not null").groupBy(F.col("up").alias("conv_id"), F.col("up_depth").alias("depth")).agg(*(F.sum(f).alias(f"more_{f}") for f in figures))
        above = now.select(F.col("conv_id").alias("up"), F.col("depth").alias("up_depth"), F.col("up").alias("next"))
        now = now.join(below, ["conv_id", "depth"], "left").withColumns({f: F.col(f) + F.coalesce(f"more_{f}", F.lit(0)) for f in figures}).drop(*(f"more_{f}" for f in figures))
        step *= 2
        if step <= depth:
            now = now.join(above, ["up", "up_depth"], "left").withColumns({"up": F.col("next"), "up_depth": F.col("depth") - step}).drop("next")
        now = settled(now)
    return now.drop("up", "up_depth")


def trie(conversations: DataFrame, bits: int = 64) -> DataFrame:
    """A row for each distinct prefix of the rebuilt conversations(conv_id, turn, role, text).

    conv_id (the smallest member) and depth name a node, parent_conv_id its parent; n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256 follow. Turns are ordered by turn (null first), then role and text; a null role or text
    is empty; repeated rows are turns each; rows without a conv_id are left out. An empty table has no node. Texts are
    compared whole, whatever their length. Other columns are left out. bits is the width of fingerprints: with few
    (tests), groups hold unlike prefixes, which are split exactly.
    """
    spark, mask = conversations.sparkSession, (1 << bits) - 1
    order = ["base", "later", "conv_id", F.col("turn").asc_nulls_first(), "role"]
    ordered = turns(conversations).repartitionByRange(partitions(spark), *order, F.substring("text", 1, 32)).sortWithinPartitions(*order, "text")
    ordered = ordered.select("conv_id", "base", "h", "hash", "role", "text").persist(StorageLevel.DISK_ONLY)
    try:
        before = spark.sparkContext.broadcast(carried(ordered.select("conv_id", "base", "h", "hash").mapInArrow(_summary, SUMMARY).collect()))
        rows = members(ordered, before, mask)
        same = rows.groupBy("depth", "fp", "before", "role", "text", "words").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"))
        none = F.lit(0).cast("long")
        kinds = F.count_if(F.col("text").isNotNull()).alias("kinds")
        nodes = settled(same.groupBy("depth", "fp").agg(F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"), F.max("words").alias("words"), F.max("before").alias("before"), kinds).withColumns({"v": none, "pv": none}))
        last = F.max(F.struct("depth", "fp", "v")).alias("end")
        if nodes.where("kinds > 1").isEmpty():
            ends = members(ordered, before, mask, text=False).withColumn("v", none).groupBy("conv_id").agg(last)
        else:
            split = _split(rows)
            root = nodes.where("depth = 0")
            nodes = settled(split.groupBy(KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"), F.max("before").alias("before"), F.max("pv").alias("pv")).unionByName(root.drop("kinds")))
            ends = split.select("conv_id", *KEY).unionByName(rows.where("depth = 0").select("conv_id", "depth", "fp", none.alias("v"))).groupBy("conv_id").agg(last)
        digests = settled(_digests(ends.select("end.*", "conv_id")))
    finally:
        ordered.unpersist()
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("fp").alias("before"), F.col("v").alias("pv"), F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(parents, ["depth", "before", "pv"], "left")
    children = nodes.groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children")).where("conv_id is not null")
    nodes = settled(nodes.join(children, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    leaf, saved = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"), (F.col("n_convs") - 1) * F.coalesce("words", F.lit(0))
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    out = rolled_up(nodes.withColumns({"n_leaves": leaf, "saved_tokens": saved}), deepest, "n_leaves", "saved_tokens")
    out = out.join(digests, KEY, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())))
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
