"""Prefix trie of conversations, screened by a count-min sketch.

A node is a distinct sequence of first turns (role, text); the root has none. For every node: its
members (conversations that start with it), children, leaves below, the bytes that storing it once
would save in its subtree, and a digest of the conversations that end there.

1. Turns become digests. A range exchange by (conversation, turn) sorts them, and every task folds the
   digests of each conversation it meets into prefix digests, h <- h * B + turn mod 2^127 - 1. A conversation
   that began in an earlier task is completed from that task's end state: as the fold is associative, one
   state a task suffices. So a conversation with a third of all turns is spread over many tasks.
2. A count-min sketch of all prefix digests is made: each task counts, the counters (0, 1, 2 or more) are
   merged by blocks. It never counts too low, so a prefix with estimate one is a singleton.
3. Nodes below a singleton are its tail, a chain of one conversation. They are emitted where they are, no
   shuffle. Only prefixes with a higher estimate are grouped exactly, combined before the exchange.
4. Each exact node has its smallest member, and every node is one member's. Walking up that
   conversation, the sums of (leaves, savings) of its nodes so far are what it adds to each prefix it
   passes: running sums per conversation (range exchange and end states as in 1), then one grouped sum.

Scale: turns move as about 60 bytes. The sketch has 3 rows of 4 counters a prefix, as a power of two up to
`MOST_CELLS` a row (12 MB as bits, sent to all tasks). Above some ten million prefixes it fills up:
more tails shuffle, the result stays the same. The parent's smallest member is found by a join on the parent
node, broadcast if proven small, else split by Spark if skewed. Ids that end at one node are joined to strings in
many tasks; one task per node then hashes those strings, as SHA-256 is sequential.

Cases: null role or text is empty; turns are ordered by number (null first), ties by their content's
digest, so repeated rows are turns of their own; rows without a conversation id belong to none; an empty table gives no rows;
other columns are not read. Ids are whole numbers.

Chosen style: Arrow/numpy for folds and the sketch, Spark for sorting, grouping and joins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwise.llm.common import arrow_map, bounded, key_column, materialize

# Fixed values of the prefix digest: a Mersenne prime and a base below it.
PRIME = (1 << 127) - 1
BASE = 0x5DEECE66D2545F4914F6CDD1D9E3779B
ROWS = 3
LEAST_CELLS, MOST_CELLS = 1 << 12, 1 << 25
BLOCK = 1 << 16

_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _digest(role: Column, text: Column) -> Column:
    both = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(both.cast("binary"), 256)), 1, 16)


def turn_digests(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """(conv_id, turn, digest of role and text, UTF-8 bytes of the text); rows without a conversation id are left out."""
    role, text = (F.coalesce(key_column(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    return conversations.where(key_column(conv_col).isNotNull()).select(
        key_column(conv_col).cast("long").alias("conv_id"), key_column(turn_col).alias("turn"),
        _digest(role, text).alias("digest"), F.octet_length(text).cast("long").alias("size"))


# --- folds over range partitions ----------------------------------------------------------------------

def _one_behind(batches: Iterator[pa.RecordBatch], fold: Callable[[pa.RecordBatch], dict]) -> Iterator[pa.RecordBatch]:
    """Folded batches with `last`: whether the next row is another conversation's, null for a task's final row."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column("conv_id").to_numpy(zero_copy_only=False)
        cols = fold(batch)
        if held:
            held[0][-1] = bool(held[2] != keys[0])
            yield pa.RecordBatch.from_arrays([*held[1].values(), pa.array(held[0], pa.bool_())], names=[*held[1], "last"])
        held = ([*(keys[1:] != keys[:-1]).tolist(), None], cols, keys[-1])
    if held:
        yield pa.RecordBatch.from_arrays([*held[1].values(), pa.array(held[0], pa.bool_())], names=[*held[1], "last"])


def _fold_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Depth n and prefix digest of each row within its task; a row without a digest is the start of a conversation."""
    state = {"key": None, "n": 0, "h": 0, "first": False}

    def fold(batch: pa.RecordBatch) -> dict:
        n, own, parent, first = [], [], [], []
        for key, d in zip(batch.column("conv_id").to_pylist(), batch.column("digest").to_pylist()):
            if key != state["key"]:
                state.update(key=key, n=0, h=0, first=state["key"] is None)
            before = state["h"]
            if d is not None:
                state["h"] = (before * BASE + int.from_bytes(d, "big") + 1) % PRIME
                state["n"] += 1
            n.append(state["n"])
            own.append(state["h"].to_bytes(16, "big"))
            parent.append(before.to_bytes(16, "big"))
            first.append(state["first"])
        return {"part": batch.column("part"), "conv_id": batch.column("conv_id"), "digest": batch.column("digest"),
                "size": batch.column("size"), "n": pa.array(n, pa.int64()), "hash": pa.array(own, pa.binary()),
                "parent": pa.array(parent, pa.binary()), "first": pa.array(first)}

    return _one_behind(batches, fold)


_FOLDED = "part int, conv_id long, digest binary, size long, n long, hash binary, parent binary, first boolean, last boolean"


def _ends(rows: DataFrame, state: list[str]) -> list:
    """Per task: its first conversation and the end state of its last one (at most a row a partition)."""
    edge = F.max(F.when(F.col("last").isNull(), F.struct("conv_id", "first", *state)))
    return sorted(rows.groupBy("part").agg(F.min("conv_id").alias("first_key"), edge.alias("edge")).collect(),
                  key=lambda r: r.part)


def _carried(ends: list, join: Callable) -> tuple[dict, set]:
    """State that each task's first conversation has from earlier tasks, and the tasks whose last one goes on."""
    carry, goes_on, key, state, part = {}, set(), None, None, None
    for r in ends:
        own = tuple(r.edge)[2:]
        if state is not None and key == r.first_key:
            carry[r.part] = state
            goes_on.add(part)
            state = join(state, own) if r.edge.first else own
        else:
            state = own
        key, part = r.edge.conv_id, r.part
    return carry, goes_on


def _join_digests(a: tuple, b: tuple) -> tuple:
    (n, h), (m, g) = a, b
    h, g = int.from_bytes(h, "big"), int.from_bytes(g, "big")
    return n + m, ((h * pow(BASE, m, PRIME) + g) % PRIME).to_bytes(16, "big")


def _globalise(batch: pa.RecordBatch, carry: dict, goes_on: set) -> dict:
    """Depth and digests of whole conversations from those within a task."""
    parts, first = batch.column("part").to_pylist(), batch.column("first").to_pylist()
    n, own, parent = (batch.column(c).to_pylist() for c in ("n", "hash", "parent"))
    for i, part in enumerate(parts):
        if first[i] and part in carry:
            before = carry[part]
            parent[i] = _join_digests(before, (n[i] - 1, parent[i]))[1]
            n[i], own[i] = _join_digests(before, (n[i], own[i]))
    last = [x if x is not None else part not in goes_on for x, part in zip(batch.column("last").to_pylist(), parts)]
    return {"conv_id": batch.column("conv_id"), "depth": pa.array(n, pa.int64()), "hash": pa.array(own, pa.binary()),
            "parent": pa.array(parent, pa.binary()), "digest": batch.column("digest"), "size": batch.column("size"),
            "last": pa.array(last)}


_CHAIN = "conv_id long, depth long, hash binary, parent binary, digest binary, size long, last boolean"


def chains(items: DataFrame, order: list, name: str) -> tuple[DataFrame, int]:
    """Each item with its depth in its conversation, prefix digest, its parent's and whether it is the last; their number.

    `items` has conv_id, digest (null: a start, of depth 0), size and the columns of `order`.
    """
    order = ["conv_id", *order]
    rows = (items.repartitionByRange(*order).sortWithinPartitions(*order)
            .select(F.spark_partition_id().alias("part"), "conv_id", "digest", "size").mapInArrow(_fold_digests, _FOLDED))
    rows = materialize(rows, name)
    carry = _carried(_ends(rows, ["n", "hash"]), _join_digests)
    return arrow_map(rows, _globalise, _CHAIN, *carry), rows.count()


def _fold_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running sums of leaves and saved per conversation within a task."""
    state = {"key": None, "sums": [0, 0], "first": False}

    def fold(batch: pa.RecordBatch) -> dict:
        keys = batch.column("conv_id").to_numpy(zero_copy_only=False)
        new = np.r_[keys[0] != state["key"], keys[1:] != keys[:-1]]
        start = np.maximum.accumulate(np.where(new, np.arange(len(keys)), -1))
        # The task's first conversation may have begun in an earlier task.
        first = np.cumsum(new) == 1 if state["key"] is None else (start < 0) & state["first"]
        out = {}
        for c, before in zip(("leaves", "saved"), state["sums"]):
            total = np.r_[0, np.cumsum(batch.column(c).to_numpy(zero_copy_only=False))]
            out[c] = total[1:] - np.where(start < 0, -before, total[start])
        state.update(key=keys[-1], sums=[int(v[-1]) for v in out.values()], first=bool(first[-1]))
        return {"part": batch.column("part"), "conv_id": batch.column("conv_id"), "depth": batch.column("depth"),
                "hash": batch.column("hash"), "first": pa.array(first), **{k: pa.array(v) for k, v in out.items()}}

    return _one_behind(batches, fold)


_SUMMED = "part int, conv_id long, depth long, hash binary, first boolean, leaves long, saved long, last boolean"


def _add_carry(batch: pa.RecordBatch, carry: dict) -> dict:
    parts = batch.column("part").to_numpy(zero_copy_only=False)
    first = batch.column("first").to_numpy(zero_copy_only=False)
    out = {c: batch.column(c).to_numpy(zero_copy_only=False).copy() for c in ("leaves", "saved")}
    for part in np.unique(parts[first]).tolist():
        if part in carry:
            mine = first & (parts == part)
            for c, before in zip(out, carry[part]):
                out[c][mine] += before
    return {"depth": batch.column("depth"), "hash": batch.column("hash"), **{k: pa.array(v) for k, v in out.items()}}


# --- sketch -------------------------------------------------------------------------------------------

def sketch_cells(hashes: pa.Array, depth: np.ndarray, width: int) -> list[np.ndarray]:
    """The counter of each row of the sketch for each prefix."""
    raw = np.frombuffer(b"".join(hashes.to_pylist()), dtype=">u8").reshape(-1, 2).astype(np.uint64)
    shift = np.uint64(64 - int(width).bit_length() + 1)
    with np.errstate(over="ignore"):
        a = raw[:, 1] + depth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        b = raw[:, 0] | np.uint64(1)
        return [(((a + np.uint64(i) * b) * np.uint64(0xD6E8FEB86659FD93)) >> shift).astype(np.int64) for i in range(ROWS)]


def _count(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((ROWS, width), dtype=np.uint8)
        for batch in batches:
            if batch.num_rows:
                depth = batch.column("depth").to_numpy(zero_copy_only=False)
                for row, cells in zip(counts, sketch_cells(batch.column("hash"), depth, width)):
                    cell, n = np.unique(cells, return_counts=True)
                    row[cell] = np.minimum(row[cell] + np.minimum(n, 2), 2)
        step = min(BLOCK, width)
        blocks = counts.reshape(-1, step)
        used = np.flatnonzero(blocks.any(axis=1))
        for at in np.array_split(used, max(1, len(used) // 256)):
            if len(at):
                bits = [[np.packbits(blocks[i] >= k).tobytes() for i in at] for k in (1, 2)]
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), *(pa.array(x, pa.binary()) for x in bits)],
                                                 names=["block", "once", "twice"])
    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    blocks: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for at, once, twice in zip(*(batch.column(i).to_pylist() for i in range(3))):
            once, twice = np.frombuffer(once, np.uint8), np.frombuffer(twice, np.uint8)
            if at in blocks:
                had = blocks[at]
                blocks[at] = [had[0] | once, had[1] | twice | (had[0] & once)]
            else:
                blocks[at] = [once, twice]
    if blocks:
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), *(
            pa.array([x[k].tobytes() for x in blocks.values()], pa.binary()) for k in (0, 1))], names=["block", "once", "twice"])


def sketch(prefixes: DataFrame, n: int) -> np.ndarray:
    """Bits of the count-min sketch of (depth, hash), rows by counters: set where two or more prefixes were counted."""
    width = min(MOST_CELLS, max(LEAST_CELLS, 1 << (4 * n - 1).bit_length())) if n else LEAST_CELLS
    kind = "block long, once binary, twice binary"
    merged = (prefixes.select("depth", "hash").mapInArrow(_count(width), kind).repartition("block").mapInArrow(_merge, kind)
              .select("block", "twice"))
    step = min(BLOCK, width) // 8
    bits = np.zeros((ROWS * width // 8 // step, step), dtype=np.uint8)
    for r in merged.collect():  # bounded by the size of the sketch
        bits[r.block] = np.frombuffer(r.twice, np.uint8)
    return bits.reshape(ROWS, width // 8)


def estimated_shared(hashes: pa.Array, depth: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether the sketch's estimate of a prefix is above one; False proves that one conversation alone has it."""
    shared = np.ones(len(depth), dtype=bool)
    for row, cells in zip(bits, sketch_cells(hashes, depth, bits.shape[1] * 8)):
        shared &= (row[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1 == 1
    return shared


def _screen(batch: pa.RecordBatch, bits: np.ndarray) -> dict:
    depth = batch.column("depth").to_numpy(zero_copy_only=False)
    out = {c: batch.column(c) for c in ("conv_id", "depth", "hash", "parent", "size", "last")}
    out["shared"] = pa.array(estimated_shared(batch.column("hash"), depth, bits))
    out["parent_shared"] = pa.array(estimated_shared(batch.column("parent"), depth - 1, bits) & (depth > 0))
    return out


_SCREENED = ("conv_id long, depth long, hash binary, parent binary, size long, last boolean, shared boolean, "
             "parent_shared boolean")


# --- conversations that end at a node ------------------------------------------------------------------

def _id_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Comma-joined ids of each node's rows in a batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        depth, node, ids = (batch.column(c).to_pylist() for c in ("depth", "hash", "conv_id"))
        cuts = [0, *(i for i in range(1, len(ids)) if (depth[i], node[i]) != (depth[i - 1], node[i - 1])), len(ids)]
        spans = list(zip(cuts, cuts[1:]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([depth[a] for a, _ in spans], pa.int64()), pa.array([node[a] for a, _ in spans], pa.binary()),
             pa.array([ids[a] for a, _ in spans], pa.int64()),
             pa.array([",".join(map(str, ids[a:b])) for a, b in spans], pa.string())],
            names=["depth", "hash", "first_id", "ids"])


def _hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the runs of a node, which come in order."""
    key, sha, done = None, None, []

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], t) for i, t in enumerate(
            (pa.int64(), pa.binary(), pa.string()))], names=["depth", "hash", "ends"])

    for batch in batches:
        for d, h, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "hash", "ids"))):
            if (d, h) != key:
                if key is not None:
                    done.append((*key, sha.hexdigest()))
                key, sha = (d, h), hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        if done:
            yield out()
            done = []
    if key is not None:
        done = [(*key, sha.hexdigest())]
        yield out()


def _end_digests(ends: DataFrame) -> DataFrame:
    """(depth, hash, ends): digest of the ascending ids (depth, hash, conv_id) of each node."""
    order = ["depth", "hash", "conv_id"]
    runs = (ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
            .mapInArrow(_id_runs, "depth long, hash binary, first_id long, ids string"))
    return (runs.repartition("depth", "hash").sortWithinPartitions("depth", "hash", "first_id").select("depth", "hash", "ids")
            .mapInArrow(_hash_runs, "depth long, hash binary, ends string"))


# --- the trie -----------------------------------------------------------------------------------------

def trie(items: DataFrame, order: list) -> DataFrame:
    """Nodes of the trie over `items` as `chains` takes them, with a start for every conversation."""
    prefixes, n = chains(items, order, "trie-prefixes")
    bits = sketch(prefixes, n)
    rows = materialize(arrow_map(prefixes, _screen, _SCREENED, bits), "trie-screened")
    shared, tails = rows.where("shared"), rows.where("NOT shared")
    ends = F.sha2(F.when(F.col("last"), F.col("conv_id").cast("string")).otherwise("").cast("binary"), 256)
    one = tails.select("conv_id", "depth", "parent", "parent_shared", F.lit(1).cast("long").alias("n_convs"),
                       F.when(F.col("last"), 0).otherwise(1).cast("long").alias("n_children"),
                       F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
                       ends.alias("ends_sha256"))
    nodes = materialize(shared.groupBy("depth", "hash").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.count_if("last").alias("n_ends"),
        F.max("size").alias("size"), F.max("parent").alias("parent"),
        F.bool_or("parent_shared").alias("parent_shared")), "trie-nodes")

    # What a conversation adds to the prefixes it passes on its way up: sums over its own nodes so far.
    none = F.lit(None).cast("binary").alias("hash")
    zero, long_one = F.lit(0).cast("long"), F.lit(1).cast("long")
    steps = (nodes.select("conv_id", "depth", F.lit(0).alias("kind"), none,
                          (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaves"),
                          ((F.col("n_convs") - 1) * F.col("size")).alias("saved"))
             .unionAll(tails.where("last").select("conv_id", "depth", F.lit(0), none, long_one, zero))
             .unionAll(shared.select("conv_id", "depth", F.lit(1), "hash", zero, zero)))
    up = ["conv_id", F.col("depth").desc(), "kind"]
    sums = materialize(steps.repartitionByRange(*up).sortWithinPartitions(*up)
                       .select(F.spark_partition_id().alias("part"), "conv_id", "depth", "hash", "leaves", "saved")
                       .mapInArrow(_fold_sums, _SUMMED), "trie-sums")
    carry, _ = _carried(_ends(sums, ["leaves", "saved"]), lambda a, b: (a[0] + b[0], a[1] + b[1]))
    added = arrow_map(sums.where("hash IS NOT NULL"), _add_carry, "depth long, hash binary, leaves long, saved long", carry)

    children = nodes.where("parent_shared").select("depth", "parent").unionAll(
        tails.where("parent_shared").select("depth", "parent"))
    parts = (added.select("depth", "hash", "leaves", "saved", zero.alias("children"))
             .unionAll(children.select(F.col("depth") - 1, "parent", zero, zero, long_one)))
    parts = parts.groupBy("depth", "hash").agg(*[F.sum(c).alias(c) for c in ("leaves", "saved", "children")])
    full = (nodes.join(parts, ["depth", "hash"]).join(_end_digests(shared.where("last")), ["depth", "hash"], "left")
            .select("conv_id", "depth", "parent", "parent_shared", "n_convs",
                    F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                    F.coalesce("ends", F.lit(_EMPTY_SHA)).alias("ends_sha256")))

    owners = nodes.select((F.col("depth") + 1).alias("of_depth"), F.col("hash").alias("of"), F.col("conv_id").alias("owner"))
    if bounded(owners, 400_000, 64):
        owners = F.broadcast(owners)
    below = full.unionByName(one)
    parent = F.when(F.col("depth") > 0, F.coalesce("owner", "conv_id"))
    found = below.where("parent_shared").join(
        owners, (F.col("depth") == F.col("of_depth")) & (F.col("parent") == F.col("of")), "left")
    out = ["conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return found.select(*out).unionAll(
        below.where("NOT parent_shared").withColumn("owner", F.lit(None).cast("long")).select(*out))


def _with_starts(items: DataFrame, convs: DataFrame) -> DataFrame:
    """`items` (conv_id, side, at, digest, size) with the start of each conversation."""
    return convs.select("conv_id", F.lit(0).alias("side"), F.lit(0).cast("long").alias("at"),
                        F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("size")).unionAll(items)


def positions(turns: DataFrame) -> DataFrame:
    """Turns as `turn_digests` gives them, with `at`, 0 for a conversation's first."""
    return chains(turns, [F.col("turn").asc_nulls_first(), "digest"], "trie-turns")[0].select(
        "conv_id", (F.col("depth") - 1).alias("at"), "digest", "size")


def prefix_trie(conversations: DataFrame, **columns: str) -> DataFrame:
    """The trie of the conversations as they are, one row per node."""
    turns = positions(turn_digests(conversations, **columns))
    items = turns.select("conv_id", F.lit(1).alias("side"), "at", "digest", "size")
    return trie(_with_starts(items, turns.select("conv_id").distinct()), ["side", "at"])


def grafted_trie(conversations: DataFrame, every: int = 5, heads: int = 9, **columns: str) -> DataFrame:
    """The trie of conversations that begin like a neighbour.

    Conversation c takes the first h turns of conversation c - c % `every` (all if it has fewer, none if it
    is absent), h = CRC-32 of c's decimal digits % `heads`, then its own turns after its first h. The
    remainder has the sign of c. A conversation may end up without turns.
    """
    turns = positions(turn_digests(conversations, **columns))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    convs = turns.select("conv_id").distinct()
    first = turns.where((F.col("at") < heads - 1) & (F.col("conv_id") % every == 0)).select(
        F.col("conv_id").alias("base"), "at", "digest", "size")
    head = (convs.join(first, F.col("conv_id") - F.col("conv_id") % every == F.col("base")).where(F.col("at") < h)
            .select("conv_id", F.lit(1).alias("side"), "at", "digest", "size"))
    own = turns.where(F.col("at") >= h).select("conv_id", F.lit(2).alias("side"), "at", "digest", "size")
    return trie(_with_starts(head.unionAll(own), convs), ["side", "at"])


def with_turns(nodes: DataFrame, conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
               role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Nodes of `prefix_trie` with the role and text of their last turn (the root: null)."""
    role, text = (F.coalesce(key_column(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    texts = conversations.select(role.alias("role"), text.alias("text"), _digest(role, text).alias("digest")).dropDuplicates(["digest"])
    at = positions(turn_digests(conversations, conv_col, turn_col, role_col, text_col)).select(
        F.col("conv_id").alias("of"), (F.col("at") + 1).alias("of_depth"), "digest")
    return (nodes.join(at, (F.col("conv_id") == F.col("of")) & (F.col("depth") == F.col("of_depth")), "left")
            .drop("of", "of_depth").join(texts, "digest", "left").drop("digest"))
