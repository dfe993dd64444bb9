"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit SimHash is cut into three segments of 22, 21 and 21 bits. Each is padded with zeros to a
23-bit word and decoded by the perfect binary Golay code [23, 12, 7]: every word is within 3 bits
of exactly one codeword. A word at distance 3 from its codeword has five more codewords at
distance 4, so a segment has one or six codeword indices ("keys").

Two facts about these keys:

* words at most 2 bits apart share a key (both use all their keys);
* words 1 bit apart have different parity. The even word's own index is among the keys of the odd
  word, so even words need just their own index.

Two fingerprints at most 4 bits apart spread the errors over the segments in one of these ways
(smallest first), and each way has a join key that both fingerprints emit:

* (0, <=1, any) and (0, 2, 2): one segment exact, with the keys of another segment;
* (1, 1, <=2): the keys of two segments, with one of three parts of the third segment, of which at
  most two can hold an error.

The keys (about 118 for a fingerprint, 29 to 34 bits each) bring candidates together; the bit
distance of candidates is verified. Within a bucket, a search that visits every fingerprint once
returns a spanning forest of the links, never all pairs. So a large group of near copies costs
about as many links as it has different fingerprints. Exact copies of a fingerprint are one row
from the start. A bucket above `bucket_rows` fingerprints is cut into blocks, and every pair of
blocks is searched by itself: exact, with bounded memory in each task.

Chosen style: numpy in Arrow batches for hashing, decoding and bucket search (the popcounts of a
bucket are vectorised); Spark for every exchange, aggregate and join.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwise.llm.common import arrow_map, key_column, materialize

SHINGLE_WORDS = 4
MAX_BITS = 4
BUCKET_ROWS = 65_536  # fingerprints searched at once in one task
CHUNK = 1 << 18  # shingles hashed at once

# --- the Golay code ------------------------------------------------------------------
# Generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 (a fixed value of the code).
GENERATOR = 0b110001110101
SEGMENT_BITS = (22, 21, 21)


def _remainder(word: int) -> int:
    for shift in range(22, 10, -1):
        if word >> shift & 1:
            word ^= GENERATOR << (shift - 11)
    return word


def _golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the high 12 and low 11 bits, error pattern of a syndrome, and five other indices (or -1)."""
    high = np.array([_remainder(i << 11) for i in range(1 << 12)], dtype=np.int64)
    error = np.zeros(1 << 11, dtype=np.int64)
    for weight in (1, 2, 3):
        for bits in combinations(range(23), weight):
            word = sum(1 << b for b in bits)
            error[high[word >> 11] ^ (word & 0x7FF)] = word
    codewords = (np.arange(1 << 12, dtype=np.int64) << 11) | high
    sevens = codewords[np.bitwise_count(codewords) == 7]
    other = np.full((1 << 11, 5), -1, dtype=np.int64)
    for syndrome in np.flatnonzero(np.bitwise_count(error) == 3):
        holds = (sevens & error[syndrome]) == error[syndrome]
        other[syndrome] = sevens[holds] >> 11
    return high, np.arange(1 << 11, dtype=np.int64), error, other


_TABLES: tuple | None = None


def golay_keys(words: np.ndarray, all_keys: np.ndarray | bool = True) -> np.ndarray:
    """The codeword indices within 4 bits of each 23-bit word: shape (n, 6), -1 where there is none.

    Where `all_keys` is false only the own index (of the nearest codeword) is returned.
    """
    global _TABLES
    if _TABLES is None:
        _TABLES = _golay_tables()
    high, low, error, other = _TABLES
    syndrome = high[words >> 11] ^ low[words & 0x7FF]
    own = (words ^ error[syndrome]) >> 11
    out = np.full((len(words), 6), -1, dtype=np.int64)
    out[:, 0] = own
    more = other[syndrome]
    out[:, 1:] = np.where((more >= 0) & np.broadcast_to(np.asarray(all_keys), own.shape)[:, None], own[:, None] ^ more, -1)
    return out


def segments(fps: np.ndarray) -> list[np.ndarray]:
    """The three segments of each signed 64-bit fingerprint."""
    u, out, shift = fps.astype(np.int64).view(np.uint64), [], 64
    for bits in SEGMENT_BITS:
        shift -= bits
        out.append(((u >> np.uint64(shift)) & np.uint64((1 << bits) - 1)).astype(np.int64))
    return out


def bucket_keys(fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(key, fingerprint) arrays: all join keys of the fingerprints."""
    segs = segments(fps)
    full = [golay_keys(s) for s in segs]
    half = [golay_keys(s, np.bitwise_count(s) % 2 == 1) for s in segs]
    tag = 0

    def emit(payload: np.ndarray, valid: np.ndarray):
        rows, _ = np.nonzero(valid)
        return payload[valid] | (tag << 40), fps[rows]

    for i in range(3):
        for j in range(3):
            if i != j:
                tag += 1
                keys = full[j] if j == (i + 1) % 3 else half[j]
                yield emit((segs[i][:, None] << 12) | keys, keys >= 0)
    for i, j in ((0, 1), (0, 2), (1, 2)):
        k = 3 - i - j
        pairs = (half[i][:, :, None] << 12 | half[j][:, None, :]).reshape(len(fps), 36)
        valid = ((half[i] >= 0)[:, :, None] & (half[j] >= 0)[:, None, :]).reshape(len(fps), 36)
        for part in range(3):
            tag += 1
            bits = (segs[k] >> (7 * part)) & (0xFF if part == 2 else 0x7F)
            yield emit((pairs << 8) | bits[:, None], valid)


# --- fingerprints --------------------------------------------------------------------
def fingerprint(text: bytes | None, shingle: int = SHINGLE_WORDS) -> int:
    """SimHash of one whole text as a signed 64-bit number (null and texts without words: 0)."""
    words = (text or b"").lower().split()  # bytes: A-Z only, and the six ASCII white-space characters
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        return int(np.uint64(xxhash.xxh64_intdigest(joined, 42)).astype(np.int64))
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(size + 1) - 1
    start, stop = (end - size)[: len(words) - shingle + 1], end[shingle - 1:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, len(start), CHUNK):
        pieces = zip(start[at: at + CHUNK].tolist(), stop[at: at + CHUNK].tolist(), strict=True)
        h = np.array([digest(joined[a:b], 42) for a, b in pieces], dtype=np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(start)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_hash, fp) for every row of `docs`; one local pass, nothing is shuffled."""
    src = docs.select(key_column(id_col).cast("long").alias("doc_id"),
                      F.xxhash64(key_column(text_col)).alias("text_hash"),
                      key_column(text_col).cast("binary").alias("text"))

    def run(batch: pa.RecordBatch) -> dict:
        fps = [fingerprint(t.as_py(), shingle) for t in batch.column("text")]
        return {"doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"),
                "fp": pa.array(fps, pa.int64())}

    return arrow_map(src, run, "doc_id long, text_hash long, fp long")


# --- links ---------------------------------------------------------------------------
def _spanning(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of the fingerprints of one bucket.

    Every fingerprint is the centre once and is compared with those not yet reached, so a dense
    bucket is nearly linear: its first centres reach almost all others.
    """
    rest, a, b = np.unique(fps), [], []
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            centre = queue.pop()
            near = np.bitwise_count(np.bitwise_xor(rest, centre).view(np.uint64)) <= max_bits
            if near.any():
                found = rest[near]
                a.append(np.full(len(found), centre))
                b.append(found)
                queue.extend(found)
                rest = rest[~near]
    if not a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a, b = np.concatenate(a), np.concatenate(b)
    return np.minimum(a, b), np.maximum(a, b)


def _search(batches: Iterator[pa.RecordBatch], max_bits: int, bucket_rows: int) -> Iterator[pa.RecordBatch]:
    """Links of the buckets of a partition sorted by key; members of an oversized bucket pass through.

    Output rows are links (key null, a < b) or members of an oversized bucket (key, a, b null).
    """
    key = fps = np.empty(0, np.int64)
    over = None  # the key of an oversized bucket that is being passed through

    def rows(a, b, k=None) -> pa.RecordBatch:
        none = pa.nulls(len(a), pa.int64())
        return pa.RecordBatch.from_arrays(
            [none if k is None else pa.array(np.full(len(a), k)), pa.array(a), none if b is None else pa.array(b)],
            names=["key", "a", "b"])

    def links(key: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        cut = np.flatnonzero(np.diff(key)) + 1
        start, stop = np.r_[0, cut], np.r_[cut, len(key)]
        size = stop - start
        two = start[size == 2]
        x, y = fps[two], fps[two + 1]
        near = (np.bitwise_count(np.bitwise_xor(x, y).view(np.uint64)) <= max_bits) & (x != y)
        a, b = [np.minimum(x, y)[near]], [np.maximum(x, y)[near]]
        for s, e in zip(start[size > 2], stop[size > 2], strict=True):
            p, q = _spanning(fps[s:e], max_bits)
            a.append(p)
            b.append(q)
        pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], axis=1), axis=0)
        return rows(pairs[:, 0].copy(), pairs[:, 1].copy())

    for batch in batches:
        k, f = (batch.column(c).to_numpy() for c in ("key", "fp"))
        if over is not None:
            more = k == over
            if more.any():
                yield rows(f[more], None, over)
            k, f = k[~more], f[~more]
        key, fps = np.concatenate([key, k]), np.concatenate([fps, f])
        if not len(key):
            continue
        over = None
        open_ = int(np.searchsorted(key, key[-1]))  # the last bucket may go on in the next batch
        if open_:
            yield links(key[:open_], fps[:open_])
            key, fps = key[open_:], fps[open_:]
        if len(key) > bucket_rows:
            over = key[0]
            yield rows(fps, None, over)
            key = fps = np.empty(0, np.int64)
    if len(key):
        yield links(key, fps)


def links(distinct: DataFrame, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (a < b) that connect all fingerprints of `distinct.fp` at most `max_bits` (<= 4) apart.

    The links of a bucket span it; joined over all buckets they connect exactly what all pairs would.
    """
    if max_bits > MAX_BITS:
        raise ValueError(f"the key scheme covers at most {MAX_BITS} differing bits")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy()
            for at in range(0, len(fps), 8192):
                for key, fp in bucket_keys(fps[at: at + 8192]):
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp)], names=["key", "fp"])

    def search(batches):
        yield from _search(batches, max_bits, bucket_rows)

    keyed = distinct.select("fp").mapInArrow(keys, "key long, fp long")
    found = keyed.repartition("key").sortWithinPartitions("key").mapInArrow(search, "key long, a long, b long")
    found = materialize(found, "simhash-links")
    # Oversized buckets: blocks by hash, every pair of blocks searched by itself.
    members = found.where("key is not null").select("key", F.col("a").alias("fp"))
    size = members.groupBy("key").count()
    blocks = F.ceil(2 * F.col("count") / bucket_rows).cast("int")
    over = (members.join(size.select("key", blocks.alias("blocks")), "key")
            .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
            .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(F.xxhash64("key", F.least("own", "with"), F.greatest("own", "with")).alias("key"), "fp"))

    def search_blocks(batches):
        yield from _search(batches, max_bits, 1 << 62)

    rest = over.repartition("key").sortWithinPartitions("key").mapInArrow(
        search_blocks, "key long, a long, b long")
    return found.where("key is null").select("a", "b").unionByName(rest.select("a", "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node of the links (a, b), the smallest node of its component.

    Alternates two contractions until nothing changes: each node's larger neighbours move to its
    smallest neighbour, then each node's smaller neighbours do. Every round is two aggregates and
    two joins on the links and is written to the shared folder; only a checksum of the links reaches
    the driver. A hot centre is one row of the small side of a join that AQE may split.
    """
    cur = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                      .where("u <> v").distinct(), "components")
    last = None
    while True:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        cur = materialize(small, "components")
        now = tuple(cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == last:
            break
        last = now
    roots = cur.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.join(cur.select(F.col("u").alias("node")), "node", "left_anti"))


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) for every row of `docs`; root is the group's least fingerprint."""
    prints = materialize(fingerprints(docs, id_col, text_col, shingle), "simhash")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    roots = components(links(distinct, max_bits)).select(F.col("node").alias("fp"), "root")
    labelled = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return prints.join(labelled.select("fp", "root").join(ids, "root"), "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id among all texts linked with this one, directly or through
    others (links: fingerprints at most `max_bits` apart). Null and blank texts have fingerprint
    zero and link like others. Rows without an id are grouped too; a group of only such rows has a
    null component_id. Ids are whole numbers. Repeated rows stay repeated. An empty table gives no rows. Other columns are
    not read, so their names can't clash.
    """
    return _grouped(docs, id_col, text_col, shingle, max_bits).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """`docs` with one document of each near-duplicate group: the one with the smallest id.

    Where several rows of a group hold that id, the one with the least text hash stays, and of
    equal rows one. Groups with the same smallest id keep a document each. A row without an id stands for its
    group only if no row of it has one. Ids are whole numbers. The texts are exchanged once, for a
    hashed join with the narrow list of survivors (not sorted).
    """
    text_hash, ident = F.xxhash64(key_column(text_col)), key_column(id_col)
    groups = _grouped(docs, id_col, text_col, shingle, max_bits)
    keep = materialize(groups.where("doc_id <=> component_id").groupBy("root", "doc_id").agg(
        F.min("text_hash").alias("kept_hash"), F.count("*").alias("copies")).withColumnRenamed("doc_id", "kept_id"), "simhash-keep")
    src = docs.select(F.struct(*map(key_column, docs.columns)).alias("row"), ident.cast("long").alias("doc_id"),
                      text_hash.alias("text_hash"))
    kept = src.join(keep.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("kept_id"))
                    & (F.col("text_hash") == F.col("kept_hash")), "inner")
    once = kept.where("copies = 1").select("row.*")
    again = kept.where("copies > 1").groupBy("doc_id", "text_hash", "root").agg(F.min("row").alias("row")).select("row.*")
    return once.unionByName(again)
