"""K-d tree sharding: near-equal bytes by recursive weighted medians over document metadata.

A point has four dimensions: log of its size, source, language (as codes of their hashes) and id, each scaled
to the table's range. All documents of one text are one point, with the least source, language and id of them,
so copies come into one shard. Only copies that hold more than `HEAVY` of a shard's bytes, and more than the largest
document, are cut: into pieces of about that by a hash of the row. A node of several shards is split along the dimension on which its points
lie widest, where the given share of its bytes is reached (the weighted median, or a third where three shards are
left), until every leaf holds the target bytes.

All nodes of a level are split together. A cut is found by histograms: bytes are summed in up to
4,096 equal ranges of each node, the range that holds the wanted share is cut into ranges again, and
so on, until it weighs next to nothing or holds one value. Points with equal coordinates are
ordered by the hash of their text, then by their piece. The tree, at most one cut per shard, is the only
thing that reaches the driver; it comes back as one CASE expression. Documents take the shard of their point by a join on
the text's hash and piece, of narrow rows.

Native: DataFrame functions only. Histograms are combined before their exchange, the texts are read
once, and the slot numbers come from one range exchange of narrow rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwise.llm.common import BROADCAST_BYTES, key_column, materialize, numbered

SHARDS = 24
BINS = 4096
GRID = 1 << 19  # steps of a dimension's range
CODE = 1 << 43  # below a grid step: 32 bits of the text's hash, 11 bits of the piece
HEAVY = 0.02  # of a shard's bytes: copies of one text that hold more, and more than the largest text, are cut
TOLERANCE = 0.0005  # of a shard's bytes: a range that light is not cut further
EXTRA_BYTES = 8
DIMENSIONS = ("size", "source", "lang", "doc_id")


def _points(docs: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str) -> DataFrame:
    """Narrow rows: doc_id, size, text_crc32, row_id, text_hash, and x1..x3 before scaling.

    A text id lies where its number does, or, if it is none, where its hash does.
    """
    text = F.coalesce(key_column(text_col), F.lit("")).cast("binary")

    def code(name: str) -> Column:
        return F.coalesce(F.crc32(key_column(name).cast("string").cast("binary")).cast("double"), F.lit(-1.0))

    return docs.select(
        key_column(id_col).alias("doc_id"), (F.octet_length(text) + EXTRA_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("text_hash"), code(source_col).alias("x1"),
        code(lang_col).alias("x2"), F.coalesce(key_column(id_col).cast("string").try_cast("double"), code(id_col)).alias("x3"),
        F.monotonically_increasing_id().alias("row_id"))


def _pieces(rows: DataFrame, most: float) -> DataFrame:
    """`rows` with `piece`: 0, or for texts whose copies hold more than `most` bytes one of so many pieces, by the row's hash."""
    heavy = (rows.groupBy("text_hash").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > most)
             .select(F.col("text_hash").alias("heavy"), F.ceil(F.col("bytes") / most).alias("pieces")))
    heavy = materialize(heavy, "shard-heavy")  # at most the total over `most`
    heavy = F.broadcast(heavy) if heavy.count() <= BROADCAST_BYTES // 64 else heavy
    piece = F.when(F.col("pieces").isNotNull(), F.pmod(F.xxhash64("doc_id", "row_id"), F.col("pieces"))).otherwise(0)
    return rows.join(heavy, rows.text_hash == heavy.heavy, "left").withColumn("piece", piece).drop("heavy", "pieces")


def _scaled(points: DataFrame) -> DataFrame:
    """x0..x3 replaced by c0..c3: grid step of the table's range, then the text's hash and the piece."""
    ends = points.agg(*[f(f"x{i}").alias(f"{f.__name__}{i}") for i in range(4) for f in (F.min, F.max)]).first()
    tie = F.col("text_crc32") * 2048 + F.pmod(F.col("piece"), F.lit(2048))

    def coordinate(i: int) -> Column:
        low, high = ends[f"min{i}"] or 0.0, ends[f"max{i}"] or 0.0
        step = (F.col(f"x{i}") - low) * ((GRID - 1) / (high - low) if high > low else 0.0)
        return (F.floor(step).cast("long") * CODE + tie).alias(f"c{i}")

    return points.select("text_hash", "piece", "size", *[coordinate(i) for i in range(4)])


class _Node:
    """A range of shards; `dim` and `cut` once it is split: coordinate < cut goes left."""

    def __init__(self, first: int, shards: int):
        self.first, self.shards = first, shards
        self.dim = self.cut = self.left = self.right = None

    def split(self, dim: int, cut: int) -> list[_Node]:
        half = self.shards // 2
        self.dim, self.cut = dim, cut
        self.left, self.right = _Node(self.first, half), _Node(self.first + half, self.shards - half)
        return [n for n in (self.left, self.right) if n.shards > 1]

    def leaf(self) -> Column:
        """The first shard of the deepest node a row falls into."""
        if self.cut is None:
            return F.lit(self.first)
        return F.when(F.col(f"c{self.dim}") < F.lit(self.cut), self.left.leaf()).otherwise(self.right.leaf())


def _case(value: Column, by: dict) -> Column:
    """by[value], or null."""
    out = None
    for k, v in by.items():
        hit = value == k
        out = F.when(hit, v) if out is None else out.when(hit, v)
    return out


def _cuts(rows: DataFrame, nodes: list[_Node], light: float) -> list[tuple[int, int]]:
    """(dimension, cut) of every node: the widest dimension, and where its left shards' bytes are reached."""
    by = {n.first: n for n in nodes}
    node = F.col("node")
    rows = rows.where(node.isin(*by))
    ends = {r["node"]: r for r in rows.groupBy("node").agg(
        F.sum("size").alias("bytes"),
        *[f(f"c{i}").alias(f"{f.__name__}{i}") for i in range(4) for f in (F.min, F.max)]).collect()}
    dim, low, high, want, cut = {}, {}, {}, {}, {}
    for k, n in by.items():
        if k not in ends:  # no rows: any cut will do
            dim[k], cut[k] = 0, 0
            continue
        e = ends[k]
        dim[k] = max(range(4), key=lambda i: e[f"max{i}"] // CODE - e[f"min{i}"] // CODE)
        low[k], high[k] = e[f"min{dim[k]}"], e[f"max{dim[k]}"] + 1
        want[k] = e["bytes"] * (n.shards // 2) / n.shards
    while open_ := [k for k in by if k not in cut]:
        width = {k: -(-(high[k] - low[k]) // BINS) for k in open_}
        at = _case(node, {k: F.col(f"c{dim[k]}") for k in open_})
        start, wide = (_case(node, {k: F.lit(v[k]) for k in open_}) for v in (low, width))
        inside = rows.where(node.isin(*open_)).withColumn("at", at).withColumn("start", start).where(
            (F.col("at") >= F.col("start")) & (F.col("at") < _case(node, {k: F.lit(high[k]) for k in open_})))
        bins = (inside.withColumn("wide", wide).withColumn("bin", F.expr("(at - start) div wide"))
                .groupBy("node", "bin").agg(F.sum("size").alias("bytes")))
        upto = F.sum("bytes").over(Window.partitionBy("node").orderBy("bin"))
        need = _case(node, {k: F.lit(float(want[k])) for k in open_})
        found = {r["node"]: r for r in bins.withColumn("upto", upto).where(F.col("upto") >= need)
                 .groupBy("node").agg(F.min_by(F.struct("bin", "bytes", "upto"), "bin").alias("r"))
                 .select("node", "r.*").collect()}
        for k in open_:
            r = found[k]
            left = low[k] + r["bin"] * width[k]
            before = r["upto"] - r["bytes"]
            if width[k] == 1 or r["bytes"] <= light:
                cut[k] = left if want[k] - before < r["upto"] - want[k] else min(left + width[k], high[k])
            else:
                want[k], low[k], high[k] = want[k] - before, left, min(left + width[k], high[k])
    return [(dim[n.first], cut[n.first]) for n in nodes]


def kd_shards(docs: DataFrame, shards: int | None = SHARDS, target_bytes: int | None = None, id_col: str = "doc_id",
              text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """One row per row of `docs`: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    `target_bytes`, if given, sets the number of shards (bytes of all documents over it, rounded up).
    size is the UTF-8 bytes of the text plus 8. law is `bytes`: shard sizes are near equal, and
    grown_shard is null. Slots number the rows of a shard from 0 without gaps, by id. A null text
    counts as empty; null ids, sources and languages are values of their own, before all others.
    Documents of one text are in one shard, unless they hold more than HEAVY of a shard's bytes (and than the largest text). Repeated rows are placed one by one. An empty table gives no rows. Other columns are not read.
    """
    points = materialize(_points(docs, id_col, text_col, source_col, lang_col), "shard-points")
    total, largest = points.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("size"), F.lit(1))).first()
    if target_bytes is not None:
        shards = max(1, math.ceil(total / target_bytes))
    rows = materialize(_pieces(points, max(float(largest), HEAVY * total / shards)), "shard-rows")
    cells = rows.groupBy("text_hash", "piece").agg(
        F.sum("size").alias("size"), F.min("text_crc32").alias("text_crc32"), F.log2(F.min("size")).alias("x0"),
        *[F.min(f"x{i}").alias(f"x{i}") for i in (1, 2, 3)])
    cells, light = materialize(_scaled(materialize(cells, "shard-cells")), "shard-scaled"), TOLERANCE * total / shards
    root = _Node(0, shards)
    level = [root] if shards > 1 else []
    while level:
        cuts = _cuts(cells.withColumn("node", root.leaf()), level, light)
        level = [child for n, (dim, cut) in zip(level, cuts, strict=True) for child in n.split(dim, cut)]
    homes = cells.select("text_hash", "piece", root.leaf().cast("int").alias("shard"))
    placed = rows.join(homes, ["text_hash", "piece"]).select("shard", "doc_id", "size", "text_crc32", "row_id")
    placed = numbered(placed, ["shard", "doc_id", "text_crc32", "row_id"], "shard-slots")
    first = placed.groupBy("shard").agg(F.min("position").alias("first"))  # one row a shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("position") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
