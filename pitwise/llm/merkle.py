"""Merkle manifest of a dataset, with an inclusion proof for every row.

A row's leaf is the SHA-256 of its fields, each written as `-` if null, else as its UTF-8 length, `:` and
its value. Leaves are ordered within their group (the lang column) and hashed by runs of `FANOUT` until
one node, the group's subroot, remains; the subroots, ordered by group, are hashed in the same way to
the root. All digests are lowercase hex text.

Slot pivot: one aggregate per level turns the nodes into parents. Conditional aggregates spread the
children of a parent into the columns s0 to s7; the columns put together hash to the parent's digest, and
without a child's own column they are its siblings. So a level is one exchange of digests, combined
before it, and no join is needed to find siblings. Proofs are put together from the root down: a
parent row takes the path of its own parent by a join on a key that at most 64 rows share.

Verification folds a given leaf with its siblings, level by level, up to a root.

Scale: texts are read once, to be hashed; rows of two digests move from there. Leaves are numbered by a
range exchange (`common.numbered`), so a group with a third of all rows is split like any other, and
equal rows are split too. The levels shrink by 8; a path is never moved with a leaf, only with every 64th
of them. The group table is broadcast if proven small, else joined.

Cases: null fields are marked, so null and "-" differ; a null group comes first; null ids come first
within their group; rows with equal ids are ordered by their leaf digest, and rows that are equal in every
field are interchangeable leaves of their own. An empty table has no root and gives no rows. Columns that
aren't named are not read.

Chosen style: DataFrame functions only; hashing and pivoting are JVM expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwise.llm.common import BROADCAST_BYTES, key_column, materialize, numbered

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_SLOTS = [f"s{i}" for i in range(FANOUT)]
_PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts put together (null parts are left out)."""
    return F.sha2(F.concat_ws("", *parts).cast("binary"), 256)


def field(col: Column) -> Column:
    """A field of a leaf: `-` for null, else UTF-8 length, colon, value."""
    text = col.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def _fits(df: DataFrame, row_bytes: Column) -> DataFrame:
    size = df.agg(F.sum(row_bytes).alias("n")).first().n or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def _levels(nodes: DataFrame, extra: Sequence[str], name: str) -> list[DataFrame]:
    """Pivot tables from the leaves up; `nodes` has grp, at (0 to size - 1), size and digest.

    A table holds grp, at (of the parent), size (nodes of the group on the parent's level), digest (of
    the parent) and s0 to s7; the first one has the columns `extra` of the children too, with the slot
    as suffix. Only groups of more than one node are in it.
    """
    tables = []
    most = nodes.agg(F.max("size").alias("n")).first().n or 0
    while most > 1:
        slot, cols = F.col("at") % FANOUT, [("s", "digest")]
        if not tables:
            cols += [(c + "_", c) for c in extra]
        spread = [F.max(F.when(slot == i, F.col(c))).alias(f"{prefix}{i}") for prefix, c in cols for i in range(FANOUT)]
        parents = (nodes.where("size > 1").groupBy("grp", F.floor(F.col("at") / FANOUT).alias("at"))
                   .agg(F.max(F.ceil(F.col("size") / FANOUT)).alias("size"), *spread)
                   .withColumn("digest", digest(*_SLOTS)))
        tables.append(materialize(parents, f"{name}-{len(tables)}"))
        nodes, most = tables[-1].select("grp", "at", "size", "digest"), -(-most // FANOUT)
    return tables


def _siblings(slot: int) -> Column:
    """Siblings of the child in that slot: the other slots, split where the child belongs."""
    return F.struct(F.concat_ws("", *_SLOTS[:slot]).alias("before"), F.concat_ws("", *_SLOTS[slot + 1:]).alias("after"))


def _paths(tables: list[DataFrame], above: DataFrame) -> DataFrame | None:
    """The first pivot table with `path`, the sibling pairs from its parent nodes up to the root.

    `above` has the path of each group's top node (grp, path), null-free.
    """
    tops = above.select(F.col("grp").alias("of"), "path")
    upper = None
    for table in reversed(tables):
        done = table.where("size = 1").join(tops, F.col("grp") == F.col("of")).drop("of")
        if upper is not None:
            higher = upper.select(F.col("grp").alias("of"), F.col("at").alias("of_at"), F.col("path").alias("higher"),
                                  *[F.col(s).alias("up_" + s) for s in _SLOTS])
            rest = (table.where("size > 1")
                    .join(higher, (F.col("grp") == F.col("of")) & (F.floor(F.col("at") / FANOUT) == F.col("of_at"))))
            # The slots of the parent's run are the siblings of this node.
            lift = rest.select(*table.columns, "higher", (F.col("at") % FANOUT).alias("slot"),
                               F.struct(*[F.col("up_" + s).alias(s) for s in _SLOTS]).alias("up"))
            pair = F.element_at(F.array(*[F.struct(
                F.concat_ws("", *[F.col("up")[s] for s in _SLOTS[:i]]).alias("before"),
                F.concat_ws("", *[F.col("up")[s] for s in _SLOTS[i + 1:]]).alias("after")) for i in range(FANOUT)]),
                (F.col("slot") + 1).cast("int"))
            rest = lift.select(*table.columns, F.concat(F.array(pair), "higher").alias("path"))
            done = done.select(*table.columns, "path").unionByName(rest)
        upper = done
    return upper


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf digest and its sibling pairs, lowest level first, lead to."""
    return F.aggregate(path, leaf, lambda node, pair: digest(pair["before"], node, pair["after"]))


def siblings_digest(path: Column) -> Column:
    """SHA-256 of all siblings of a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda p: F.concat(p["before"], p["after"])), ""))


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "lang",
             claims: Column | None = None) -> DataFrame:
    """One row per row of `docs`: id, leaf, subroot, root, path (sibling pairs), claimed leaf.

    `claims` is a leaf digest to be verified against the manifest (null, or no `claims`: the row's own).
    """
    leaf = digest(*[field(key_column(c)) for c in fields])
    leaves = docs.select(key_column(id_col).alias("id"), key_column(group_col).alias("value"), leaf.alias("digest"),
                         (F.lit(None).cast("string") if claims is None else claims).alias("claim"),
                         F.monotonically_increasing_id().alias("row"))
    ranked = numbered(leaves, ["value", "id", "digest", "row"], "merkle-leaves")
    groups = materialize(ranked.groupBy("value").agg(F.min("position").alias("start"), F.count("*").alias("size")), "merkle-groups")
    groups = groups.select(F.col("value").alias("of"), F.col("start").alias("grp"), F.col("size"))  # a start names a group
    nodes = ranked.join(_fits(groups, 40 + F.coalesce(F.octet_length(F.col("of").cast("string")), F.lit(0))),
                        F.col("value").eqNullSafe(F.col("of"))).select(
        "grp", (F.col("position") - F.col("grp")).alias("at"), "size", "digest", "claim", "id")
    nodes = materialize(nodes, "merkle-nodes")
    tables = _levels(nodes, ["id", "claim"], "merkle-level")
    single = nodes.where("size = 1").select("grp", "digest")
    subroots = single
    for table in tables:
        subroots = subroots.unionByName(table.where("size = 1").select("grp", "digest"))
    tops = numbered(subroots, ["grp"], "merkle-subroots")
    tops = tops.select(F.lit(0).cast("long").alias("grp"), F.col("position").alias("at"), F.lit(tops.count()).alias("size"),
                       "digest", F.col("grp").alias("id"))
    upper = _levels(tops, ["id"], "merkle-root")
    if upper:
        end = docs.sparkSession.range(1).select(F.col("id").alias("grp"), F.array().cast(_PATH).alias("path"))
        proved = _children(_paths(upper, end), ["id"])
    else:  # one group or none: its subroot is the root
        proved = tops.select("id", "digest", F.array().cast(_PATH).alias("path"))
    root = (upper[-1] if upper else tops).select("digest").first()  # one row; none for an empty table
    root = F.lit(root.digest if root else None).cast("string")
    above = materialize(proved.select(F.col("id").alias("grp"), F.col("digest").alias("subroot"), "path"), "merkle-tops")
    rows = above.join(nodes.where("size = 1"), "grp").select("grp", "id", "digest", "claim", "path")
    if tables:
        rows = rows.unionByName(_children(_paths(tables, above), ["id", "claim"]).select("grp", "id", "digest", "claim", "path"))
    tip = _fits(above.select(F.col("grp").alias("of"), "subroot"), F.lit(100))
    return (rows.join(tip, F.col("grp") == F.col("of"))
            .select("id", F.col("digest").alias("leaf"), "subroot", root.alias("root"), "path",
                    F.coalesce("claim", "digest").alias("claimed")))


def _children(table: DataFrame, extra: Sequence[str]) -> DataFrame:
    """The children of a first pivot table with `path`: grp, digest, the extra columns, path from the child up."""
    child = [F.struct(F.col(s).alias("digest"), *[F.col(f"{c}_{i}").alias(c) for c in extra], _siblings(i).alias("pair"))
             for i, s in enumerate(_SLOTS)]
    return (table.select("grp", "path", F.explode(F.array(*child)).alias("c")).where("c.digest IS NOT NULL")
            .select("grp", "c.digest", *[f"c.{c}" for c in extra], F.concat(F.array("c.pair"), "path").alias("path")))


def tampered_leaf(docs_fields: Sequence[str] = FIELDS, id_col: str = "doc_id", text_col: str = "text", every: int = 3) -> Column:
    """A trial of the manifest: the leaf with A-Z of the text lowered, for ids whose CRC-32 `every` divides; else null.

    A null id is never tampered with.
    """
    low = F.translate(key_column(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    leaf = digest(*[field(low if c == text_col else key_column(c)) for c in docs_fields])
    return F.when(F.crc32(key_column(id_col).cast("string").cast("binary")) % every == 0, leaf)


def verify(docs: DataFrame) -> DataFrame:
    """Manifest and proofs of `docs`, and the check of tampered rows against them.

    Columns: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.
    """
    rows = manifest(docs, claims=tampered_leaf())
    out = rows.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", siblings_digest(F.col("path")).alias("proof_sha256"),
                      fold(F.col("claimed"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
