"""Mixing sources to target weights.

Sizes are counted in words. The sources, ordered by code point with null last, get weights from a
repeating list. Targets share the budget (a multiple of all sizes) in proportion to the weights; a
target stops at `max_repeat` times its source's size, and what it can't take is shared among the
others by weight, until none is above. This is a water level: target = min(max_repeat * size,
level * weight). The level is found from aggregates over the table of sources.

A source's rate is target / size. Each document is emitted floor(rate) times, plus once more with the
fractional part f as probability. The draw is hash-seeded and stratified by size, as free draws of documents
of very different sizes miss the target widely: a source's documents are put into strata of similar size (length
and first `STRATUM_BITS` bits of the size). From the largest size down, a stratum gives floor(w + u) documents a copy: w are
as many as make up f of its words and of what the strata before have missed, u is hashed from source and stratum. Those are the ones
with the least hashed numbers, seeded and made of id and text. So each document's chance is f, small documents make
up for what large ones miss, and the choice is the same on every rerun and for every partitioning.

Chosen style: DataFrame only. Aggregates by source and stratum are combined before their exchange, so a hot
source costs one row per task; the documents' numbers are ordered by a range exchange (a few dozen bytes a document, no
text). A stratum's limit is a number, so the texts aren't exchanged: documents compare their own number with it. The tables
of sources and strata are broadcast only if their size is proven small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwise.llm.common import BROADCAST_BYTES, key_column, materialize, n_words, numbered, unit_hash

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEAT = 3.0
BUDGET = 1.0
SEED = "mix-1"
STRATUM_BITS = 4


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET,
                   max_repeat: float = MAX_REPEAT) -> DataFrame:
    """(source, source_size, weight, target) from rows of (source, size)."""
    named = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = numbered(named.withColumn("no_name", F.col("source").isNull()), ["no_name", "source"], "mix-sources")
    # The first rows of the weight list go round the sources in their order.
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("position") % len(weights) + 1).cast("int"))
    per = per.select("source", "source_size", weight.cast("double").alias("weight"))
    most = F.col("source_size") * F.lit(float(max_repeat))
    total = per.agg(F.sum("source_size")).first()[0] or 0
    goal, level, below = budget * total, 0.0, -1
    while True:  # each round holds more sources at their limit, so this ends
        full = most <= F.lit(level) * F.col("weight")
        r = per.agg(F.sum(F.when(full, most)).alias("full"), F.count_if(full).alias("n"),
                    F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if r["n"] == below or not r["open"]:
            break
        below, level = r["n"], (goal - (r["full"] or 0.0)) / r["open"]
    return per.withColumn("target", F.least(most, F.lit(level) * F.col("weight")))


def _small(df: DataFrame, key: str) -> DataFrame:
    """`df`, to be broadcast if its rows, counted with the text of `key`, are proven small."""
    size = df.agg(F.sum(64 + F.coalesce(F.octet_length(F.col(key).cast("string")), F.lit(0))).alias("n")).first().n or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def stratum(size: Column) -> Column:
    """Documents of similar size: bits of the size, and the first of them (within 1/8 of each other)."""
    bits = F.bin(size)
    return F.concat(F.length(bits).cast("string"), F.lit(":"), F.substring(bits, 1, STRATUM_BITS))


def drawn_number(doc_id: Column, text: Column, seed: str) -> Column:
    """A document's number: MD5 of seed, id and text (nulls marked)."""
    ident = F.coalesce(doc_id.cast("string"), F.lit("\\N"))
    return F.md5(F.concat(F.lit(seed + ":"), ident, F.lit(":"), F.md5(F.coalesce(text, F.lit("\\N")).cast("binary"))).cast("binary"))


def _limits(rows: DataFrame, targets: DataFrame, seed: str) -> DataFrame:
    """(source, stratum, copies, limit): whole copies, and the number up to which documents get one more (null: none)."""
    strata = rows.groupBy("source", "stratum").agg(F.count("*").alias("n"), F.sum("size").alias("words"), F.min("size").alias("low"))
    # A source has at most some hundred strata, whatever its size: they are one array, largest first.
    each = F.struct(F.col("low").alias("low"), F.col("stratum").alias("stratum"), F.col("n").alias("n"), F.col("words").alias("words"))
    per = _with_target(strata.groupBy("source").agg(F.sort_array(F.collect_list(each), asc=False).alias("strata")), targets)
    per = per.withColumn("rate", F.expr(RATE)).withColumn("f", F.col("rate") - F.floor("rate"))
    name = F.coalesce(F.col("source").cast("string"), F.lit("\\N"))

    def take(state: Column, x: Column) -> Column:
        mean = x["words"].cast("double") / x["n"]
        wanted = F.when(x["words"] > 0, (F.col("f") * x["words"] + state["missing"]) / mean).otherwise(F.col("f") * x["n"])
        u = unit_hash(F.concat(name, F.lit(":"), x["stratum"]), seed)
        more = F.least(F.greatest(F.floor(wanted + u), F.lit(0)), x["n"]).cast("long")
        return F.struct((state["missing"] + F.col("f") * x["words"] - more * mean).alias("missing"),
                        F.array_append(state["taken"], F.struct(x["stratum"].alias("stratum"), more.alias("more"))).alias("taken"))

    none = F.struct(F.lit(0.0).alias("missing"), F.array().cast("array<struct<stratum:string,more:bigint>>").alias("taken"))
    per = per.select("source", "rate", F.explode(F.aggregate("strata", none, take)["taken"]).alias("t")).select(
        "source", "rate", "t.stratum", "t.more")
    order = ["source", "stratum", "number"]
    ranked = numbered(rows.select(*order), order, "mix-numbers")
    first = ranked.groupBy("source", "stratum").agg(F.min("position").alias("first"))
    same = lambda a, b: a["source"].eqNullSafe(b["source"]) & (a["stratum"] == b["stratum"])
    per = materialize(per.join(first, same(per, first)).select(
        per["source"], per["stratum"], F.floor("rate").cast("long").alias("whole"), (F.col("first") + F.col("more")).alias("end")), "mix-ends")
    ends = _small(per.select(F.col("source").alias("of"), F.col("stratum").alias("of_stratum"), "end"), "of")
    last = (ranked.join(ends, F.col("source").eqNullSafe(F.col("of")) & (F.col("stratum") == F.col("of_stratum")))
            .where("position < end").groupBy("of", "of_stratum").agg(F.max("number").alias("limit")))
    out = per.join(last, per["source"].eqNullSafe(last["of"]) & (per["stratum"] == last["of_stratum"]), "left")
    return materialize(out.select("source", "stratum", "whole", "limit"), "mix-limits")


def _with_target(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """`rows` (with a column source) with their source's size and target joined on."""
    targets = _small(targets.select(F.col("source").alias("mix_source"), "source_size", "target"), "mix_source")
    return rows.join(targets, F.col("source").eqNullSafe(F.col("mix_source"))).drop("mix_source")


def _with_copies(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """`rows` (source, stratum, number) with their number of copies."""
    limits = _small(limits.select(F.col("source").alias("mix_source"), F.col("stratum").alias("mix_stratum"), "whole", "limit"), "mix_source")
    more = F.coalesce((F.col("number") <= F.col("limit")).cast("int"), F.lit(0))
    return (rows.join(limits, F.col("source").eqNullSafe(F.col("mix_source")) & (F.col("stratum") == F.col("mix_stratum")))
            .withColumn("copies", (F.col("whole") + more).cast("long")).drop("mix_source", "mix_stratum", "whole", "limit"))


RATE = "CASE WHEN source_size > 0 THEN target / source_size ELSE 0D END"


def _measured(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> list[Column]:
    size = n_words(key_column(text_col))
    return [key_column(source_col).alias("source"), size.alias("size"), stratum(size).alias("stratum"),
            drawn_number(key_column(id_col), key_column(text_col), seed).alias("number")]


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         seed: str = SEED, **shares) -> DataFrame:
    """One row per row of `docs`: doc_id, size, source_size, target, taken, copies.

    Null and blank texts have size 0 and are never counted against a target (they are emitted at
    their source's rate). A null source is a source of its own. Rows with the same source, id and text have one
    number, so they are taken alike. An empty table gives no rows.
    """
    rows = materialize(docs.select(key_column(id_col).alias("doc_id"), *_measured(docs, id_col, text_col, source_col, seed)), "mix-sizes")
    targets = materialize(source_targets(rows, **shares), "mix-targets")
    rated = _with_target(_with_copies(rows, _limits(rows, targets, seed)), targets)
    return rated.select("doc_id", "size", "source_size", "target",
                        (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: str = SEED, **shares) -> DataFrame:
    """`docs` with every document repeated as the plan says (0 to max_repeat times).

    All columns are kept, whatever their names. Cases are defined as for `plan`.
    """
    measured = _measured(docs, id_col, text_col, source_col, seed)
    rows = materialize(docs.select(*measured), "mix-sizes")
    targets = materialize(source_targets(rows, **shares), "mix-targets")
    src = docs.select(F.struct(*map(key_column, docs.columns)).alias("row"), *measured)
    rated = _with_copies(src, _limits(rows, targets, seed))
    return (rated.where("copies > 0")
            .select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy")).select("row.*"))
