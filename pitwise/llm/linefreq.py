"""Quality rules by cross-document line frequency.

Lines are normalised (words joined by one space, A-Z lowered, runs of digits as 0) and hashed. For
every host (the source column) the distinct documents that hold a line are counted; exact copies of
a text are one document. A line in more than max(`min_docs`, `max_share` of the host's distinct
documents) of them is boilerplate and is removed. A document that keeps less than `min_left` of its
words is depleted and rejected, as are documents that fail the base rules (under 10 words, or more
than 20 % of the words in five-word windows that repeat).

Scale: a text is read once. Its line hashes and measures are written, about ten numbers a document;
everything after that works on them. Counts are combined before each exchange, so a hot line or
host costs a task one row. The boilerplate lines are joined back by hash.

Chosen style: numpy in Arrow batches for the measures of a text (one pass over its bytes), Spark for
counts and joins.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwise.llm.common import arrow_map, bounded, key_column, materialize

MIN_DOCS = 10
MAX_SHARE = 0.01
MIN_LEFT = 0.3
WINDOW = 5
SYMBOLS = b"#*$%&|<>"

_DIGITS = re.compile(rb"[0-9]+")
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def repeat_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words that lie in a window of `size` words found twice or more in the text."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    word = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.uint64, count=len(words))
    mixed = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            mixed = (mixed ^ word[i: i + n]) * _PRIME
            mixed ^= mixed >> np.uint64(31)
    ordered = np.sort(mixed)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return 0
    # Equal hashes are few: compare the words themselves.
    seen: dict[tuple, list[int]] = {}
    for i in np.flatnonzero(np.isin(mixed, again)).tolist():
        seen.setdefault(tuple(words[i: i + size]), []).append(i)
    covered = np.zeros(len(words), dtype=bool)
    for places in seen.values():
        if len(places) > 1:
            for i in places:
                covered[i: i + size] = True
    return int(covered.sum())


def normal_line(line: bytes) -> bytes:
    return _DIGITS.sub(b"0", b" ".join(line.lower().split()))


def measures(text: bytes | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and per line: hash (0 without a word), words."""
    text = text or b""
    raw = np.frombuffer(text, np.uint8)
    words = text.split()
    chars = int(((raw & 0xC0 != 0x80) & ~_SPACE[raw]).sum())
    lines = text.split(b"\n")
    seen, dup, hashes, sizes = set(), 0, [], []
    for line in lines:
        normal = normal_line(line)
        if normal:
            dup += line in seen
            seen.add(line)
        hashes.append(xxhash.xxh64_intdigest(normal) - (1 << 63) if normal else 0)
        sizes.append(normal.count(b" ") + 1 if normal else 0)
    return len(words), chars, int(_SYMBOL[raw].sum()), dup, repeat_words(words), hashes, sizes


_NUMBERS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _measured(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    src = docs.select(key_column(id_col).alias("doc_id"), key_column(host_col).cast("string").alias("host"),
                      F.xxhash64(key_column(text_col)).alias("text_hash"),
                      key_column(text_col).cast("binary").alias("text"))

    def run(batch: pa.RecordBatch) -> dict:
        rows = [measures(t.as_py()) for t in batch.column("text")]
        out = {c: batch.column(c) for c in ("doc_id", "host", "text_hash")}
        for i, name in enumerate(_NUMBERS):
            out[name] = pa.array([r[i] for r in rows], pa.int64())
        out["lines"] = pa.array([r[5] for r in rows], pa.list_(pa.int64()))
        out["line_words"] = pa.array([r[6] for r in rows], pa.list_(pa.int64()))
        return out

    kind = src.schema["doc_id"].dataType.simpleString()
    measured = arrow_map(src, run, f"doc_id {kind}, host string, text_hash long, {' long, '.join(_NUMBERS)} long, "
                                   "lines array<long>, line_words array<long>")
    # The number of a row is written with it, so it is the same for every later reader.
    return materialize(measured.withColumn("row_id", F.monotonically_increasing_id()), "line-measures")


def _boilerplate(measured: DataFrame, min_docs: int, max_share: float) -> DataFrame:
    """(host, line) above the limit of its host."""
    lines = (measured.select("host", "text_hash", F.explode("lines").alias("line")).where("line <> 0").distinct()
             .groupBy("host", "line").agg(F.count("*").alias("docs")).where(F.col("docs") > min_docs))
    hosts = measured.select("host", "text_hash").distinct().groupBy("host").agg(F.count("*").alias("host_docs"))
    hosts = hosts.withColumnRenamed("host", "of_host")
    if bounded(hosts, 50_000, 512):
        hosts = F.broadcast(hosts)
    return (lines.join(hosts, F.col("host").eqNullSafe(F.col("of_host")))
            .where(F.col("docs") > max_share * F.col("host_docs")).select("host", "line"))


def _judged(docs: DataFrame, id_col: str, text_col: str, host_col: str, min_docs: int, max_share: float,
            min_left: float) -> DataFrame:
    measured = _measured(docs, id_col, text_col, host_col)
    lines = materialize(_boilerplate(measured, min_docs, max_share), "line-boilerplate").select(
        F.col("host").alias("of_host"), F.col("line").alias("of_line"))
    if bounded(lines, 200_000, 128):
        lines = F.broadcast(lines)
    each = measured.select("row_id", "host", F.posexplode(F.arrays_zip("lines", "line_words")).alias("at", "l")).select(
        "row_id", "host", "at", F.col("l.lines").alias("line"), F.col("l.line_words").alias("words")).where("line <> 0")
    same = (F.col("line") == F.col("of_line")) & F.col("host").eqNullSafe(F.col("of_host"))
    removed = (each.join(lines, same).groupBy("row_id")
               .agg(F.sum("words").alias("removed_words"), F.collect_list("at").alias("removed_lines")))
    out = measured.join(removed, "row_id", "left").withColumn("removed_words", F.coalesce("removed_words", F.lit(0)))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    left = F.col("n_words") - F.col("removed_words") >= min_left * F.col("n_words")
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & left)


def line_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
               min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, min_left: float = MIN_LEFT) -> DataFrame:
    """One row per row of `docs`: doc_id, the base measures, base_failed, kept, removed_words.

    A null text has no words and fails; a null host is a host of its own; null and repeated ids are
    rows of their own. Lines without a word are never counted. An empty table gives no rows; other
    columns are not read.
    """
    return _judged(docs, id_col, text_col, host_col, min_docs, max_share, min_left).select(
        "doc_id", *_NUMBERS, "base_failed", "kept", "removed_words")


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", **limits) -> DataFrame:
    """(doc_id, text without the boilerplate lines) of the documents that are kept, one row for each."""
    limits = {"min_docs": MIN_DOCS, "max_share": MAX_SHARE, "min_left": MIN_LEFT} | limits
    judged = _judged(docs, id_col, text_col, host_col, **limits)
    texts = docs.select(F.xxhash64(key_column(text_col)).alias("text_hash"), key_column(host_col).cast("string").alias("of"),
                        key_column(text_col).alias("text")).groupBy("text_hash", "of").agg(F.min("text").alias("text"))
    verdict = judged.where("kept").select("doc_id", "host", "text_hash", "removed_lines")
    gone = F.coalesce("removed_lines", F.array().cast("array<int>"))
    left = F.filter(F.split("text", "\n", -1), lambda _, i: ~F.array_contains(F.col("gone"), i))
    return (verdict.withColumn("gone", gone).join(texts, (verdict.text_hash == texts.text_hash)
                                                  & verdict.host.eqNullSafe(texts.of))
            .select("doc_id", F.array_join(left, "\n").alias("text")))
