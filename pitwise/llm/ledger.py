"""Secret scans with an incremental ledger of blobs.

Every version of every path is addressed by its content (SHA-256 of the UTF-8 text). The ledger
records which (blob, rule version) pairs have been scanned and what was found there. An update scans
only the pairs that the ledger lacks, whatever the number of paths and versions that hold a blob, and
`findings` joins what is known of a blob back to all of them. A rule whose version is raised is
scanned again over all blobs, the other rules are not.

The ledger is a folder of generations. An update writes one Parquet table, and a generation counts
once its `_SUCCESS` file is there, so an update that was killed leaves nothing behind that is read.
A row holds a blob's digest, the pairs scanned and their spans. Two updates at the same time may
both scan a pair; reading takes each span once.

Scale: texts of pairs to scan are thinned to one a blob within each task, then dealt by digest, so a
text with a third of all rows moves once a task. Digests alone decide what is unseen. The findings
are joined to the paths by digest: broadcast if proven small, else a join that Spark splits if skewed.

Cases: a null text is an empty one (no findings); null and repeated paths are rows of their own; an
empty table scans nothing and gives no rows; columns that aren't named are not read. Bytes that are
no UTF-8 count as one replacement character each.

Chosen style: Arrow batches with compiled patterns, as Spark's expressions give no positions; Spark for
addressing, joins and the ledger.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwise.llm.common import BROADCAST_BYTES, key_column, materialize
from pitwise.session import new_scratch


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern`, leftmost and non-overlapping, whose `group` has `least` characters or more.

    A text without any of the `hints` (lower case, compared to the text in lower case) has no match.
    """

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    hints: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# Base rules (the order is that of the report), then well-known token formats.
BASE_KINDS = ("assign", "access", "hex")
RULES = (
    Rule("assign", 1, r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=2, least=8, hints=("password", "passwd", "secret", "token", "apikey", "api_key")),
    Rule("access", 1, r"AKIA[A-Z0-9]+", least=16, hints=("akia",)),
    Rule("hex", 1, r"[0-9a-f]{32,}"),
    Rule("private_key", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", hints=("private key-----",)),
    Rule("forge_token", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", hints=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("chat_token", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}", hints=("xox",)),
    Rule("web_token", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hints=("eyj",)),
    Rule("url_login", 1, r"[a-z][a-z0-9+.-]{0,15}://[A-Za-z0-9._%+-]+:[A-Za-z0-9._%+-]{4,}@", hints=("://",)),
)

_SCANNED = "blob string, scanned array<string>, findings array<struct<rule:string,kind:string,start:long,stop:long>>"


def blob_id(text: Column) -> Column:
    """Content address of a text: lowercase hex SHA-256 of its UTF-8 bytes (null: of none)."""
    return F.sha2(F.coalesce(text.cast("binary"), F.lit(b"")), 256)


def spans(text: str, rules: Sequence[Rule]) -> list[tuple[str, str, int, int]]:
    """(rule name, kind, start, end) of every finding, in code points, end exclusive."""
    out, low = [], text.lower() if any(r.hints for r in rules) else ""
    for rule in rules:
        if rule.hints and not any(h in low for h in rule.hints):
            continue
        for m in re.finditer(rule.pattern, text):  # compiled patterns are cached by `re`
            if len(m[rule.group]) >= rule.least:
                out.append((rule.name, rule.kind, m.start(), m.end()))
    return out


def _firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each blob in a task's rows (a digest a row is remembered)."""
    seen: set[bytes] = set()
    for batch in batches:
        keep = []
        for i, blob in enumerate(batch.column("blob").to_pylist()):
            key = bytes.fromhex(blob)
            if key not in seen:
                seen.add(key)
                keep.append(i)
        if keep:
            yield batch.take(pa.array(keep))


def _scan(rules: Sequence[Rule]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("rule", pa.string()), ("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
        for batch in _firsts(batches):
            found, scanned = [], batch.column("pending")
            for text, names in zip(batch.column("text"), scanned.to_pylist()):
                wanted = set(names)
                hits = spans((text.as_py() or b"").decode("utf-8", "replace"), [r for r in rules if r.name in wanted])
                found.append([dict(zip(("rule", "kind", "start", "stop"), h)) for h in hits])
            yield pa.RecordBatch.from_arrays([batch.column("blob"), scanned, pa.array(found, kind)],
                                             names=["blob", "scanned", "findings"])
    return run


def generations(spark: SparkSession, ledger_dir: str) -> list[str]:
    """Finished generations of a ledger."""
    root = spark._jvm.org.apache.hadoop.fs.Path(ledger_dir)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = [s.getPath().toString() for s in fs.listStatus(root)]
    return sorted(p for p in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p + "/_SUCCESS")))


def read(spark: SparkSession, ledger_dir: str) -> DataFrame:
    """(blob, scanned, findings) of all finished generations; empty for a new ledger."""
    found = generations(spark, ledger_dir)
    return spark.read.schema(_SCANNED).parquet(*found) if found else spark.createDataFrame([], _SCANNED)


def _broadcast_if_small(df: DataFrame, row_bytes: Column) -> DataFrame:
    size = df.agg(F.sum(row_bytes).alias("n")).first().n or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def unseen(versions: DataFrame, ledger_dir: str, rules: Sequence[Rule] = RULES, text_col: str = "text") -> DataFrame:
    """(blob, pending): the blobs of `versions` that lack rules in the ledger, with the names of those rules."""
    wanted = F.array(*[F.lit(r.name) for r in rules])
    blobs = versions.select(blob_id(key_column(text_col)).alias("blob")).distinct()
    known = (read(versions.sparkSession, ledger_dir).groupBy("blob")
             .agg(F.array_distinct(F.flatten(F.collect_set("scanned"))).alias("scanned")))
    pending = F.array_except(wanted, F.coalesce("scanned", F.array().cast("array<string>")))
    return blobs.join(known, "blob", "left").select("blob", pending.alias("pending")).where(F.size("pending") > 0)


def update(versions: DataFrame, ledger_dir: str, rules: Sequence[Rule] = RULES, text_col: str = "text") -> str | None:
    """Scan what the ledger lacks of `versions` (any number of paths and versions, a text each) and record it.

    Returns the path of the generation written, None if nothing was unseen.
    """
    spark = versions.sparkSession
    texts = versions.select(blob_id(key_column(text_col)).alias("blob"), key_column(text_col).cast("binary").alias("text"))
    if generations(spark, ledger_dir):
        todo = materialize(unseen(versions, ledger_dir, rules, text_col), "ledger-unseen")
        if todo.isEmpty():
            return None
        texts = texts.join(_broadcast_if_small(todo, F.lit(200)), "blob")
    else:  # a new ledger knows no blob, so no digests need comparing
        texts = texts.withColumn("pending", F.array(*[F.lit(r.name) for r in rules]))
    texts = texts.select("blob", "pending", "text")
    path = f"{ledger_dir.rstrip('/')}/generation-{uuid.uuid4().hex[:12]}"
    each = texts.mapInArrow(_firsts, texts.schema).repartition("blob")
    each.mapInArrow(_scan(tuple(rules)), _SCANNED).write.parquet(path)
    return path


def findings(spark: SparkSession, ledger_dir: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(blob, findings) of the blobs in which the given rule versions have found something.

    Findings are distinct and ordered by start, then by the order of `rules`.
    """
    place = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.name), F.lit(i))])
    known = read(spark, ledger_dir).where(F.size("findings") > 0).groupBy("blob").agg(
        F.flatten(F.collect_list("findings")).alias("all"))
    current = F.filter("all", lambda f: f["rule"].isin([r.name for r in rules]))
    ordered = F.array_sort(F.array_distinct(F.transform(current, lambda f: F.struct(
        f["start"].alias("start"), F.element_at(place, f["rule"]).alias("place"), f["stop"].alias("stop"),
        f["kind"].alias("kind")))))
    return known.select("blob", ordered.alias("findings")).where(F.size("findings") > 0)


def joined(found: Column) -> Column:
    """Findings as kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda f: F.concat_ws(":", f["kind"], f["start"], f["stop"])), ",")


def report(versions: DataFrame, ledger_dir: str, rules: Sequence[Rule] = RULES, path_cols: Sequence[str] = ("doc_id",),
           text_col: str = "text") -> DataFrame:
    """One row per row of `versions`: its path columns, blob, findings (array, empty if none) from the ledger."""
    known = findings(versions.sparkSession, ledger_dir, rules).withColumnRenamed("blob", "of_blob")
    known = _broadcast_if_small(known, F.lit(120) + 48 * F.size("findings"))
    rows = versions.select(*[key_column(c) for c in path_cols], blob_id(key_column(text_col)).alias("blob"))
    none = F.array().cast("array<struct<start:long,place:int,stop:long,kind:string>>")
    return (rows.join(known, rows.blob == known.of_blob, "left").drop("of_blob")
            .withColumn("findings", F.coalesce("findings", none)))


def secrets(docs: DataFrame, rules: Sequence[Rule] = RULES, ledger_dir: str | None = None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Bring the ledger up to date with `docs` and report each row: id, counts and digest of the base kinds, all spans.

    Without `ledger_dir` a new ledger is started in the shared folder.
    """
    ledger_dir = ledger_dir or new_scratch(docs.sparkSession, "secret-ledger")
    update(docs, ledger_dir, rules, text_col)
    rows = report(docs.select(key_column(id_col).alias("doc_id"), key_column(text_col).alias("text")), ledger_dir, rules)
    base = F.filter("findings", lambda f: f["kind"].isin(*BASE_KINDS))
    kinds = F.transform("findings", lambda f: f["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return rows.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                       joined(F.col("findings")).alias("spans"), "blob")
