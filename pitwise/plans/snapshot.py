"""Build a frozen training snapshot from the live tables.

    matrix  -> Parquet under a fresh object id             (executors write)
            -> stats, cut points, fingerprint on the written files (lineage cut)
            -> manifest (recipe, counts, split, columns, sha256) under stamp and hash, written last

Nothing passes through the driver except the one-row manifest. `dry_run=True`
computes the manifest from the lazy matrix and writes nothing.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwise.operators import labels as L
from pitwise.operators.fingerprint import content_fingerprint
from pitwise.operators.splits import cut_points
from pitwise.session import materialize
from pitwise.plans.matrix import ID_COLUMNS, LABEL_COLUMN, feature_matrix
from pitwise.sources import snapshots as S

DATASET = "card_fraud"
GRANULARITY = "weekly"


def dataset_stats(df: DataFrame, label: str = LABEL_COLUMN) -> DataFrame:
    """One row: rows, positives, fraud_rate (0.0 on an empty frame)."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(label), F.lit(0)).cast("long").alias("positives")) \
        .withColumn("fraud_rate", F.round(F.coalesce(
            F.try_divide(F.col("positives").cast("double"), F.col("rows").cast("double")), F.lit(0.0)), 6))


def _ts_text(c):
    return F.date_format(F.col(c).cast("timestamp"), "yyyy-MM-dd HH:mm:ss")


def manifest_frame(spark: SparkSession, data: DataFrame, tx: DataFrame, snapshot_id: str, dataset: str, maturity_days: int,
                   source: str, approx_quantiles: bool = False, sha256: str | None = None, data_path: str | None = None) -> DataFrame:
    """The one-row manifest, computed with three small aggregates over `data` (two if its fingerprint is given)."""
    features = [c for c in data.columns if c not in (*ID_COLUMNS, LABEL_COLUMN)]
    stats = dataset_stats(data)
    cuts = cut_points(data, approx=approx_quantiles).select(
        F.col("train_end").cast("string").alias("train_end"), F.col("val_end").cast("string").alias("val_end"))
    fp = content_fingerprint(data).select("sha256") if sha256 is None else spark.range(1).select(F.lit(sha256).alias("sha256"))
    bounds = L.snapshot_bounds(tx, maturity_days).select(
        _ts_text("now_ts").alias("now_ts"), _ts_text("tx_cutoff").alias("transaction_cutoff"))
    one = stats.crossJoin(cuts).crossJoin(fp).crossJoin(bounds)  # 1 x 1 x 1 x 1 rows
    created = datetime.now(timezone.utc).isoformat().replace("+00:00", "Z")
    return one.select(
        F.lit(snapshot_id).alias("snapshot_id"), F.lit(dataset).alias("dataset_name"),
        F.lit(created).alias("created_utc"), F.lit(source).alias("source"),
        F.lit("pitwise.plans.matrix.feature_matrix").alias("plan"),
        F.struct(F.col("now_ts"), F.col("transaction_cutoff"),
                 F.lit(int(maturity_days)).alias("maturity_window_days"),
                 F.lit(GRANULARITY).alias("merchant_rate_granularity")).alias("recipe"),
        "rows", "positives", "fraud_rate",
        F.struct("train_end", "val_end").alias("split"),
        F.array(*[F.lit(c) for c in features]).alias("feature_columns"),
        F.lit(LABEL_COLUMN).alias("label_column"), "sha256",
        F.lit("approximate" if approx_quantiles else "exact").alias("quantiles"),
        F.lit(data_path).cast("string").alias("data_path"),
    )


def publish(spark: SparkSession, matrix: DataFrame, tx: DataFrame, root: str, dataset: str = DATASET,
            maturity_days: int = L.MATURITY_DAYS, source: str = "tables", now: datetime | None = None,
            snapshot_id: str | None = None):
    """Write `matrix` and publish it: (snapshot id, manifest DataFrame, data DataFrame).

    The id is the stamp of `now` and the content's hash, unless it is given. Content that is already published
    is not kept twice. May be called again after any failure.
    """
    path = S.write_data(matrix, root, dataset, snapshot_id or S.new_object_id())
    sha = content_fingerprint(spark.read.parquet(path)).first()["sha256"]  # of the frozen files, not the live tables
    kept = S.find_content(spark, root, dataset, sha)
    if kept is not None:
        S.drop_object(spark, path)
        path = f"{S.dataset_dir(root, dataset)}/{kept}"
    data = spark.read.parquet(path)
    snapshot_id = snapshot_id or S.snapshot_id_of(S.utc_stamp(now), sha)
    man = manifest_frame(spark, data, tx, snapshot_id, dataset, maturity_days, source, sha256=sha,
                         data_path="objects/" + path.rsplit("/", 1)[1])
    return snapshot_id, spark.read.schema(S.MANIFEST_SCHEMA).json(S.write_manifest(man, root, dataset, snapshot_id)), data


def build_snapshot(spark: SparkSession, tx: DataFrame, labels: DataFrame, merchants: DataFrame, root: str,
                   dataset: str = DATASET, maturity_days: int = L.MATURITY_DAYS, source: str = "tables",
                   dry_run: bool = False, snapshot_id: str | None = None):
    """Returns (snapshot_id, manifest DataFrame, data DataFrame)."""
    matrix = feature_matrix(tx, labels, merchants, maturity_days)
    if not dry_run:
        return publish(spark, matrix, tx, root, dataset, maturity_days, source, snapshot_id=snapshot_id)
    data = materialize(matrix, "snapshot-dry-run")  # every statistic reads this one copy
    sha = content_fingerprint(data).first()["sha256"]
    snapshot_id = snapshot_id or S.snapshot_id_of(S.utc_stamp(), sha)
    return snapshot_id, manifest_frame(spark, data, tx, snapshot_id, dataset, maturity_days, source, sha256=sha), data
