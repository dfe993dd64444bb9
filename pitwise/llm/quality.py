"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are looked up in a learned embedding. Chunks of 16 bytes, each overlapping the next by 8, cover
the whole text. Every learned filter is applied to every chunk (two matrix products, one for each
half of a chunk), rectified, and max-pooled over the text. A small hidden layer combines the
pooled values into one probability.

Training uses a bounded sample of labelled rows (`max_docs`, half of each class where there are
enough, chosen by a hash of the id; documents above `max_doc_bytes` are not sampled) in one task,
which returns the parameters, about 70 kB. Scoring is one local pass over every whole text: texts
stream through in pieces, so memory does not grow with their length.

Chosen style: numpy in Arrow batches, because the work is matrix products. Nothing is shuffled but
the sample.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwise.llm.common import arrow_map, key_column, materialize

HALF = 8  # bytes in half a chunk; chunks are twice that long and start every HALF bytes
EMBED, FILTERS, HIDDEN = 8, 48, 16
MAX_DOCS = 4_000  # bound of the training sample
MAX_DOC_BYTES = 1 << 18  # longer documents are not sampled (they are scored like all others)
STEPS, BATCH, RATE, SEED = 1_200, 32, 3e-3, 7
PIECE = 1 << 20  # bytes convolved at once


def init(seed: int = SEED) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)

    def normal(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    return {"embed": normal(256, EMBED, scale=0.5), "first": normal(HALF * EMBED, FILTERS, scale=0.09),
            "second": normal(HALF * EMBED, FILTERS, scale=0.09), "bias": np.zeros(FILTERS, np.float32),
            "hidden": normal(FILTERS, HIDDEN, scale=0.2), "hidden_bias": np.zeros(HIDDEN, np.float32),
            "out": normal(HIDDEN, scale=0.3), "out_bias": np.zeros(1, np.float32)}


def _blocks(texts: list[bytes], ends: list[bool] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All texts as rows of HALF bytes, zero-padded; and each text's first row.

    A text gets an empty last block, unless `ends` says that it goes on in another piece.
    """
    count = np.array([-(-len(t) // HALF) + 1 for t in texts]) - (0 if ends is None else ~np.array(ends))
    padded = b"".join(t + bytes(n * HALF - len(t)) for t, n in zip(texts, count.tolist(), strict=True))
    return np.frombuffer(padded, np.uint8).reshape(-1, HALF), np.r_[0, np.cumsum(count)[:-1]]


def _convolve(p: dict, blocks: np.ndarray, filters: np.ndarray) -> np.ndarray:
    """Filter responses of the chunk that starts at each block (the last row has no second half)."""
    both = p["embed"][blocks].reshape(len(blocks), -1) @ filters
    out = both[:, :FILTERS] + p["bias"]
    out[:-1] += both[1:, FILTERS:]
    return out


def _pool(p: dict, texts: list[bytes], ends: list[bool] | None = None) -> np.ndarray:
    """Max over all chunks of each text (or piece of one), rectified."""
    filters = np.hstack([p["first"], p["second"]])
    blocks, start = _blocks(texts, ends)
    out = _convolve(p, blocks, filters)
    out[np.r_[start[1:], len(blocks)] - 1] = 0  # the chunk that would run into the next text
    return np.maximum(np.maximum.reduceat(out, start, axis=0), 0)


def _combine(p: dict, pooled: np.ndarray) -> np.ndarray:
    hidden = np.maximum(pooled @ p["hidden"] + p["hidden_bias"], 0)
    return 1 / (1 + np.exp(-np.clip(hidden @ p["out"] + p["out_bias"][0], -30, 30)))


def predict(p: dict, texts: list[bytes]) -> np.ndarray:
    """Probability of label 1 for whole texts; long texts are pooled piece by piece."""
    pooled = np.zeros((len(texts), FILTERS), np.float32)
    pieces, ends, owner, size = [], [], [], 0

    def flush():
        nonlocal pieces, ends, owner, size
        if pieces:
            np.maximum.at(pooled, np.array(owner), _pool(p, pieces, ends))
        pieces, ends, owner, size = [], [], [], 0

    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text)), PIECE):  # pieces share one block, so no chunk is lost
            ends.append(at + PIECE >= len(text))
            pieces.append(text[at: at + PIECE + HALF * (not ends[-1])])
            owner.append(i)
            size += len(pieces[-1])
            if size >= PIECE:
                flush()
    flush()
    return _combine(p, pooled).astype(float)


def _gradients(p: dict, texts: list[bytes], label: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    filters = np.hstack([p["first"], p["second"]])
    blocks, start = _blocks(texts)
    out = _convolve(p, blocks, filters)
    stop = np.r_[start[1:], len(blocks)] - 1
    at = np.stack([s + out[s:e].argmax(axis=0) if e > s else np.full(FILTERS, s)
                   for s, e in zip(start.tolist(), stop.tolist(), strict=True)])
    raw = np.take_along_axis(out, at, axis=0) * (stop > start)[:, None]
    pooled = np.maximum(raw, 0)
    before = pooled @ p["hidden"] + p["hidden_bias"]
    hidden = np.maximum(before, 0)
    score = 1 / (1 + np.exp(-(hidden @ p["out"] + p["out_bias"][0])))
    d_out = ((score - label) * weight / len(texts)).astype(np.float32)
    d_hidden = np.outer(d_out, p["out"]) * (before > 0)
    d_pool = (d_hidden @ p["hidden"].T) * (raw > 0)
    g = {"out": hidden.T @ d_out, "out_bias": d_out.sum(keepdims=True), "hidden": pooled.T @ d_hidden,
         "hidden_bias": d_hidden.sum(axis=0), "bias": d_pool.sum(axis=0)}
    d_embed = np.zeros_like(p["embed"])
    for name, shift in (("first", 0), ("second", 1)):  # only the winning chunk of a filter has a gradient
        chosen = blocks[np.minimum(at + shift, len(blocks) - 1)]  # (texts, filters, HALF)
        x = p["embed"][chosen].reshape(len(texts), FILTERS, -1)
        g[name] = np.einsum("tf,tfk->kf", d_pool, x)
        d_x = (d_pool[:, :, None] * p[name].T[None]).reshape(-1, EMBED)
        np.add.at(d_embed, chosen.reshape(-1), d_x)
    return g | {"embed": d_embed}


def train(texts: list[bytes], labels: np.ndarray, steps: int = STEPS, seed: int = SEED) -> dict[str, np.ndarray]:
    """Parameters learned by Adam on class-balanced batches of whole texts."""
    p, rng = init(seed), np.random.default_rng(seed)
    if not texts:
        return p
    labels = labels.astype(np.float32)
    share = labels.mean()
    weight = np.where(labels > 0, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6)).astype(np.float32)
    if share in (0.0, 1.0):
        weight[:] = 1
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    order = np.empty(0, np.int64)
    for step in range(1, steps + 1):
        if len(order) < BATCH:
            order = np.r_[order, rng.permutation(len(texts))]
        pick, order = order[:BATCH], order[BATCH:]
        g = _gradients(p, [texts[i] for i in pick], labels[pick], weight[pick])
        rate = RATE * min(1, 2 * (1 - step / (steps + 1)))
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
            p[k] -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return p


# --- on Spark ------------------------------------------------------------------------
def _dump(p: dict) -> bytes:
    buffer = io.BytesIO()
    np.savez(buffer, **p)
    return buffer.getvalue()


def _load(data: bytes) -> dict[str, np.ndarray]:
    return dict(np.load(io.BytesIO(data)))


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    """Whether the remainder of the id's CRC-32 (as text) is the held-out one; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_docs: int = MAX_DOCS, steps: int = STEPS) -> bytes:
    """Train on a bounded sample of the labelled rows outside the held-out third; returns the parameters.

    At most `max_docs` ids are sampled, up to half of each label, in the order of an id hash. Rows
    without an id, label or text and texts above MAX_DOC_BYTES are not sampled. Without any labelled
    row the network keeps its seeded start.
    """
    ident = key_column(id_col)
    rows = (labels.select(ident.alias("doc_id"), key_column(label_col).cast("int").alias("label"))
            .where("doc_id is not null and label in (0, 1)").where(~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max("label").alias("label")))
    rank = F.xxhash64("doc_id", F.lit(SEED))
    each = [rows.where(F.col("label") == k).orderBy(rank, "doc_id").limit(max_docs // 2) for k in (0, 1)]
    sample = materialize(each[0].unionByName(each[1]), "quality-sample")  # at most max_docs narrow rows
    texts = docs.select(ident.alias("doc_id"), key_column(text_col).cast("binary").alias("text")).where(
        F.octet_length("text") <= MAX_DOC_BYTES)
    chosen = (texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
              .repartition(1).sortWithinPartitions("doc_id"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, label = [], []
        for batch in batches:
            data += batch.column("text").to_pylist()
            label += batch.column("label").to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([_dump(train(data, np.array(label, np.float32), steps))])], names=["model"])

    learned = chosen.mapInArrow(learn, "model binary").first()  # Spark may plan no task for an empty sample
    return _dump(init()) if learned is None else bytes(learned["model"])


def score(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score of every whole text; null and empty texts are scored as no bytes."""
    src = docs.select(key_column(id_col).alias("doc_id"), key_column(text_col).cast("binary").alias("text"))

    def run(batch: pa.RecordBatch) -> dict:
        texts = [t or b"" for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "score": pa.array(predict(_load(model), texts), pa.float64())}

    return arrow_map(src, run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, score double")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score (0 to 1), predicted (1 if score >= 0.5).

    Only the text's bytes are read for a score; equal texts have equal scores. Null ids are not held
    out. Repeated rows stay repeated; an empty table gives no rows; other columns are not read.
    """
    scored = score(docs, fit(docs, labels, id_col, text_col), id_col, text_col)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without those the classifier rejects (score below 0.5), all columns kept, nothing shuffled."""
    model = fit(docs, labels, id_col, text_col)
    names = docs.columns
    src = docs.select(*[key_column(c).alias(f"c{i}") for i, c in enumerate(names)],
                      key_column(text_col).cast("binary").alias("bytes_"))
    schema = src.drop("bytes_").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                texts = [t or b"" for t in batch.column(batch.num_columns - 1).to_pylist()]
                good = pa.array(predict(_load(model), texts) >= 0.5)
                yield pa.RecordBatch.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1]).filter(good)

    kept = src.mapInArrow(run, schema)
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
