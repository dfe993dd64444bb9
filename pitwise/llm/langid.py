"""Language identification by rank-order profiles.

A profile is the ranking of a language's most frequent letter n-grams (one to three letters, with
the edges of words as a letter), counted over all training texts. A text is ranked the same way and
compared with every profile: the out-of-place distance adds, for each of the text's most frequent
n-grams, how far its rank is from the profile's, or the greatest distance if the profile lacks it.
The nearest profile is the answer; the score is the lead over the second nearest.

Scale: tasks count their own texts and send (language, n-gram, count) rows, which are summed and
cut to the top ranks per language before any ranking is exchanged. Profiles are a few hundred rows a
language. Prediction is one local pass over whole texts.

Chosen style: numpy in Arrow batches (a text's n-grams are one sort of packed integers).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitwise.llm.common import arrow_map, bounded, key_column, materialize
from pitwise.llm.quality import held_out

RANKS = 400  # n-grams of a profile and of a text's ranking
MAX_LANGS = 2_000  # profiles are held by every task
FLUSH = 2_000_000  # n-grams held by a counting task before it sends them on
UNKNOWN = "und"
PIECE = 1 << 20  # characters ranked at once

_BITS = 21  # of a code point
_letters = np.zeros(1 << 16, dtype=bool)
_letters[[i for i in range(1 << 16) if chr(i).isalpha()]] = True


def _codes(text: str) -> np.ndarray:
    """Code points of the letters, lower case, with one 0 at every edge of a word."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    letter = _letters[np.minimum(code, (1 << 16) - 1)]
    high = code >= 1 << 16
    if high.any():
        letter[high] = [chr(c).isalpha() for c in code[high].tolist()]
    code[~letter] = 0
    code = np.r_[0, code, 0]
    return code[np.r_[True, (code[1:] != 0) | (code[:-1] != 0)]]


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams of a text, sorted, and their counts (empty without a letter)."""
    text = text or ""
    if len(text) > PIECE:  # whole text, piece by piece; pieces end at white space where there is some
        parts, at = [], 0
        while at < len(text):
            end = at + PIECE
            if end < len(text):
                cut = text.rfind(" ", at + 1, end)
                end = cut if cut > 0 else end
            parts.append(ngrams(text[at:end]))
            at = end
        return _sum(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
    a = _codes(text)
    if not a.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    one, two = a[a > 0], a[:-1] << _BITS | a[1:]
    three = (two[:-1] << _BITS | a[2:])[a[1:-1] > 0]
    return np.unique(np.concatenate([one, two, three]), return_counts=True)


def _sum(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out, where = np.unique(grams, return_inverse=True)
    return out, np.bincount(where, weights=counts, minlength=len(out)).astype(np.int64)


def ranking(grams: np.ndarray, counts: np.ndarray, ranks: int = RANKS) -> np.ndarray:
    """The most frequent n-grams, ties by their packed value."""
    if len(grams) > 4 * ranks:
        floor = np.partition(counts, -ranks)[-ranks]
        grams, counts = grams[counts >= floor], counts[counts >= floor]
    return grams[np.lexsort((grams, -counts))[:ranks]]


def profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", ranks: int = RANKS) -> DataFrame:
    """(lang, gram, rank) of the most frequent n-grams of every language, counted over all rows of `docs`."""
    src = docs.select(key_column(lang_col).cast("string").alias("lang"), key_column(text_col).alias("text")).where(
        "lang is not null and text is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0

        def flush():
            for lang, parts in held.items():
                grams, counts = _sum(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts)], names=["lang", "gram", "n"])

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                got = ngrams(text.as_py())
                held.setdefault(lang, []).append(got)
                size += len(got[0])
                if size > FLUSH:
                    yield from flush()
                    held, size = {}, 0
        yield from flush()

    total = src.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    # The limit is on the row number itself, so that tasks keep their own first n-grams only before the exchange.
    ranked = total.withColumn("place", F.row_number().over(order)).where(F.col("place") <= ranks)
    return ranked.select("lang", "gram", (F.col("place") - 1).alias("rank"))


class _Profiles:
    """All profiles as one table: sorted n-grams, and the rank of each in every language."""

    def __init__(self, rows: pa.Table, ranks: int):
        self.ranks = ranks
        lang = np.array(rows.column("lang").to_pylist(), dtype=object)
        self.langs = sorted(set(lang))
        self.grams, where = np.unique(rows.column("gram").to_numpy(), return_inverse=True)
        self.rank = np.full((len(self.grams), len(self.langs)), -1, dtype=np.int64)
        column = {x: i for i, x in enumerate(self.langs)}
        self.rank[where, [column[x] for x in lang]] = rows.column("rank").to_numpy()

    def predict(self, text: str | None) -> tuple[str, float]:
        own = ranking(*ngrams(text), self.ranks)
        if not len(own) or not self.langs:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        rank = np.where((self.grams[at] == own)[:, None], self.rank[at], -1)
        place = np.where(rank >= 0, np.abs(rank - np.arange(len(own))[:, None]), self.ranks)
        distance = np.minimum(place, self.ranks).sum(axis=0)
        best = int(distance.argmin())  # ties: the first language by code point
        rest = np.delete(distance, best)
        second = rest.min() if len(rest) else self.ranks * len(own)
        return self.langs[best], float((second - distance[best]) / second) if second else 0.0


def identify(docs: DataFrame, training: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", ranks: int = RANKS) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, lang_pred, score (0 to 1).

    Profiles are learned from `training`, or from the rows of `docs` outside the held-out quarter.
    Only the text is read for a prediction. A null text and one without a letter are `und` with
    score 0, as is everything if nothing could be learned. Rows without a language teach nothing;
    null ids are not held out. Repeated rows stay repeated; an empty table gives no rows; other
    columns are not read. More than MAX_LANGS different values of lang raise a ValueError.
    """
    is_out = held_out(key_column(id_col), 4, 2)
    learned = materialize(profiles(docs.where(~is_out) if training is None else training, text_col, lang_col, ranks), "language-profiles")
    if not bounded(learned, MAX_LANGS * ranks, 40):
        raise ValueError(f"more than {MAX_LANGS} languages in {lang_col}")
    table = _Profiles(learned.toArrow(), ranks)  # ranks rows a language
    src = docs.select(key_column(id_col).alias("doc_id"), is_out.alias("held_out"), key_column(text_col).alias("text"))

    def run(batch: pa.RecordBatch) -> dict:
        got = [table.predict(t.as_py()) for t in batch.column("text")]
        return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                "lang_pred": pa.array([g[0] for g in got], pa.string()), "score": pa.array([g[1] for g in got], pa.float64())}

    kind = src.schema["doc_id"].dataType.simpleString()
    return arrow_map(src, run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
