"""Benchmark decontamination by template windows.

Texts become templates: tokens are stripped of punctuation and folded, numbers become a typed
placeholder, and so do units (after a number) and names (capitalised; at the start of a sentence a token
is taken both as a name and as a word). Windows of
five template tokens with at least three literal words are hashed; equal hashes join documents with
benchmark items. So an item whose numbers, units or names were changed still matches.

Items that give no such window, or are shorter, are hashed whole: at their own length, or in windows of
LONGEST tokens if they are longer, whatever their literals. Documents emit windows of these lengths
too, as literals and (if two words or more are literal) as templates.

The matches of a document and an item are then aligned: windows whose document position minus item
position is the same (up to a small slack) belong together. Their slots are checked for consistency.
Each value of the item must stand for one value in the document and the other way round, as a
re-parameterised question would have it. Windows that contradict the mapping don't count. A document
is contaminated by an item if 0.8 or more of the item's windows are left.

Scale: a document's windows are made and hashed in its own task. Hashes of the benchmark, if proven
to be few, travel as a bitmap of fixed size that drops most windows at once (no match is lost);
otherwise all windows go to the join. The hash join on Spark decides. Rows grow with matches, not
with pairs: a passage in a third of all documents gives its windows once per document.

Chosen style: numpy in Arrow batches for tokens and window hashes, Spark for the join and grouping.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitwise.llm.common import arrow_map, bounded, key_column, materialize

WINDOW = 5
LITERALS = 3  # words that aren't placeholders, at least, in a window
MAYBE = 4  # kind of a token that may be a name: it starts a sentence
WHOLE_LITERALS = 2  # the same for windows of items hashed whole; with fewer, only equal tokens match
LONGEST = 16  # tokens hashed at once of such an item
COVERAGE = 0.8
SLACK = 3  # tokens that may be inserted or missing between windows of one alignment
BITMAP_BITS = 24
BITMAP_ROWS = 2_000_000  # benchmark windows up to which the bitmap is made

# Words taken as units where they follow a number.
UNITS = frozenset("""
    % percent km m cm mm mi mile miles ft foot feet inch inches yard yards kg g mg lb lbs oz ton tons
    l ml litre litres liter liters gallon gallons s sec second seconds min minute minutes h hr hour hours
    day days week weeks month months year years mph kmh kph hz khz mhz ghz w kw v a j kj pa n c f k
    usd eur gbp dollar dollars cent cents euro euros pound pounds $ € £ ¥ kb mb gb tb byte bytes degree degrees
""".split())

_CURRENCY = "$€£¥"
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D  # odd: it has an inverse modulo 2^64
PIECE = 1 << 20  # characters templated at once

# Classes of the characters of the basic plane; others count as letters.
_SPACE, _IN_WORD, _LETTER, _DIGIT, _UPPER, _IN_NUMBER, _ENDS, _QUOTE = (1 << i for i in range(8))


def _char_tables() -> tuple[np.ndarray, np.ndarray]:
    """Class bits and lower-case form of every character of the basic plane (the last entry: all other planes)."""
    kinds, lower = np.zeros(1 << 16, np.uint8), np.arange(1 << 16, dtype=np.uint64)
    for i in range(1 << 16):
        c = chr(i)
        low = c.lower()
        lower[i] = ord(low) if len(low) == 1 else i
        kinds[i] = (c.isspace() * _SPACE | (c.isalnum() or c == "_" or c in _CURRENCY + "%") * _IN_WORD | c.isalpha() * _LETTER
                    | c.isdecimal() * _DIGIT | c.isupper() * _UPPER | (c.isdecimal() or c in "+-.,:/%" + _CURRENCY) * _IN_NUMBER
                    | (c in ".!?:…") * _ENDS | (c in "\"')]}»”’") * _QUOTE)
    kinds[-1] = _IN_WORD | _LETTER
    return kinds, lower


_CHARS: tuple[np.ndarray, np.ndarray] | None = None
_POWERS: tuple[np.ndarray, np.ndarray] | None = None


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE ** i and its inverse, modulo 2^64, for i < n."""
    global _POWERS
    if _POWERS is None or len(_POWERS[0]) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        _POWERS = tuple(np.r_[np.uint64(1), np.cumprod(np.full(max(n, 4096), x, np.uint64), dtype=np.uint64)] for x in (_BASE, inverse))
    return _POWERS


def _hash_form(form: str) -> np.uint64:
    h = 0
    for i, c in enumerate(form):
        h += (ord(c) + 1) * pow(_BASE, i, 1 << 64)
    return _finish(np.array([h & ((1 << 64) - 1)], np.uint64), np.array([len(form)]))[0]


def _finish(h: np.ndarray, size: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ size.astype(np.uint64)) * _PRIME
        return h ^ (h >> np.uint64(32))


_KIND = np.array([xxhash.xxh64_intdigest(x) for x in (b"", b"\0number", b"\0unit", b"\0name", b"\0name")], dtype=np.uint64)
_UNITS = np.sort(np.array([_hash_form(u) for u in UNITS]))


def _running(x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x) + 1, dtype=x.dtype)
    np.cumsum(x, out=out[1:])
    return out


def _tokens(text: str) -> tuple[np.ndarray, ...]:
    """Per token of a piece of text: hash of its lower-case core, start and end of the core, number, title, ends a sentence."""
    global _CHARS
    if _CHARS is None:
        _CHARS = _char_tables()
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    plane = np.minimum(code, (1 << 16) - 1)
    kinds, n, place = _CHARS[0][plane], len(code), np.arange(len(code), dtype=np.int32)
    digit = kinds & _DIGIT > 0
    gap = np.ones(n + 2, dtype=bool)
    gap[1:-1] = kinds & _SPACE
    filled, before, behind = ~gap[1:-1], gap[:-2], gap[2:]
    if digit.any():
        cut = (kinds[1:] & _LETTER > 0) & digit[:-1]  # 5km is 5 km
        before, behind = before.copy(), behind.copy()
        before[1:] |= cut
        behind[:-1] |= cut
    start, stop = np.flatnonzero(filled & before), np.flatnonzero(filled & behind) + 1
    inner = kinds & _IN_WORD > 0
    after = np.minimum.accumulate(np.where(inner, place, n)[::-1])[::-1]
    first, last = after[start], np.maximum.accumulate(np.where(inner, place, -1))[stop - 1] + 1
    plain = np.maximum.accumulate(np.where(kinds & (_QUOTE | _SPACE) == 0, place, 0))[stop - 1]
    ends = kinds[plain] & _ENDS > 0
    some = first < stop
    first, last, ends_of = first[some], last[some], ends
    power, inverse = _powers(n)
    with np.errstate(over="ignore"):
        low = np.where(code < 1 << 16, _CHARS[1][plane], code) + np.uint64(1)
        total = _running(low * power[:n])
        h = _finish((total[last] - total[first]) * inverse[first], last - first)
    number = np.zeros(len(first), dtype=bool)
    if digit.any():
        digits, others = _running(digit.astype(np.int64)), _running((kinds & _IN_NUMBER == 0).astype(np.int64))
        number = (digits[last] > digits[first]) & (others[last] == others[first])
    title = (kinds[first] & _UPPER > 0) & ~((last - first > 1) & (kinds[np.minimum(first + 1, n - 1)] & _UPPER > 0))
    opened = np.ones(len(start), dtype=bool)  # the token before (also one without a core) ended a sentence
    opened[1:] = ends_of[:-1]
    opened = opened[some]
    return h, first, last, number, title, opened, ends_of[-1:]


class _Forms:
    """Lower-case forms of the tokens, made when asked for."""

    def __init__(self, pieces: list[str], owner: np.ndarray, first: np.ndarray, last: np.ndarray):
        self.pieces, self.owner, self.first, self.last = pieces, owner, first, last

    def __getitem__(self, i: int) -> str:
        return self.pieces[self.owner[i]][self.first[i]: self.last[i]].lower()


def template(text: str | None) -> tuple[np.ndarray, np.ndarray, _Forms | None]:
    """Hash of the lower-case core and kind (0 literal, 1 number, 2 unit, 3 name) of every token, and the forms."""
    h, kind, forms = _kinds(text)
    return h, np.where(kind == MAYBE, 0, kind), forms


def _kinds(text: str | None) -> tuple[np.ndarray, np.ndarray, _Forms | None]:
    """As `template`, with the kind MAYBE for a capitalised token that starts a sentence: a name, or any word."""
    text = text or ""
    if not unicodedata.is_normalized("NFKC", text):
        text = unicodedata.normalize("NFKC", text)
    pieces, at = [], 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            end = max(text.rfind(c, at + 1, end) for c in " \n")
            end = end if end > 0 else at + PIECE
        pieces.append(text[at:end])
        at = end
    parts, opened = [], True
    for i, piece in enumerate(pieces):
        *part, ended = _tokens(piece)
        if len(ended):
            if len(part[0]):
                part[5][0] &= opened  # what the piece before ended with
            opened = bool(ended[0])
        parts.append((*part, np.full(len(part[0]), i)))
    if not parts or not sum(len(p[0]) for p in parts):
        return np.empty(0, np.uint64), np.empty(0, np.int64), None
    h, first, last, number, title, opened_at, owner = (
        x[0] if len(parts) == 1 else np.concatenate(x) for x in zip(*parts, strict=True))
    unit = np.zeros(len(h), dtype=bool)
    if number.any():
        unit[1:] = number[:-1]
        where = np.minimum(np.searchsorted(_UNITS, h), len(_UNITS) - 1)
        unit &= (_UNITS[where] == h) & ~number
    kind = np.where(title & ~number & ~unit, np.where(opened_at, MAYBE, 3), 0) + number + 2 * unit
    return h, kind, _Forms(pieces, owner, first, last) if kind.any() else None


def _rolled(h: np.ndarray, span: int, seed: int) -> np.ndarray:
    """Hashes of the windows of `span` tokens."""
    out = np.full(len(h) - span + 1, seed, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(span):
            out = (out ^ h[i: i + len(out)]) * _PRIME
            out ^= out >> np.uint64(29)
    return out


def whole_windows(text: str | None, lengths: list[int] | None = None, size: int = WINDOW) -> list[tuple]:
    """(hash, position, slots, number of positions, length) by which items without usable windows are found.

    With `lengths`: those of a document. Without: those of an item, at the one length it needs, if any.
    """
    literal, kind, forms = _kinds(text)
    n = len(literal)
    if lengths is None:
        words = np.convolve((kind == 0) | (kind == MAYBE), np.ones(size, np.int64), "valid") if n >= size else np.zeros(1)
        words = words + (np.convolve(kind == 3, np.ones(size, np.int64), "valid") if n >= size else 0)
        lengths = [min(n, LONGEST)] if n and not (words >= LITERALS).any() else []
    out = []
    for span in lengths:
        if span > n:
            continue
        spots, where = n - span + 1, np.arange(n - span + 1)
        out.append((_rolled(literal, span, 1000 + span), where, _Slots(kind, None, where, None, span), spots, span))
        for top in (2, 3, MAYBE):
            slot = (kind > 0) & (kind <= top)
            good = np.flatnonzero((np.convolve(~slot, np.ones(span, np.int64), "valid") >= WHOLE_LITERALS)
                                  & (np.convolve(kind == top if top > 2 else slot, np.ones(span, np.int64), "valid") > 0))
            if len(good):
                h = _rolled(np.where(slot, _KIND[kind], literal), span, 2000 + span)[good]
                out.append((h, good, _Slots(kind, forms, good, np.full(len(good), top), span), spots, span))
    return out


def windows(text: str | None, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, _Slots | None, int]:
    """(hash, position, slots) of the template windows of a text, and the number of positions they cover.

    A window that holds a name is hashed twice, with the name as placeholder and as literal word:
    names are told by case, which a copy may have changed. A window with a capitalised token that starts
    a sentence is hashed once more, with that as a name too. A text shorter than a window is one
    window of its own, whatever its literals.
    """
    literal, kind, forms = _kinds(text)
    n = len(literal)
    if n == 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), None, 0
    span = min(size, n)
    hashes, where, named, kept = [], [], [], np.zeros(n - span + 1, dtype=bool)
    for top in (2, 3, MAYBE):
        if top > 2 and not (kind == top).any():
            continue
        slot = (kind > 0) & (kind <= top)
        h = np.where(slot, _KIND[kind], literal) if slot.any() else literal
        rolled = _rolled(h, span, span)
        words = np.zeros(n - span + 1, dtype=np.int64)
        has_name = np.zeros(n - span + 1, dtype=bool)
        for i in range(span):
            words += ~slot[i: i + len(rolled)]
            has_name |= kind[i: i + len(rolled)] == top
        good = ((words >= LITERALS) | (n < size)) & (has_name if top > 2 else True)
        hashes.append(rolled[good])
        where.append(np.flatnonzero(good))
        named.append(np.full(good.sum(), top))
        kept |= good
    where, named = np.concatenate(where), np.concatenate(named)
    return np.concatenate(hashes), where, _Slots(kind, forms, where, named, span), int(kept.sum())


class _Slots:
    """The placeholders of the windows, made only for those asked for: place in the window, kind, value."""

    def __init__(self, kind, forms, where, named, span):
        self.kind, self.forms, self.where, self.named, self.span = kind, forms, where, named, span

    def pick(self, keep: np.ndarray) -> list[list[str]]:
        if self.forms is None:
            return [[]] * len(keep)
        return [[f"{i}:{min(self.kind[at + i], 3)}:{self.forms[at + i]}" for i in range(self.span)
                 if 0 < self.kind[at + i] <= top]
                for at, top in zip(self.where[keep].tolist(), self.named[keep].tolist(), strict=True)]


def _consistent(matches: list[dict]) -> tuple[int, int]:
    """Of one alignment: item windows whose slots agree with a one-to-one mapping, and slots that changed."""
    votes: Counter = Counter()
    pairs = []
    for m in matches:
        own = [(a.split(":", 2)[1], a.split(":", 2)[2], b.split(":", 2)[2])
               for a, b in zip(m["item_slots"], m["slots"], strict=True)]
        pairs.append((m["item_pos"], own))
        votes.update(set(own))
    to, back = {}, {}
    for kind, a, b in sorted(votes, key=lambda x: (-votes[x], x[1] != x[2], x)):
        if (kind, a) not in to and (kind, b) not in back:
            to[kind, a], back[kind, b] = b, a
    agree = {pos for pos, own in pairs if all(to.get((k, a)) == b for k, a, b in own)}
    return len(agree), sum(b != a for (_, a), b in to.items())


def judge(matches: list[dict], slack: int = SLACK) -> tuple[int, int]:
    """(item windows matched consistently, changed slots) of the best alignment of one document and item."""
    by_line = sorted(matches, key=lambda m: (m["pos"] - m["item_pos"], m["pos"]))
    best, group, last = (0, 0), [], None
    for m in [*by_line, None]:
        line = None if m is None else m["pos"] - m["item_pos"]
        if group and (m is None or line - last > slack):
            found = _consistent(group)
            best = max(best, (found[0], -found[1]))
            group = []
        if m is not None:
            group.append(m)
            last = line
    return best[0], -best[1]


def _keyed(texts: DataFrame, id_col: str) -> DataFrame:
    return texts.select(F.col(id_col).alias("id"), F.xxhash64(id_col, "text").alias("text_hash"), "text")


def _matches(keyed: DataFrame, bitmap: np.ndarray | None, size: int, lengths: list[int] | None = None) -> DataFrame:
    """(id, text_hash, hash, pos, slots, n_windows, length) of all windows, or of those the bitmap lets through.

    `lengths` are those of the items hashed whole (None: `keyed` holds the items); `length` is 0 for other windows.
    """
    kind = keyed.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if bitmap is None else np.unpackbits(bitmap).astype(bool)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                row, hashes, pos, slots, total, spans = [], [], [], [], [], []
                made = ((i, *w) for i, value in enumerate(part.column("text")) for text in [value.as_py()]
                        for w in [(*windows(text, size), 0), *(whole_windows(text, lengths, size) if lengths != [] else [])])
                for i, h, where, values, n, span in made:
                    if not len(h):
                        continue
                    keep = np.arange(len(h)) if bits is None else np.flatnonzero(
                        bits[(h >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)])
                    if len(keep):
                        row.append(np.full(len(keep), i))
                        hashes.append(h[keep].view(np.int64))
                        pos.append(where[keep])
                        total.append(np.full(len(keep), n))
                        spans.append(np.full(len(keep), span))
                        slots += values.pick(keep)
                if row:
                    take = pa.array(np.concatenate(row))
                    yield pa.RecordBatch.from_arrays(
                        [part.column("id").take(take), part.column("text_hash").take(take), pa.array(np.concatenate(hashes)),
                         pa.array(np.concatenate(pos).astype(np.int32)), pa.array(slots, pa.list_(pa.string())),
                         pa.array(np.concatenate(total).astype(np.int32)), pa.array(np.concatenate(spans).astype(np.int32))],
                        names=["id", "text_hash", "hash", "pos", "slots", "n_windows", "length"])

    return keyed.mapInArrow(run, f"id {kind}, text_hash long, hash long, pos int, slots array<string>, n_windows int, length int")


def rare_windows(item_rows: DataFrame, coverage: float) -> DataFrame:
    """(hash, item_hash) of the windows by which items are looked for: of each item its rarest places, one more than may be missed.

    A document that covers the wanted share of an item's places holds one of them. How rare a place is, is told by the
    items that share its windows; so what many items begin with brings no pair of document and item together.
    """
    shared = item_rows.select("hash", "item_hash").distinct().groupBy("hash").agg(F.count("*").alias("items"))
    places = (item_rows.join(shared, "hash").groupBy("item_hash", "item_pos")
              .agg(F.max("items").alias("items"), F.max("n_windows").alias("n_windows")))
    rank = F.row_number().over(Window.partitionBy("item_hash").orderBy("items", "item_pos"))
    wanted = places.withColumn("rank", rank).where(
        F.col("rank") <= F.floor((1 - coverage) * F.col("n_windows") + 1e-9) + 1).select("item_hash", "item_pos")
    return item_rows.join(wanted, ["item_hash", "item_pos"]).select("hash", "item_hash").distinct()


def candidate_pairs(found: DataFrame, item_rows: DataFrame, coverage: float) -> DataFrame:
    """(text_hash, item_hash) of documents and items that may reach the coverage."""
    return found.select("hash", "text_hash").join(rare_windows(item_rows, coverage), "hash").select(
        F.col("text_hash").alias("of_text"), F.col("item_hash").alias("of_item")).distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", size: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """One row per contaminated document and item: doc_id, text_hash, item_id, n_windows, n_matched,
    coverage, n_changed (slots whose value differs: above 0 for a re-parameterised question).

    Null and blank texts and items have no windows and match nothing. Items without a
    usable window, or shorter than one, are found whole inside a longer text. Rows with the same id and text give one row. Texts
    with the same item id are judged each by itself, and the id has the best one's figures; null ids are an id of their own. An empty table on either side
    gives no rows. Other columns are not read. Windows are joined only for pairs that share a rare one (`rare_windows`).
    """
    items = benchmark.select(key_column(item_col).alias("item_id"), key_column("text").alias("text"))
    item_rows = materialize(_matches(_keyed(items, "item_id").distinct(), None, size), "decontam-items")
    lengths = sorted(r[0] for r in item_rows.where("length > 0").select("length").distinct().collect())  # LONGEST at most
    item_rows = item_rows.select("hash", F.col("pos").alias("item_pos"), "n_windows", F.col("slots").alias("item_slots"),
                                 F.col("id").alias("item_id"), F.col("text_hash").alias("item_hash"))
    bitmap = None
    hashes = item_rows.select(F.shiftrightunsigned("hash", 64 - BITMAP_BITS).cast("int").alias("bit")).distinct()
    if bounded(hashes, BITMAP_ROWS, 4):  # checked: at most BITMAP_ROWS integers reach the driver
        bitmap = np.zeros(1 << BITMAP_BITS, dtype=bool)
        bitmap[hashes.toArrow().column("bit").to_numpy()] = True
        bitmap = np.packbits(bitmap)
    keyed = _keyed(docs.select(key_column(id_col).alias("doc_id"), key_column(text_col).alias("text")), "doc_id")
    found = materialize(_matches(keyed, bitmap, size, lengths).drop("n_windows", "length"), "decontam-windows").withColumnRenamed("id", "doc_id")
    pairs = materialize(candidate_pairs(found, item_rows, coverage), "decontam-pairs")
    both = found.join(pairs, F.col("text_hash") == F.col("of_text")).drop("of_text")
    matched = both.join(item_rows, (both["hash"] == item_rows["hash"]) & (both["of_item"] == item_rows["item_hash"])).groupBy("doc_id", "text_hash", "item_id", "item_hash").agg(
        F.max("n_windows").alias("n_windows"),
        F.collect_list(F.struct("pos", "slots", "item_pos", "item_slots")).alias("matches"))

    def run(batch: pa.RecordBatch) -> dict:
        judged = [judge(m) for m in batch.column("matches").to_pylist()]
        return {c: batch.column(c) for c in ("doc_id", "text_hash", "item_id", "n_windows")} | {
            "n_matched": pa.array([a for a, _ in judged], pa.int32()), "n_changed": pa.array([b for _, b in judged], pa.int32())}

    kinds = {f.name: f.dataType.simpleString() for f in matched.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in ("doc_id", "text_hash", "item_id", "n_windows"))
    out = arrow_map(matched, run, schema + ", n_matched int, n_changed int")
    best = F.max(F.struct("coverage", "n_windows", "n_matched", (-F.col("n_changed")).alias("unchanged")))
    return (out.withColumn("coverage", F.col("n_matched") / F.col("n_windows")).where(F.col("coverage") >= coverage)
            .groupBy("doc_id", "text_hash", "item_id").agg(best.alias("best"))
            .select("doc_id", "text_hash", "item_id", "best.n_windows", "best.n_matched", "best.coverage",
                    (-F.col("best.unchanged")).alias("n_changed")))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        **options) -> DataFrame:
    """`docs` without the contaminated ones, all columns kept.

    The list of leaks is broadcast if proven small; otherwise both sides are hashed by id and text.
    """
    leaks = materialize(contaminated(docs, benchmark, id_col, text_col, **options).select(
        F.col("text_hash").alias("leak")).distinct(), "decontam-leaks")
    leaks = F.broadcast(leaks) if bounded(leaks, 1_000_000, 16) else leaks.hint("shuffle_hash")
    src = docs.select(F.struct(*map(key_column, docs.columns)).alias("row"),
                      F.xxhash64(key_column(id_col), key_column(text_col)).alias("own"))
    return src.join(leaks, F.col("own") == F.col("leak"), "left_anti").select("row.*")
