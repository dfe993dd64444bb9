"""Language-model scores: a log-bilinear model trained by noise-contrastive estimation.

The `KNOWN` most frequent training tokens, or all if there are fewer (the end of a text is a token), are
leaves of a tree of three levels; tokens that aren't fall into six groups by last character and ASCII, each a
leaf too. A node has about the cube root of their number of children. The log-bilinear model predicts
the node of a token on each level from the vectors of the three tokens before it, scaled place by place:
score = log prior(child) + q(child) . sum_i c_i * r(token before by i), the prior being the bias. Tokens of like spelling share
nodes. As context, a token's vector is its lowest node's plus one of its own. A token of a group has probability (count + 0.1) / (mass of the group), where
an unseen token has count 0. So all probabilities of a context add up to one.

Training: stochastic gradients (AdaGrad) of the noise-contrastive objective, node by node; the noise is the
prior of a node's children, summed over them on the upper levels and drawn for the leaves. Every task passes over the
training texts of its partitions; the changes of all tasks are averaged, weighted by tokens, slice by
slice of the parameters. A first round finds a common start: each task learns from its first block of texts
alone. The second, from there, learns from every training token of the corpus.

Scoring: the contexts of a block of texts, ordered by token, are multiplied with the vectors of all children of each
node on the way; the log-sum-exp over the children makes token log-probabilities exact.

Counts: tasks count their own tokens and send (token hash, group, count), summed by Spark. The
`KNOWN` most frequent counts travel with the scoring tasks (bounded); the rarer tokens of the texts
are joined with the counts by hash. So no frequent token meets a shuffle as a hot key.

Chosen style: numpy in Arrow batches for the model, Spark for counts, joins and averaging.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwise.llm.common import arrow_map, key_column, materialize
from pitwise.llm.quality import held_out

FEATURES = 128  # of a token's spelling
KNOWN = 100_000  # most frequent tokens: every task holds their counts, and their vectors
CONTEXT, DIM, NOISE = 3, 16, 48
LEAF_NOISE = 4  # draws of leaves a node and batch
RATE, SEED = 0.2, 11
SEGMENT = 64  # tokens that are shuffled as one
LEAST_BATCH, MOST_BATCH, BATCH_SHARE = 256, 16_384, 32
ENOUGH, MOST_PASSES = 1_500_000, 20  # a corpus of fewer tokens is passed over until so many are seen, or so often
FIRST_BLOCK, BLOCK = 1 << 16, 1 << 18  # tokens of the first round's block; tokens trained on or scored at once
CHUNK, PART = 4_096, 2_048  # tokens scored, or trained on, in one matrix product
MOST_TASKS = 2_000  # training tasks
SLICE = 8_192  # parameters averaged as one row
FLUSH = 500_000  # distinct tokens held by a counting task
ADD = 0.1
END = b"\n"  # no word holds white space
GROUPS = 6

_LAST = {ord("."): 1, ord(","): 2}


def tokens(text: bytes | None) -> list[bytes]:
    words = (text or b"").lower().split()
    words.append(END)
    return words


def group(token: bytes) -> int:
    return _LAST.get(token[-1], 0) + (0 if token.isascii() else 3)


def token_hash(token: bytes) -> int:
    return xxhash.xxh64_intdigest(token) - (1 << 63)


def spelling_order(counts: dict[bytes, int]) -> list[bytes]:
    """Tokens ordered by clusters of their spelling, the most frequent of a cluster first.

    Words of one language or ending are spelled alike and follow alike contexts, so they should share nodes of the tree. A
    token's features are its byte pairs, hashed to FEATURES places; the clusters, as many as a node has children,
    are found by spherical k-means from tokens spread over the frequent ones, and ordered by the main direction of their
    centres. At most KNOWN tokens, so this is bounded work of the driver.
    """
    words = sorted(counts, key=lambda t: (-counts[t], t))
    k = min(len(words), math.ceil(len(words) ** (1 / 3)))
    if k < 2:
        return words
    plain = [b"^" + (t.strip(b".,;:!?'\"()[]{}*#-") or t) + b"$" for t in words]
    size = np.array([len(t) for t in plain])
    raw = np.frombuffer(b"".join(plain), np.uint8).astype(np.int64)
    pair = (raw[:-1] * 257 + raw[1:]) * 0x9E3779B1 % (1 << 32) >> 16
    of = np.repeat(np.arange(len(plain)), size)
    inside = of[:-1] == of[1:]
    flat = np.bincount(of[:-1][inside] * FEATURES + pair[inside] % FEATURES, minlength=len(plain) * FEATURES)
    x = np.sqrt(flat.astype(np.float32)).reshape(len(plain), FEATURES)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    weight = np.sqrt(np.array([counts[t] for t in words], dtype=np.float32))
    centres = x[np.linspace(0, min(len(words), 100 * k) - 1, k).astype(int)].copy()
    for _ in range(10):
        nearest = (x @ centres.T).argmax(axis=1)
        for j in range(k):
            mine = nearest == j
            if mine.any():
                centre = weight[mine] @ x[mine]
                centres[j] = centre / np.linalg.norm(centre)
    nearest = (x @ centres.T).argmax(axis=1)
    spread = centres - centres.mean(axis=0)
    place = np.argsort(np.argsort(spread @ np.linalg.svd(spread, full_matrices=False)[2][0], kind="stable"), kind="stable")
    return [words[i] for i in np.argsort(place[nearest], kind="stable").tolist()]


class Vocabulary:
    """Classes and counts of the most frequent tokens, and the masses of the groups of all others."""

    def __init__(self, known: dict[bytes, int], n: int, v: int, mass: np.ndarray):
        self.n, self.v, self.mass = n, v, mass  # mass: of tokens outside the classes, (count + ADD), by group
        self.counts = known
        frequent = spelling_order(known)
        self.class_of = {t: i for i, t in enumerate(frequent)}
        self.log_of = np.log10(np.array([known[t] for t in frequent], dtype=np.float64) + ADD)
        self.size = len(frequent) + GROUPS
        self.start = self.size  # stands before a text, and is never predicted
        prior = np.array([known[t] + ADD for t in frequent] + [m + ADD for m in mass])
        self.prior = prior / prior.sum()

    def classes(self, words: list[bytes]) -> np.ndarray:
        """Classes of the tokens, -1 for those of the groups."""
        return np.fromiter(map(self.class_of.get, words, repeat(-1)), dtype=np.int32, count=len(words))

    def numbered(self, texts: list[list[bytes]]) -> np.ndarray:
        """Classes of the tokens of all texts, CONTEXT starts before each text."""
        out = [np.full(CONTEXT, self.start, dtype=np.int32)]
        for words in texts:
            ids = self.classes(words)
            others = np.flatnonzero(ids < 0)
            ids[others] = [len(self.class_of) + group(words[i]) for i in others.tolist()]
            out += [ids, out[0]]
        return np.concatenate(out[:-1] if texts else out)


class Tree:
    """Three levels over the classes: a node holds `width` nodes of the level below, or leaves."""

    def __init__(self, prior: np.ndarray):
        self.size = len(prior)
        self.width = max(2, math.ceil(self.size ** (1 / 3)))
        self.first2 = np.arange(0, self.size, self.width)
        self.n2 = len(self.first2)
        self.n1 = -(-self.n2 // self.width)
        self.leaf2 = (np.arange(self.size) // self.width).astype(np.int32)
        self.mid1 = (np.arange(self.n2) // self.width).astype(np.int32)
        mass2 = np.add.reduceat(prior, self.first2)
        mass1 = np.add.reduceat(mass2, np.arange(0, self.n2, self.width))
        self.p1, self.p2, self.p3 = mass1 / mass1.sum(), mass2 / mass1[self.mid1], prior / mass2[self.leaf2]
        self.log1, self.log2, self.log3 = (np.log(x).astype(np.float32) for x in (self.p1, self.p2, self.p3))
        self.node_of = np.r_[self.leaf2, np.int32(self.n2)]  # the start has a node of its own

        self.below = np.r_[0.0, np.cumsum(self.p3)]

    def leaves(self, nodes: np.ndarray, rng) -> np.ndarray:
        """LEAF_NOISE leaves of each of the lowest nodes, drawn by their frequency."""
        first = self.first2[nodes]
        last = np.minimum(first + self.width, self.size)
        low = self.below[first][:, None]
        at = low + rng.random((len(nodes), LEAF_NOISE)) * (self.below[last][:, None] - low)
        return np.clip(np.searchsorted(self.below, at, side="right") - 1, first[:, None], last[:, None] - 1).astype(np.int32)


def init(tree: Tree, seed: int = SEED) -> dict[str, np.ndarray]:
    """Context vectors (of nodes, and each class's own), weights of the places, vectors of the three levels."""
    rng = np.random.default_rng(seed)

    def small(*shape):
        return (rng.standard_normal(shape) * 0.1).astype(np.float32)

    def zeros(*shape):
        return np.zeros(shape, np.float32)

    return {"node": small(tree.n2 + 1, DIM), "own": zeros(tree.size + 1, DIM), "c": np.ones((CONTEXT, DIM), np.float32) / CONTEXT,
            "q1": small(tree.n1, DIM), "q2": zeros(tree.n2, DIM), "q3": zeros(tree.size, DIM)}


def _order(keys: np.ndarray) -> np.ndarray:
    """Stable order of numbers below 2^32 by two or three radix passes."""
    order = np.argsort((keys & 0xFFFF).astype(np.uint16), kind="stable")
    return order.take(np.argsort((keys >> 16).astype(np.uint16).take(order), kind="stable"))


def _runs(ordered: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])


def _put(to: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """Rows of a table replaced, each as one item of its bytes."""
    kind = np.dtype((np.void, to.strides[0]))
    to.view(kind)[:, 0][rows] = values.view(kind)[:, 0]


def _descend(p: dict, state: dict, k: str, rows, grad: np.ndarray) -> None:
    """One AdaGrad step of distinct rows (None: of all)."""
    s = grad * grad
    if rows is None:
        s += state[k]
        state[k][:] = s
    else:
        rows = rows.astype(np.int64)
        s += state[k].take(rows, axis=0)
        _put(state[k], rows, s)
    np.sqrt(s, out=s)
    np.divide(grad, s, out=s)
    s *= np.float32(RATE)
    if rows is None:
        p[k] -= s
    else:
        _put(p[k], rows, np.subtract(p[k].take(rows, axis=0), s, out=s))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _nce(x: np.ndarray, q: np.ndarray, prior: np.ndarray, own: np.ndarray, scale: float = 1.0) -> np.ndarray:
    """Gradient (times `scale`) by the scores of a node's children, for tokens `x` whose child is `own`.

    A score holds the log noise probability, so against NOISE draws the logit is q.x - log NOISE. The draws'
    part is summed over the children by their probability instead of drawn.
    """
    s = x @ -q.T
    np.exp(s, out=s)
    s *= np.float32(NOISE)
    s += 1  # 1 / s is the probability that a child is the token and no noise
    at = np.arange(len(x))
    right = (1 / s[at, own] - 1) * np.float32(scale)
    np.divide((NOISE * scale * prior).astype(np.float32), s, out=s)
    s[at, own] += right
    return s


def train(p: dict, tree: Tree, seq: np.ndarray, state: dict, rng, seen: int = 0) -> int:
    """One pass of noise-contrastive estimation over the tokens of `seq`, by AdaGrad; `p` and `state` change.

    Runs of SEGMENT tokens, each with its context, are taken in random order. A batch is a BATCH_SHARE-th of the tokens
    seen so far, from LEAST_BATCH to MOST_BATCH. Returns the tokens seen.
    """
    runs = -(-(len(seq) - CONTEXT) // SEGMENT)
    padded = np.r_[seq, np.full(runs * SEGMENT + CONTEXT - len(seq), tree.size, dtype=np.int32)]
    order, at = rng.permutation(runs), 0
    while at < runs:
        n = int(min(max(seen // BATCH_SHARE, LEAST_BATCH), MOST_BATCH)) // SEGMENT
        pick = order[at: at + n]
        at += n
        seen += _step(p, tree, padded.take(pick[:, None] * SEGMENT + np.arange(SEGMENT + CONTEXT)), state, rng)
    return seen


def _step(p: dict, tree: Tree, seq: np.ndarray, state: dict, rng) -> int:
    """A gradient step on the tokens of some runs, CONTEXT tokens before each; returns their number."""
    flat = seq.ravel()
    r = (p["node"].take(tree.node_of.take(flat), axis=0) + p["own"].take(flat, axis=0)).reshape(*seq.shape, DIM)
    places = [r[:, CONTEXT - 1 - i: seq.shape[1] - 1 - i] for i in range(CONTEXT)]
    pred = places[0] * p["c"][0]
    for i in range(1, CONTEXT):
        pred += places[i] * p["c"][i]
    pred = pred.reshape(-1, DIM)
    target = seq[:, CONTEXT:].ravel()
    kept = np.flatnonzero(target != tree.size)
    if not len(kept):
        return 0
    order = kept.take(_order(target.take(kept)))
    y, x = target.take(order), pred.take(order, axis=0)
    y2 = tree.leaf2.take(y)
    y1 = tree.mid1.take(y2)
    n, scale = len(y), np.float32(1 / len(y))

    g_x, g_q = np.empty_like(x), np.zeros_like(p["q1"])
    for lo in range(0, n, PART):  # parts that fit the cache
        g = _nce(x[lo: lo + PART], p["q1"], tree.p1, y1[lo: lo + PART], scale)
        g_x[lo: lo + PART] = g @ p["q1"]
        g_q += g.T @ x[lo: lo + PART]
    steps = [("q1", None, g_q)]

    # Inner nodes, as in `_nce`: products by node, what lies between at once for the nodes of about PART tokens.
    g_q, met = np.zeros_like(p["q2"]), np.zeros(tree.n2, dtype=bool)
    share, minus = (NOISE * scale * tree.p2).astype(np.float32), -p["q2"]
    cut1 = np.r_[_runs(y1), n]
    firsts = y1.take(cut1[:-1]).astype(np.int64) * tree.width
    own = y2 - y1 * np.int32(tree.width)
    k, room = 0, np.empty((max(PART, int(np.diff(cut1).max())), tree.width), np.float32)
    while k < len(firsts):
        last = max(k + 1, int(np.searchsorted(cut1, cut1[k] + PART, side="right")) - 1)
        start, end = int(cut1[k]), int(cut1[last])
        spans = list(zip((cut1[k:last] - start).tolist(), (cut1[k + 1: last + 1] - start).tolist(), firsts[k:last].tolist()))
        s, some, back = room[:end - start], x[start:end], g_x[start:end]
        for lo, hi, a in spans:
            b = min(a + tree.width, tree.n2)
            np.matmul(some[lo:hi], minus[a:b].T, out=s[lo:hi, :b - a])
            s[lo:hi, b - a:] = 0
        np.exp(s, out=s)
        s *= np.float32(NOISE)
        s += 1
        at, mine = np.arange(end - start), own[start:end]
        right = (1 / s[at, mine] - 1) * scale
        for lo, hi, a in spans:
            b = min(a + tree.width, tree.n2)
            np.divide(share[a:b], s[lo:hi, :b - a], out=s[lo:hi, :b - a])
        s[at, mine] += right
        for lo, hi, a in spans:
            b = min(a + tree.width, tree.n2)
            g = s[lo:hi, :b - a]
            back[lo:hi] += g @ p["q2"][a:b]
            np.matmul(g.T, some[lo:hi], out=g_q[a:b])
            met[a:b] = True
        k = last
    rows = np.flatnonzero(met)
    steps.append(("q2", rows, g_q[rows]))

    # Leaves: LEAF_NOISE draws from the node, shared by its tokens in the batch; some nodes at a time, to stay in the cache.
    cut2, cut3 = _runs(y2), _runs(y)
    drawn = tree.leaves(y2.take(cut2), rng)
    log_k = np.float32(math.log(LEAF_NOISE))
    ends = np.r_[cut2, n]
    good, g_n = np.empty(n, np.float32), np.empty((len(cut2), LEAF_NOISE * DIM), np.float32)
    first = 0
    while first < len(cut2):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + PART)) - 1)
        lo, hi = ends[first], ends[last]
        some, starts = x[lo:hi], ends[first:last] - lo
        of = np.repeat(np.arange(last - first), np.diff(ends[first: last + 1]))
        q_y, q_n = p["q3"].take(y[lo:hi], axis=0), p["q3"].take(drawn[first:last], axis=0).take(of, axis=0)
        right = good[lo:hi] = (_sigmoid(np.einsum("nd,nd->n", some, q_y) - log_k) - 1) * scale
        bad = _sigmoid(np.einsum("nd,nkd->nk", some, q_n) - log_k) * scale
        g_x[lo:hi] += right[:, None] * q_y + np.einsum("nk,nkd->nd", bad, q_n)
        g_n[first:last] = np.add.reduceat((bad[:, :, None] * some[:, None, :]).reshape(hi - lo, -1), starts, axis=0)
        first = last
    grads = np.vstack([np.add.reduceat(good[:, None] * x, cut3, axis=0), g_n.reshape(-1, DIM)])
    rows = np.r_[y.take(cut3), drawn.ravel()]
    by_row = _order(rows)
    at = _runs(rows.take(by_row))
    steps.append(("q3", rows.take(by_row).take(at), np.add.reduceat(grads.take(by_row, axis=0), at, axis=0)))

    # Contexts: a token's vector takes part in the predictions of the next CONTEXT tokens.
    back = np.zeros_like(pred)
    back[order] = g_x
    back = back.reshape(len(seq), -1, DIM)
    g_r = np.zeros_like(r)
    for i in range(CONTEXT):
        g_r[:, CONTEXT - 1 - i: seq.shape[1] - 1 - i] += back * p["c"][i]
    steps.append(("c", None, np.stack([np.einsum("abd,abd->d", back, place) for place in places])))
    by_class = _order(flat)
    classes = flat.take(by_class)
    at = _runs(classes)
    own, classes = np.add.reduceat(g_r.reshape(-1, DIM).take(by_class, axis=0), at, axis=0), classes.take(at)
    nodes = tree.node_of.take(classes)
    at = _runs(nodes)
    steps += [("own", classes, own), ("node", nodes.take(at), np.add.reduceat(own, at, axis=0))]
    for k, rows, grad in steps:
        _descend(p, state, k, rows, grad)
    return n


def _picked_minus_log_sum(score: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Log probability of child `own` of every token; `score` has a row per child."""
    score -= score.max(axis=0)
    picked = score[own, np.arange(len(own))]
    return picked - np.log(np.exp(score, out=score).sum(axis=0))


def log_probs(p: dict, tree: Tree, seq: np.ndarray) -> np.ndarray:
    """Normalised natural-log probability of every predicted token of `seq`, in order: of its node on each level.

    Matrix products of the contexts with all children of a node give the scores of all of them.
    """
    r = p["node"].take(tree.node_of.take(seq), axis=0) + p["own"].take(seq, axis=0)
    pred = sum(r[CONTEXT - 1 - i: len(seq) - 1 - i] * p["c"][i] for i in range(CONTEXT))
    target = seq[CONTEXT:]
    kept = np.flatnonzero(target != tree.size)
    by_class = _order(target.take(kept))
    order = kept.take(by_class)
    y, x = target.take(order), pred.take(order, axis=0)
    y2 = tree.leaf2.take(y)
    y1 = tree.mid1.take(y2)
    got = np.zeros(len(y), np.float32)

    def add(q, b, own, cuts, first, last):
        for lo, hi, a, z in zip(cuts[:-1], cuts[1:], first, last):
            for at in range(lo, hi, CHUNK):
                end = min(at + CHUNK, hi)
                score = q[a:z] @ x[at:end].T
                score += b[a:z, None]
                got[at:end] += _picked_minus_log_sum(score, own[at:end] - a)

    if len(y):
        w = tree.width
        add(p["q1"], tree.log1, y1, [0, len(y)], [0], [tree.n1])
        for q, b, own, up, limit in (("q2", tree.log2, y2, y1, tree.n2), ("q3", tree.log3, y, y2, tree.size)):
            cut = _runs(up)
            first = (up[cut].astype(np.int64) * w).tolist()
            add(p[q], b, own, [*cut.tolist(), len(y)], first, [min(f + w, limit) for f in first])
    out = np.empty(len(y))
    out[by_class] = got
    return out


# --- on Spark ------------------------------------------------------------------------
def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    ident = key_column(id_col)
    return docs.select(ident.alias("doc_id"), held_out(ident, 10, 0).alias("held_out"),
                       key_column(text_col).cast("binary").alias("text"))


def token_counts(src: DataFrame) -> DataFrame:
    """(token_hash, token, group, n) of all tokens of the rows of `src`, as the training counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            words = list(held)
            return pa.RecordBatch.from_arrays(
                [pa.array(map(token_hash, words), pa.int64()), pa.array(words, pa.binary()),
                 pa.array(map(group, words), pa.int32()), pa.array(held.values(), pa.int64())],
                names=["token_hash", "token", "grp", "n"])

        for batch in batches:
            for text in batch.column("text"):
                held.update(tokens(text.as_py()))
                if len(held) > FLUSH:
                    yield flush()
                    held = Counter()
        if held:
            yield flush()

    counted = src.select("text").mapInArrow(count, "token_hash long, token binary, grp int, n long")
    # Tokens are keys, not aggregates, so the sums are hashed and nothing is sorted.
    return counted.groupBy("token_hash", "grp", "token").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From the written counts; the driver gets about KNOWN tokens, six masses and as many different counts at most.

    The most frequent tokens are told by the count that KNOWN of them reach, not by a sort, which would bring the first of
    every partition to one task. Of the tokens that have just that count, those with the least hashes are taken.
    """
    total = counts.groupBy("grp").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    above, limit, share = 0, 0, 0.0
    for r in counts.groupBy("n").agg(F.count("*").alias("tokens")).orderBy(F.desc("n")).limit(KNOWN + 1).collect():
        if above + r["tokens"] > KNOWN:
            limit, share = r["n"], (KNOWN - above) / r["tokens"]
            break
        above += r["tokens"]
    least = min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))
    chosen = (F.col("n") > limit) | ((F.col("n") == limit) & (F.col("token_hash") < F.lit(least)))
    top = counts.where(chosen).select("token", "n").toArrow()
    known = dict(zip(top.column("token").to_pylist(), top.column("n").to_pylist(), strict=True))
    mass = np.zeros(GROUPS)
    for r in total:
        mass[r["grp"]] = r["n"] + ADD * r["v"]
    n, v = sum(r["n"] for r in total), sum(r["v"] for r in total)
    for t, k in known.items():  # classes of their own are no part of their group
        mass[group(t)] -= k + ADD
    return Vocabulary(known, n, v, np.maximum(mass, 0.0))


def fit(src: DataFrame, vocab: Vocabulary, tree: Tree) -> dict[str, np.ndarray]:
    """Parameters after two rounds, each averaged over all tasks by their tokens.

    Tasks send what they changed as slices of SLICE half-precision numbers, and every slice is averaged
    by itself. Partitions are put together to at most MOST_TASKS tasks.
    """
    p = init(tree)
    ends = np.cumsum([x.size for x in p.values()])
    # A rule of the corpus, alike for all tasks and partitions: few tokens are passed over more often.
    passes = int(min(MOST_PASSES, max(1, -(-ENOUGH // max(1, vocab.n)))))

    def learn(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
        own, rng = {k: x.copy() for k, x in p.items()}, np.random.default_rng(SEED)
        state = {k: np.full_like(x, 1e-5) for k, x in own.items()}
        held, size, seen = [], 0, 0

        def learn_block() -> int:
            n = seen
            seq = vocab.numbered(held)
            for _ in range(passes):
                n = train(own, tree, seq, state, rng, n)
            return n

        limit = BLOCK if whole else FIRST_BLOCK
        for text in (t for batch in batches for t in batch.column("text")):
            held.append(tokens(text.as_py()))
            size += len(held[-1])
            if size >= limit:
                seen = learn_block()
                held, size = [], 0
                if not whole:
                    break
        if held:
            seen = learn_block()
        if seen:
            change = np.concatenate([(x - p[k]).ravel() for k, x in own.items()]).astype(np.float16)
            parts = [change[i: i + SLICE].tobytes() for i in range(0, len(change), SLICE)]
            for at in range(0, len(parts), 64):
                some = parts[at: at + 64]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(at, at + len(some)), pa.int32()), pa.array([float(seen)] * len(some)), pa.array(some, pa.binary())],
                    names=["slice", "weight", "change"])

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, float] = {}
        mean: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, weight, data in zip(*(batch.column(c).to_pylist() for c in range(3))):
                each = np.frombuffer(data, np.float16).astype(np.float32)
                total[i] = total.get(i, 0.0) + weight
                mean[i] = each if i not in mean else mean[i] + (each - mean[i]) * np.float32(weight / total[i])
        if mean:
            yield pa.RecordBatch.from_arrays(
                [pa.array(mean, pa.int32()), pa.array([total[i] for i in mean]), pa.array([x.tobytes() for x in mean.values()], pa.binary())],
                names=["slice", "weight", "change"])

    schema = "slice int, weight double, change binary"
    texts = src.select("text").coalesce(MOST_TASKS)
    for whole in (False, True):
        each = materialize(texts.mapInArrow(lambda batches, whole=whole: learn(batches, whole), schema), "lm-rounds")
        got = each.repartition("slice").mapInArrow(average, schema).collect()  # the size of the parameters, whatever the corpus
        if not got:
            break
        flat = np.concatenate([np.frombuffer(bytes(r["change"]), np.float32) for r in sorted(got, key=lambda r: r["slice"])])
        p = {k: (x + c.reshape(x.shape)).astype(np.float32) for (k, x), c in zip(p.items(), np.split(flat, ends[:-1]))}
    return p


def _score_rows(src: DataFrame, vocab: Vocabulary, tree: Tree, p: dict) -> DataFrame:
    """Per text: sums over its frequent tokens, and hashes and counts of the others."""
    base_total = vocab.n + ADD * (vocab.v + 1)
    log_total = math.log10(base_total)
    group_log = np.log10(np.maximum(vocab.mass + ADD, ADD))  # each group holds one unseen type more
    n_classes = len(vocab.class_of)

    def run(batch: pa.RecordBatch) -> dict:
        n = batch.num_rows
        out = {"n_tokens": np.zeros(n, np.int64), "n_known": np.zeros(n, np.int64), "base": np.zeros(n), "model": np.zeros(n)}
        rare_hash, rare_n, rare_ends = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.zeros(1, np.int64)]

        def score_block(at: int, texts: list[list[bytes]]):
            """Sums of the texts from row `at` on."""
            words = list(chain.from_iterable(texts))
            size = np.array([len(t) for t in texts])
            first, rows = np.r_[0, np.cumsum(size)[:-1]], slice(at, at + len(texts))
            ids = vocab.classes(words)
            others = np.flatnonzero(ids < 0)
            logs = np.where(ids < 0, 0.0, vocab.log_of.take(np.maximum(ids, 0))) if n_classes else np.zeros(len(ids))
            out["n_tokens"][rows], out["n_known"][rows] = size, size - np.add.reduceat(ids < 0, first, dtype=np.int64)
            out["base"][rows] = np.add.reduceat(logs, first) - size * log_total
            rare = [words[j] for j in others.tolist()]
            groups = np.fromiter(map(group, rare), dtype=np.int32, count=len(rare))
            ids[others] = n_classes + groups
            # Each text begins with its starts; its tokens follow.
            seq = np.full(len(ids) + CONTEXT * len(texts), vocab.start, dtype=np.int32)
            place = np.arange(len(ids)) + CONTEXT * np.repeat(np.arange(1, len(texts) + 1), size)
            seq[place] = ids
            model = log_probs(p, tree, seq) / np.log(10)
            model[others] -= group_log.take(groups)
            out["model"][rows] = np.add.reduceat(model, first)
            hashes = np.fromiter(map(token_hash, rare), dtype=np.int64, count=len(rare))
            of = np.searchsorted(first, others, side="right") - 1
            order = np.lexsort((hashes, of))
            hashes, of = hashes[order], of[order]
            new = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])][: len(hashes)])
            rare_hash.append(hashes[new])
            rare_n.append(np.diff(np.r_[new, len(hashes)]))
            rare_ends.append(rare_ends[-1][-1] + np.cumsum(np.bincount(of[new], minlength=len(texts))))

        at, block, held = 0, [], 0
        for text in batch.column("text"):
            block.append(tokens(text.as_py()))
            held += len(block[-1])
            if held >= BLOCK:
                score_block(at, block)
                at, block, held = at + len(block), [], 0
        if block:
            score_block(at, block)
        ends = pa.array(np.concatenate(rare_ends), pa.int32())
        return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                **{k: pa.array(x) for k, x in out.items()},
                **{k: pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x))) for k, x in (("rare", rare_hash), ("rare_n", rare_n))}}

    kind = src.schema["doc_id"].dataType.simpleString()
    rows = arrow_map(src, run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, model double, "
                               "rare array<long>, rare_n array<long>")
    return materialize(rows.withColumn("row_id", F.monotonically_increasing_id()), "lm-rows")


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows that are not held out (null ids are learned from). Scores are log10
    probabilities of whole texts with their end; a null text is empty. With nothing to learn from,
    every token is unseen and the model is uniform. Repeated rows stay repeated (and count as often);
    an empty table gives no rows; other columns are not read.
    """
    src = _source(docs, id_col, text_col)
    counts = materialize(token_counts(src.where("not held_out")), "lm-counts")
    vocab = vocabulary(counts)
    tree = Tree(vocab.prior)
    rows = _score_rows(src, vocab, tree, fit(src.where("not held_out"), vocab, tree))
    rare = rows.select("row_id", F.explode(F.arrays_zip("rare", "rare_n")).alias("r")).select(
        "row_id", F.col("r.rare").alias("token_hash"), F.col("r.rare_n").alias("k"))
    by_hash = counts.groupBy("token_hash").agg(F.sum("n").alias("n"))  # tokens of one hash are one, as in the rows
    found = rare.join(by_hash, "token_hash", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    sums = found.groupBy("row_id").agg(
        F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("more_known"),
        F.sum(F.col("k") * F.log10(F.col("n") + ADD)).alias("rest"),
        F.sum("k").alias("n_rest"))
    base_total = vocab.n + ADD * (vocab.v + 1)
    rest = F.coalesce("rest", F.lit(0.0))
    return rows.join(sums, "row_id", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.n).cast("long").alias("train_tokens"), (F.col("base") + rest).alias("base_score"),
        (F.col("model") + rest).alias("score"))
