from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pitwise.llm import langid, lm, quality

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# --- op4 -----------------------------------------------------------------------------
def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_lm_base_equals_brute_force_and_model_beats_it_held_out(docs):
    rows = {r.doc_id: r for r in lm.score(docs).collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    toks = {d: [*re.findall(r"[^\x20\x09-\x0D]+", low(t)), "\n"] for d, t in text.items()}
    out = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d in text}
    c = Counter(w for d, ws in toks.items() if not out[d] for w in ws)
    n, v = sum(c.values()), len(c)
    for d, ws in toks.items():
        r = rows[d]
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[d], len(ws), sum(c[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    held = [r for d, r in rows.items() if out[d]]
    gain = sum(r.score - r.base_score for r in held) / sum(r.n_tokens for r in held)
    assert gain > 0.238
    assert sum(r.score > r.base_score for r in held) >= 0.98 * len(held)


def small_vocab():
    known = {b"a": 50, b"b.": 20, lm.END: 10} | {f"w{i}".encode(): 3 for i in range(500)}
    mass = np.zeros(lm.GROUPS)
    full = lm.Vocabulary(known, sum(known.values()), len(known), mass)
    for t, k in known.items():
        if t not in full.class_of:
            mass[lm.group(t)] += k + lm.ADD
    return lm.Vocabulary(known, full.n, full.v, mass)


def test_lm_probabilities_are_normalised():
    vocab = small_vocab()
    tree = lm.Tree(vocab.prior)
    rng = np.random.default_rng(0)
    p = {k: x + rng.standard_normal(x.shape).astype(np.float32) * 0.3 for k, x in lm.init(tree).items()}
    for context in ([vocab.start] * 3, [3, 1, vocab.start], [500, 7, 2]):
        every = np.concatenate([[*context[::-1], c] for c in range(vocab.size)]).astype(np.int32)
        logs = lm.log_probs(p, tree, every)  # the contexts' own tokens are predicted too
        seq = every[lm.CONTEXT:]
        last = np.arange(len(seq)) % 4 == 0
        assert np.exp(logs[np.cumsum(seq != vocab.start)[last] - 1]).sum() == pytest.approx(1, abs=1e-5)
    # within a group: known tokens and the unseen one share its mass
    rest = [t for t in vocab.counts if t not in vocab.class_of and lm.group(t) == 0]
    assert sum(vocab.counts[t] + lm.ADD for t in rest) == pytest.approx(vocab.mass[0])
    assert sum(vocab.prior) == pytest.approx(1) and tree.p1.sum() == pytest.approx(1)


def test_lm_vocabulary_is_the_most_frequent_tokens(spark, monkeypatch):
    rows = [(f"w{i}".encode(), 1 + i // 40) for i in range(1000)]  # 40 tokens of each count
    counts = spark.createDataFrame([(lm.token_hash(t), lm.group(t), t, n) for t, n in rows], "token_hash long, grp int, token binary, n long")
    for known in (300, 320, 10, 5000):
        monkeypatch.setattr(lm, "KNOWN", known)
        vocab = lm.vocabulary(counts)
        taken, full = vocab.counts, known // 40 * 40
        assert all(taken[t] == n for t, n in rows if t in taken) and vocab.n == sum(n for _, n in rows) and vocab.v == 1000
        assert {t for t, n in sorted(rows, key=lambda x: -x[1])[:full]} <= set(taken)
        assert abs(len(taken) - min(known, 1000)) <= 12  # ties are parted by hash
        outside = sum(n + lm.ADD for t, n in rows if t not in taken)
        assert vocab.mass.sum() == pytest.approx(outside)


def test_lm_untrained_model_is_the_prior():
    vocab = small_vocab()
    tree = lm.Tree(vocab.prior)
    p = {k: np.zeros_like(x) for k, x in lm.init(tree).items()}
    seq = vocab.numbered([[b"a", b"b.", b"w3", b"unseen,", lm.END], [lm.END]])
    assert seq[:3].tolist() == seq[8:11].tolist() == [vocab.start] * 3 and seq[6] == len(vocab.class_of) + lm.group(b"unseen,")
    assert lm.log_probs(p, tree, seq) == pytest.approx(np.log(vocab.prior[seq[seq != vocab.start]]), abs=1e-4)


def test_lm_scores_follow_the_formula():
    """Against sums written out for one token: three tokens before it, a softmax on each of the levels."""
    vocab = small_vocab()
    tree = lm.Tree(vocab.prior)
    rng = np.random.default_rng(3)
    p = {k: rng.standard_normal(x.shape).astype(np.float32) * 0.5 for k, x in lm.init(tree).items()}
    seq = np.array([vocab.start] * 3 + [5, 80, 300], dtype=np.int32)
    x = sum(p["c"][i] * (p["node"][tree.node_of[t]] + p["own"][t]) for i, t in enumerate((80, 5, vocab.start)))
    want, w = 0.0, tree.width
    for q, prior, child, n in (("q1", tree.p1, 300 // w // w, tree.n1), ("q2", tree.p2, 300 // w, tree.n2), ("q3", tree.p3, 300, tree.size)):
        first = 0 if q == "q1" else child // w * w
        kids = range(first, n if q == "q1" else min(first + w, n))
        score = {c: math.exp(math.log(prior[c]) + float(p[q][c] @ x)) for c in kids}
        want += math.log(score[child] / sum(score.values()))
    assert lm.log_probs(p, tree, seq)[2] == pytest.approx(want, abs=1e-4)


def learned(vocab, ids, passes):
    """Mean log probability of a cycle of tokens after training, all of them alike in the prior."""
    prior = np.full(vocab.size, 1e-9)
    prior[ids] = 0.25
    tree = lm.Tree(prior / prior.sum())
    seq = np.r_[[vocab.start] * 3, np.tile(ids, 3000)].astype(np.int32)
    p = lm.init(tree)
    state, rng, seen = {k: np.full_like(x, 1e-5) for k, x in p.items()}, np.random.default_rng(2), 0
    for _ in range(passes):
        seen = lm.train(p, tree, seq, state, rng, seen)
    assert seen == passes * 12_000  # every token, the last run's too
    return lm.log_probs(p, tree, seq).mean()


def test_lm_noise_contrastive_training_learns_a_chain():
    vocab = small_vocab()
    assert len(vocab.class_of) == len(vocab.counts) and vocab.mass.sum() == 0
    w = lm.Tree(vocab.prior).width
    for ids in ([0, 1, 2, 3], [0, w, 2 * w, 3 * w], [0, w * w, 2 * w * w, 3 * w * w]):  # told apart on each of the levels
        assert learned(vocab, np.array(ids), 8) > math.log(0.25) / 2


def test_lm_gradient_is_that_of_the_objective():
    """Numerical derivative of the noise-contrastive loss of a node with its noise summed."""
    rng = np.random.default_rng(1)
    x, q = rng.standard_normal((5, 4)), rng.standard_normal((3, 4))
    prior, own = np.array([0.5, 0.3, 0.2]), np.array([0, 2, 1, 1, 0])

    def loss(shift):
        logit = x @ q.T + shift - math.log(lm.NOISE)
        return (np.log1p(np.exp(-logit[np.arange(5), own])).sum()
                + (lm.NOISE * prior * np.log1p(np.exp(logit))).sum())

    got = lm._nce(x.astype(np.float32), q.astype(np.float32), prior, own).sum(axis=0)
    want = [(loss(e) - loss(-e)) / 2e-5 for e in np.eye(3) * 1e-5]
    assert got == pytest.approx(want, rel=1e-3)


def test_lm_step_takes_inner_nodes_together(monkeypatch):
    """Node by node there are matrix products only; rows of a table are replaced like by plain indexing."""
    rng = np.random.default_rng(7)
    prior = rng.random(1_000)
    tree = lm.Tree(prior / prior.sum())
    calls, plain = [], lm._nce
    monkeypatch.setattr(lm, "_nce", lambda *a: calls.append(1) or plain(*a))
    seq = rng.integers(0, 1_000, (8, lm.SEGMENT + lm.CONTEXT)).astype(np.int32)
    got = []
    for part in (lm.PART, 1, 100):  # nodes all at once, one by one, some at a time
        monkeypatch.setattr(lm, "PART", part)
        p = lm.init(tree)
        p["q2"] += np.random.default_rng(9).standard_normal(p["q2"].shape).astype(np.float32)
        state = {k: np.full_like(x, 1e-5) for k, x in p.items()}
        calls.clear()
        assert lm._step(p, tree, seq, state, np.random.default_rng(8)) == 8 * lm.SEGMENT
        assert len(calls) == -(-8 * lm.SEGMENT // part) and tree.n1 == 10
        got.append((p, state))
    for p, state in got[1:]:
        for k in p:
            assert state[k] == pytest.approx(got[0][1][k], rel=1e-3, abs=1e-9)
    table, rows = rng.random((50, lm.DIM), dtype=np.float32), np.array([3, 49, 7])
    want, values = table.copy(), rng.random((3, lm.DIM), dtype=np.float32)
    want[rows] = values
    lm._put(table, rows, values)
    assert (table == want).all()


def test_lm_tree_keeps_like_spelling_together():
    known = {f"{a}{b}ung".encode(): 5 for a in "bdfghk" for b in "aeiou"} | {f"{a}{b}tion".encode(): 5 for a in "bdfghk" for b in "aeiou"}
    order = lm.spelling_order(known)
    assert sorted(order) == sorted(known) and lm.spelling_order({b"x": 1}) == [b"x"] and lm.spelling_order({}) == []
    ends = [w.endswith(b"ung") for w in order]
    assert sum(a != b for a, b in zip(ends, ends[1:])) <= 2  # at most a few changes from one ending to the other


def test_lm_partitions_learn_alike(docs):
    """The passes follow from the corpus, not from a task: any partitioning learns, and reads every token."""
    some = docs.where("doc_id % 2 = 0")
    gains = []
    for n in (1, 7):
        held = lm.score(some.repartition(n)).where("held_out").collect()
        gains.append(sum(r.score - r.base_score for r in held) / sum(r.n_tokens for r in held))
    assert min(gains) > 0.12


def test_lm_messy_and_empty(messy, empty):
    got = lm.score(messy).collect()
    assert len(got) == messy.count() and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (2, 3, 4)} == {1}
    assert lm.score(empty).count() == 0


# --- op5 -----------------------------------------------------------------------------
def brute_grams(text):
    c = Counter()
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        w = f"\0{word}\0"
        for n in (1, 2, 3):
            c.update(g for i in range(len(w) - n + 1) for g in [w[i:i + n]] if g.strip("\0") and "\0" not in g[1:-1])
    return c


def test_language_ngrams_and_distance_equal_brute_force():
    text = "The cat, the hat & l'été: 42 Öl-Kanne"
    grams, counts = langid.ngrams(text)
    want = Counter()
    for g, k in brute_grams(text).items():
        code = 0
        for ch in g:
            code = code << 21 | ord(ch) * (ch != "\0")
        want[code] += k
    assert dict(zip(grams.tolist(), counts.tolist(), strict=True)) == {k: v for k, v in want.items()}
    own = langid.ranking(grams, counts, 10)
    assert own.tolist() == sorted(want, key=lambda k: (-want[k], k))[:10]


def test_language_held_out_accuracy_and_long_text(docs):
    rows = langid.identify(docs).collect()
    lang = {r.doc_id: r.lang for r in docs.collect()}
    held = [r for r in rows if r.held_out]
    assert len(held) > 150 and sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    long = "the cat and the hat " * 120_000
    a, b = langid.ngrams(long), langid.ngrams("the cat and the hat " * 1_200)
    assert (a[0] == b[0]).all() and langid.ranking(*a).tolist() == langid.ranking(*b).tolist()


def test_language_messy_and_empty(spark, messy, empty):
    got = langid.identify(messy, messy.where("lang is not null")).collect()
    assert len(got) == messy.count()
    assert {r.lang_pred for r in got if r.doc_id in (2, 3, 4, 6)} == {"und"}
    assert {r.score for r in got if r.lang_pred == "und"} == {0.0}
    assert {r.lang_pred for r in got if r.doc_id == 7} == {"de"}
    assert langid.identify(empty).count() == 0
    assert {r.lang_pred for r in langid.identify(messy, empty).collect()} == {"und"}


# --- op8 -----------------------------------------------------------------------------
def test_quality_held_out_accuracy(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in rows.items())
    held = [(rows[r.doc_id].predicted, r.quality) for r in labels.collect() if rows[r.doc_id].held_out]
    assert sum(a == b for a, b in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())


def brute_pool(p, text):
    blocks = -(-len(text) // quality.HALF) + 1
    raw = text + bytes(blocks * quality.HALF - len(text))
    w = np.vstack([p["first"], p["second"]])
    out = [p["embed"][np.frombuffer(raw[i * 8:i * 8 + 16], np.uint8)].reshape(-1) @ w + p["bias"] for i in range(blocks - 1)]
    return np.maximum(np.max(out, axis=0), 0) if out else np.zeros(quality.FILTERS)


def test_quality_network_covers_the_whole_text(monkeypatch):
    p = quality.init()
    texts = [b"", b"a", b"x" * 15, b"some words of a text, " * 40, b"tail" + b"." * 3000 + b"$$$%%%"]
    want = np.array([quality._combine(p, brute_pool(p, t)[None])[0] for t in texts])
    assert quality.predict(p, texts) == pytest.approx(want, abs=1e-5)
    monkeypatch.setattr(quality, "PIECE", 64)
    assert quality.predict(p, texts) == pytest.approx(want, abs=1e-5)


def test_quality_gradients_match_differences():
    p = {k: x.astype(np.float64) for k, x in quality.init().items()}
    texts, label, weight = [b"hello world, this is text", b"$$$ ### %%%"], np.array([1.0, 0.0]), np.ones(2)

    def loss(q):
        s = quality._combine(q, quality._pool(q, texts))
        return -(weight * (label * np.log(s) + (1 - label) * np.log(1 - s))).mean()

    g = quality._gradients(p, texts, label, weight)
    rng = np.random.default_rng(1)
    for k in p:
        at = tuple(int(rng.integers(0, n)) for n in p[k].shape) if k != "embed" else (ord("$"), 2)
        q = {n: x.copy() for n, x in p.items()}
        q[k][at] += 1e-6
        assert (loss(q) - loss(p)) / 1e-6 == pytest.approx(g[k][at], abs=1e-4)


def test_quality_messy_and_empty(spark, messy, empty):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (7, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.classify(messy, labels).collect()
    assert len(got) == messy.count() and len({r.score for r in got if r.doc_id in (2, 3)}) == 1
    kept = quality.keep_good(messy, labels)
    assert kept.columns == messy.columns and kept.count() == sum(r.predicted for r in got)
    assert quality.classify(messy, labels.limit(0)).count() == messy.count()
    assert quality.classify(empty, labels).count() == 0 and quality.keep_good(empty, labels).count() == 0


def test_language_answer_equals_brute_force_distance(spark):
    """Out-of-place distance written out: how far each of a text's n-grams is from its rank in a profile, at most `ranks`."""
    ranks = 30
    train = spark.createDataFrame([("a", "banana bandana cabana"), ("a", "banal cabal canal"), ("b", "the three thin thieves"),
                                   ("b", "then this thing"), ("c", "über öl übel")], "lang string, text string")
    texts = ["banana", "thing", "übel", "the banana", "zzz", "xyz the", "canal this öl", "a", "123", None, "tttt nnnn aaaa"]
    docs = spark.createDataFrame([(i, t, "none") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    ranked = {}
    for r in langid.profiles(train, ranks=ranks).collect():
        ranked.setdefault(r.lang, {})[r.gram] = r.rank
    assert all(sorted(p.values()) == list(range(len(p))) and len(p) <= ranks for p in ranked.values())
    got = {r.doc_id: r for r in langid.identify(docs, train, ranks=ranks).collect()}
    for i, t in enumerate(texts):
        own = langid.ranking(*langid.ngrams(t), ranks).tolist()
        if not own:
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        distance = {lang: sum(min(abs(p[g] - k), ranks) if g in p else ranks for k, g in enumerate(own)) for lang, p in ranked.items()}
        first, second = sorted(distance.items(), key=lambda x: (x[1], x[0]))[:2]
        assert got[i].lang_pred == first[0]
        assert got[i].score == pytest.approx((second[1] - first[1]) / second[1] if second[1] else 0.0)


def test_language_profiles_are_limited_before_the_exchange(spark):
    train = spark.createDataFrame([("a", "banana")], "lang string, text string")
    plan = langid.profiles(train)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
