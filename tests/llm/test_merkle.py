from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from pitwise.llm import merkle


def sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(row, low=False) -> str:
    out = []
    for c in merkle.FIELDS:
        v = row[c]
        if c == "text" and low and v is not None:
            v = "".join(x.lower() if "A" <= x <= "Z" else x for x in v)
        out.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return sha(*out)


def climb(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Top node and, for each of `nodes`, the (before, after) siblings of its ancestors."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            run = nodes[p // 8 * 8: p // 8 * 8 + 8]
            paths[i].append(("".join(run[: p % 8]), "".join(run[p % 8 + 1:])))
        nodes = [sha(*nodes[i: i + 8]) for i in range(0, len(nodes), 8)]
        at = [p // 8 for p in at]
    return nodes[0], paths


def brute(rows: list) -> list[tuple]:
    rows = sorted(rows, key=lambda r: (r["lang"] is not None, (r["lang"] or "").encode(), r["doc_id"] is not None,
                                       r["doc_id"] or 0, brute_leaf(r)))
    langs = list(dict.fromkeys(r["lang"] for r in rows))
    groups = {g: [r for r in rows if r["lang"] == g] for g in langs}
    tops = {g: climb([brute_leaf(r) for r in groups[g]]) for g in langs}
    root, upper = climb([tops[g][0] for g in langs])
    out = []
    for i, g in enumerate(langs):
        for r, path in zip(groups[g], tops[g][1]):
            path = [*path, *upper[i]]
            forged = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            node = brute_leaf(r, low=forged)
            for before, after in path:
                node = sha(before, node, after)
            out.append((r["doc_id"], brute_leaf(r), tops[g][0], root, sha(*(x for p in path for x in p)), node, node == root))
    return out


def result(df) -> list[tuple]:
    return sorted((tuple(r) for r in merkle.verify(df).collect()), key=repr)


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 8}, {"en": 9}, {"en": 73, "fr": 1, None: 2, "é": 64, "Z": 65},
                                   {f"l{i}": 1 + i % 3 for i in range(20)}])
def test_tree_and_proofs_equal_brute_force(spark, sizes):
    rows = [(100 * g + i, f"Text {i} Ünd {g}\n" * (i % 4), lang, None if i % 5 == 0 else "s", i)
            for g, (lang, n) in enumerate(sizes.items()) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    assert result(df) == sorted(brute(df.collect()), key=repr)


def test_messy_rows_and_empty_table(spark, messy, empty):
    assert result(messy) == sorted(brute(messy.collect()), key=repr)
    assert result(empty) == [] and merkle.verify(empty).columns == [
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_a_third_of_equal_rows_is_split_and_proved(spark):
    rows = [(None, "same", "en", "s", 4)] * 300 + [(i, f"t{i}", "en", "s", 2) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    assert result(df) == sorted(brute(df.collect()), key=repr)


def test_claims_fail_unless_they_are_the_leaf(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "en", "s", 6) for i in range(30)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    claim = F.when(F.col("doc_id") == 7, F.lit("0" * 64))
    rows = merkle.manifest(docs, claims=claim).withColumn("folded", merkle.fold(F.col("claimed"), F.col("path"))).collect()
    assert {r.id for r in rows if r.folded != r.root} == {7}


def test_other_ids_and_groups(spark):
    docs = spark.createDataFrame([("b", "x", 3), ("a", "y", 3), ("c", "z", 1)], "key string, body string, host int")
    rows = {r.id: r for r in merkle.manifest(docs, ["key", "body"], "key", "host").collect()}
    leaf = {k: sha(f"1:{k}", f"1:{v}") for k, v in (("b", "x"), ("a", "y"), ("c", "z"))}
    assert rows["a"].subroot == sha(leaf["a"], leaf["b"]) and rows["c"].subroot == leaf["c"]
    assert rows["b"].root == sha(leaf["c"], rows["a"].subroot)
