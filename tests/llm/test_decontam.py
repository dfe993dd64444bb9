from __future__ import annotations

from pitwise.llm import decontam

ITEM = ("Maria buys 12 apples for 3 dollars each and gives 12 of them to Peter before "
        "the train leaves the old station at noon with 40 people on board.")


def frames(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")


def test_finds_copies_and_reparameterised_questions(spark):
    changed = ITEM.replace("Maria", "Ingrid").replace("Peter", "Paul").replace("12", "17").replace("40", "88").replace("dollars", "euros")
    broken = ITEM.replace("gives 12", "gives 99")  # the two equal numbers differ now
    texts = [ITEM, f"Intro words come first. {ITEM} And more text follows here.", changed,
             ITEM.upper(), ITEM.replace(",", "").replace(".", ""), broken,
             "An unrelated text about apples and trains that leaves the station at noon.", ITEM[: len(ITEM) // 2]]
    docs, items = frames(spark, texts, [ITEM])
    got = {r.doc_id: r for r in decontam.contaminated(docs, items).collect()}
    assert {0, 1, 2, 3, 4} <= set(got) and not {6, 7} & set(got)
    assert got[0].n_changed == 0 and got[1].n_changed == 0 and got[0].coverage == 1.0
    assert got[2].n_changed >= 4
    assert 5 not in got or got[5].n_matched < got[5].n_windows  # inconsistent windows don't count


def test_slot_consistency_rejects_mixed_values():
    m = [{"pos": i, "item_pos": i, "item_slots": ["1:1:5"], "slots": [f"1:1:{i}"]} for i in range(4)]
    assert decontam.judge(m)[0] == 1  # one value of the item can't be four in the document
    same = [{"pos": i, "item_pos": i, "item_slots": ["1:1:5"], "slots": ["1:1:8"]} for i in range(4)]
    assert decontam.judge(same) == (4, 1)


def brute(doc, item, size=5):
    """Share of the item's windows (folded words) found in the document."""
    def grams(t):
        w = [x.strip(".,:;!?").lower() for x in t.split()]
        w = [x for x in w if x]
        return [tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))]
    own = set(grams(doc))
    g = grams(item)
    return sum(x in own for x in g) / len(g)


def test_equals_brute_force_on_the_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, items).collect()}
    bench = [(r.item_id, r.text) for r in items.collect()]
    want = {(d.doc_id, i) for d in docs.collect() for i, t in bench if brute(d.text, t) >= 0.8}
    assert got == want and want


def test_unbounded_benchmark_gives_the_same_rows(spark, monkeypatch):
    docs, items = frames(spark, [ITEM, "other words in a text that has no item", ITEM], [ITEM, "short item", ""])
    one = sorted(map(tuple, decontam.contaminated(docs, items).collect()))
    monkeypatch.setattr(decontam, "bounded", lambda *a: False)
    assert sorted(map(tuple, decontam.contaminated(docs, items).collect())) == one and len(one) == 2


def test_messy_and_empty(spark, messy, empty):
    _, items = frames(spark, [], ["Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu", None, " "])
    got = [r.doc_id for r in decontam.contaminated(messy, items).collect()]
    assert sorted(got, key=str) == [1, None]
    kept = decontam.remove_contaminated(messy, items)
    assert kept.columns == messy.columns and kept.count() == messy.count() - 3
    assert decontam.contaminated(empty, items).count() == 0
    assert decontam.contaminated(messy, items.limit(0)).count() == 0
    assert decontam.remove_contaminated(messy, items.limit(0)).count() == messy.count()


def test_template_kinds_and_pieces(monkeypatch):
    text = 'He met Anna Lee at 5km, "10 kg" and 3,000.50 $ (NASA). "Then Bob left... é É ÉCOLE 7 oaks'
    h, kind, forms = decontam.template(text)
    words = [forms[i] for i in range(len(h))]
    assert words == ["he", "met", "anna", "lee", "at", "5", "km", "10", "kg", "and", "3,000.50", "$", "nasa", "then",
                     "bob", "left", "é", "é", "école", "7", "oaks"]
    assert kind.tolist() == [0, 0, 3, 3, 0, 1, 2, 1, 2, 0, 1, 2, 0, 0, 3, 0, 0, 3, 0, 1, 0]
    assert all(x == decontam._hash_form(w) for x, w in zip(h, words, strict=True))
    long = " ".join([text] * 50)
    whole = decontam.windows(long)
    monkeypatch.setattr(decontam, "PIECE", 97)
    pieces = decontam.windows(long)
    assert (whole[0] == pieces[0]).all() and (whole[1] == pieces[1]).all() and whole[3] == pieces[3]
    keep = list(range(40))
    assert whole[2].pick(keep) == pieces[2].pick(keep)


def test_items_without_a_usable_window_are_found_inside_longer_texts(spark):
    items = ["What is 12 + 30 * 7?", "Compute 3 x 4 + 5 x 6 - 7", "Who wrote Faust early?", "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20"]
    texts = [f"Some words come before. {x} And several words follow it here." for x in items]
    texts += ["Some words come before. What is 14 + 31 * 9? And more.", "Numbers 21 22 23 24 25 26 27 28 29 30 31 32 33 34 35 36 37 38 39 40",
              "Who wrote this early text about Faust, and what is in it?"]
    docs, bench = frames(spark, texts, items)
    got = {(r.doc_id, r.item_id): r for r in decontam.contaminated(docs, bench).collect()}
    assert set(got) == {(0, 0), (1, 1), (2, 2), (3, 3), (4, 0)}
    assert got[4, 0].n_changed == 3 and got[0, 0].n_changed == 0


def test_a_changed_name_that_starts_sentences_is_found(spark):
    item = "Tom has 5 apples. Tom eats 2 of them. How many apples does Tom have now?"
    docs, items = frames(spark, [item.replace("Tom", "Ana"), f"Words before. {item.replace('Tom', 'Ana')} Words after."], [item])
    got = {r.doc_id: r for r in decontam.contaminated(docs, items).collect()}
    assert set(got) == {0, 1} and got[0].n_changed == 1


def test_every_text_of_an_item_id_is_searched(spark):
    other = "The quick brown fox of the old tale jumps over a lazy dog that sleeps."
    docs, _ = frames(spark, [f"Before it. {ITEM}", f"Before it. {other}", f"{ITEM} {other}"], [])
    for ids in ((1, 1), (None, None)):
        items = spark.createDataFrame(list(zip(ids, [ITEM, other], strict=True)), "item_id long, text string")
        got = [(r.doc_id, r.item_id) for r in decontam.contaminated(docs, items).collect()]
        assert sorted(got) == [(i, ids[0]) for i in range(3)]


def test_a_shared_opening_brings_no_pairs_together(spark):
    """300 documents and 300 items begin alike; only what is their own makes a pair, and no leak is lost."""
    opening = "consider the following question about the history of a small town and answer it in one short sentence please"
    own = [" ".join(f"w{i}x{k}" for k in range(25)) for i in range(300)]
    items = spark.createDataFrame([(i, f"{opening} {w}") for i, w in enumerate(own)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"{opening} {own[i] if i % 10 == 0 else f'other words of text {i} go on here'} end")
                                  for i in range(300)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, items).collect()}
    assert got == {(i, i) for i in range(0, 300, 10)}
    rows = decontam._matches(decontam._keyed(items, "item_id"), None, decontam.WINDOW)
    rows = rows.select("hash", rows.pos.alias("item_pos"), "n_windows", rows.text_hash.alias("item_hash"))
    found = decontam._matches(decontam._keyed(docs, "doc_id"), None, decontam.WINDOW)
    assert decontam.candidate_pairs(found, rows, decontam.COVERAGE).count() == 30
