from __future__ import annotations

import json
import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from pitwise.llm import decontam, licenses, linefreq, mixing, queries, quality, simhash, wrappers

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- op3 -----------------------------------------------------------------------------
def brute_repeat(words):
    c = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    hit = {j for i in range(len(words) - 4) if c[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    return len(hit)


def test_line_measures_equal_brute_force():
    for text in ["", "a b c", "x y z u v x y z u v", "é ü\né ü\n\n \né ü #$%", "a a a a a a a a", "one\ntwo\none\n1 2\n1 3"]:
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        got = linefreq.measures(text.encode())
        assert got[:5] == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
                           len(lines) - len(set(lines)), brute_repeat(words))


def test_boilerplate_is_removed_and_depleted_documents_go(spark):
    own = [f"document {chr(97 + i)} has words of its own that no other one holds at all {'q' * i}" for i in range(12)]
    rows = [(i, f"Shared line number 7 of the host\n{t}", "h") for i, t in enumerate(own)]
    rows += [(100, "Shared line number 8 of the host\nshared LINE number 9 of the  host\nand two", "h")]
    rows += [(200 + i, "the same copy of one text with many words in it here", "h") for i in range(40)]
    rows += [(300, "Shared line number 7 of the host is not a line elsewhere but words", "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in linefreq.line_rules(docs).collect()}
    assert all(got[i].removed_words == 7 and got[i].kept for i in range(12))
    assert got[100].removed_words == 14 and not got[100].kept and not got[100].base_failed
    assert all(got[200 + i].kept and got[200 + i].removed_words == 0 for i in range(40))  # copies are one document
    assert got[300].removed_words == 0
    cleaned = {r.doc_id: r.text for r in linefreq.clean(docs).collect()}
    assert cleaned[0] == own[0] and 100 not in cleaned and len(cleaned) == 53


def test_line_rules_messy_and_empty(messy, empty):
    got = linefreq.line_rules(messy).collect()
    assert len(got) == messy.count()
    assert all(r.base_failed and not r.kept and r.n_words == 0 for r in got if r.doc_id in (2, 3, 4))
    assert linefreq.line_rules(empty).count() == 0 and linefreq.clean(empty).count() == 0
    assert linefreq.clean(messy).count() == sum(r.kept for r in got)


# --- op7 -----------------------------------------------------------------------------
def brute_scan(text):
    out = []
    units = [("line", i, t) for i, t in enumerate(text.split("\n"))]
    blocks = re.split("\n[ \t\r]*\n", text)
    units += [("block", i, t) for i, t in enumerate(blocks) if "\n" in t]
    units += [("text", 0, text)] if len(blocks) > 1 else []
    for unit, i, part in units:
        own = licenses.bigrams(part)
        best = max(((2 * len(own & b) / (len(own) + len(b)), name) for name, t in licenses.TEMPLATES.items()
                    if own for b in [licenses.bigrams(t)]), key=lambda x: (x[0], [-ord(c) for c in x[1]]), default=(0, ""))
        if best[0] >= licenses.THRESHOLD:
            out.append((unit, i, best[1], round(best[0], 9)))
    return out


def brute_spans(text):
    words = re.findall("[0-9a-z]+", text.translate(str.maketrans(*licenses.LOWER)))
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
    found = []
    for name, body in licenses.TEMPLATES.items():
        own = licenses.bigrams(body)
        at, most = [i for i, g in enumerate(pairs) if g in own], max(2, len(own) // 8)
        cuts = [0, *(i for i in range(1, len(at)) if at[i] - at[i - 1] > most), len(at)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            held = set(pairs[at[a]: at[b - 1] + 1])
            dice = 2 * len(held & own) / (len(held) + len(own))
            if dice >= 0.8:
                found.append((at[a], -at[b - 1], -dice, name))
    out, reached = [], -1
    for start, stop, dice, name in sorted(found):
        if -stop > reached:
            out.append(("span", start, name, round(-dice, 9)))
        reached = max(reached, -stop)
    return out


MIT_PARAGRAPHS = re.sub(r"(conditions: |Software\. )(?=The|THE)", "\\\\1\n\n", re.sub(r"\s+", " ", licenses.TEMPLATES["MIT"]))


def test_licenses_inside_longer_texts_are_found(spark):
    code = "\n".join(f"int f{i}(int x) {{ return x * {i}; }}" for i in range(400))
    header = "\n".join(" * " + line for line in re.sub(r"\s+", " ", licenses.TEMPLATES["Apache-2.0 header"]).split(". "))
    prose = "Some words of prose go here, and they are followed by others. " * 40
    assert MIT_PARAGRAPHS.count("\n\n") == 2
    texts = [f"{prose}\n\n{MIT_PARAGRAPHS}\n\n{prose}", "Copyright 2024 Jane Doe. Licensed under the MIT License.",
             f"/*\n{header}\n */\n{code}", f"{prose} {licenses.TEMPLATES['BSD-3-Clause']} {prose}",
             f"x {licenses.TEMPLATES['Zlib']} y {licenses.TEMPLATES['ISC']} z", prose]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((r.doc_id, r.unit, r.unit_no, r.license, round(r.dice, 9)) for r in licenses.scan(docs).where("unit = 'span'").collect())
    assert got == sorted((d, *x) for d, t in enumerate(texts) for x in brute_spans(t))
    assert {(r[0], r[3]) for r in got} >= {(0, "MIT"), (1, "MIT notice (licensed)"), (2, "Apache-2.0 header"), (3, "BSD-3-Clause"),
                                           (4, "Zlib"), (4, "ISC")} and 5 not in {r[0] for r in got}


def test_anchors_are_in_every_unit_that_reaches_the_threshold():
    rng = random.Random(4)
    for body in licenses.TEMPLATES.values():
        own, words = licenses.bigrams(body), licenses.anchors(body)
        least = -(-len(own) * 2 // 3)
        for _ in range(20):
            kept = rng.sample(sorted(own), least)
            assert any(words.intersection(b.split()) for b in kept)
        # the worst case: everything that can be left out holds anchors
        plain = [b for b in own if not words.intersection(b.split())]
        assert len(plain) < least


def test_license_scan_equals_brute_force(spark, messy, empty):
    mit = licenses.TEMPLATES["MIT"]
    texts = [mit, f"Copyright me\n\n{mit.replace('Software', 'Program')}\n\nmore", "Licensed under CC BY 4.0", "nothing here",
             "some prose\nReleased under the MIT licence.\nAll rights reserved", "", "the " * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((r.doc_id, r.unit, r.unit_no, r.license, round(r.dice, 9)) for r in licenses.scan(docs).collect())
    assert got == sorted((d, *x) for d, t in enumerate(texts) for x in brute_scan(t) + brute_spans(t)) and len(got) >= 4
    assert sorted((r.doc_id, r.unit) for r in licenses.scan(messy).collect()) == [(8, "line"), (8, "span")]
    assert licenses.scan(empty).count() == 0


# --- op9 -----------------------------------------------------------------------------
def page(body, extra=""):
    return (f"<!DOCTYPE html><html><head><title>t</title><script>var a='<p>no</p>';</script></head><body>"
            f"<nav><ul><li><a href='/x'>Home</a></ul></nav>{extra}{body}<footer>&copy; host</footer></body></html>")


def test_extraction_keeps_the_article_and_nothing_else():
    html = page("<div class='ad'>buy</div><article><h1>Title &amp; more</h1><p>One  <b>bold</b>\n word<p>Two&nbsp;&#233;"
                "<ul><li>x<li>y</ul><aside>side</aside><form>f</form><!-- c --><div id='comments'>nice post</div></article>",
                "<header>Site</header><div class='cookie-notice'>We use cookies</div>")
    assert wrappers.extract(html) == "Title & more One bold word Two é x y"
    assert wrappers.extract(None) == "" and wrappers.extract("") == "" and wrappers.extract("<p>open") == "open"
    assert wrappers.extract("plain <b>text</b> a < b &amp c") == "plain text a < b & c"
    assert wrappers.extract("<article>cut <p class='x") == "cut"


def test_wrapper_drops_what_a_host_repeats_and_keeps_what_varies(spark):
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta"]
    rows = [(i, f"http://Host.example/{i}", page(f"<div><p>Read our daily letter</p><h1>{w} head</h1><p>{w} " + f"{w}x " * 20
             + "</p><p>Thanks for your visit</p></div>")) for i, w in enumerate(words)]
    rows += [(50, None, None), (51, "http://alone.example/", page("<p>Thanks for your visit</p>")), (51, "x", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {(r.page_id, r.url): r for r in wrappers.main_text(pages).collect()}
    for i, w in enumerate(words):
        r = got[i, f"http://Host.example/{i}"]
        assert r.text == f"{w} head {w} " + " ".join([f"{w}x"] * 20) and r.n_chars == len(r.text)
    assert got[50, None].text == "" and got[51, "x"].text == ""
    assert got[51, "http://alone.example/"].text == "Thanks for your visit"
    assert wrappers.main_text(pages.limit(0)).count() == 0


def test_without_its_wrapper_a_page_reads_otherwise():
    pages = [page(f"<div><p>Read our daily letter</p><p>{w} " + f"{w}x " * 20 + "</p><p>Thanks for your visit</p></div>")
             for w in ("alpha", "beta", "gamma", "delta", "eps")]
    wrapper = wrappers._tree(json.loads(wrappers.induce(pages)))
    own = "beta " + " ".join(["betax"] * 20)
    assert wrappers.extract(pages[1], wrapper) == own
    assert wrappers.extract(pages[1]) == f"Read our daily letter {own} Thanks for your visit"


def test_every_layout_of_a_host_has_its_wrapper_by_all_its_pages(spark):
    """Two layouts; a constant line on most pages of a large host, and one on a few of them only."""
    rows = []
    for i in range(60):
        body = f"<p>word{i} " + f"own{i} " * 12 + "</p>"
        note = "<p>Constant line</p>" if i % 10 else ""
        few = "<p>On a few pages</p>" if i % 6 == 0 else ""
        wrap = "<section>{}</section><table><tr><td>Shop of the day</td></tr></table>" if i % 2 else "<div>{}</div>"
        rows.append((i, "http://h.example/", page(wrap.format(note + body + few))))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    assert wrappers.wrappers(df).count() == 2
    got = {r.page_id: r.text for r in wrappers.main_text(df).collect()}
    for i in range(60):
        want = f"word{i} " + " ".join([f"own{i}"] * 12) + (" On a few pages" if i % 6 == 0 else "")
        assert got[i] == want


def test_boilerplate_does_not_make_pages_copies(spark):
    """Large shared styles, scripts and menus, and a long constant notice beside longer articles."""
    css, menu = "<style>" + "a{b:c}" * 500 + "</style>", "<nav>" + "<a>menu entry</a>" * 300 + "</nav>"
    rows = [(i, "http://h.example/", f"<html><head>{css}</head><body>{menu}<div><p>Constant line</p><p>"
             + f"own{i} " * 12 + "</p></div></body></html>") for i in range(8)]
    got = {r.text for r in wrappers.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {" ".join([f"own{i}"] * 12) for i in range(8)}


def test_near_copies_of_an_article_are_one_voter(spark):
    same = "<p>A paragraph that is repeated by all of the copies and is the longest one of them all.</p><p>Second part.</p>"
    rows = [(i, "http://h.example/", page(f"<div><h1>Title</h1>{same}<p>edit {i}</p></div>")) for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    text = wrappers.main_text(df).where("page_id = 7").first().text
    assert text.startswith("Title A paragraph that") and text.endswith("Second part. edit 7")


@pytest.mark.parametrize("tag", ["<article class='post has-sidebar'>", "<article class='entry share-enabled'>",
                                 "<article class='story no-comments'>", "<article class='post widget-free'>",
                                 "<article class='ad'>", "<main class='nav-open'>", "<div class='entry-content no-comments'>"])
def test_class_names_of_an_article_do_not_lose_it(tag):
    end = tag.split()[0].replace("<", "</") + ">"
    html = page(f"{tag}<p>Kept text</p><div class='social-history'>History too</div><p class='notice-period'>And the period</p>"
                f"<div class='sidebar-left'>no</div><div class='ad-slot top'>no</div><div class='comments-list'>no</div>{end}")
    assert wrappers.extract(html) == "Kept text History too And the period"


def test_deep_and_wide_pages(spark):
    deep = "<div>" * 5000 + "deep text" + "</div>" * 5000
    wide = "<div>" + "<p>x</p>" * 3000 + "</div>"
    rows = [(i, "http://h.example/", page(f"{deep}<p>own words {i}</p>")) for i in range(6)]
    rows += [(10 + i, "http://w.example/", page(wide + f"<p>own words {i} and some</p>")) for i in range(5)]
    got = {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"own words {i}" for i in range(6))
    assert all(got[10 + i] == f"own words {i} and some" for i in range(5))


def test_pages_messy(spark):
    schema = "page_id long, url string, html string, host int, wrapper string, layout string, reference int, html_hash string"
    rows = [(None, None, None), (1, "http://a.b/", ""), (1, "http://a.b/", ""), (2, "http://a.b/", "<p>x " + "y " * 300_000), (3, None, "<p>t")]
    df = spark.createDataFrame([(*r, 1, "w", "l", 2, "h") for r in rows], schema)
    got = sorted(((r.page_id, r.n_chars) for r in wrappers.main_text(df).collect()), key=str)
    assert got == sorted([(None, 0), (1, 0), (1, 0), (2, 600_001), (3, 1)], key=str)


def test_copies_on_a_host_do_not_become_template(spark):
    body = "<article><h1>Same</h1><p>" + "the same article on many pages " * 10 + "</p></article>"
    pages = [page(body, f"<p class='ad'>{i}</p>") for i in range(12)] + [page("<article><p>other</p></article>")]
    assert wrappers.induce(pages) == ""


def brute_match(a, b):
    if a.tag != b.tag:
        return 0
    if a.tag == "#":
        return 1 + (a.text == b.text)
    m = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
    for i, x in enumerate(a.children, 1):
        for j, y in enumerate(b.children, 1):
            m[i][j] = max(m[i - 1][j], m[i][j - 1], m[i - 1][j - 1] + brute_match(x, y))
    return 1 + m[-1][-1]


def test_tree_matching_is_maximal():
    a = wrappers.parse("<div><p>a</p><ul><li>1<li>2</ul><p>b</p></div><hr><p>c</p>")
    b = wrappers.parse("<p>z</p><div><ul><li>1</ul><p>q</p><p>b</p></div><p>c</p><hr>")
    assert sum(1 + (x.tag == "#" and x.text == y.text) for x, y in wrappers.match(a, b)) == brute_match(a, b)


def test_extraction_equals_the_article_of_the_given_pages(spark):
    import html as h

    rows = queries.op9_wrapper_extraction(spark, "/root/testdata/sf0.001").collect()
    source = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    for r in rows:
        m = re.search(r"<article>(.*?)(</article>|$)", source[r.page_id], re.S)
        assert r.text == " ".join(h.unescape(re.sub(r"<[^>]+>", " ", m[1])).split())


# --- pipeline --------------------------------------------------------------------------
def test_pipeline_stages_take_effect(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 300").cache()
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    good = corpus_pipeline.quality_stage(spark, docs, sf).cache()
    verdict = {r.doc_id for r in quality.classify(docs, labels).collect() if r.predicted}
    assert {r.doc_id for r in good.collect()} == verdict
    one = corpus_pipeline.near_duplicate_stage(spark, good, sf).cache()
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicates(good).collect()}
    assert sorted(r.doc_id for r in one.collect()) == sorted(d for d, c in groups.items() if d == c)
    clean = corpus_pipeline.decontamination_stage(spark, one, sf).cache()
    leaks = {r.doc_id for r in decontam.contaminated(one, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in one.collect()} - leaks and leaks
    mixed = corpus_pipeline.mixing_stage(spark, clean, sf).cache()
    assert Counter(r.doc_id for r in mixed.collect()) == {r.doc_id: r.copies for r in mixing.plan(clean).collect() if r.copies}
    for stage in (good, one, clean, mixed):
        assert stage.columns == docs.columns
    shards = corpus_pipeline.sharding_stage(spark, mixed, sf).collect()
    assert Counter(r.doc_id for r in shards) == Counter(r.doc_id for r in mixed.collect())


def test_pipeline_stages_on_messy_and_empty_tables(spark, messy, empty, tmp_path):
    sf = "/root/testdata/sf0.001"
    for table in (messy, empty):
        docs = table
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf)
            assert docs.count() <= 3 * max(1, messy.count())
    assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_their_sql(spark, name):
    from oracle_check import canon, duck

    sf = "/root/testdata/sf0.001"
    got, want = queries.QUERIES[name](spark, sf).toPandas(), duck(sf).execute(queries.ORACLES[name]).df()
    assert canon(got) == canon(want) and len(got)
