"""Main text, quality rules, quality classifier, fingerprints and token counts."""

import hashlib
import html
import math
import os
import re
import time

import brute
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from crowdgrid.llm import (
    fingerprints,
    main_text,
    quality_classifier,
    quality_rules,
    token_counts,
)
from crowdgrid.llm.common import table
from crowdgrid.llm.labelled_pages import PAGES, STYLES, laid_out
from crowdgrid.llm.queries import QUERIES

DOCS = "doc_id long, text string"
ODD = [
    (1, None), (2, ""), (3, " \n\t"), (4, "word"), (4, "word"), (None, "no id here"), (6, "é#$| " * 30),
    (7, "a b c d e f g h i\n" * 9), (8, "x " * 20000), (9, "<|endoftext|> 你好   😀"),
]


@pytest.fixture(scope="module")
def tree(spark):
    return main_text.train(spark)


def test_tree_agrees_with_its_labels(tree):
    for page, wanted in PAGES:
        assert main_text.main_text(page, tree) == "\n".join(wanted)


def test_main_text_of_the_pages(spark, sf_dir, tree):
    pages = table(spark, sf_dir, "pages")
    got = {r.page_id: r for r in main_text.extract(pages, tree).collect()}
    for page in pages.collect():
        inside = page.html.split("<article>")[1].split("</article>")[0].split("<footer>")[0]
        blocks = [
            " ".join(html.unescape(re.sub("<[^>]*>", "", b)).split())
            for b in re.split("</?(?:p|h1)>", inside)
        ]
        want = "\n".join(b for b in blocks if b)
        assert got[page.page_id].text == want
        assert got[page.page_id].n_chars == len(want)


def test_unseen_page_layouts(tree):
    page = """<html><body class="has-sidebar"><div id="nav"><a href=1>One</a> <a href=2>Two</a></div>
    <div role="alert">We will be closed tomorrow, please come back on the day after.</div>
    <main><section><h2>A &lt;b&gt; &#233;</h2><p>First line<br>second &amp; third.</p><p>No.</p></section>
    <form><p>Send us a letter with your address and we will answer</p><textarea>type</textarea></form>
    <section class="user-comments"><p>I liked this one very much, thank you all.</p></section></main>
    <aside><p>Buy now and save half of the price of everything in the shop.</p></aside>
    <script>document.write("<p>never</p>")</script><style>p{}</style><footer>Imprint</footer>"""
    assert main_text.main_text(page, tree) == "A <b> é\nFirst line second & third.\nNo."


def test_held_out_layouts(tree):
    """Pages whose seeds the training never draws, in every style."""
    for style in STYLES:
        right = blocks = 0
        for seed in range(1000, 1060):
            page, wanted = laid_out(style, seed)
            for text, features in main_text.blocks_of(page):
                right += main_text.belongs(tree, features) == (text in wanted)
                blocks += 1
        assert blocks > 600 and right >= 0.98 * blocks, (style, right, blocks)


def test_tree_learns_from_words_links_and_neighbours(tree):
    def used(node):
        return set() if len(node) == 1 else {main_text.FEATURES[node[0]]} | used(node[2]) | used(node[3])

    assert "link_density" in [main_text.FEATURES[n[0]] for n in (tree, tree[2])]
    assert {"words", "words_before", "words_after"} <= used(tree)
    assert used(tree) & {"link_density_before", "link_density_after"}


ARTICLE = "<article><h1>Slow rivers</h1><p>The river rose by two metres in a single night.</p><p>Yes.</p></article>"


@pytest.mark.parametrize(
    "opening",
    [
        '<div class="layout with-sidebar">', '<div id="page-header-social-wrap">', '<form id="aspnetForm">',
        '<div class="comments-open"><section class="ad-free">', '<div class="header">',
    ],
)
def test_layouts_with_misleading_names_keep_their_article(tree, opening):
    page = (
        f"<nav><a href=1>Home</a></nav>{opening}{ARTICLE}<aside><p>Buy a boat from us this week.</p></aside>"
        "</div><footer>&copy; Owner</footer>"
    )
    wanted = "Slow rivers\nThe river rose by two metres in a single night.\nYes."
    assert main_text.main_text(page, tree) == wanted


def test_pages_without_names_lose_links_and_notices(tree):
    story = "The river rose by two metres in one night, and the lower town was under water at dawn."
    page = f"""<body><p><a href=1>Home</a> | <a href=2>World</a></p><h1>Flood in the town</h1><p>{story}</p>
    <p>Nobody was hurt.</p><p>{story} Then it sank again.</p>
    <p><a href=3>Old bridge to be rebuilt after the flood of the last spring</a></p>
    <p><a href=4>Mayor thanks the many helpers of the long and cold night</a></p>
    <p>All rights reserved by the owner of this site</p></body>"""
    wanted = f"Flood in the town\n{story}\nNobody was hurt.\n{story} Then it sank again."
    assert main_text.main_text(page, tree) == wanted


def test_more_comments_than_article(tree):
    said = "<article><p>I was there too and it was a very long and wet night for all of us.</p></article>"
    page = f"<nav><a href=1>Home</a></nav>{ARTICLE}<section id=comments>{said * 20}</section><footer>End</footer>"
    wanted = "Slow rivers\nThe river rose by two metres in a single night.\nYes."
    assert main_text.main_text(page, tree) == wanted


def test_very_long_pages_are_read_whole(tree):
    body = "".join(f"<p>word{n} and some more of them</p>" for n in range(20_000)) + "<p>" + "w " * 500_000
    page = f"<nav><a href=1>Home</a></nav><article>{body}</article><footer>End</footer>"
    lines = main_text.main_text(page, tree).split("\n")
    assert len(lines) == 20_001 and len(lines[-1]) == 999_999


def test_deep_named_places_take_linear_time():
    start = time.perf_counter()
    main_text.blocks_of('<div class="ad">x' * 20_000)
    assert time.perf_counter() - start < 5


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "<!--", "<script>x", "</p></div>", "<a b='"])
def test_odd_pages(tree, page):
    assert main_text.main_text(page, tree) == ""


def test_links_are_seen_through_any_number_of_tags():
    for depth in (0, 60, 70, 500):
        page = "<a href=1>" + "<b>" * depth + "seven words that are all one link</a>"
        (_, features), = main_text.blocks_of(f"<p>{page}</p>")
        assert features[1] == 1.0


@pytest.mark.parametrize(
    "page",
    ["<b></i>", "<p><b>", "<a><div><b><a>x</a>", "<b><br>x<div>y</div>", "<a href='", "<!--", "</", "<script>"],
)
def test_broken_pages_take_linear_time(page):
    def seconds(times):
        start = time.perf_counter()
        main_text.blocks_of(page * times)
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(40_000) < 0.2 + 25 * min(seconds(4_000) for _ in range(3))


def test_main_text_with_nulls_and_extra_columns(spark, tree):
    rows = [(1, None, None, "x"), (1, None, None, "x"), (None, "u", "<article><p>Yes.</p></article>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((tuple(r) for r in main_text.extract(pages, tree).collect()), key=repr)
    assert got == sorted([(1, None, "", 0), (1, None, "", 0), (None, "u", "Yes.", 4)], key=repr)
    assert main_text.extract(pages.limit(0), tree).count() == 0


def _hash(*values):
    """Spark's xxhash64 of strings or longs, signed."""
    seed = 42
    for v in values:
        raw = v.encode() if isinstance(v, str) else v.to_bytes(8, "little", signed=True)
        seed = xxhash.xxh64_intdigest(raw, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def _buckets(text, buckets):
    h = [_hash(w) for w in brute.words(text)]
    return [x % buckets for x in h] + [_hash(a, b) % buckets for a, b in zip(h, h[1:])]


def test_quality_rules_against_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    labels = table(spark, sf_dir, "labels")
    good = {r.doc_id for r in labels.collect() if r.quality == 1}
    docs += [(d, t) for d, t in ODD if d is None or d > 10**6]
    n = quality_rules.BUCKETS
    raw, trusted = np.zeros(n), np.zeros(n)
    for d, t in docs:
        for b in _buckets(t, n):
            raw[b] += 1
            trusted[b] += d in good
    weight = np.log((trusted + 1) / (trusted.sum() + n)) - np.log((raw + 1) / (raw.sum() + n))
    got = quality_rules.judge(spark.createDataFrame(docs, DOCS), labels).collect()
    found = {r.doc_id: r for r in got}
    assert len(got) == len(docs)
    for d, t in docs:
        grams, r = _buckets(t, n), found[d]
        ratio = float(np.mean(weight[grams])) if grams else 0.0
        base = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert base == brute.base_rules(t)
        assert math.isclose(r.log_ratio, ratio, abs_tol=1e-5)
        if abs(ratio - quality_rules.THRESHOLD) > 1e-4:
            assert r.kept == (not r.base_failed and ratio >= quality_rules.THRESHOLD)


def test_quality_rules_on_odd_texts(spark):
    docs = spark.createDataFrame(ODD, DOCS).withColumn("words", F.lit(1)).withColumn("trusted", F.lit(1))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality_rules.judge(docs, labels).collect()
    want = sorted(((d, *brute.base_rules(t)) for d, t in ODD), key=repr)
    found = [
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        for r in got
    ]
    assert sorted(found, key=repr) == want
    assert all(r.log_ratio == 0 and r.kept == (not r.base_failed) for r in got)
    assert quality_rules.judge(docs.limit(0), labels).count() == 0


def test_rules_run_no_python(spark, sf_dir):
    for name in ("op3_quality_rules", "op6_url_lists", "op7_fingerprints"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan), name


def test_classifier_on_held_out_labels(spark, sf_dir):
    sf_dir = os.path.join(os.path.dirname(os.path.normpath(sf_dir)), "sf0.01")  # more labels
    got = QUERIES["op5_quality_classifier"](spark, sf_dir)
    rows = got.join(table(spark, sf_dir, "labels"), "doc_id").collect()
    unseen = [r for r in rows if r.held_out]
    assert unseen and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert sum(r.predicted == r.quality for r in unseen) / len(unseen) >= 0.95
    assert got.count() == table(spark, sf_dir, "documents").count()


def test_held_out_labels_do_not_reach_the_fit(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    flipped = labels.withColumn(
        "quality",
        F.when(quality_classifier.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")),
    )
    one = {r.doc_id: r.score for r in quality_classifier.classify(docs, labels).collect()}
    two = {r.doc_id: r.score for r in quality_classifier.classify(docs, flipped).collect()}
    assert all(math.isclose(one[d], two[d], rel_tol=1e-6, abs_tol=1e-9) for d in one)


def test_log_density_against_plain_gaussians():
    r = np.random.default_rng(3)
    width = len(quality_classifier.NAMES)
    total = np.zeros((2, width + 1, width + 1))
    groups = [r.normal(size=(300, width)) @ r.normal(size=(width, width)) + c for c in (0, 1)]
    for c, x in enumerate(groups):
        wide = np.hstack([np.ones((len(x), 1)), x])
        total[c] = wide.T @ wide
    model = quality_classifier._model(total, 0.2, 0.1, 1e-4, 1.0)
    pooled = sum(np.cov(x.T, bias=True) * len(x) for x in groups) / 600
    logs = []
    for x in groups:
        own = 0.8 * np.cov(x.T, bias=True) + 0.2 * pooled
        own = 0.9 * own + 0.1 * np.diag(np.diag(own)) + 1e-4 * np.eye(width)
        away = groups[0] - x.mean(axis=0)
        logs.append(
            -0.5 * np.einsum("ij,jk,ik->i", away, np.linalg.inv(own), away)
            - 0.5 * np.linalg.slogdet(own)[1]
        )
    assert np.allclose(model.score(groups[0]), 1 / (1 + np.exp(logs[0] - logs[1])), atol=1e-6)


def test_classifier_on_odd_tables(spark):
    docs = spark.createDataFrame(ODD, DOCS).withColumn("vector", F.lit("x")).withColumn("llm_vector", F.lit(1))
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = quality_classifier.classify(docs, none).collect()
    assert len(got) == len(ODD) and {r.score for r in got} == {0.5}
    strange = spark.createDataFrame(
        [(4, 1), (4, 0), (4, 1), (6, None), (None, 1), (7, 5), (8, 0)], "doc_id long, quality int"
    )
    assert quality_classifier.classify(docs, strange).count() == len(ODD)
    kept = quality_classifier.keep_good(docs, strange)
    assert kept.columns == docs.columns
    assert quality_classifier.classify(docs.limit(0), strange).count() == 0


def _edited(docs):
    order = sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""), reverse=True)
    for i, (d, t) in enumerate(order):
        text, follower = t or "", order[(i + 1) % len(order)][1] or ""
        cut = len(text) // 3
        yield d, len(text), hashlib.sha256((text[: len(text) - cut] + follower[:cut]).encode()).hexdigest()


def test_edited_texts_of_the_documents(spark, sf_dir):
    docs = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    got = QUERIES["op7_fingerprints"](spark, sf_dir).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == sorted(_edited(docs))
    assert sum(r.near_edited > r.near_next for r in got) / len(got) > 0.95
    assert all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in got)


def test_edited_texts_across_blocks_and_odd_ids(spark):
    rows = [(d, f"text {d} of many words that go on") for d in (0, 1, 1023, 1024, 5000, 10**12, -7, -5000)]
    rows += [(1, "a second text of one id"), *[(d, t) for d, t in ODD if d not in (1, 4)]]
    docs = spark.createDataFrame(rows, DOCS).withColumn("block", F.lit(1)).withColumn("guest", F.lit(True))
    got = fingerprints.compare_with_edits(docs).collect()
    found = sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr)
    assert found == sorted(_edited(rows), key=repr)
    same = {r.fingerprint for r in got if r.n_chars == 0}
    assert same == {""}
    assert fingerprints.compare_with_edits(docs.limit(0)).count() == 0
    alone = fingerprints.compare_with_edits(spark.createDataFrame([(1, "abcdef")], DOCS)).first()
    assert alone.near_next == 1 and alone.n_chars == 6


def _mask(x):
    return x & ((1 << 24) - 1)


def _order_minhash(text):
    """The fingerprint written out with lists."""
    h = [_hash(w) for w in brute.words(text)]
    kmers = [_hash(a, b) for a, b in zip(h, h[1:])] or h
    seen, placed = {}, []
    for place, k in enumerate(kmers):
        high = (k % (1 << 64)) >> 25
        nth = seen[high] = seen.get(high, -1) + 1
        if nth:
            # The occurrence number is hashed as a 32-bit number.
            raw = xxhash.xxh64_intdigest(high.to_bytes(8, "little"), 42)
            high = xxhash.xxh64_intdigest(nth.to_bytes(4, "little"), raw) >> 25
        placed.append((high, place))
    if not placed:
        return ""
    placed.sort()
    points, bits = fingerprints.POINTS, fingerprints.POINTS.bit_length() - 1
    out = ""
    for p in range(points):
        first = sum(h >> (39 - bits) < p for h, _ in placed)
        picked = [placed[(first + t) % len(placed)] for t in range(min(2, len(placed)))]
        tuple_ = [h for h, _ in sorted(picked, key=lambda x: x[1])]
        out += f"{_hash(*tuple_) % (1 << 64):016x}"[: fingerprints.HEX]
    return out


def test_fingerprints_against_brute_force(spark, sf_dir):
    rows = [r.text for r in table(spark, sf_dir, "documents").select("text").collect()]
    rows += [t for _, t in ODD if t is not None and len(t) < 10**4] + ["the the the a the a the"]
    df = spark.createDataFrame([(t,) for t in rows], "text string")
    got = df.select("text", fingerprints.fingerprint(F.col("text")).alias("f")).collect()
    for r in got:
        assert r.f == _order_minhash(r.text)


def _fewest(word, pieces, byte):
    """Best score and its tokens for one pre-token, without a trie."""
    marked, longest = token_counts.MARK + word, max(map(len, pieces))
    best = [(0.0, 0)]
    for end in range(1, len(marked) + 1):
        width = len(marked[end - 1].encode())
        options = [(best[end - 1][0] + byte * width, -(best[end - 1][1] + width))]
        for start in range(max(0, end - longest), end):
            if marked[start:end] in pieces:
                options.append((best[start][0] + pieces[marked[start:end]], -(best[start][1] + 1)))
        score, tokens = max(options)
        best.append((score, -tokens))
    return best[-1][1]


def test_a_full_trie_keeps_its_counts_right(monkeypatch):
    monkeypatch.setattr(token_counts, "MOST_WORDS", 7)
    trie = token_counts.Trie(token_counts.default_vocabulary(), 60)
    words = [f"{a}{b}" for a in ("under", "é", "x" * 70, "ing") for b in range(30)] * 2
    model = token_counts.scores(token_counts.default_vocabulary())
    assert trie.total(words) == sum(_fewest(w, *model) for w in words)
    assert len(trie.counts) <= 7


@pytest.mark.parametrize("most_nodes", [50, token_counts.MOST_NODES])
def test_token_counts_against_plain_dynamic_programming(spark, sf_dir, most_nodes):
    model = token_counts.scores(token_counts.default_vocabulary())
    docs = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").limit(60).collect()]
    docs += ODD
    df = spark.createDataFrame(docs, DOCS).withColumn("n_tokens", F.lit(1))
    got = token_counts.count_tokens(df, most_nodes=most_nodes).collect()
    known = {}
    want = []
    for d, t in docs:
        found = brute.words(t)
        for w in set(found) - set(known):
            known[w] = _fewest(w, *model)
        want.append((d, len(found), len(set(found)), sum(known[w] for w in found)))
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)
    assert token_counts.count_tokens(df.limit(0)).count() == 0
