"""Secrets, extraction, languages, toxicity and decontamination."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from beatline.llm import decontamination, extraction, languages, secrets, toxicity
from beatline.llm.registry import queries
from beatline.llm.words import slices, spaced_words, text_words

WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(text: str) -> bytes:
    return text.encode().lower()


def test_flat_words_are_those_of_regular_expressions():
    texts = ["", None, "A b", "b", " x\x85y \t\x0bz", "ÉTÉ a1_b2", "no end", "end ", "\n"] * 3
    batch = pa.record_batch({"text": pa.array(texts)})
    for limit in (1, 10, 1000):
        done = 0
        for rows, flat in slices(batch, "text", limit):
            for find, pattern in ((text_words, WORD), (spaced_words, re.compile(rb"[^\x20\x09-\x0d]+"))):
                words = find(flat)
                for i, text in enumerate(rows.column("text").to_pylist()):
                    at = range(words.bounds[i], words.bounds[i + 1])
                    found = [flat.data[words.starts[j] : words.ends[j]].tobytes() for j in at]
                    assert found == pattern.findall(lowered(text or ""))
            done += rows.num_rows
        assert done == len(texts)


def test_word_hashes_depend_on_the_word_alone():
    one = text_words(next(slices(pa.record_batch({"t": ["cat dog cat"]}), "t"))[1]).hashes
    other = text_words(next(slices(pa.record_batch({"t": ["xx dog", "cat"]}), "t"))[1]).hashes
    assert one[0] == one[2] == other[2] and one[1] == other[1] and len({*one.tolist(), *other.tolist()}) == 3


def brute_base(text: str):
    kinds = {
        "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8),
        "access": ("AKIA[A-Z0-9]+", 16),
        "hex": ("[0-9a-f]+", 32),
    }
    out = []
    for place, (kind, (pattern, least)) in enumerate(kinds.items()):
        flags = re.ASCII | (re.IGNORECASE if kind == "assign" else 0)
        for m in re.finditer(pattern, text, flags):
            if len(m[2] if kind == "assign" else m[0]) >= least:
                out.append((m.start(), place, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


SECRETS = [
    'token = "0123456789abcdef0123456789abcdef" token=token = abcdefghij',
    "PassWord : short password='longenough1' api_key=APIKEY=abcdefgh",
    "AKIAAKIA12 AKIAABCDEFGH1234567 0123456789abcdef0123456789abcdeF" + "a" * 40,
    "ſecret=abcdefghi café secret=abcdefghi",
    "toKen=abcdefghi",
]


def test_base_spans_are_those_of_the_plain_patterns():
    chance = random.Random(3)
    parts = ["password", "Token", "=", ":", " ", '"', "abcdefgh", "AKIA", "A1B2C3D4", "0f" * 9, "é", "-", "\n", "api_key", "x"]
    texts = SECRETS + ["".join(chance.choices(parts, k=40)) for _ in range(500)]
    for text in texts:
        assert [f"{k}:{a}:{b}" for k, a, b, _ in secrets.base_spans(text)] == brute_base(text)


def test_secret_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in queries()["op5_secret_ownership"](spark, sf_dir).collect():
        base = brute_base(texts[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r["spans"].split(",")) or not base
        assert r["n_assign"] + r["n_access"] + r["n_hex"] == len(base)


def test_owners_tell_examples_from_live_ones(spark):
    copied, live = "Ab3dEf6hIj9kLm2nOp5q", "Zy8xWv5uTs2rQp9oNm6l"
    rows = [(i, f"see {copied} here", f"owner{i}") for i in range(5)] + [(9, f"mine {live} and {copied}", "owner9")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r["doc_id"]: r for r in secrets.scan(frame).collect()}
    assert [s["kind"] for s in found[9]["all_spans"]] == ["owned"]
    assert found[9]["all_spans"][0]["start"] == 5 and not found[0]["all_spans"]


def test_copies_within_one_owner_and_exact_copies_across_owners(spark):
    example, real, null = "Ab3dEf6hIj9kLm2nOp5q", "Zy8xWv5uTs2rQp9oNm6l", "Qw7eRt4yUi1oPa8sDf5g"
    rows = [(i, f"page {i} says token={example} and {example[::-1]}", "one") for i in range(20)]
    rows += [(None, f"page {i} says {null}", None) for i in range(20)]
    rows += [(100, f"mine is token={real} and {real[::-1]}", "a"), (101, f"mine is token={real} and {real[::-1]}", "b")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    found = secrets.scan(frame).collect()
    for r in found:
        got = [(s["kind"], s["owners"], s["repositories"], s["live"]) for s in r["all_spans"]]
        if r["source"] == "one":
            assert got == [("assign", 1, 20, False)]
        elif r["source"] is None:
            assert got == []
        else:
            assert got == [("assign", 1, 1, True), ("owned", 1, 1, True)]


def test_secrets_of_odd_rows(odd, nothing):
    assert secrets.scan(odd).count() == odd.count()
    assert secrets.scan(nothing).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>Title of the page</title><script>var a = "<p>no</p>";</script>
<style>p { margin: 0 }</style></head><body class="has-sidebar"><header><h2>The site and the name of it</h2></header>
<nav><ul><li><a href="/a">the one</a><li><a href="/b">the other</a></ul></nav>
<div class="cookie-notice">We use the cookies that you have to accept, as it is with all of the pages that we have for you.</div>
<article><h1>Head &amp; line</h1><p>It is the   first of the paragraphs that we have, and it is <b>long
</b>enough to be the text of it.<p>Short.</p><p>1 &lt; 2 &eacute;</p>
<form><label>Your name</label><input name="a>b"><button>Send it to the people that we have for this</button></form>
<div class="comments"><p>It is the comment of a reader who has not read it, but he has to say it to all of us.</p></div></article>
<!-- <p>It is the comment that is not to be in the text of it, and it is long enough.</p> -->
<aside>It is the sidebar with all of the things that are not in the text of the article that we have.</aside>
<footer>&copy; 2020 the people of the page and all of the others that are with us</footer></body></html>"""


def test_article_alone_is_kept():
    assert extraction.main_text(PAGE) == (
        "Head & line\n\nIt is the first of the paragraphs that we have, and it is long enough to be the text of it."
        "\n\nShort.\n\n1 < 2 é"
    )


def test_pages_without_marks_go_by_text():
    prose = "It is the text of the page that we have for you and it is not in an article but it is the text of it for all"
    page = f"<body><div><a href='/'>Home</a> <a href='/x'>News</a></div><div><h2>Heading</h2><p>{prose}.</p><p>{prose}!</p></div></body>"
    assert extraction.main_text(page) == f"Heading\n\n{prose}.\n\n{prose}!"


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "</p></p>", "<!--", "<script>", "<a b='>", "&amp", "<p>x</p>" * 3])
def test_odd_pages_do_not_break(page):
    assert isinstance(extraction.main_text(page), str)


PROSE = "It is the text of the page that we have for you and it is not in the menu but it is the text of it for all."


@pytest.mark.parametrize(
    "page",
    [
        f'<div class="content has-sidebar"><article><p>{PROSE}</p></article></div>',
        f'<main class="site-main no-sidebar"><p>{PROSE}</p></main>',
        f'<article class="post comments-open"><p>{PROSE}</p></article>',
        f'<div id="ad-free-content"><article><p>{PROSE}</p></article></div>',
        f'<div class="related-layout"><main class="search"><p>{PROSE}</p></main></div>',
        f'<div class="has-sidebar"><p>{PROSE}</p></div>',
        f'<article><svg viewBox="0 0 1 1"/><p>{PROSE}</p></article>',
        f'<article><object-list><p>{PROSE}</p></object-list></article>',
        f'<template-card><p>{PROSE}</p></template-card>',
    ],
)
def test_class_words_and_tags_do_not_hide_the_article(page):
    aside = f'<div class="sidebar"><article class="card"><p>{PROSE}</p></article></div>'
    assert extraction.main_text(page) == PROSE
    assert extraction.main_text(page + aside) == PROSE
    assert extraction.main_text(f"<svg><text>{PROSE}</text></svg>" + page) == PROSE


def test_extract_keeps_other_columns(spark):
    rows = [(1, "u", PAGE, "old", None), (None, None, None, None, None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string, extra string")
    found = extraction.extract(frame)
    assert found.columns == ["page_id", "url", "extra", "text", "n_chars"]
    assert [r["n_chars"] for r in found.collect()] == [len(extraction.main_text(PAGE)), 0]
    assert extraction.extract(frame.limit(0)).count() == 0


def test_bundles_are_sums_of_bound_letters():
    texts = ["Ab  ab", "", "é", "1 2"]
    dimensions = 128
    got = languages.grams_of(texts).bundles(np.arange(4), 4, dimensions)

    def vector(letter):
        return languages.letter_vectors(np.array([ord(letter) if letter != " " else 0], dtype=np.uint32), dimensions)[0].astype(int)

    def bundle(text):
        return sum(np.roll(vector(a), 2) * np.roll(vector(b), 1) * vector(c) for a, b, c in zip(text, text[1:], text[2:], strict=False) if b != " ")

    assert (got[0] == bundle(" ab ab ")).all()
    assert (got[2] == bundle(" é ")).all()
    assert not got[1].any() and not got[3].any()


def test_language_query(spark, sf_dir):
    documents = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    held = [r for r in queries()["op2_hyperdimensional_language"](spark, sf_dir).collect() if r["held_out"]]
    right = sum(r["lang_pred"] == documents[r["doc_id"]]["lang"] for r in held)
    assert right >= 0.97 * len(held) and all(0 <= r["score"] <= 1 for r in held)


def test_languages_of_odd_rows(odd, nothing):
    profiles = languages.learn(odd)
    rows = languages.identify(odd, profiles).collect()
    assert len(rows) == odd.count()
    for r in rows:
        without = not any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == without and (r["score"] == 0 or not without)
    none = languages.learn(nothing)
    assert {r["lang_pred"] for r in languages.identify(odd, none).collect()} == {"und"}
    assert languages.identify(nothing, profiles).count() == 0


def test_segments_are_maximal():
    chance = random.Random(5)
    for _ in range(300):
        scores = [chance.choice([-3, -2, -1, 1, 2, 5]) for _ in range(chance.randint(1, 25))]
        found = toxicity.maximal_segments(scores, list(range(len(scores))), list(range(1, len(scores) + 1)))

        def split(low, high, scores=scores):
            best = max(((sum(scores[a:b]), -(b - a), a, b) for a in range(low, high) for b in range(a + 1, high + 1)), default=(0,))
            if best[0] <= 0:
                return []
            _, _, a, b = best
            return [*split(low, a), (a, b, best[0]), *split(b, high)]

        expected = split(0, len(scores))
        assert sum(x[2] for x in found) == sum(x[2] for x in expected) and len(found) == len(expected)


def test_toxic_query(spark, sf_dir):
    rows = {r["doc_id"]: r for r in queries()["op4_toxic_segments"](spark, "/root/testdata/sf0.1").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()
    held = [(r["toxic"], rows[r["doc_id"]]["predicted"]) for r in labels if rows[r["doc_id"]]["held_out"]]
    assert sum(p for t, p in held if t) >= 0.9 * sum(t for t, _ in held)
    assert sum(p for t, p in held if not t) <= 0.03 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_toxicity_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1), (2, 0), (5, 0), (None, 1), (3, None), (1, 0)], "doc_id long, toxic int")
    for table in (labels, labels.limit(0)):
        rows = toxicity.score(odd, table, lambda key: key.isNotNull()).collect()
        assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    kept = toxicity.without_toxic(odd, labels, lambda key: F.lit(True), threshold=1.1)
    assert kept.columns == odd.columns and sorted(map(str, kept.collect())) == sorted(map(str, odd.collect()))
    assert toxicity.without_toxic(nothing, labels, lambda key: F.lit(True)).count() == 0


def brute_hits(text: str, items, window=10):
    words = WORD.findall(lowered(text or ""))
    hit, ids = set(), set()
    for item, item_text in items:
        of_item = WORD.findall(lowered(item_text or ""))
        n = min(window, len(of_item))
        wanted = {tuple(of_item[i : i + n]) for i in range(len(of_item) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i : i + n]) in wanted:
                hit |= set(range(i, i + n))
                ids.add(item)
    return len(words), len(hit), sorted(ids)


@pytest.mark.parametrize("pass_windows", [3, 200_000])
def test_passages_by_brute_force(spark, pass_windows):
    chance = random.Random(11)
    words = ["a", "b", "c", "été", "D1"]
    items = [(i, " ".join(chance.choices(words, k=chance.choice([1, 2, 6, 10, 11, 15])))) for i in range(4, 12)]
    items += [(20, None), (21, ""), (22, items[0][1]), (23, "..."), (24, "one two three four five six seven eight nine ten eleven")]
    texts = [" ".join(chance.choices(words, k=chance.randint(0, 300))) for _ in range(40)]
    texts += [None, "", "x One, two THREE four five six seven eight nine ten eleven one two three four five six seven eight nine ten z"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    table = spark.createDataFrame([*items, (None, "a b")], "item_id long, text string")
    found = decontamination.find_passages(frame, table, pass_windows=pass_windows)
    rows = found.withColumn("n_hit", decontamination.hit_words()).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r["n_words"], r["n_hit"], r["hit_items"]) == brute_hits(r["text"], items)


def test_decontamination_of_odd_rows(spark, odd, nothing):
    items = spark.createDataFrame([(1, "the same key and another text")], "item_id long, text string")
    kept = decontamination.without_passages(odd, items)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 1
    assert decontamination.without_passages(odd, items.limit(0)).count() == odd.count()
    assert decontamination.without_passages(nothing, items).count() == 0


def test_items_may_have_text_ids(spark):
    documents = spark.createDataFrame([(1, "a b c d e f g h i j k"), (2, None), (3, "x y z")], "doc_id long, text string")
    items = spark.createDataFrame([("q9", "b c d e f g h i j k"), ("q10", "X y"), ("q11", None), (None, "x y z")], "item_id string, text string")
    for pass_windows in (1, 200_000):
        found = decontamination.find_passages(documents, items, pass_windows=pass_windows)
        assert {r["doc_id"]: r["hit_items"] for r in found.collect()} == {1: ["q9"], 2: [], 3: ["q10"]}
