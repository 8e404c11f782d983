"""Runs of repeated words: grammar against brute force, and the query's columns."""

import hashlib
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from beatline.llm import grammar, periodic
from beatline.llm.registry import queries


def all_runs(words, least=6, times=4):
    """Every period, every place: the definition."""
    n, found = len(words), []
    for q in range(1, n // times + 1):
        k = q
        while k < n:
            first = k
            while k < n and words[k] == words[k - q]:
                k += 1
            start, end = first - q, k
            if k > first and end - start >= max(least, times * q):
                if not any(a <= start and end <= b for a, b, _ in found):
                    found.append((start, end, q))
            k += 1
    return sorted(found, key=lambda run: (run[0], run[2]))


repeated = st.lists(
    st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=6), st.integers(1, 9), st.integers(0, 5)), max_size=8
).map(lambda parts: [w for unit, times, cut in parts for w in (unit * times)[: max(1, len(unit) * times - cut)]])


@settings(max_examples=400, deadline=None)
@given(st.one_of(repeated, st.lists(st.integers(0, 1), max_size=80)))
def test_runs_are_those_of_brute_force(words):
    found = grammar.runs(np.array(words, dtype=np.int64))
    assert [tuple(run) for run in found.tolist()] == all_runs(words)


@settings(max_examples=100, deadline=None)
@given(repeated, st.integers(2, 6))
def test_other_exponents(words, times):
    found = grammar.runs(np.array(words, dtype=np.int64), least=3, times=times)
    assert [tuple(run) for run in found.tolist()] == all_runs(words, 3, times)


@settings(max_examples=100, deadline=None)
@given(repeated)
def test_grammar_derives_the_text(words):
    made = grammar.re_pair(np.array(words, dtype=np.int64), [(0, len(words))] if words else [])

    def derived(symbol):
        if symbol < made.terminals:
            return [symbol]
        rule = symbol - made.terminals
        return derived(made.left[rule]) + derived(made.right[rule])

    assert [w for _, root in made.roots for w in derived(root)] == words
    for rule, place in enumerate(made.place):
        assert derived(made.terminals + rule) == words[place : place + made.length[rule]]


@pytest.mark.parametrize("kind", ["one word", "long period", "two words", "growing prefixes"])
def test_time_grows_with_the_words(kind):
    def text(n):
        random = np.random.default_rng(3)
        if kind == "one word":
            return np.zeros(n, dtype=np.int64)
        if kind == "long period":
            return np.tile(np.arange(n // 8), 8)
        if kind == "two words":
            return random.integers(0, 2, n)
        return np.concatenate([np.arange(k) for k in range(1, int((2 * n) ** 0.5))])

    seconds = []
    for n in (50_000, 100_000):
        words = text(n)
        start = time.process_time()
        grammar.runs(words)
        seconds.append(time.process_time() - start)
    assert seconds[1] < 3.2 * seconds[0] + 0.3 and seconds[1] < 20


def test_rows_of_every_kind(spark, odd, nothing):
    long = " ".join(["a b c d e"] * 40_000)
    clash = spark.createDataFrame(
        [(1, "x y " * 3 + "x y", "mine", 1), (2, None, None, None), (3, "", "", 0), (4, long, None, 2), (4, long, None, 2)],
        "doc_id long, text string, Runs string, n_words int",
    )
    rows = periodic.detect(clash).collect()
    assert periodic.detect(clash).columns == ["doc_id", "text", "n_words", "runs", "collapsed"]
    by_id = {r["doc_id"]: r for r in rows}
    assert len(rows) == 5
    assert [tuple(r) for r in by_id[1]["runs"]] == [(0, 8, 2)] and by_id[1]["collapsed"] == "x y"
    assert (by_id[2]["n_words"], by_id[2]["runs"], by_id[2]["collapsed"]) == (0, [], "")
    assert (by_id[3]["n_words"], by_id[3]["collapsed"]) == (0, "")
    assert [tuple(r) for r in by_id[4]["runs"]] == [(0, 200_000, 5)] and by_id[4]["collapsed"] == "a b c d e"
    assert periodic.detect(odd).count() == odd.count()
    assert periodic.detect(nothing).count() == 0


def test_strongest_breaks_ties(spark):
    # exponents 4 (later), 6 and 6 with a longer period
    text = "a a a a a a b c d c d c d c d c d c d e f g h f g h f g h f g h"
    frame = spark.createDataFrame([(1, text), (2, "nothing repeats here")], "doc_id long, text string")
    rows = periodic.detect(frame).withColumn("best", periodic.strongest()).orderBy("doc_id").collect()
    assert [tuple(r) for r in rows[0]["runs"]] == [(0, 6, 1), (7, 12, 2), (20, 12, 3)]
    assert tuple(rows[0]["best"]) == (0, 6, 1) and rows[1]["best"] is None


def test_query_against_brute_force(spark, sf_dir):
    rows = {r["doc_id"]: r for r in queries()["op13_grammar_runs"](spark, sf_dir).collect()}
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(rows) == len(documents)
    checked = 0
    for d in documents:
        words = (d["text"] or "").encode().split()
        if len(words) > 1500:
            continue
        h = zlib.crc32(str(d["doc_id"]).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = all_runs(words)
        dropped = {i for a, b, q in found for i in range(a + q, b)}
        r = rows[d["doc_id"]]
        lines = "".join(f"{a},{b - a},{q}\n" for a, b, q in found)
        left = b" ".join(w for i, w in enumerate(words) if i not in dropped)
        best = min(((-(b - a) / q, a, q, b - a) for a, b, q in found), default=None)
        assert r["n_runs"] == len(found)
        assert r["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(left).hexdigest()
        if best:
            assert (r["start"], r["length"], r["period"]) == (best[1], best[3], best[2])
            assert r["exponent_milli"] == 1000 * best[3] // best[2]
            checked += 1
        else:
            assert r["start"] is r["length"] is r["period"] is r["exponent_milli"] is None
    assert checked > 5
