"""Similarity join, components, language-model scores, and the pipeline."""

import math
import random
import re
import uuid
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from beatline.llm import chosen_path, network, scoring
from beatline.llm.components import connected
from beatline.llm.registry import queries, statements

WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def shingles(text):
    words = WORD.findall((text or "").encode().lower())
    n = min(5, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if n else frozenset()


def brute_classes(texts: dict[int, str | None], similarity=0.8):
    sets = {key: shingles(text) for key, text in texts.items()}
    linked = {a: [b for b in sets if b != a and sets[a] and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])] for a in sets}
    least = {}
    for key in sorted(sets):
        stack = [] if key in least else [key]
        while stack:
            at = stack.pop()
            if at not in least:
                least[at] = key
                stack += linked[at]
    return least, {key: len(found) for key, found in linked.items()}, linked


def near_copies(chance, words, n, changes):
    base = [f"w{chance.randint(0, 5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(changes):
            copy[chance.randrange(words)] = f"x{chance.randint(0, 10**6)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("small, block", [(128, 1024), (2, 16)])
def test_join_by_brute_force(spark, monkeypatch, small, block):
    monkeypatch.setattr(chosen_path, "BLOCK_SETS", block)
    chance = random.Random(2)
    texts = []
    for words in (30, 80, 200):
        texts += near_copies(chance, words, 60, words // 60 + 1)
    texts += near_copies(chance, 12, 5, 1) + near_copies(chance, 300, 20, 0)
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [passage + " " + " ".join(f"q{chance.randint(0, 9000)}" for _ in range(60)) for _ in range(80)]
    texts += ["one", "One!", "two words", "two words", "", None, "...", "a b c d", "a b c d e", "a b c d e f"]
    texts = dict(enumerate(texts))
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    rows = chosen_path.join(frame, small=small).collect()
    least, links, linked = brute_classes(texts)
    assert len(rows) == len(texts)
    assert {r["doc_id"]: r["class_id"] for r in rows} == least
    got = sum(r["n_links"] for r in rows)
    assert sum(links.values()) * 0.998 <= got <= sum(links.values())
    assert all(r["n_links"] <= links[r["doc_id"]] for r in rows)


def test_join_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    least, links, _ = brute_classes(texts)
    rows = queries()["op8_chosen_path_join"](spark, sf_dir).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in rows} == {k: (least[k], links[k]) for k in texts}


def test_join_of_odd_rows(odd, nothing):
    rows = chosen_path.join(odd).collect()
    assert len(rows) == odd.count()
    by_key = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by_key[1]["class_id"] == by_key[2]["class_id"] == 1 and by_key[2]["n_links"] == 2
    assert by_key[3]["n_links"] == 0 and by_key[4]["class_id"] == 4
    assert chosen_path.join(nothing).count() == 0


def test_one_of_each_keeps_rows_and_columns(odd, nothing):
    kept = chosen_path.one_of_each(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    # of the three equal texts one row stays
    assert len(rows) == odd.count() - 2 and sum(r["doc_id"] == 1 for r in rows) == 1
    assert chosen_path.one_of_each(nothing).count() == 0


def test_runs_reach_the_recall():
    assert chosen_path.runs_for(0.999, 0.8, 1) == 7
    assert chosen_path.runs_for(0.999, 0.8, 3) == 15


def test_components_of_long_chains(spark):
    chance = random.Random(4)
    nodes = list(range(200))
    chance.shuffle(nodes)
    edges = list(zip(nodes[:120], nodes[1:120], strict=False)) + list(zip(nodes[120:], nodes[121:], strict=False)) + [(500, 500), (7, 7)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r["node"]: r["root"] for r in connected(frame).collect()}
    expected = {n: min(nodes[:120]) for n in nodes[:120]} | {n: min(nodes[120:]) for n in nodes[120:]} | {500: 500}
    assert found == expected
    assert connected(frame.limit(0)).count() == 0


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def test_base_scores_by_brute_force(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(scoring.summary, "__defaults__", (500,))
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    held = {key: zlib.crc32(str(key).encode()) % 7 == 2 for key in texts}
    counts = Counter(t for key, text in texts.items() if not held[key] for t in tokens(text))
    n, different = sum(counts.values()), len(counts)
    rows = queries()["op7_recurrent_scores"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        of_text = tokens(texts[r["doc_id"]])
        base = sum(math.log10((counts[t] + 1) / (n + different + 1)) for t in of_text)
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[r["doc_id"]], len(of_text), n)
        assert r["n_known"] == sum(counts[t] > 0 for t in of_text)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert r["score"] < 0


def test_network_beats_counts_on_held_out_texts(spark):
    rows = queries()["op7_recurrent_scores"](spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert sum(r["score"] for r in rows) > 0.98 * sum(r["base_score"] for r in rows)


def test_network_shares_sum_to_one():
    net = network.Network.of_counts(np.arange(300, 0, -1).astype(float), 50.0)
    chance = np.random.default_rng(1)
    net.c[:] = chance.normal(0, 0.3, net.c.shape)
    net.w[:] = chance.normal(0, 0.3, net.w.shape)
    start = [5, 17, net.words]
    total = 0.0
    prefix = network.log_likelihoods(net, np.array(start), np.array([0, 3]))[0]
    for word in [*range(300), net.words]:
        total += math.exp(network.log_likelihoods(net, np.array([*start, word]), np.array([0, 4]))[0] - prefix)
    # classes without a word keep a little
    assert 0.9 < total <= 1 + 1e-4


def test_gradients_are_those_of_the_loss():
    chance = np.random.default_rng(0)
    net = network.Network.of_counts(np.sort(chance.integers(1, 100, 300))[::-1].astype(float), 50.0)
    net = network.Network(*(part.astype(np.float64) for part in net.parts()))
    net.c[:], net.w[:] = chance.normal(0, 0.1, net.c.shape), chance.normal(0, 0.1, net.w.shape)
    ids, bounds = chance.integers(0, 300, 12), np.array([0, 7, 12])
    trainer, got = network.Trainer(net), []
    trainer._update = got.append
    trainer._group(ids, bounds[:-1], np.diff(bounds))
    for part, grad in zip(net.parts(), got[0], strict=True):
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        losses = []
        for step in (1e-5, -2e-5):
            part[at] += step
            losses.append(-network.log_likelihoods(net, ids, bounds).sum() / len(ids))
        part[at] += 1e-5
        assert math.isclose(grad[at], (losses[0] - losses[1]) / 2e-5, rel_tol=1e-4)


def test_state_goes_on_across_windows(monkeypatch):
    net = network.Network.of_counts(np.arange(300, 0, -1).astype(float), 50.0)
    net.c[:] = np.random.default_rng(1).normal(0, 0.3, net.c.shape)
    ids, bounds = np.arange(200) % 37, np.array([0, 5, 5, 105, 200])
    whole = network.log_likelihoods(net, ids, bounds)
    monkeypatch.setattr(network, "WINDOW", 3)
    monkeypatch.setattr(network, "_LANES", 1)
    assert np.allclose(whole, network.log_likelihoods(net, ids, bounds), rtol=1e-5)


def test_every_training_document_is_learned_from(spark, tmp_path, monkeypatch):
    rows = [(i, f"word{i} stands here and there") for i in range(5000)] + [(None, None), (7, "word7 stands here and there")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    folder = str(tmp_path)

    def note(weights, shapes, batches):
        # in the task: what would be trained on leaves as files
        for batch in batches:
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as file:
                file.write("\n".join(str(len(ids) // 4) for ids in batch.column("ids").to_pylist()))
            yield from ()

    monkeypatch.setattr(scoring, "_train", note)
    scoring.learn(frame, scoring.summary(scoring.token_counts(frame)))
    sizes = Counter(int(line) for file in tmp_path.iterdir() for line in file.read_text().split())
    assert sizes == Counter({6: 5001, 1: 1})
    small, large = scoring.plan(1000), scoring.plan(1_000_000)
    assert large[0] > small[0] and large[1] > small[1] and 1_000_000 / math.prod(large) > 1000 / math.prod(small)


def test_a_pass_learns_from_every_token_once():
    chance = np.random.default_rng(2)
    ids, lengths = chance.integers(0, 300, 3000), [0, 1, 2500, 3, 0, 196, 300]
    bounds = np.cumsum([0, *lengths])
    trainer, seen = network.Trainer(network.Network.of_counts(np.ones(300), 1.0)), []
    trainer._learn = lambda trace: seen.extend((x[1], x[4]) for x in trace)
    assert trainer.train(ids, bounds) == 3000
    expected = []
    for a, b in zip(bounds, bounds[1:], strict=False):
        expected += zip([trainer.net.words + 1, *ids[a : b - 1]], ids[a:b], strict=False) if b > a else []
    assert Counter((int(a), int(b)) for x, y in seen for a, b in zip(x, y, strict=True)) == Counter((int(a), int(b)) for a, b in expected)


def test_words_of_the_network_grow_with_the_counted_ones(spark):
    sizes = {}
    for n in (100, 20_000, 60_000):
        rows = spark.range(n).select(F.xxhash64("id").alias("token"), (F.lit(n) - F.col("id")).alias("n"))
        counts = scoring.summary(rows)
        hashes = rows.toPandas()["token"].to_numpy(np.int64).view(np.uint64)
        numbers = counts.word_numbers(hashes)
        assert counts.own == min(n, scoring.OWN) and len(np.unique(numbers[: counts.own])) == counts.own
        # all words of a bucket and one unknown word sum to it
        of_n = np.arange(n, 0, -1) + 1.0
        summed = np.bincount(numbers, weights=of_n, minlength=len(counts.masses()))
        assert np.allclose(summed[: counts.own], counts.masses()[: counts.own])
        assert np.allclose(summed[counts.own :] + 1, counts.buckets)
        sizes[n] = network.Network.of_counts(counts.masses(), 0.0).words
        assert len(counts.masses()) <= sizes[n] <= network.MOST_WORDS
    assert sizes[100] < sizes[20_000] < sizes[60_000]


def test_scores_of_odd_rows(odd, nothing):
    rows = scoring.score(odd, F.col("doc_id").isNotNull()).collect()
    assert len(rows) == odd.count() and all(math.isfinite(r["score"]) for r in rows)
    rows = scoring.score(odd, F.lit(False)).collect()
    assert {r["n_known"] for r in rows} == {0} and all(r["base_score"] == 0 for r in rows)
    assert scoring.score(nothing, F.lit(True)).count() == 0


def test_pipeline_by_its_parts(spark):
    sf_dir = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, docs = documents.columns, documents
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_copies", "benchmark", "mixing", "sharding"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns
        kept[name] = docs.collect()
    toxic = {r["doc_id"] for r in queries()["op4_toxic_segments"](spark, sf_dir).where("predicted = 1").collect()}
    rows = {r["doc_id"]: r["text"] for r in documents.collect()}
    assert {r["doc_id"] for r in kept["toxicity"]} == set(rows) - toxic
    least, _, _ = brute_classes({key: text for key, text in rows.items() if key not in toxic})
    assert {r["doc_id"] for r in kept["near_copies"]} == set(least.values())
    hit = {r["doc_id"] for r in queries()["op9_benchmark_passages"](spark, sf_dir).where("contaminated").collect()}
    assert {r["doc_id"] for r in kept["benchmark"]} == set(least.values()) - hit
    final = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter(r["doc_id"] for r in final) == Counter(r["doc_id"] for r in kept["mixing"])
    slots = defaultdict(list)
    for r in final:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_stages_of_odd_rows(spark, odd, nothing, sf_dir):
    for docs in (odd, nothing):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, sf_dir).columns == docs.columns
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, sf_dir).collect()


@pytest.mark.parametrize("name", sorted(statements()))
def test_query_and_twin_agree(spark, sf_dir, name):
    found = queries()[name](spark, sf_dir)
    db = duckdb.connect()
    for table in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    expected = db.execute(statements()[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == sorted(found.columns)
    assert Counter(tuple(r) for r in found.select(*names).collect()) == Counter(expected.fetchall())
