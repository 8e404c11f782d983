"""Fingerprints, sharding and mixing against plain Python."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from beatline.llm import fingerprints, mixing, sharding
from beatline.llm.columns import space_words
from beatline.llm.registry import queries


def jump(key: int, shards: int) -> int:
    at, to, key = -1, 0, key % 2**64
    while to < shards:
        at = to
        key = (key * 2862933555777941757 + 1) % 2**64
        to = int((at + 1) * (2**31 / ((key >> 33) + 1)))
    return at


def test_jump_is_the_published_one(spark):
    keys = [0, 1, 2, -1, 2**63 - 1, -(2**63), 10863919174838991, *range(10**6, 10**6 + 300)]
    frame = spark.createDataFrame([(k,) for k in keys], "key long")
    for shards in (1, 2, 24, 25, 1000):
        rows = frame.select("key", sharding.jump_shard(F.col("key"), shards).alias("shard")).collect()
        assert {r["key"]: r["shard"] for r in rows} == {k: jump(k, shards) for k in keys}


def test_shards_of_odd_rows(odd, nothing):
    rows = sharding.shard_rows(odd, 4, digits=1).collect()
    assert len(rows) == odd.count()
    slots = defaultdict(list)
    for r in rows:
        text = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(text) + 8, zlib.crc32(text), "key")
        assert r["shard"] == jump(r["doc_id"] or 0, 4) and r["grown_shard"] == jump(r["doc_id"] or 0, 5)
        assert r["grown_shard"] in (r["shard"], 4)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert sharding.shard_rows(nothing, 4).count() == 0


def test_shards_query(spark, sf_dir):
    rows = queries()["op3_jump_shards"](spark, sf_dir).collect()
    assert all(r["shard"] == jump(r["doc_id"], 24) and r["grown_shard"] == jump(r["doc_id"], 25) for r in rows)


def test_mix_keeps_to_targets_and_reruns_agree(spark, sf_dir):
    query = queries()["op10_mix_sources"]
    rows = query(spark, sf_dir).collect()
    assert sorted(rows) == sorted(query(spark, sf_dir).collect())
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    documents = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    taken, target, size = Counter(), {}, Counter()
    for r in rows:
        source = documents[r["doc_id"]]
        taken[source] += r["taken"]
        size[source] += r["size"]
        target[source] = r["target"]
    assert math.isclose(sum(target.values()), sum(size.values()))
    assert all(target[s] <= 3 * size[s] + 1e-6 for s in size)


def test_targets_share_excess_again(spark):
    sizes = [("a", 10), ("b", 1000), ("c", 0), (None, 500)]
    rows = mixing.source_targets(spark.createDataFrame(sizes, "source string, source_size long"), "source").collect()
    target = {r["source"]: r["target"] for r in rows}
    weights = dict(zip(["a", "b", "c", None], [5, 2, 1, 5], strict=True))
    expected, free, left = {}, set(weights), 1510.0
    while True:
        level = left / sum(weights[s] for s in free)
        full = {s for s in free if weights[s] * level > 3 * dict(sizes)[s]}
        if not full:
            break
        for s in full:
            expected[s] = 3.0 * dict(sizes)[s]
            left -= expected[s]
        free -= full
    expected |= {s: weights[s] * level for s in free}
    assert all(math.isclose(target[s], expected[s], abs_tol=1e-9) for s in expected)


def test_mix_of_odd_rows(odd, nothing):
    mixed = mixing.mix(odd, space_words(F.col("text")))
    rows = mixed.collect()
    assert len(rows) == odd.count()
    assert all(0 <= r["copies"] <= 3 for r in rows)
    emitted = mixing.mixed_rows(odd, space_words)
    assert emitted.columns == odd.columns
    assert emitted.count() == sum(r["copies"] for r in rows)
    assert mixing.mixed_rows(nothing, space_words).count() == 0


def test_copies_cross_integers(spark):
    # one source far above and one far below what it has: each row is taken floor or ceil of the rate times
    rows = [(i, "w " * (i % 7 + 1), "big" if i % 4 else "small") for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(frame, space_words(F.col("text"))).collect()
    taken = Counter()
    for r in mixed:
        rate = r["target"] / r["source_size"]
        assert math.floor(rate) <= r["copies"] <= math.ceil(rate)
        taken[r["source"]] += r["copies"] * r["size"]
    for r in mixed:
        assert abs(taken[r["source"]] - r["target"]) <= 0.05 * r["target"] + 20


def test_fingerprint_query(spark, sf_dir):
    documents = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").collect(), key=lambda r: r["doc_id"])
    rows = {r["doc_id"]: r for r in queries()["op1_order_minhash"](spark, sf_dir).collect()}
    texts = [r["text"] or "" for r in documents]
    by_text = {}
    for i, document in enumerate(documents):
        row, text = rows[document["doc_id"]], texts[i]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + texts[(i + 1) % len(texts)][:cut]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, row["fingerprint"]) == row["fingerprint"]
        assert 0 <= row["near_next"] <= 1 and 0 <= row["near_edited"] <= 1
    long_enough = [rows[d["doc_id"]] for d in documents if rows[d["doc_id"]]["n_chars"] > 400]
    nearer = sum(r["near_edited"] > r["near_next"] for r in long_enough)
    assert nearer >= 0.97 * len(long_enough)


def test_fingerprint_follows_order(spark):
    words = [f"word{i}" for i in range(400)]
    texts = [
        " ".join(words),
        " ".join(words[:200] + ["changed"] + words[200:]),
        " ".join(words[200:] + words[:200]),
        " ".join(f"other{i}" for i in range(400)),
        " ".join(["x y z"] * 30 + ["p q r s t"] * 2),
        " ".join(["x y z"] * 4 + ["p q r s t"] * 2),
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    signed = {r["doc_id"]: r["signature"] for r in fingerprints.fingerprints(frame).collect()}

    def near(a, b):
        return sum(x == y for x, y in zip(signed[a], signed[b], strict=True)) / 64

    assert near(0, 0) == 1 and near(0, 3) == 0
    assert near(0, 1) > 0.8
    # the same words, but pairs across the middle have changed their order
    assert near(0, 2) < near(0, 1)
    # the same different k-mers; occurrence numbers weigh them
    assert near(4, 5) < 1


def test_fingerprints_of_odd_rows(odd, nothing):
    rows = fingerprints.fingerprints(odd).collect()
    assert len(rows) == odd.count() and all(len(r["signature"]) == 64 for r in rows)
    assert all(set(r["signature"]) == {0} for r in rows if not (r["text"] or "").strip())
    following = fingerprints.with_next(odd, "doc_id", {"next_text": "text"}, ["text"], range_rows=2).collect()
    assert len(following) == odd.count()
    order = sorted(following, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] is not None, r["text"] or ""))
    assert [r["next_text"] for r in order] == [r["text"] for r in order[1:] + order[:1]]
    assert fingerprints.with_next(nothing, "doc_id", {"next_text": "text"}, ["text"]).count() == 0
