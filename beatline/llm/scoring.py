"""Log-probabilities of whole documents under word counts and under a gated recurrent network."""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from beatline.llm import network
from beatline.llm.network import Network, Trainer
from beatline.llm.words import Words, seeds, slices, spaced_words
from beatline.session import discard, staged, staging_path

# Tokens whose counts every task holds, 24 bytes each; the counts of others come by a join.
HEAD = 200_000
# Words of the network's own at most; all others share buckets by hash, one for so many of them, and so many at most.
OWN, BUCKET_WORDS, MOST_BUCKETS = 4_800, 16, network.MOST_WORDS - 4_800
# Rounds, replicas of a round, and documents of a replica each grow with the cube root of the training documents.
LEAST_ROUNDS, LEAST_REPLICAS, ROUND_DOCUMENTS = 2, 2, 1_000
END = seeds("end", 1)[0]
_CHUNKS = 64


@dataclass
class Counts:
    """Counts of the training tokens: of all, of the different ones, and of the most frequent by sorted hash.

    ``words`` has the network's number of each of these that has one of its own, and -1 for others.  Tokens without one,
    counted or not, have a bucket by hash; ``buckets`` are the sums over each of count + 1, with 1 for unknown tokens.
    The network numbers them after the ``own`` words.
    """

    tokens: int
    distinct: int
    heads: np.ndarray
    counts: np.ndarray
    words: np.ndarray
    buckets: np.ndarray

    @property
    def base_total(self) -> float:
        return float(self.tokens + self.distinct + 1)

    @property
    def own(self) -> int:
        return int((self.words >= 0).sum())

    def masses(self) -> np.ndarray:
        """Count + 1 of the own words by their number, then the buckets."""
        known = np.flatnonzero(self.words >= 0)
        return np.append(self.counts[known[np.argsort(self.words[known])]] + 1.0, self.buckets)

    def bucket(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(40)).astype(np.int64) % len(self.buckets)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each token among the most frequent, and whether it is there."""
        if not len(self.heads):
            return np.zeros(len(hashes), dtype=np.int64), np.zeros(len(hashes), dtype=bool)
        place = np.minimum(np.searchsorted(self.heads, hashes), len(self.heads) - 1)
        return place, self.heads[place] == hashes

    def word_numbers(self, hashes: np.ndarray) -> np.ndarray:
        place, found = self.find(hashes)
        shared = self.own + self.bucket(hashes)
        if not len(self.heads):
            return shared
        return np.where(found & (self.words[place] >= 0), self.words[place], shared)


def _with_ends(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes with one end after each text, and where each text begins."""
    return np.insert(words.hashes, words.bounds[1:], END), words.bounds + np.arange(len(words.bounds))


def _tokens(batch: pa.RecordBatch, text: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for rows, texts in slices(batch, text):
        yield rows, *_with_ends(spaced_words(texts))


def _count(text: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [hashes for _, hashes, _ in _tokens(batch, text)]
        if parts:
            tokens, counts = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(counts)], ["token", "n"])


def token_counts(documents: DataFrame, text: str = "text") -> DataFrame:
    """(``token``, ``n``) over all documents: 64-bit hashes of words between ASCII spaces, A-Z in lower case, and an end each."""
    counted = documents.select(text).mapInArrow(lambda batches: _count(text, batches), "token bigint, n bigint")
    return counted.groupBy("token").agg(F.sum("n").alias("n"))


def summary(counts: DataFrame, most: int = HEAD) -> Counts:
    """The counts' totals, and the most frequent tokens: all from a count on that leaves ``most`` at most.

    The limit is found on a histogram of the counts by their five leading bits, so nothing is sorted.
    """
    totals = counts.agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("distinct")).first()
    bits = F.bin("n")
    step = F.length(bits) * 32 + F.conv(F.rpad(F.substring(bits, 1, 5), 5, "0"), 2, 10).cast("int")
    histogram = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n"), F.min("n").alias("least")).collect()
    held, least = 0, None
    for row in sorted(histogram, key=lambda row: -row["step"]):
        held += row["n"]
        if held > most:
            break
        least = row["least"]
    if least is None:
        hashes = n = np.zeros(0, dtype=np.int64)
    else:
        rows = counts.where(F.col("n") >= least).toPandas()
        hashes, n = rows["token"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
    hashes = hashes.view(np.uint64)
    by_count = np.lexsort((hashes, -n))[:OWN]
    words = np.full(len(n), -1)
    words[by_count] = np.arange(len(by_count))
    order = np.argsort(hashes)
    others = totals["distinct"] - len(by_count)
    buckets = np.zeros(min(MOST_BUCKETS, max(1, -(-others // BUCKET_WORDS))))
    made = Counts(totals["tokens"] or 0, totals["distinct"], hashes[order], n[order], words[order], buckets)
    by_bucket = F.pmod(F.shiftrightunsigned("token", 40), F.lit(len(buckets))).cast("int")
    for row in counts.groupBy(by_bucket.alias("bucket")).agg(F.sum(F.col("n") + 1).alias("n")).collect():
        buckets[row["bucket"]] = row["n"]
    buckets += 1 - np.bincount(made.bucket(hashes[by_count]), weights=n[by_count] + 1, minlength=len(buckets))
    return made


def _train(weights: list[np.ndarray], shapes: list[tuple[int, ...]], batches) -> Iterator[pa.RecordBatch]:
    """What training changes in the weights, in pieces."""
    start = np.concatenate([part.ravel().astype(np.float32) for part in weights])
    trainer = Trainer(Network.of_flat(start, shapes))
    tokens = 0
    for batch in batches:
        texts = [np.frombuffer(ids, "<i4") for ids in batch.column("ids").to_pylist()]
        if texts:
            bounds = np.cumsum([0, *map(len, texts)])
            tokens += trainer.train(np.concatenate(texts), bounds)
    if tokens:
        change = np.clip(trainer.net.flat() - start, -60_000, 60_000)
        chunks = [part.astype("<f2").tobytes() for part in np.array_split(change, _CHUNKS)]
        made = [pa.array(range(_CHUNKS), pa.int32()), pa.array([tokens] * _CHUNKS, pa.int64()), pa.array(chunks, pa.binary())]
        yield pa.RecordBatch.from_arrays(made, ["chunk", "tokens", "change"])


def _numbered(batch: pa.RecordBatch, text: str, counts: Counts) -> tuple[np.ndarray, np.ndarray]:
    ids, bounds, n = [], [np.zeros(1, dtype=np.int64)], 0
    for _, hashes, begins in _tokens(batch, text):
        ids.append(counts.word_numbers(hashes).astype(np.int32))
        bounds.append(begins[1:] + n)
        n += len(hashes)
    return (np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32)), np.concatenate(bounds)


def _texts_as_numbers(text: str, counts: Counts, batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, bounds = _numbered(batch, text, counts)
        data = pa.py_buffer(ids.astype("<i4").tobytes())
        made = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * 4).tobytes()), data])
        kept = [batch.column("round"), batch.column("replica"), made.cast(pa.binary())]
        yield pa.RecordBatch.from_arrays(kept, ["round", "replica", "ids"])


def plan(documents: int) -> tuple[int, int]:
    """Rounds, and replicas of a round, for so many training documents."""
    root = math.ceil((documents / ROUND_DOCUMENTS) ** (1 / 3))
    return max(LEAST_ROUNDS, 2 * root), max(LEAST_REPLICAS, root)


def _average(table: pa.Table) -> pa.Table:
    tokens = np.array(table.column("tokens").to_pylist(), dtype=float)
    changes = np.stack([np.frombuffer(x, "<f2").astype(float) for x in table.column("change").to_pylist()])
    mean = (changes * (tokens / tokens.sum())[:, None]).sum(axis=0).astype("<f4").tobytes()
    return pa.table({"chunk": table.column("chunk")[:1], "change": pa.array([mean], pa.binary())})


def learn(documents: DataFrame, counts: Counts, text: str = "text", key: str = "doc_id") -> Network:
    """The network, trained on every document, whole texts each.

    Replicas start alike, each learns in a task of its own from its part of the round's documents, and what they change in the
    weights is averaged by tokens, once a round; a digest of key and text deals each document to one round and one replica.  With more
    documents there are more rounds, more replicas, and more documents for each.  A network's size is bounded whatever
    the corpus, and only the averages leave the cluster.  Weights go to the tasks, and changes come back, in half precision (0.9 MB);
    the driver adds the changes up in full.
    """
    # before it learns, the network gives the base score but for the unknown word of each bucket
    start = Network.of_counts(counts.masses(), 0.0)
    rounds, replicas = plan(documents.count())
    dealt = F.xxhash64(key, text)
    dealt = documents.select(
        F.pmod(dealt, F.lit(rounds)).cast("int").alias("round"),
        F.pmod(F.shiftrightunsigned(dealt, 32), F.lit(replicas)).cast("int").alias("replica"),
        F.col(text).alias("text"),
    )
    schema = "round int, replica int, ids binary"
    numbered = dealt.mapInArrow(lambda batches: _texts_as_numbers("text", counts, batches), schema)
    path = staging_path(documents.sparkSession, "numbered")
    # a round reads its own files only
    numbered.write.partitionBy("round").parquet(path)
    numbered = documents.sparkSession.read.schema(schema).parquet(path)
    weights, shapes = start.flat(), start.shapes()
    for i in range(rounds):
        part = numbered.where(F.col("round") == i).drop("round").repartitionById(replicas, "replica")
        part = part.sortWithinPartitions("replica", F.xxhash64("ids"), "ids").select("ids")
        sent = start.with_flat(weights).packed()
        trained = part.mapInArrow(
            lambda batches, sent=sent: _train(sent, shapes, batches), "chunk int, tokens bigint, change binary"
        )
        mean = trained.groupBy("chunk").applyInArrow(_average, "chunk int, change binary").collect()
        if mean:
            change = [np.frombuffer(row["change"], "<f4") for row in sorted(mean, key=lambda row: row["chunk"])]
            weights = weights + np.concatenate(change)
    discard(documents.sparkSession, path)
    return start.with_flat(weights)


def _score(text: str, names: list[str], counts: Counts, net: Network, batches) -> Iterator[pa.RecordBatch]:
    bucket_logs = np.log10(counts.buckets)
    count_logs = np.log10(counts.counts + 1.0)
    for batch in batches:
        # each text is read once: words are numbered for the network, and placed among the counted ones for the base
        parts, ids, bounds, n_ids = [], [], [np.zeros(1, dtype=np.int64)], 0
        for rows, hashes, begins in _tokens(batch, text):
            place, found = counts.find(hashes)
            number = counts.own + counts.bucket(hashes)
            if len(counts.heads):
                number = np.where(found & (counts.words[place] >= 0), counts.words[place], number)
            rare = np.flatnonzero(~found)
            parts.append((rows, begins, np.where(found, place, -1).astype(np.int32), rare, hashes[rare]))
            ids.append(number.astype(np.int32))
            bounds.append(begins[1:] + n_ids)
            n_ids += len(hashes)
        if not parts:
            continue
        starts = np.concatenate(bounds)
        likelihood = network.log_likelihoods(net, np.concatenate(ids), starts) / np.log(10)
        first = 0
        for (rows, begins, place, rare, rare_hashes), number in zip(parts, ids, strict=True):
            n = rows.num_rows
            logs = np.where(place >= 0, count_logs[place], 0.0) if len(counts.heads) else np.zeros(len(place))
            owner = np.repeat(np.arange(n), np.diff(begins))
            shared = np.flatnonzero(number >= counts.own)
            within = logs[shared] - bucket_logs[number[shared] - counts.own]
            in_buckets = np.bincount(owner[shared], weights=within, minlength=n)
            offsets = np.searchsorted(rare, begins).astype(np.int32)
            made = {
                "n_tokens": pa.array(np.diff(begins), pa.int64()),
                "n_known": pa.array(np.bincount(owner[place >= 0], minlength=n), pa.int64()),
                "base_score": pa.array(np.bincount(owner, weights=logs, minlength=n)),
                "score": pa.array(likelihood[first : first + n] + in_buckets),
                "rare": pa.ListArray.from_arrays(pa.array(offsets), pa.array(rare_hashes.view(np.int64))),
            }
            yield pa.RecordBatch.from_arrays([made[x] if x in made else rows.column(x) for x in names], names)
            first += n


def score(documents: DataFrame, may_learn: Column, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All columns but the text, with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    Tokens are words between ASCII spaces with A-Z in lower case, and one end per text; NULL is an empty text.
    ``base_score`` sums log10 of ``(count + 1) / (tokens + different + 1)`` over the tokens, with the counts of all
    documents where ``may_learn`` holds.  ``score`` is the log10 probability under the network: a class, then a word or
    a bucket of the class; a bucket gives each of its words by its count in the same way, so unknown words have a share too.
    Without any training document both use counts of 0.  Repeated rows are scored each; columns of the names are replaced.
    """
    taught = documents.where(may_learn)
    all_counts = staged(token_counts(taught, text), "counts")
    counts = summary(all_counts)
    net = learn(taught, counts, text, key)
    made = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    kept = documents.drop(*made, "rare")
    types = {"n_tokens": "long", "n_known": "long", "base_score": "double", "score": "double", "rare": "array<bigint>"}
    schema = kept.drop(text).withColumns({name: F.lit(None).cast(type_) for name, type_ in types.items()}).schema
    names = schema.names
    rows = kept.mapInArrow(lambda batches: _score(text, names, counts, net, batches), schema)
    rows = staged(rows.withColumn("__row", F.monotonically_increasing_id()), "scores")
    # rare tokens meet their counts in a join; a token in no training document finds none and adds the logarithm of 1
    rare = rows.select("__row", F.explode("rare").alias("token")).join(all_counts, "token")
    found = rare.groupBy("__row").agg(F.count(F.lit(1)).alias("__known"), F.sum(F.log10(F.col("n") + 1)).alias("__logs"))
    joined = rows.drop("rare").join(found, "__row", "left").drop("__row")
    logs = F.coalesce("__logs", F.lit(0.0))
    base = F.col("base_score") + logs - F.col("n_tokens") * F.lit(float(np.log10(counts.base_total)))
    out = joined.withColumns(
        {
            "n_known": F.col("n_known") + F.coalesce("__known", F.lit(0)),
            "train_tokens": F.lit(counts.tokens).cast("long"),
            "base_score": base,
            "score": F.col("score") + logs,
        }
    )
    return out.drop("__known", "__logs")
