"""Toxic passages: maximum-scoring segments of token log-odds, aggregated by extreme-value calibration."""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from beatline.llm.columns import digest_of, on_plain_names
from beatline.llm.words import Texts, Words, heads, slices, text_words
from beatline.session import staged

# The model is fitted on at most so many labelled documents, chosen by a digest of their IDs.
MOST_LABELLED = 200_000
# Tokens with a score of their own; all others are neutral.
LEXICON = 50_000
# Mass of the Dirichlet prior, as a share of all tokens.
PRIOR_SHARE = 0.1
# A smaller difference is no sign of toxicity, however certain it is in a large corpus.
LEAST_ODDS = 1.2
# What a neutral token takes from a passage, in log-odds.
DRIFT = 0.1
# A word without a score of its own takes that of its first letters, of as many as have one.
HEADS = (4,)
# Width and number of the bins that turn a document's significance into a probability.
BIN, BINS = 0.5, 200


@dataclass
class Model:
    """Token scores by sorted 64-bit hash, the scale of scores, and the probability for each bin of significance."""

    tokens: np.ndarray
    scores: np.ndarray
    scale: float
    log_rate: float = 0.0
    probabilities: tuple[float, ...] = ()


def labelled(labels: DataFrame, label: str, key: str = "doc_id", most: int = MOST_LABELLED) -> DataFrame:
    """(``key``, ``label``) of at most ``most`` labelled documents; rows without a key or a label of 0 or 1 are left out.

    Of several labels of one document the highest holds.  The choice depends on a digest of the key alone; the threshold
    on it keeps the sort to little more than ``most`` rows.
    """
    known = labels.select(F.col(key), F.col(label).cast("int").alias(label)).where(F.col(key).isNotNull() & F.col(label).isin(0, 1))
    single = known.groupBy(key).agg(F.max(label).alias(label))
    n = single.count()
    share = F.conv(F.substring(digest_of(F.col(key)), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    near = single.where(share <= F.lit(1.1 * most / max(1, n))) if n > most else single
    return near.orderBy(digest_of(F.col(key)), key).limit(most)


def _once(owners: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """The tokens, each once per text."""
    order = np.lexsort((tokens, owners))
    owners, tokens = owners[order], tokens[order]
    first = np.ones(len(tokens), dtype=bool)
    first[1:] = (owners[1:] != owners[:-1]) | (tokens[1:] != tokens[:-1])
    return tokens[first]


def _count(text: str, label: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["head", "token", "toxic", "clean"]
    for batch in batches:
        held: dict[tuple[int, bool], list[np.ndarray]] = {}
        for rows, texts in slices(batch, text):
            words = text_words(texts)
            toxic = np.asarray(rows.column(label))[words.owners()] == 1
            owners = words.owners()
            for head in (0, *HEADS):
                tokens = heads(texts, words, head) if head else words.hashes
                for side in (False, True):
                    chosen = (toxic == side) & (tokens != 0)
                    held.setdefault((head, side), []).append(_once(owners[chosen], tokens[chosen]))
        for (head, side), parts in held.items():
            tokens, counts = np.unique(np.concatenate(parts), return_counts=True)
            none = np.zeros(len(tokens), dtype=np.int64)
            sides = (counts, none) if side else (none, counts)
            columns = [pa.array(np.full(len(tokens), head, dtype=np.int32)), pa.array(tokens.view(np.int64)), *map(pa.array, sides)]
            yield pa.RecordBatch.from_arrays(columns, names)


def learn_scores(documents: DataFrame, text: str, label: str) -> Model:
    """Log-odds of each token between toxic and other documents, with an informative Dirichlet prior.

    Tokens are words and, counted apart, the first letters of longer words, each once per document.  The prior of a token
    is its share of all tokens times ``PRIOR_SHARE`` of their number.  Only tokens keep a score whose log-odds are ``LEAST_ODDS``
    from 0 and more standard errors than chance gives to any of so many tokens, the ``LEXICON`` most certain ones; that
    table alone leaves the cluster.
    """
    counts = documents.select(text, label).mapInArrow(
        lambda batches: _count(text, label, batches), "head int, token bigint, toxic bigint, clean bigint"
    )
    sides = ("toxic", "clean")
    tokens = staged(counts.groupBy("head", "token").agg(*(F.sum(side).alias(side) for side in sides)), "tokens")
    totals = {row["head"]: row for row in tokens.groupBy("head").agg(*(F.sum(side).alias(side) for side in sides)).collect()}
    if 0 not in totals or not totals[0]["toxic"] or not totals[0]["clean"]:
        return Model(np.zeros(0, dtype=np.uint64), np.zeros(0), 1.0)

    def total(side: str) -> Column:
        by_length = F.create_map(*(F.lit(x) for head, row in totals.items() for x in (head, float(row[side]))))
        return F.element_at(by_length, F.col("head"))

    mass = (total("toxic") + total("clean")) * F.lit(PRIOR_SHARE)
    prior = (F.col("toxic") + F.col("clean")) * F.lit(PRIOR_SHARE)
    toxic, clean = ((F.col(side) + prior) for side in sides)
    odds = F.log(toxic / (total("toxic") + mass - toxic)) - F.log(clean / (total("clean") + mass - clean))
    scored = tokens.withColumn("odds", odds).withColumn("z", F.col("odds") / F.sqrt(1 / toxic + 1 / clean))
    scored = scored.withColumn("share", clean / (total("clean") + mass))
    # the largest of n normal errors stays below sqrt(2 ln n)
    chance = float(np.sqrt(2 * np.log(max(2, tokens.count()))))
    certain = scored.where((F.abs("z") >= chance) & (F.abs("odds") >= LEAST_ODDS)).orderBy(F.abs("z").desc(), "token").limit(LEXICON)
    rows = certain.select("token", "odds", "share").toPandas()
    hashes = rows["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    scores = rows["odds"].to_numpy(float)[order] - DRIFT
    return Model(hashes[order], scores, _scale(scores, rows["share"].to_numpy(float)[order]))


def _scale(scores: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of ``sum(share * exp(root * score)) = 1`` over the tokens of clean documents."""
    neutral = max(0.0, 1.0 - shares.sum())

    def excess(root: float) -> float:
        return float((shares * np.exp(np.minimum(root * scores, 700))).sum() + neutral * np.exp(-root * DRIFT) - 1)

    low, high = 1e-6, 1e-6
    while excess(high) < 0 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return high


def maximal_segments(scores: list[float], starts: list[int], ends: list[int]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments, by the linear scan of Ruzzo and Tompa.

    Item ``i`` covers the tokens ``starts[i]`` to ``ends[i]``.  A segment joins an earlier one where the sum from there on
    is higher at both ends; segments are disjoint and each scores more than any part of it.
    """
    # with each segment the nearest earlier one that begins lower: those in between need not be looked at again
    found: list[tuple[int, int, float, float, int]] = []
    total = 0.0
    for score, start, end in zip(scores, starts, ends, strict=True):
        before, total = total, total + score
        if score <= 0:
            continue
        left, right = before, total
        at = len(found) - 1
        while True:
            while at >= 0 and found[at][2] >= left:
                at = found[at][4]
            if at < 0 or found[at][3] >= right:
                found.append((start, end, left, right, at))
                break
            start, left, lower = found[at][0], found[at][2], found[at][4]
            del found[at:]
            at = lower
    return [(start, end, right - left) for start, end, left, right, _ in found]


def _token_scores(texts: Texts, words: Words, model: Model) -> np.ndarray:
    """The score of each word; NaN for neutral ones."""
    out = np.full(len(words.hashes), np.nan)
    for head in (0, *HEADS):
        tokens = heads(texts, words, head) if head else words.hashes
        place = np.minimum(np.searchsorted(model.tokens, tokens), len(model.tokens) - 1)
        found = (model.tokens[place] == tokens) & np.isnan(out)
        out[found] = model.scores[place[found]]
    return out


def text_segments(texts: Texts, words: Words, model: Model) -> list[list[tuple[int, int, float]]]:
    """The segments of each text; runs of neutral tokens count as one item, which changes no segment."""
    out: list[list[tuple[int, int, float]]] = [[] for _ in range(len(words.bounds) - 1)]
    if not len(model.tokens) or not len(words.hashes):
        return out
    scores_of = _token_scores(texts, words, model)
    hit = np.flatnonzero(~np.isnan(scores_of))
    owner = np.searchsorted(words.bounds, hit, side="right") - 1
    score = scores_of[hit]
    cuts = np.searchsorted(owner, np.arange(len(out) + 1))
    some = np.zeros(len(out), dtype=bool)
    some[owner[score > 0]] = True
    for i in np.flatnonzero(some):
        at = hit[cuts[i] : cuts[i + 1]] - words.bounds[i]
        gaps = np.diff(at, prepend=-1) - 1
        scores, starts = np.empty(2 * len(at)), np.empty(2 * len(at), dtype=np.int64)
        scores[0::2], scores[1::2] = -DRIFT * gaps, score[cuts[i] : cuts[i + 1]]
        starts[0::2], starts[1::2] = at - gaps, at
        ends = np.append(starts[1:], at[-1] + 1)
        out[i] = maximal_segments(scores.tolist(), starts.tolist(), ends.tolist())
    return out


_SEGMENT = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
_SEGMENTS_SQL = "array<struct<start:bigint,end:bigint,score:double>>"


def _segments(text: str, names: list[str], model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in slices(batch, text):
            words = text_words(texts)
            found = [[{"start": a, "end": b, "score": s} for a, b, s in x] for x in text_segments(texts, words, model)]
            made = {
                "n_tokens": pa.array(words.counts(), type=pa.int64()),
                "segments": pa.array(found, type=pa.list_(_SEGMENT)),
            }
            yield pa.RecordBatch.from_arrays([made[n] if n in made else rows.column(n) for n in names], names)


def segments(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns with ``n_tokens`` and ``segments``: (start, end, score) in tokens, end exclusive."""
    kept = documents.drop("n_tokens", "segments")
    made = {"n_tokens": F.lit(None).cast("long"), "segments": F.lit(None).cast(_SEGMENTS_SQL)}
    schema = kept.withColumns(made).schema
    return kept.mapInArrow(lambda batches: _segments(text, schema.names, model, batches), schema)


def significance(model: Model, segment_list: str = "segments", tokens: str = "n_tokens") -> Column:
    """Sum over the segments of how far each lies above what chance gives in a text of that length, in logarithms.

    Chance has about ``rate * tokens * exp(-scale * score)`` segments of a score or more; one with less than one expected
    is significant.
    """
    expected = F.lit(model.log_rate) + F.log(F.greatest(F.col(tokens), F.lit(1)).cast("double"))

    def above(segment: Column) -> Column:
        return F.greatest(F.lit(model.scale) * segment["score"] - expected, F.lit(0.0))

    return F.aggregate(segment_list, F.lit(0.0), lambda total, segment: total + above(segment))


def _bin(value: Column) -> Column:
    return F.least(F.ceil(value / F.lit(BIN)), F.lit(BINS)).cast("int")


def calibrate(found: DataFrame, label: str, model: Model) -> Model:
    """The model with the rate of chance segments and the probabilities, from labelled rows with their segments.

    The rate comes from the segments of clean documents above the median of their scores.  Probabilities are shares of toxic
    documents by bin of significance, pooled until they never fall.  Only counts leave the cluster.
    """
    clean = found.where(F.col(label) == 0)
    tokens = clean.agg(F.sum("n_tokens")).first()[0] or 0
    scores = clean.select(F.explode("segments.score").alias("score"))
    median = scores.agg(F.percentile_approx("score", 0.5, 10_000)).first()[0]
    above = scores.where(F.col("score") >= F.lit(median)).count() if median is not None else 0
    level = median if median is not None else 0.0
    model.log_rate = float(np.log(max(1, above) / max(1, tokens)) + model.scale * level)
    bins = found.groupBy(_bin(significance(model)).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("toxic"))
    n, toxic = np.zeros(BINS + 1), np.zeros(BINS + 1)
    for row in bins.collect():
        n[row["bin"]], toxic[row["bin"]] = row["n"], row["toxic"]
    model.probabilities = tuple(_never_falling(n, toxic))
    return model


def _never_falling(n: np.ndarray, hits: np.ndarray) -> list[float]:
    """Shares with one prior observation at the overall share, neighbours pooled until none is below the one before."""
    overall = hits.sum() / n.sum() if n.sum() else 0.0
    pools: list[list[float]] = []
    for bin_n, bin_hits in zip(n.tolist(), hits.tolist(), strict=True):
        pools.append([bin_n, bin_hits, 1])
        while len(pools) > 1 and _share(pools[-2], overall) >= _share(pools[-1], overall):
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return [_share(pool, overall) for pool in pools for _ in range(int(pool[2]))]


def _share(pool: list[float], overall: float) -> float:
    return (pool[1] + overall) / (pool[0] + 1)


def score(
    documents: DataFrame,
    labels: DataFrame,
    may_learn: Callable[[Column], Column],
    text: str = "text",
    key: str = "doc_id",
    label: str = "toxic",
    most_labelled: int = MOST_LABELLED,
) -> DataFrame:
    """All columns with ``segments`` (each with its significance), ``significance`` and ``score``, the probability of toxic.

    The model learns from the labelled documents whose key ``may_learn`` allows, at most
    ``most_labelled``, which is also the bound of what is broadcast.  A score depends on the text alone; NULL and empty
    texts have no segment and get the probability of documents without one.  Without any label, or with labels of one kind
    only, every score is the share of toxic ones among the labels (0 without any).  Repeated rows are scored each.
    """
    known = labelled(labels.where(may_learn(F.col(key))), label, key, most_labelled)
    taught = documents.where(may_learn(F.col(key))).select(key, text).join(F.broadcast(known), key)
    model = learn_scores(taught.where(F.col(text).isNotNull()), text, label)
    narrow = staged(segments(taught, model, text).select(label, "n_tokens", "segments"), "segments")
    model = calibrate(narrow, label, model)
    found = segments(documents, model, text)
    found = found.withColumn("significance", significance(model))
    probability = F.element_at(F.array(*(F.lit(p) for p in model.probabilities)), _bin(F.col("significance")) + 1)
    return found.withColumn("score", probability)


def without_toxic(
    documents: DataFrame,
    labels: DataFrame,
    may_learn: Callable[[Column], Column],
    threshold: float = 0.3,
    text: str = "text",
    key: str = "doc_id",
    label: str = "toxic",
) -> DataFrame:
    """The documents whose score is below the threshold, with the columns they had."""

    def kept(plain: DataFrame, text_name: str, key_name: str) -> DataFrame:
        known = labels.select(F.col(key).alias(key_name), F.col(label))
        scored = score(plain, known, may_learn, text_name, key_name, label)
        return scored.where(F.col("score") < threshold)

    return on_plain_names(documents, kept, text, key)
