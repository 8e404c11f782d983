"""Runs of repeated words in documents."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from beatline.llm import grammar

# Fewest words of a run, and fewest times that its period fits into it.
LEAST_WORDS, LEAST_TIMES = 6, 4

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_MADE = ("n_words", "runs", "collapsed")


def split_words(text: bytes | None) -> list[bytes]:
    """Words between ASCII spaces of a UTF-8 text; NULL has none."""
    return (text or b"").split()


def _numbered(words: list[bytes]) -> np.ndarray:
    numbers: dict[bytes, int] = {}
    return np.fromiter((numbers.setdefault(word, len(numbers)) for word in words), dtype=np.int64, count=len(words))


def runs_of(words: list[bytes]) -> np.ndarray:
    """(start, end, period) of each run of the words, by start, then period."""
    if len(words) < LEAST_WORDS:
        return np.zeros((0, 3), dtype=np.int64)
    return grammar.runs(_numbered(words), LEAST_WORDS, LEAST_TIMES)


def collapsed(words: list[bytes], found: np.ndarray) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not len(found):
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return [words[i] for i in kept.tolist()]


def _detect(
    text: str, names: list[str], change: Callable | None, key: str | None, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(text).cast(pa.binary())
        keys = batch.column(key) if key else None
        # results leave in batches of some megabytes, however long the texts are
        step = max(1, min(batch.num_rows, (batch.num_rows << 22) // max(texts.nbytes, 1)))
        for begin in range(0, batch.num_rows, step):
            rows = batch.slice(begin, step)
            n_words, found, left = [], [], []
            for i in range(begin, begin + rows.num_rows):
                words = split_words(texts[i].as_py())
                if change:
                    words = change(words, keys[i].as_py())
                runs = runs_of(words)
                n_words.append(len(words))
                found.append([{"start": a, "length": b - a, "period": q} for a, b, q in runs.tolist()])
                left.append(b" ".join(collapsed(words, runs)))
            made = {
                "n_words": pa.array(n_words, type=pa.int64()),
                "runs": pa.array(found, type=pa.list_(_RUN)),
                "collapsed": pa.array(left, type=pa.binary()).view(pa.string()),
            }
            yield pa.RecordBatch.from_arrays([made[n] if n in made else rows.column(n) for n in names], names)


def detect(documents: DataFrame, text: str = "text", change: Callable | None = None, key: str | None = None) -> DataFrame:
    """All rows with ``n_words``, ``runs`` and ``collapsed``.

    ``runs`` are the stretches of consecutive words, maximal, with smallest period ``q`` and at least ``max(6, 4 * q)`` words, as
    (start, length, period), ordered by start, then period.  ``collapsed`` are the words that no run holds after its first
    period, with single spaces between them.  ``change(words, key)`` may turn the words into others before; it gets the value
    of the column ``key``.

    Rows are independent, so nothing is shuffled and a lost task reads its rows again.  A whole text of any length is read, in time
    that grows little more than its words.  A NULL or empty text has no words, no runs and an empty ``collapsed``; repeated
    rows are searched each; an empty table gives an empty one.  Columns of the three names are replaced.
    """
    kept = documents.drop(*(c for c in documents.columns if c.lower() in _MADE and c not in (text, key)))
    out = kept.select(
        *(F.col(f"`{c}`") for c in kept.columns if c.lower() not in _MADE),
        F.lit(None).cast("long").alias("n_words"),
        F.lit(None).cast("array<struct<start:bigint,length:bigint,period:bigint>>").alias("runs"),
        F.lit(None).cast("string").alias("collapsed"),
    )
    names = out.columns
    return kept.mapInArrow(lambda batches: _detect(text, names, change, key, batches), out.schema)


def strongest(runs: str = "runs"):
    """The run of greatest length for its period, then smallest start, then period; NULL if there is none.

    Ratios are compared as whole numbers, crosswise, so equal ones are ties.
    """

    def better(best, run):
        first, second = run["length"] * best["period"], best["length"] * run["period"]
        sooner = F.struct(run["start"], run["period"]) < F.struct(best["start"], best["period"])
        return F.when(best.isNull() | (first > second) | ((first == second) & sooner), run).otherwise(best)

    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, better)
