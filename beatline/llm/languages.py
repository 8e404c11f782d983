"""Language identification with hyperdimensional profiles."""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from beatline.llm.words import mixed, seeds, slices

DIMENSIONS = 1024
UNKNOWN = "und"
# n-gram vectors that are held at once
_BLOCK = 4096


@cache
def _letters() -> np.ndarray:
    """For each code point, itself if it is a letter, else 0."""
    points = np.arange(0x110000, dtype=np.uint32)
    return np.where(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000), points, np.uint32(0))


def letter_vectors(points: np.ndarray, dimensions: int) -> np.ndarray:
    """A random vector of 1 and -1 for each code point; it depends on the code point alone."""
    start = seeds("letters", dimensions // 64)
    with np.errstate(over="ignore"):
        words = mixed(mixed(points.astype(np.uint64) + np.uint64(1))[:, None] ^ start[None, :])
    bits = np.unpackbits(words.astype("<u8").view(np.uint8).reshape(len(points), -1), axis=1, bitorder="little")
    return (bits.astype(np.int8) << 1) - np.int8(1)


@dataclass
class Grams:
    """Letter trigrams of some texts; spaces stand for anything else, also before the first and after the last letter.

    ``text`` and ``gram`` say which text has which of the distinct ``grams`` (rows of three places in ``points``), and
    ``count`` how often.
    """

    points: np.ndarray
    grams: np.ndarray
    text: np.ndarray
    gram: np.ndarray
    count: np.ndarray

    def vectors(self, start: int, end: int, dimensions: int) -> np.ndarray:
        """Each n-gram binds its letters' vectors, permuted by their place in it."""
        letters = letter_vectors(self.points, dimensions)
        at = self.grams[start:end]
        twice, once = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1)
        return (twice[at[:, 0]] * once[at[:, 1]] * letters[at[:, 2]]).astype(np.float32)

    def bundles(self, rows: np.ndarray, n: int, dimensions: int) -> np.ndarray:
        """The sum of all n-gram vectors by row; ``rows`` has the row of each text."""
        out = np.zeros((n, dimensions))
        row = rows[self.text]
        order = np.argsort(self.gram, kind="stable")
        begin = np.searchsorted(self.gram[order], np.arange(0, len(self.grams) + _BLOCK, _BLOCK))
        for block, start in enumerate(range(0, len(self.grams), _BLOCK)):
            end = min(start + _BLOCK, len(self.grams))
            part = order[begin[block] : begin[block + 1]]
            counts = np.zeros((n, end - start), dtype=np.float32)
            np.add.at(counts, (row[part], self.gram[part] - start), self.count[part].astype(np.float32))
            out += counts @ self.vectors(start, end, dimensions)
        return out


def grams_of(texts: list[str]) -> Grams:
    joined = "\0".join(["", *(text.lower() for text in texts), ""])
    points = _letters()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    lengths = np.fromiter((len(text.lower()) + 1 for text in texts), np.int64, len(texts))
    owner = np.concatenate([np.repeat(np.arange(len(texts)), lengths), [len(texts)]])
    # one space between words; the zero before a text belongs to it, the next one closes it
    keep = np.ones(len(points), dtype=bool)
    keep[1:] = (points[1:] != 0) | (points[:-1] != 0) | (owner[1:] != owner[:-1])
    points, owner = points[keep], owner[keep]
    known, place = np.unique(points, return_inverse=True)
    size = len(known)
    middle = np.arange(1, len(points) - 1)
    middle = middle[(points[1:-1] != 0) & (owner[1:-1] < len(texts))]
    key = (place[middle - 1] * size + place[middle]) * size + place[middle + 1]
    both, count = np.unique(owner[middle] * size**3 + key, return_counts=True)
    distinct, gram = np.unique(both % size**3, return_inverse=True)
    grams = np.stack([distinct // size**2, distinct // size % size, distinct % size], axis=1)
    return Grams(known, grams, both // size**3, gram, count)


@dataclass
class Profiles:
    """One prototype vector per language, of length 1."""

    languages: list[str]
    vectors: np.ndarray


def _texts(batch: pa.RecordBatch, text: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for rows, _ in slices(batch, text, lower=False):
        yield rows, [value or "" for value in rows.column(text).to_pylist()]


def _bundle(text: str, language: str, dimensions: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for rows, texts in _texts(batch, text):
            names = rows.column(language).to_pylist()
            known = sorted(set(names))
            made = grams_of(texts).bundles(np.searchsorted(known, names), len(known), dimensions)
            for name, vector in zip(known, made, strict=True):
                sums[name] = sums.get(name, 0) + vector
    for name, vector in sums.items():
        at = pa.array(np.arange(dimensions, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([pa.array([name] * dimensions), at, pa.array(vector)], ["language", "at", "value"])


def learn(documents: DataFrame, text: str = "text", language: str = "lang", dimensions: int = DIMENSIONS) -> Profiles:
    """Prototypes of all languages in ``documents``; rows without a text or language teach nothing.

    Each task bundles its rows and returns one vector per language; the sums of these, whole numbers, come to the driver:
    languages times ``dimensions`` values, whatever the number of documents.
    """
    if dimensions % 64:
        raise ValueError("dimensions must be a multiple of 64")
    taught = documents.select(F.col(text).alias("text"), F.col(language).cast("string").alias("language"))
    taught = taught.where("text IS NOT NULL AND language IS NOT NULL")
    parts = taught.mapInArrow(
        lambda batches: _bundle("text", "language", dimensions, batches), "language string, at int, value double"
    )
    values = parts.groupBy("language", "at").agg(F.sum("value").alias("value")).collect()
    names = sorted({row["language"] for row in values})
    vectors = np.zeros((len(names), dimensions))
    for row in values:
        vectors[names.index(row["language"]), row["at"]] = row["value"]
    lengths = np.linalg.norm(vectors, axis=1)
    # a language whose texts have no letter has no direction
    return Profiles([n for n, x in zip(names, lengths, strict=True) if x], vectors[lengths > 0] / lengths[lengths > 0][:, None])


def predictions(texts: list[str], profiles: Profiles) -> tuple[list[str], np.ndarray]:
    """The language of each text and its cosine, 0 at least."""
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if not profiles.languages or not texts:
        return names, scores
    dimensions = profiles.vectors.shape[1]
    bundles = grams_of(texts).bundles(np.arange(len(texts)), len(texts), dimensions)
    lengths = np.linalg.norm(bundles, axis=1)
    cosines = bundles @ profiles.vectors.T / np.maximum(lengths, 1e-12)[:, None]
    best = cosines.argmax(axis=1)
    for i in np.flatnonzero(lengths > 0):
        names[i] = profiles.languages[best[i]]
    scores = np.where(lengths > 0, np.clip(cosines[np.arange(len(texts)), best], 0, 1), 0)
    return names, scores


def _identify(text: str, names: list[str], profiles: Profiles, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in _texts(batch, text):
            found, scores = predictions(texts, profiles)
            made = {"lang_pred": pa.array(found, type=pa.string()), "score": pa.array(scores, type=pa.float64())}
            yield pa.RecordBatch.from_arrays([made[n] if n in made else rows.column(n) for n in names], names)


def identify(documents: DataFrame, profiles: Profiles, text: str = "text", keep: tuple[Column | str, ...] = ()) -> DataFrame:
    """``keep`` of each row (all columns if it is empty) with ``lang_pred`` and ``score``, the cosine to that prototype.

    The prediction depends on the text alone, whole and of any length.  Without a text, a letter or a learned language it
    is ``und`` with the score 0; of equally near languages the first by name wins.  Columns of the two names are replaced.
    """
    kept = documents.select(*keep, text) if keep else documents
    kept = kept.drop("lang_pred", "score")
    out = kept.drop(text) if keep else kept
    schema = out.withColumns({"lang_pred": F.lit("").cast("string"), "score": F.lit(None).cast("double")}).schema
    names = schema.names
    return kept.mapInArrow(lambda batches: _identify(text, names, profiles, batches), schema)
