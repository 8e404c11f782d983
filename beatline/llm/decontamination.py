"""Benchmark passages in documents, by Wu-Manber search for many word sequences at once."""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from beatline.llm.columns import on_plain_names
from beatline.llm.words import Texts, Words, runs_at, runs_of, slices, text_words
from beatline.session import Staging

WINDOW = 10
# Search patterns that one pass over the documents holds; further ones take further passes.
PASS_WINDOWS = 200_000
_LANE = 256


@dataclass
class Patterns:
    """The test strings of one length, ready to be searched."""

    length: int
    keys: np.ndarray
    strings: list[list[tuple[bytes, int]]]
    block: int = field(init=False)
    shifts: np.ndarray = field(init=False)

    @classmethod
    def of(cls, length: int, found: list[tuple[int, bytes, int, np.ndarray]]) -> "Patterns":
        """From (hash, string, item, word hashes) of each window."""
        found.sort(key=lambda x: (x[0], x[1], x[2]))
        keys, strings = [], []
        for key, string, item, _ in found:
            if not keys or keys[-1] != key:
                keys.append(key)
                strings.append([])
            strings[-1].append((string, item))
        made = cls(length, np.array(keys, dtype=np.uint64), strings)
        made.block = min(2, length)
        bits = max(12, int(np.ceil(np.log2(8 * length * len(keys)))))
        # a block that is in no pattern lets the search jump over all places whose window would hold it
        made.shifts = np.full(1 << bits, length - made.block + 1, dtype=np.uint16)
        words = np.unique(np.array([hashes for *_, hashes in found], dtype=np.uint64), axis=0)
        for end in range(made.block, length + 1):
            blocks = made.slots(words[:, end - made.block : end])
            np.minimum.at(made.shifts, blocks, length - end)
        return made

    def slots(self, blocks: np.ndarray) -> np.ndarray:
        """The place in the shift table of each row's block of words."""
        mixed = blocks[:, 0] if self.block == 1 else blocks[:, 0] * np.uint64(0x9E3779B97F4A7C15) + blocks[:, 1]
        return (mixed >> np.uint64(64 - int(np.log2(len(self.shifts))))).astype(np.int64)

    def candidates(self, words: Words) -> np.ndarray:
        """The places where a window's last block is the end of a pattern, found in many lanes side by side."""
        hashes, bounds = words.hashes, words.bounds
        if len(hashes) < self.length:
            return np.zeros(0, dtype=np.int64)
        tails = hashes[self.length - self.block :]
        blocks = np.stack([tails[: len(tails) - 1], tails[1:]], axis=1) if self.block == 2 else tails[:, None]
        jump = self.shifts[self.slots(blocks)].astype(np.int64)
        first, last = bounds[:-1], bounds[1:] - self.length + 1
        long_enough = last > first
        first, last = first[long_enough], last[long_enough]
        lanes = -(-(last - first) // _LANE)
        nth = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = np.repeat(first, lanes) + nth * _LANE
        stop = np.minimum(at + _LANE, np.repeat(last, lanes))
        found = []
        while len(at):
            step = jump[at]
            found.append(at[step == 0])
            at = at + np.maximum(step, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)

    def occurrences(self, texts: Texts, words: Words) -> list[tuple[int, int]]:
        """(place, item) of every occurrence, each confirmed on the words themselves."""
        at = self.candidates(words)
        if not len(at):
            return []
        total = runs_at(words.hashes, at, self.length)
        bucket = np.minimum(np.searchsorted(self.keys, total), len(self.keys) - 1)
        same = self.keys[bucket] == total
        out = []
        for place, number in zip(at[same].tolist(), bucket[same].tolist(), strict=True):
            string = string_of(texts, words, place, self.length)
            out += [(place, item) for wanted, item in self.strings[number] if wanted == string]
        return out


def string_of(texts: Texts, words: Words, place: int, length: int) -> bytes:
    starts, ends = words.starts[place : place + length], words.ends[place : place + length]
    return b" ".join(texts.data[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True))


def pattern_blocks(items: Iterable[tuple[int, str | None]], window: int, limit: int) -> Iterator[list[Patterns]]:
    """Patterns of all items, about ``limit`` windows at a time; an item shorter than the window is one pattern."""
    found: dict[int, list] = {}
    held = 0
    for item, text in items:
        column = pa.array([text or ""], type=pa.large_string())
        for _, texts in slices(pa.record_batch({"text": column}), "text"):
            words = text_words(texts)
            n = len(words.hashes)
            length = min(window, n)
            if length:
                for place, key in zip(range(n - length + 1), runs_of(words.hashes, length).tolist(), strict=True):
                    string = string_of(texts, words, place, length)
                    found.setdefault(length, []).append((key, string, item, words.hashes[place : place + length]))
                    held += 1
        if held >= limit:
            yield [Patterns.of(length, rows) for length, rows in sorted(found.items())]
            found, held = {}, 0
    yield [Patterns.of(length, rows) for length, rows in sorted(found.items())]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def _search(patterns: list[Patterns], text: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in slices(batch, text):
            words = text_words(texts)
            spans = [[(s["start"], s["end"]) for s in x] for x in rows.column("hit_spans").to_pylist()]
            items = rows.column("hit_items").to_pylist()
            touched = set()
            for group in patterns:
                found = group.occurrences(texts, words)
                owners = np.searchsorted(words.bounds, [place for place, _ in found], side="right") - 1
                for (place, item), owner in zip(found, owners.tolist(), strict=True):
                    start = place - int(words.bounds[owner])
                    spans[owner].append((start, start + group.length))
                    items[owner].append(item)
                    touched.add(owner)
            for owner in touched:
                spans[owner], items[owner] = _merged(spans[owner]), sorted(set(items[owner]))
            made = {
                "n_words": pa.array(words.counts(), type=pa.int64()),
                "hit_spans": pa.array([[{"start": a, "end": b} for a, b in x] for x in spans], type=pa.list_(_SPAN)),
                "hit_items": pa.array(items, type=rows.schema.field("hit_items").type),
            }
            names = rows.schema.names
            yield pa.RecordBatch.from_arrays([made.get(n, rows.column(i)) for i, n in enumerate(names)], names)


def find_passages(
    documents: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW, pass_windows: int = PASS_WINDOWS
) -> DataFrame:
    """All documents with ``n_words``, ``hit_spans`` and ``hit_items``.

    Words are runs of letters, digits and other than ASCII characters of the text with A-Z in lower case.  ``hit_spans``
    are the word ranges (end exclusive, merged) inside any occurrence of ``window`` consecutive words of an item, or of
    a whole shorter item; ``hit_items`` are the IDs of the items with such occurrences, in order, each once.

    Items (``item_id`` of any type that sorts, ``text``) come to the driver row by row and go to the tasks about ``pass_windows``
    windows at a time.  A block of windows is one pass over the documents, without a shuffle; between two blocks the
    documents are written to the shared folder, so that driver and tasks hold one block whatever the number of items.
    A NULL text, on either side, has no words; items without words and rows without ``item_id`` are in no document; repeated
    rows are searched each.  Columns of the three names are replaced; other columns stay as they are.
    """
    known = items.select("item_id", "text").where("item_id IS NOT NULL").toLocalIterator()
    ids = T.ArrayType(items.schema["item_id"].dataType)
    out = documents.drop("n_words", "hit_spans", "hit_items").select(
        "*",
        F.lit(0).cast("long").alias("n_words"),
        F.lit(None).cast("array<struct<start:bigint,end:bigint>>").alias("hit_spans"),
        F.lit(None).cast(ids).alias("hit_items"),
    )
    out = out.withColumn("hit_spans", F.coalesce("hit_spans", F.array().cast("array<struct<start:bigint,end:bigint>>")))
    out = out.withColumn("hit_items", F.coalesce("hit_items", F.array().cast(ids)))
    schema = out.schema
    staging = Staging(documents.sparkSession)
    blocks = pattern_blocks(((row["item_id"], row["text"]) for row in known), window, pass_windows)
    patterns = next(blocks)
    for following in blocks:
        found = out.mapInArrow(lambda batches, patterns=patterns: _search(patterns, text, batches), schema)
        out, patterns = staging.write(found, "searched"), following
    return out.mapInArrow(lambda batches: _search(patterns, text, batches), schema)


def hit_words(spans: str = "hit_spans"):
    """Number of words inside the spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, span: total + span["end"] - span["start"])


def without_passages(documents: DataFrame, items: DataFrame, text: str = "text", **settings) -> DataFrame:
    """The documents that hold no passage of any item, with the columns they had."""

    def kept(plain: DataFrame, text_name: str) -> DataFrame:
        return find_passages(plain, items, text_name, **settings).where(F.size("hit_items") == 0)

    return on_plain_names(documents, kept, text)
