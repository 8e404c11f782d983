"""N-gram Jaccard join by chosen paths."""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from beatline.llm.columns import on_plain_names
from beatline.llm.components import connected
from beatline.llm.words import Texts, mixed, runs_at, runs_of, seeds, slices, text_words, whole_runs
from beatline.session import Staging, staged

WORDS = 5
SIMILARITY = 0.8
LEVELS = 3
TARGET_RECALL = 0.999
# What one task compares at once; larger buckets are dealt out as pairs of blocks.
BLOCK_SETS, BLOCK_SHINGLES = 1024, 2_000_000
# Buckets of up to four blocks are compared in full, larger ones are split on a further token while there is a level left.
# A group of near copies does not split, so splitting it early only makes more buckets of it.
SMALL = 4 * BLOCK_SETS
# What a comparison holds at once besides the matrix of what each two sets share: members, cells of the incidence matrix
# and rows of the matrix, so that a task's memory depends on the bucket's own sets only.
MEMBERS_AT_ONCE, CELLS_AT_ONCE, ROWS_AT_ONCE = 1 << 18, 1 << 20, 256
# A set's smallest hashes, for a first comparison. Sets that are similar share at least 0.8 of the smallest hashes of
# both on average; asking for less than half of that loses one pair in ten million.
SKETCH, SKETCH_SHARE = 32, 0.375


def runs_for(recall: float, similarity: float, levels: int) -> int:
    """Runs after which a pair just similar enough has met with that probability, also if all buckets split to the end.

    A set samples a token with probability ``1 / (similarity * size)`` at each node, so such a pair samples at least one
    common token on average, and the chance that a common path reaches the last level follows from that.
    """
    reached = 1.0
    for _ in range(levels):
        reached = 1 - math.exp(-reached)
    return math.ceil(math.log(1 - recall) / math.log(1 - reached))


def shingle_sets(texts: Texts, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of ``words`` consecutive words of each text in order, and where each text's begin.

    A text of fewer words has one shingle, of all its words; one without words has none.
    """
    found = text_words(texts)
    counts = found.counts()
    at = whole_runs(found.bounds, words)
    owners = [np.searchsorted(found.bounds, at, side="right") - 1]
    values = [runs_of(found.hashes, words)[at]]
    for fewer in range(1, words):
        short = np.flatnonzero(counts == fewer)
        owners.append(short)
        values.append(runs_at(found.hashes, found.bounds[short], fewer))
    owner, value = np.concatenate(owners), np.concatenate(values)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    first = np.ones(len(value), dtype=bool)
    first[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    owner, value = owner[first], value[first]
    return value, np.searchsorted(owner, np.arange(len(texts) + 1))


def digests(values: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """128 bits of each set, whatever the order of its members."""
    halves = []
    for seed in seeds("digest", 2):
        total = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(mixed(values ^ seed), out=total[1:])
        halves.append(mixed(total[bounds[1:]] - total[bounds[:-1]] + np.uint64(1)))
    return [row.tobytes() for row in np.stack(halves, axis=1).astype(">u8")]


def _extended(values, bounds, limits, owners, parents) -> tuple[np.ndarray, np.ndarray]:
    """For each node, its set's sampled tokens: the node's number and the key of the longer path."""
    sizes = bounds[owners + 1] - bounds[owners]
    begins = np.cumsum(sizes) - sizes
    at = np.arange(sizes.sum()) + np.repeat(bounds[owners] - begins, sizes)
    tokens = mixed(values[at] ^ np.repeat(parents, sizes))
    chosen = np.flatnonzero(tokens < np.repeat(limits[owners], sizes))
    return np.searchsorted(begins, chosen, side="right") - 1, mixed(tokens[chosen] + np.uint64(1))


def paths(values: np.ndarray, bounds: np.ndarray, runs: int, similarity: float, levels: int) -> list[tuple]:
    """Per level, (owner, parent key, key) of the nodes of all runs."""
    sizes = np.diff(bounds)
    share = np.minimum(1 / (similarity * np.maximum(sizes, 1)), 1)
    # the product may reach 2^64, which no unsigned number holds
    limits = np.where(share < 1, share * 2.0**64, 0).astype(np.uint64) - np.where(share < 1, 0, 1).astype(np.uint64)
    found: list[list[tuple]] = [[] for _ in range(levels)]
    for seed in seeds("run", runs):
        owners = np.flatnonzero(sizes)
        parents = np.full(len(owners), seed, dtype=np.uint64)
        for level in range(levels):
            node, keys = _extended(values, bounds, limits, owners, parents)
            owners, before = owners[node], parents[node]
            found[level].append((owners, before, keys))
            parents = keys
    return [tuple(np.concatenate(part) for part in zip(*level, strict=True)) for level in found]


def _lists(owner: np.ndarray, columns: dict[str, np.ndarray], n: int) -> pa.Array:
    order = np.argsort(owner, kind="stable")
    offsets = pa.array(np.searchsorted(owner[order], np.arange(n + 1)).astype(np.int32))
    arrays = [pa.array(column[order].view(np.int64)) for column in columns.values()]
    inner = arrays[0] if len(arrays) == 1 else pa.StructArray.from_arrays(arrays, list(columns))
    return pa.ListArray.from_arrays(offsets, inner)


def _summaries(text: str, key: str, runs: int, similarity: float, levels: int, words: int, batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in slices(batch, text):
            values, bounds = shingle_sets(texts, words)
            n = len(texts)
            made = {key: rows.column(key), "digest": pa.array(digests(values, bounds), type=pa.binary())}
            made["size"] = pa.array(np.diff(bounds), type=pa.int64())
            short = (values >> np.uint64(32)).astype("<u4")
            made["sketch"] = pa.array([short[a : min(b, a + SKETCH)].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
            for level, (owner, parent, keys) in enumerate(paths(values, bounds, runs, similarity, levels)):
                made[f"level{level}"] = _lists(owner, {"key": keys} if not level else {"parent": parent, "key": keys}, n)
            yield pa.RecordBatch.from_arrays(list(made.values()), list(made))


def _sets(text: str, words: int, batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, texts in slices(batch, text):
            values, bounds = shingle_sets(texts, words)
            found = [values[a:b].astype("<u8").tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(digests(values, bounds), type=pa.binary()), pa.array(found, type=pa.binary())], ["digest", "members"])


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int, int], dict[str, list]]]:
    """Runs of rows with one (leaf, low, high); a run may go on in the next batch."""
    held: dict[str, list] = {}
    current = None
    # a batch becomes Python objects a piece at a time
    for batch in (whole.slice(at, BLOCK_SETS) for whole in batches for at in range(0, whole.num_rows, BLOCK_SETS)):
        keys = np.stack([np.asarray(batch.column(n)).astype(np.int64) for n in ("leaf", "low", "high")], axis=1)
        if not len(keys):
            continue
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        columns = {n: batch.column(n).to_pylist() for n in batch.schema.names if n not in ("leaf", "low", "high")}
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
            key = tuple(keys[start].tolist())
            if key != current:
                if held:
                    yield current, held
                current, held = key, {n: [] for n in columns}
            for name, column in columns.items():
                held[name] += column[start:end]
    if held:
        yield current, held


def _common_part(members: list[np.ndarray], out: np.ndarray) -> None:
    n = len(members)
    value = np.concatenate(members)
    row = np.repeat(np.arange(n), [len(x) for x in members])
    _, place, counts = np.unique(value, return_inverse=True, return_counts=True)
    # members of one set only are in no intersection
    shared = counts > 1
    number = np.cumsum(shared) - 1
    kept = shared[place]
    row, column = row[kept], number[place[kept]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = min(4096, max(64, CELLS_AT_ONCE // n))
    for start in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [start, start + width])
        block = np.zeros((n, width), dtype=np.float32)
        block[row[a:b], column[a:b] - start] = 1
        out += block @ block.T


def common(members: list[np.ndarray]) -> np.ndarray:
    """How many members each two of the sets share, by products of blocks of the incidence matrix.

    Many members are taken in parts by their remainder, which is the same for equal ones.
    """
    out = np.zeros((len(members), len(members)), dtype=np.float32)
    parts = -(-sum(map(len, members)) // MEMBERS_AT_ONCE)
    for part in range(parts):
        _common_part([x[x % x.dtype.type(parts) == part] for x in members] if parts > 1 else members, out)
    return out


def _strips(n: int) -> Iterator[slice]:
    """The rows of a matrix, a few at a time."""
    return (slice(at, at + ROWS_AT_ONCE) for at in range(0, n, ROWS_AT_ONCE))


def _pairs(key: tuple[int, int, int], rows: dict[str, list]) -> np.ndarray:
    """Which two rows are to be compared here: in this pair of blocks, and in no leaf with a smaller key."""
    leaf, low, high = key
    n = len(rows["digest"])
    if low == high:
        wanted = ~np.eye(n, dtype=bool)
    else:
        side = np.array(rows["side"])
        wanted = side[:, None] != side[None, :]
    earlier = [np.array([x for x in leaves if x < leaf], dtype=np.int64) for leaves in rows["leaves"]]
    if any(len(x) for x in earlier):
        wanted &= common(earlier) == 0
    return wanted


def _plausible(similarity: float, batches) -> Iterator[pa.RecordBatch]:
    """The (leaf, digest) of sets that look similar to another one in the bucket, by their smallest hashes."""
    leaves, found = [], []
    for key, rows in _grouped(batches):
        sizes = rows["size"]
        n = len(sizes)
        if n <= 8:
            sketches = [frozenset(np.frombuffer(x, "<u4").tolist()) for x in rows["sketch"]]
            chosen = set()
            for i in range(n):
                for j in range(i):
                    least, most = sorted((sizes[i], sizes[j]))
                    if least < similarity * most or key[1] != key[2] and rows["side"][i] == rows["side"][j]:
                        continue
                    if len(sketches[i] & sketches[j]) >= max(1, SKETCH_SHARE * min(SKETCH, least)):
                        if min(set(rows["leaves"][i]) & set(rows["leaves"][j])) == key[0]:
                            chosen |= {i, j}
        else:
            size = np.array(sizes)
            shared = common([np.frombuffer(x, "<u4") for x in rows["sketch"]])
            alike = np.empty((n, n), dtype=bool)
            for part in _strips(n):
                least = np.minimum(size[part, None], size[None, :])
                alike[part] = least >= similarity * np.maximum(size[part, None], size[None, :])
                alike[part] &= shared[part] >= np.maximum(1, SKETCH_SHARE * np.minimum(SKETCH, least))
            del shared
            alike &= _pairs(key, rows)
            chosen = np.flatnonzero(alike.any(axis=1)).tolist()
        leaves += [key[0]] * len(chosen)
        found += [rows["digest"][i] for i in chosen]
        if len(found) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(leaves, pa.int64()), pa.array(found, pa.binary())], ["leaf", "digest"])
            leaves, found = [], []
    yield pa.RecordBatch.from_arrays([pa.array(leaves, pa.int64()), pa.array(found, pa.binary())], ["leaf", "digest"])


def _links(similarity: float, batches) -> Iterator[pa.RecordBatch]:
    """Per set with a link in the bucket: its links to documents and to sets, and the least set it hangs together with."""
    out: dict[str, list] = {"digest": [], "links": [], "set_links": [], "root": []}
    schema = pa.schema([("digest", pa.binary()), ("links", pa.int64()), ("set_links", pa.int64()), ("root", pa.binary())])
    for key, rows in _grouped(batches):
        order = sorted(range(len(rows["digest"])), key=lambda i: rows["digest"][i])
        rows = {name: [column[i] for i in order] for name, column in rows.items()}
        members = [np.frombuffer(x, "<u8") for x in rows["members"]]
        size = np.array([len(x) for x in members])
        shared = common(members)
        # whole numbers below 2^24 are exact in the products; the bound of the block's shingles keeps them there
        n = len(size)
        linked = np.empty((n, n), dtype=bool)
        for part in _strips(n):
            linked[part] = shared[part] >= similarity * (size[part, None] + size[None, :] - shared[part]) - 1e-6
        del shared
        linked &= _pairs(key, rows)
        label = np.arange(n)
        while True:
            near = [np.where(linked[part], label[None, :], n).min(axis=1) for part in _strips(n)]
            least = np.minimum(label, np.concatenate(near))
            if (least == label).all():
                break
            label = least
        copies = np.array(rows["copies"], dtype=np.int64)
        links = np.concatenate([linked[part] @ copies for part in _strips(n)])
        for i in np.flatnonzero(linked.any(axis=1)).tolist():
            out["digest"].append(rows["digest"][i])
            out["links"].append(int(links[i]))
            out["set_links"].append(int(linked[i].sum()))
            out["root"].append(rows["digest"][label[i]])
        if len(out["digest"]) > 10_000:
            yield pa.RecordBatch.from_pydict(out, schema=schema)
            out = {name: [] for name in out}
    yield pa.RecordBatch.from_pydict(out, schema=schema)


def _leaves(rows: DataFrame, levels: int, small: int, staging: Staging) -> DataFrame:
    """(leaf, digest) of buckets with two sets or more; copies count once.

    A bucket of more than ``small`` sets is left for its children, down to the last level, whose buckets are all leaves.
    """
    out, large = None, None
    for level in range(levels):
        nodes = rows.select("digest", F.explode(f"level{level}").alias("node"))
        if level:
            nodes = nodes.select("digest", F.col("node.parent").alias("parent"), F.col("node.key").alias("leaf"))
            nodes = nodes.join(large.select(F.col("leaf").alias("parent")), "parent", "left_semi").drop("parent")
        else:
            nodes = nodes.select("digest", F.col("node").alias("leaf"))
        nodes = staging.write(nodes.distinct(), f"nodes{level}")
        sizes = nodes.groupBy("leaf").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1")
        if level < levels - 1:
            sizes = staging.write(sizes, f"buckets{level}")
            large = sizes.where(F.col("sets") > small)
            sizes = sizes.where(F.col("sets") <= small)
        found = nodes.join(sizes.select("leaf"), "leaf", "left_semi")
        out = found if out is None else out.unionByName(found)
    return out


def _dealt(rows: DataFrame) -> DataFrame:
    """The (leaf, digest, size) in blocks, each with every block of its leaf; a leaf of one block is one bucket."""
    sizes = rows.groupBy("leaf").agg(F.count(F.lit(1)).alias("sets"), F.sum("size").alias("shingles"))
    blocks = F.ceil(F.greatest(F.col("sets") / F.lit(BLOCK_SETS), F.col("shingles") / F.lit(BLOCK_SHINGLES))).cast("int")
    with_blocks = rows.join(sizes.select("leaf", blocks.alias("blocks")), "leaf")
    side = F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int")
    dealt = with_blocks.withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("low", F.least("side", "other")).withColumn("high", F.greatest("side", "other"))
    return dealt.select("leaf", "low", "high", "side", "digest")


def _bucketed(dealt: DataFrame) -> DataFrame:
    """The rows of each bucket one after the other."""
    return dealt.repartition("leaf", "low", "high").sortWithinPartitions("leaf", "low", "high")


def join(
    documents: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    similarity: float = SIMILARITY,
    words: int = WORDS,
    target_recall: float = TARGET_RECALL,
    levels: int = LEVELS,
    small: int = SMALL,
) -> DataFrame:
    """One row per document: ``key``, ``digest``, ``class_id``, ``n_links``, ``n_set_links`` and ``class_digest``.

    Two documents are linked if the Jaccard similarity of their sets of ``words`` consecutive words is ``similarity`` or
    more.  ``n_links`` counts the other documents linked to this one, copies too, ``n_set_links`` the different sets;
    ``class_id`` is the least key of all documents that hang together by links, ``class_digest`` the least digest (NULL
    without words), which tells classes apart also if keys repeat.

    In each run, every set samples a few of its tokens by a hash of the node, and goes down to the child of each; buckets
    of ``small`` sets or fewer are compared in full.  Runs are repeated until a pair meets with ``target_recall``.  Equal sets are one
    set throughout, so copies cost a row per task.  Buckets that do not split are dealt out as pairs of bounded blocks.  A pair is
    counted in the first leaf that both reach, so no pair is ever a row: only sets and their counts are.  Sets are first compared by
    their smallest hashes; whole sets are made and moved for those that look similar only, and every link is exact.

    Texts without words (NULL, empty) are linked to nothing and are classes of their own.  Rows with one key and text are
    copies of each other, rows with a NULL key are documents like others; an empty table gives an empty one.
    """
    runs = runs_for(target_recall, similarity, levels)
    kept = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    key_type = kept.schema["key"].dataType.simpleString()
    nodes = ", level0 array<bigint>" + "".join(f", level{i} array<struct<parent:bigint,key:bigint>>" for i in range(1, levels))
    rows = kept.mapInArrow(
        lambda batches: _summaries("text", "key", runs, similarity, levels, words, batches),
        f"key {key_type}, digest binary, size bigint, sketch binary{nodes}",
    )
    staging = Staging(documents.sparkSession)
    rows = staging.write(rows, "summaries")
    filled = rows.where("size > 0")
    leaves = staging.write(_leaves(filled, levels, small, staging), "leaves")
    staging.drop(*(f"{name}{level}" for name in ("nodes", "buckets") for level in range(levels)))
    own = leaves.groupBy("digest").agg(F.collect_list("leaf").alias("leaves"))
    # equal sets have equal sizes, sketches and leaves
    sets = filled.groupBy("digest").agg(
        F.count(F.lit(1)).alias("copies"), F.min("key").alias("least"), F.max("size").alias("size"), F.max("sketch").alias("sketch")
    )
    sets = staging.write(sets, "sets")
    rows = staging.write(rows.select("key", "digest", "size"), "rows")
    staging.drop("summaries")
    about = staging.write(sets.drop("least").join(own, "digest"), "about")
    compared = _dealt(leaves.join(about.select("digest", "size"), "digest")).join(about.drop("copies"), "digest")
    alike = _bucketed(compared).mapInArrow(lambda batches: _plausible(similarity, batches), "leaf bigint, digest binary")
    alike = staging.write(alike.distinct(), "alike")
    wanted = staging.write(alike.select("digest").distinct().join(sets.select("digest", "least"), "digest"), "wanted")
    wanted_keys = wanted.select(F.col("least").alias("key")).distinct()
    texts = kept.join(wanted_keys, kept["key"].eqNullSafe(wanted_keys["key"]), "left_semi").select("text")
    members = texts.mapInArrow(lambda batches: _sets("text", words, batches), "digest binary, members binary")
    members = members.join(wanted.select("digest"), "digest", "left_semi").groupBy("digest").agg(F.max("members").alias("members"))
    exact = _dealt(alike.join(about.select("digest", "size"), "digest"))
    exact = exact.join(members.join(about.drop("size", "sketch"), "digest"), "digest")
    links = _bucketed(exact).mapInArrow(
        lambda batches: _links(similarity, batches), "digest binary, links bigint, set_links bigint, root binary"
    )
    links = staging.write(links, "links")
    staging.drop("leaves", "alike", "wanted", "about")
    roots = connected(links.select(F.col("digest").alias("a"), F.col("root").alias("b")))
    counted = links.groupBy("digest").agg(F.sum("links").alias("links"), F.sum("set_links").alias("set_links"))
    hung = sets.join(roots.withColumnRenamed("node", "digest"), "digest", "left")
    hung = hung.withColumn("root", F.coalesce("root", "digest"))
    least = hung.groupBy("root").agg(F.min("least").alias("class_id"))
    classes = hung.join(least, "root").join(counted, "digest", "left")
    classes = classes.select(
        "digest",
        "class_id",
        F.col("root").alias("class_digest"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("set_links", F.lit(0)).alias("n_set_links"),
    )
    out = rows.join(classes, "digest", "left")
    known = F.col("size") > 0
    return out.select(
        F.col("key").alias(key),
        "digest",
        F.when(known, F.col("class_id")).otherwise(F.col("key")).alias("class_id"),
        F.when(known, F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
        F.when(known, F.col("n_set_links")).otherwise(F.lit(0)).cast("long").alias("n_set_links"),
        F.when(known, F.col("class_digest")).alias("class_digest"),
    )


def _with_digest(text: str, words: int, names: list[str], batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in slices(batch, text):
            made = pa.array(digests(*shingle_sets(texts, words)), type=pa.binary())
            yield pa.RecordBatch.from_arrays([made if n == "digest" else rows.column(n) for n in names], names)


def one_of_each(documents: DataFrame, text: str = "text", key: str = "doc_id", words: int = WORDS, **settings) -> DataFrame:
    """The documents without near copies, with the columns they had: of each class the one with the least key stays.

    Of rows with one key, that with the least digest stays, and of equal rows one.  Documents without words stay.
    """

    def kept(plain: DataFrame, text_name: str, key_name: str) -> DataFrame:
        classes = join(plain, text_name, key_name, words=words, **settings).where("class_digest IS NOT NULL")
        places = classes.groupBy("class_digest", F.col(key_name).alias("key"), "digest").agg(F.count(F.lit(1)).alias("rows"))
        places = staged(places, "places")
        first = places.groupBy("class_digest").agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "digest")).alias("first"))
        told = places.join(first, "class_digest").withColumn(
            "stays", F.col("key").eqNullSafe(F.col("first.key")) & (F.col("digest") == F.col("first.digest"))
        )
        told = staged(told.select("key", "digest", "rows", "stays"), "told")
        schema = plain.withColumn("digest", F.lit(None).cast("binary")).schema
        marked = plain.mapInArrow(lambda batches: _with_digest(text_name, words, schema.names, batches), schema)
        gone = told.where(~F.col("stays")).select("key", "digest")
        same = (marked["digest"] == gone["digest"]) & marked[key_name].eqNullSafe(gone["key"])
        out = marked.join(gone, same, "left_anti")
        repeated = told.where(F.col("stays") & (F.col("rows") > 1)).select("key", "digest")
        if repeated.isEmpty():
            return out
        again = (out["digest"] == repeated["digest"]) & out[key_name].eqNullSafe(repeated["key"])
        single = out.join(repeated, again, "left_semi").dropDuplicates([key_name, "digest"])
        return out.join(repeated, again, "left_anti").unionByName(single)

    return on_plain_names(documents, kept, text, key)
