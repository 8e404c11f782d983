"""Random forests grown level by level from counts; the model is MLlib's own.

MLlib's trainer walks every row through trees of objects and takes microseconds for a row, a tree and a level.  Here rows
are stored once as blocks of bins, tasks count their rows of all open nodes of a level with numpy, the counts of a node are
summed after a shuffle, and its split is chosen there.  Candidate splits, stopping rules, gains and the merging of like leaves
are MLlib's.  Draws depend on the key of a row, not on partitions, so a forest does not change with the layout of its rows.
"""

import json
import math
import time
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from beatline.session import discard, staged, staging_path

# What MLlib takes where nothing else is said.
DEFAULTS = {
    "numTrees": 20,
    "maxDepth": 5,
    "maxBins": 32,
    "featureSubsetStrategy": "sqrt",
    "subsamplingRate": 1.0,
    "bootstrap": True,
    "minInstancesPerNode": 1,
    "seed": 42,
}
SUBSETS = {"all": lambda n: n, "sqrt": lambda n: math.ceil(math.sqrt(n)), "onethird": lambda n: math.ceil(n / 3)}

# Rows of a stored partition, rows looked at and cells counted at a time, and nodes whose counts travel together.
ROWS_PER_PART = 1_000_000
ROWS_AT_ONCE = 1 << 13
CELLS_AT_ONCE = 1 << 20
NODES_PER_PART = 64
QUANTILE_ACCURACY = 10_000

_BLOCK = ["keys", "labels", "bins"]


@dataclass
class Features:
    """How values become bins: upper bounds of numbers, which a value may equal, or the number of categories."""

    bounds: list[np.ndarray | None]
    categories: list[int]
    classes: int
    unordered: list[bool]

    @property
    def bins(self) -> np.ndarray:
        pairs = zip(self.bounds, self.categories, strict=True)
        return np.array([n if b is None else len(b) + 1 for b, n in pairs], dtype=np.int64)


@dataclass
class Tree:
    """Nodes by place: 1 is the root, 2 i and 2 i + 1 are the children of i."""

    feature: np.ndarray
    right: np.ndarray
    counts: dict[int, np.ndarray] = field(default_factory=dict)
    gain: dict[int, float] = field(default_factory=dict)
    open: list[int] = field(default_factory=lambda: [1])


@dataclass
class Level:
    """What a task needs of one tree: the splits above the level, its open nodes and the features each may use."""

    feature: np.ndarray
    right: np.ndarray
    nodes: np.ndarray
    chosen: np.ndarray
    start: np.ndarray  # of node and chosen feature, the place of the first bin; one more at the end

    def parts(self) -> list[tuple[int, int, int]]:
        """Number, first node and end of each group of nodes whose counts travel together."""
        begins = range(0, len(self.nodes), NODES_PER_PART)
        return [(i, b, min(b + NODES_PER_PART, len(self.nodes))) for i, b in enumerate(begins)]


# ---- from values to bins ----


def _bounds(rows: DataFrame, numeric: list[int], most: int) -> dict[int, np.ndarray]:
    """Midpoints between the values of a number with few of them, else quantiles over all rows."""
    if not numeric:
        return {}
    distinct = rows.agg(*[F.approx_count_distinct(f"x{i}", 0.05).alias(f"x{i}") for i in numeric]).first()
    few = [i for i in numeric if distinct[f"x{i}"] <= 2 * most]
    values: dict[int, list[float]] = {i: [] for i in few}
    if few:
        pairs = F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"x{i}").alias("v")) for i in few]))
        for row in rows.select(pairs).distinct().collect():
            values[row["i"]].append(row["v"])
    made = {i: np.unique(values[i]) for i in few if len(set(values[i])) <= most}
    made = {i: (known[:-1] + known[1:]) / 2 for i, known in made.items()}
    # the quantiles, the costly part, only of numbers whose values do not fit
    if many := [i for i in numeric if i not in made]:
        steps = [k / most for k in range(1, most)] + [1.0]
        found = rows.agg(*[F.percentile_approx(f"x{i}", steps, QUANTILE_ACCURACY).alias(f"x{i}") for i in many]).first()
        # nothing lies above the greatest value
        made |= {i: np.unique(found[f"x{i}"])[:-1] for i in many}
    return made


def _bin(features: Features, i: int, values: np.ndarray) -> np.ndarray:
    bounds = features.bounds[i]
    return (values if bounds is None else np.searchsorted(bounds, values, side="left")).astype(np.int16)


def _packed(features: Features, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by the thousand, each block one row: keys, labels and bins as bytes, since every level reads them again."""
    for whole in batches:
        for begin in range(0, whole.num_rows, ROWS_AT_ONCE):
            batch = whole.slice(begin, ROWS_AT_ONCE)
            columns = [_bin(features, i, batch.column(f"x{i}").to_numpy()) for i in range(len(features.bounds))]
            block = [batch.column("key").to_numpy(), batch.column("label").to_numpy(), np.stack(columns, axis=1)]
            yield pa.RecordBatch.from_arrays([pa.array([part.tobytes()], pa.binary()) for part in block], _BLOCK)


def _blocks(batches: Iterator[pa.RecordBatch], width: int, classes: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Keys of each block, its bins row after row, and the same as places among bins and classes."""
    blocks = []
    for batch in batches:
        for row in zip(*(batch.column(name) for name in _BLOCK), strict=True):
            types = (np.uint64, np.int16, np.int16)
            keys, labels, bins = (np.frombuffer(cell.as_buffer(), kind) for cell, kind in zip(row, types, strict=True))
            coded = bins.reshape(-1, width) * np.int32(classes) + labels.astype(np.int32)[:, None]
            blocks.append((keys, bins, coded.ravel()))
    return blocks


# ---- counting, in tasks ----


def _thresholds(rate: float) -> np.ndarray:
    """A random 64-bit number that reaches k of these gives the Poisson draw k."""
    share, total, reached = math.exp(-rate), 0.0, []
    for k in range(1, 40):
        total += share
        share *= rate / k
        if int(total * 2**64) < 2**64:
            reached.append(int(total * 2**64))
    return np.array(reached, dtype=np.uint64)


def draws(keys: np.ndarray, tree: int, seed: int, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that the tree has drawn, and how often: the draw follows from key, tree and seed (SplitMix64)."""
    z = keys + np.uint64((seed * 0xD1342543DE82EF95 + (tree + 1) * 0x9E3779B97F4A7C15) % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    rows = np.flatnonzero(z >= thresholds[0])
    z, weight = z[rows], np.ones(len(rows))
    again = np.flatnonzero(z >= thresholds[1])
    weight[again] = 2.0 + np.searchsorted(thresholds[2:], z[again], side="right")
    return rows, weight


def _steps(feature: np.ndarray, right: np.ndarray, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The feature that each node looks at, and by node and bin where a row goes: from a leaf to the place named for it."""
    inner = feature >= 0
    onward = 2 * np.arange(len(feature))[:, None] + right
    return np.where(inner, feature, 0), np.where(inner[:, None], onward, leaves[:, None]).ravel()


class _Counter:
    """Rows of one tree by open node, chosen feature, bin and class, end to end.

    A few thousand rows are looked at together, so that what belongs to them stays in the processor's cache; their
    cells are gathered and counted when there are many, as each count walks over the cells of all open nodes.
    """

    def __init__(self, level: Level, depth: int, width: int, classes: int) -> None:
        self.depth, self.width, self.most = depth, width, level.right.shape[1]
        # rows of leaves go to place 0 and stay there
        self.feature, self.next = _steps(level.feature, level.right, np.zeros(len(level.feature), np.int64))
        self.slots = np.full(2 << depth, -1, dtype=np.int64)
        self.slots[level.nodes] = np.arange(len(level.nodes))
        self.chosen = np.ascontiguousarray(level.chosen.T)
        self.start = np.ascontiguousarray(level.start[:-1].reshape(level.chosen.shape).T) * classes
        self.total = np.zeros(level.start[-1] * classes)
        self.cells, self.weights = np.empty(CELLS_AT_ONCE, np.int64), np.empty(CELLS_AT_ONCE)
        self.filled = 0

    def add(self, bins: np.ndarray, coded: np.ndarray, rows: np.ndarray, weight: np.ndarray) -> None:
        """Rows, by number, of flat tables: the bins of each row, and the same as places among bins and classes."""
        first, node = rows * self.width, np.ones(len(rows), dtype=np.int64)
        for _ in range(self.depth):
            node = self.next[node * self.most + bins[first + self.feature[node]]]
        slot = self.slots[node]
        if slot.min(initial=0) < 0:
            here = np.flatnonzero(slot >= 0)
            first, weight, slot = first[here], weight[here], slot[here]
        n = len(slot)
        if self.filled + n * len(self.chosen) > len(self.cells):
            self._count()
        for chosen, start in zip(self.chosen, self.start, strict=True):
            end = self.filled + n
            np.add(start[slot], coded[first + chosen[slot]], out=self.cells[self.filled : end])
            self.weights[self.filled : end] = weight
            self.filled = end

    def _count(self) -> None:
        self.total += np.bincount(self.cells[: self.filled], self.weights[: self.filled], len(self.total))
        self.filled = 0

    def counts(self) -> np.ndarray:
        self._count()
        return self.total.astype(np.int64)


def _count_level(levels, depth, width, classes, seed, thresholds, batches) -> Iterator[pa.RecordBatch]:
    """One row per tree and group of nodes with the counts of this task's rows."""
    blocks = _blocks(batches, width, classes)
    if not blocks:
        return
    for tree, level in levels.items():
        counter = _Counter(level, depth, width, classes)
        for keys, bins, coded in blocks:
            if thresholds is None:
                rows, weight = np.arange(len(keys)), np.ones(len(keys))
            else:
                rows, weight = draws(keys, tree, seed, thresholds)
            counter.add(bins, coded, rows, weight)
        total, wide = counter.counts(), level.chosen.shape[1]
        parts = level.parts()
        cuts = [total[level.start[b * wide] * classes : level.start[e * wide] * classes].tobytes() for _, b, e in parts]
        yield pa.RecordBatch.from_arrays(
            [pa.array([tree] * len(parts), pa.int32()), pa.array([p[0] for p in parts], pa.int32()), pa.array(cuts, pa.binary())],
            ["tree", "part", "counts"],
        )


# ---- choosing, one task per group of nodes ----


def _gini(counts: np.ndarray) -> np.ndarray:
    total = counts.sum(axis=-1, keepdims=True)
    return 1 - ((counts / np.maximum(total, 1)) ** 2).sum(axis=-1)


def _sides(counts: np.ndarray, categories: int, unordered: bool) -> tuple[np.ndarray, np.ndarray]:
    """Candidate splits of one feature: which bins go left, and the classes of their rows."""
    n = len(counts)
    if unordered:
        goes_left = (np.arange(1, 2 ** (n - 1))[:, None] >> np.arange(n)) & 1 == 1
        return goes_left, goes_left @ counts
    order = np.arange(n)
    if categories:
        # MLlib's order: by impurity, of two classes by rows of the second; categories without rows last
        key = _gini(counts) if counts.shape[1] > 2 else counts[:, 1].astype(float)
        order = np.argsort(np.where(counts.sum(axis=1) > 0, key, np.inf), kind="stable")
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    return place <= np.arange(n - 1)[:, None], counts[order].cumsum(axis=0)[:-1]


def best_split(counts: list[np.ndarray], chosen: np.ndarray, features: Features, fewest: int):
    """Gain, feature, bins that go left and classes there, of the first of the best valid splits; None if there is none."""
    node = counts[0].sum(axis=0)
    total, impurity, best = node.sum(), _gini(node), None
    for cells, i in zip(counts, chosen.tolist(), strict=True):
        if len(cells) < 2:
            continue
        goes_left, left = _sides(cells, features.categories[i], features.unordered[i])
        n_left = left.sum(axis=1)
        share = n_left / total
        gain = impurity - share * _gini(left) - (1 - share) * _gini(node - left)
        gain[(n_left < fewest) | (total - n_left < fewest)] = -1
        at = int(gain.argmax())
        if gain[at] > (best[0] if best else 0):
            best = float(gain[at]), i, goes_left[at], left[at]
    return best


def _choose(levels, features: Features, fewest: int, table: pa.Table) -> pa.Table:
    tree, part = table.column("tree")[0].as_py(), table.column("part")[0].as_py()
    level, bins, wide = levels[tree], features.bins, levels[tree].chosen.shape[1]
    total = 0
    for cut in table.column("counts"):
        total = total + np.frombuffer(cut.as_buffer(), dtype=np.int64)
    counts = total.reshape(-1, features.classes)
    _, begin, end = level.parts()[part]
    found = []
    for slot in range(begin, end):
        chosen = level.chosen[slot]
        starts = level.start[slot * wide : (slot + 1) * wide] - level.start[begin * wide]
        cells = [counts[s : s + bins[i]] for s, i in zip(starts, chosen, strict=True)]
        best = best_split(cells, chosen, features, fewest)
        row = {"tree": tree, "node": int(level.nodes[slot]), "counts": cells[0].sum(axis=0).tolist(), "feature": -1}
        if best:
            row |= {"gain": best[0], "feature": best[1], "goes_left": best[2].tolist(), "left": best[3].tolist()}
        found.append(row)
    return pa.Table.from_pylist(found, _CHOICE_ARROW)


_CHOICE = "tree int, node int, counts array<bigint>, feature int, gain double, goes_left array<boolean>, left array<bigint>"
_CHOICE_ARROW = pa.schema(
    [
        ("tree", pa.int32()),
        ("node", pa.int32()),
        ("counts", pa.list_(pa.int64())),
        ("feature", pa.int32()),
        ("gain", pa.float64()),
        ("goes_left", pa.list_(pa.bool_())),
        ("left", pa.list_(pa.int64())),
    ]
)


# ---- growing, on the driver: at most 2 ** maxDepth nodes a tree ----


def _level(tree: Tree, number: int, depth: int, features: Features, subset: int, seed: int) -> Level:
    nodes = np.array(tree.open, dtype=np.int64)
    n = len(features.bounds)
    draw = [np.random.default_rng([seed, number, node]).permutation(n)[:subset] for node in tree.open]
    chosen = np.sort(np.stack(draw), axis=1).astype(np.int64)
    start = np.concatenate([[0], np.cumsum(features.bins[chosen].ravel())])
    return Level(tree.feature[: 1 << depth], tree.right[: 1 << depth], nodes, chosen, start)


def _choices(stored: DataFrame, levels: dict[int, Level], depth: int, features: Features, settings: dict) -> DataFrame:
    """One row per open node with its split, if it has one."""
    thresholds = _thresholds(settings["subsamplingRate"]) if settings["bootstrap"] else None
    seed, fewest = settings["seed"], settings["minInstancesPerNode"]
    counted = stored.mapInArrow(
        lambda batches: _count_level(levels, depth, len(features.bounds), features.classes, seed, thresholds, batches),
        "tree int, part int, counts binary",
    )
    return counted.groupBy("tree", "part").applyInArrow(lambda table: _choose(levels, features, fewest, table), _CHOICE)


def _grow(stored: DataFrame, features: Features, settings: dict) -> list[Tree]:
    most, deepest, fewest = int(features.bins.max()), settings["maxDepth"], settings["minInstancesPerNode"]
    size = 1 << deepest
    trees = [Tree(np.full(size, -1, np.int64), np.zeros((size, most), np.uint8)) for _ in range(settings["numTrees"])]
    subset = SUBSETS[settings["featureSubsetStrategy"]](len(features.bounds))
    for depth in range(deepest):
        levels = {t: _level(tree, t, depth, features, subset, settings["seed"]) for t, tree in enumerate(trees) if tree.open}
        if not levels:
            break
        for tree in trees:
            tree.open = []
        for row in _choices(stored, levels, depth, features, settings).collect():
            tree, node, counts = trees[row["tree"]], row["node"], np.array(row["counts"], dtype=np.int64)
            tree.counts[node] = counts
            if row["feature"] < 0:
                continue
            tree.feature[node], tree.gain[node] = row["feature"], row["gain"]
            tree.right[node, : len(row["goes_left"])] = ~np.array(row["goes_left"])
            left = np.array(row["left"], dtype=np.int64)
            for child, held in ((2 * node, left), (2 * node + 1, counts - left)):
                tree.counts[child] = held
                # a pure node, or one that is too small for two children, stays a leaf
                if depth + 1 < deepest and held.sum() >= 2 * fewest and (held > 0).sum() > 1:
                    tree.open.append(child)
        for tree in trees:
            tree.open.sort()
    return trees


# ---- MLlib's stored form ----


def _leaf(tree: Tree, place: int, merged: set[int]) -> bool:
    return place in merged or place not in tree.gain


def _merge_alike(tree: Tree) -> set[int]:
    """Nodes whose children are leaves of one prediction; MLlib makes them leaves."""
    merged: set[int] = set()
    for place in sorted(tree.gain, reverse=True):
        left, right = 2 * place, 2 * place + 1
        if _leaf(tree, left, merged) and _leaf(tree, right, merged):
            if tree.counts[left].argmax() == tree.counts[right].argmax():
                merged.add(place)
    return merged


def _node_rows(number: int, tree: Tree, features: Features) -> list[dict]:
    """The nodes in the order of MLlib's files: a node, its left part, its right part."""
    merged, rows = _merge_alike(tree), []

    def put(place: int) -> int:
        counts, n = tree.counts[place], len(rows)
        node = {
            "id": n,
            "prediction": float(counts.argmax()),
            "impurity": float(_gini(counts)),
            "impurityStats": counts.astype(float).tolist(),
            "rawCount": int(counts.sum()),
            "gain": -1.0,
            "leftChild": -1,
            "rightChild": -1,
            "split": {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1},
        }
        rows.append({"treeID": number, "nodeData": node})
        if not _leaf(tree, place, merged):
            i = int(tree.feature[place])
            left = np.flatnonzero(tree.right[place, : features.bins[i]] == 0)
            values = left if features.bounds[i] is None else features.bounds[i][left[-1:]]
            node["split"] = {
                "featureIndex": i,
                "leftCategoriesOrThreshold": values.astype(float).tolist(),
                "numCategories": features.categories[i] if features.bounds[i] is None else -1,
            }
            node["gain"] = tree.gain[place]
            node["leftChild"], node["rightChild"] = put(2 * place), put(2 * place + 1)
        return n

    put(1)
    return rows


_NODES = pa.schema(
    [
        ("treeID", pa.int32()),
        (
            "nodeData",
            pa.struct(
                [
                    ("id", pa.int32()),
                    ("prediction", pa.float64()),
                    ("impurity", pa.float64()),
                    ("impurityStats", pa.list_(pa.float64())),
                    ("rawCount", pa.int64()),
                    ("gain", pa.float64()),
                    ("leftChild", pa.int32()),
                    ("rightChild", pa.int32()),
                    (
                        "split",
                        pa.struct(
                            [
                                ("featureIndex", pa.int32()),
                                ("leftCategoriesOrThreshold", pa.list_(pa.float64())),
                                ("numCategories", pa.int32()),
                            ]
                        ),
                    ),
                ]
            ),
        ),
    ]
)


def _as_model(spark: SparkSession, trees: list[Tree], features: Features, settings: dict) -> RandomForestClassificationModel:
    """The trees written as MLlib stores a forest, and loaded from there."""
    path = staging_path(spark, "forest")
    package = "org.apache.spark.ml.classification."
    uid = path.rsplit("-", 1)[-1]

    def described(kind: str, name: str, params: dict, **more) -> str:
        head = {"class": package + kind, "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": name}
        usual = {"featuresCol": "features", "labelCol": "label", "predictionCol": "prediction", "impurity": "gini"}
        usual |= {"probabilityCol": "probability", "rawPredictionCol": "rawPrediction"}
        return json.dumps(head | {"paramMap": params, "defaultParamMap": usual} | more)

    shared = {k: settings[k] for k in ("maxDepth", "maxBins", "minInstancesPerNode", "seed")}
    whole = shared | {k: settings[k] for k in ("numTrees", "featureSubsetStrategy", "subsamplingRate", "bootstrap")}
    sizes = {"numFeatures": len(features.bounds), "numClasses": features.classes, "numTrees": len(trees)}
    head = described("RandomForestClassificationModel", f"RandomForestClassifier_{uid}", whole, **sizes)
    spark.createDataFrame([(head,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    described_trees = [
        (t, described("DecisionTreeClassificationModel", f"dtc_{uid}_{t}", shared), 1.0) for t in range(len(trees))
    ]
    spark.createDataFrame(described_trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    nodes = [row for t, tree in enumerate(trees) for row in _node_rows(t, tree, features)]
    spark.createDataFrame(pa.Table.from_pylist(nodes, _NODES)).write.parquet(f"{path}/data")
    model = RandomForestClassificationModel.load(path)
    discard(spark, path)
    return model


def _drop(stored: DataFrame) -> None:
    discard(stored.sparkSession, *{path.rsplit("/", 1)[0] for path in stored.inputFiles()})


# ---- scoring ----


class Grown:
    """The trees of a model, to score rows by the thousand: MLlib walks each row through trees of objects, node by node.

    Votes are added and divided in the order of MLlib's, so its model gives the same doubles.
    """

    def __init__(self, trees: list[Tree], features: Features) -> None:
        self.features, self.trees = features, []
        for tree in trees:
            merged = _merge_alike(tree)
            inner = np.array([not _leaf(tree, place, merged) for place in range(len(tree.feature))])
            share = np.zeros((2 * len(inner), features.classes))
            for place, counts in tree.counts.items():
                if _leaf(tree, place, merged):
                    share[place] = counts / max(counts.sum(), 1)
            self.trees.append((np.where(inner, tree.feature, -1), tree.right, share))

    def _votes(self, bins: np.ndarray) -> np.ndarray:
        first, flat = np.arange(len(bins)) * bins.shape[1], bins.ravel()
        votes = np.zeros((len(bins), self.features.classes))
        for feature, right, share in self.trees:
            most, inner = right.shape[1], len(feature)
            look, onward = _steps(feature, right, np.arange(inner))
            node = np.ones(len(bins), dtype=np.int64)
            # as many steps as levels; a row that comes to a leaf before stays there
            for _ in range(inner.bit_length() - 1):
                node = onward[node * most + flat[first + look[node]]]
            votes += share[node]
        return votes

    def _scored(self, x: pa.Array) -> pa.Array:
        values = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
        bins = [_bin(self.features, i, values[:, i]) for i in range(values.shape[1])]
        votes = self._votes(np.stack(bins, axis=1))
        total = np.zeros(len(votes))
        for column in votes.T:
            total += column
        total[total == 0] = 1
        ends = np.arange(len(votes) + 1, dtype=np.int32) * votes.shape[1]
        shares = pa.ListArray.from_arrays(pa.array(ends), pa.array((votes / total[:, None]).ravel()))
        return pa.StructArray.from_arrays([shares, pa.array(votes.argmax(axis=1).astype(float))], ["shares", "prediction"])

    def transform(self, encoded: DataFrame) -> DataFrame:
        """``probability`` and ``prediction`` of rows with ``features``, as the model gives them."""
        score = F.arrow_udf(self._scored, "shares array<double>, prediction double")
        found = encoded.withColumn("_scored", score(vector_to_array("features")))
        return found.withColumns(
            {"probability": array_to_vector("_scored.shares"), "prediction": F.col("_scored.prediction")}
        ).drop("_scored")


class Forest(Estimator):
    """A random forest over the columns ``features``, ``label`` and a key, with the settings of MLlib's.

    The key says which rows a tree draws: rows of one key are drawn alike.  ``classes`` is for a label without metadata.
    """

    def __init__(self, key: str, classes: int | None = None, **settings) -> None:
        super().__init__()
        if unknown := set(settings) - set(DEFAULTS):
            raise ValueError(f"no settings of the forest: {sorted(unknown)}")
        self.key, self.classes, self.settings = key, classes, DEFAULTS | settings

    def _features(self, dataset: DataFrame, rows: DataFrame) -> Features:
        groups = dataset.schema["features"].metadata["ml_attr"]["attrs"]
        attributes = sorted((a for group in groups.values() for a in group), key=lambda a: a["idx"])
        categories = [len(a["vals"]) if "vals" in a else 0 for a in attributes]
        most = self.settings["maxBins"]
        if max(categories) > most:
            raise ValueError(f"a feature has {max(categories)} categories, more than {most} bins")
        classes = self.classes or len(dataset.schema["label"].metadata["ml_attr"]["vals"])
        bounds = _bounds(rows, [i for i, n in enumerate(categories) if not n], most)
        # with three classes or more, all ways to halve a feature of few categories are tried, as MLlib does
        few = math.floor(math.log2(most // 2 + 1) + 1)
        unordered = [classes > 2 and 1 < n <= few for n in categories]
        return Features([bounds.get(i) for i in range(len(categories))], categories, classes, unordered)

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        spark = dataset.sparkSession
        vector = dataset.select(
            F.xxhash64(self.key).alias("key"),
            F.col("label").cast("smallint").alias("label"),
            vector_to_array("features").alias("x"),
        )
        width = sum(len(group) for group in dataset.schema["features"].metadata["ml_attr"]["attrs"].values())
        # encoded once: bounds, values and bins each read them
        rows = staged(vector.select("key", "label", *[F.col("x")[i].alias(f"x{i}") for i in range(width)]), "forest-rows")
        n = rows.count()
        if not n:
            raise ValueError("no rows to learn from")
        features = self._features(dataset, rows)
        # equal shares for all cores: one part more than they take at a time would double the time of each level
        cores = spark.sparkContext.defaultParallelism
        parts = cores * max(2, math.ceil(n / ROWS_PER_PART / cores))
        packed = rows.mapInArrow(lambda batches: _packed(features, batches), ", ".join(f"{name} binary" for name in _BLOCK))
        stored = staged(packed.repartition(parts), "forest-bins")
        _drop(rows)
        trees = _grow(stored, features, self.settings)
        _drop(stored)
        model = _as_model(spark, trees, features, self.settings)
        model.grown = Grown(trees, features)
        return model
