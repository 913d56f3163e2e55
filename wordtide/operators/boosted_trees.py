"""Gradient-boosted trees over sparse rows: as Spark ML's ``GBTClassifier`` fits them, without a number for every zero.

Spark ML turns each row into as many numbers as there are features, 50,000 for hashed words, and adds all of them up for
every node. Here a row keeps the bins of its values that are not zero. Each level of a tree is one pass: tasks add up
counts and residuals by node and bin, the sums are shuffled in blocks of features, each block gives its best split, and
the driver picks among the blocks. What a node has in a feature's zero bin is the node's total less the other bins.

Thresholds, gains, loss and weights are those of Spark ML: up to 32 bins for a feature, between the values if they are few
and at quantiles else, by all rows and not by a sample; variance; logistic loss over labels -1 and 1.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol, HasSeed, HasStepSize
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordtide.session import stage

# Bins of one block of features, and sums that one task holds at once: more are made in several passes.
BLOCK, HELD = 8_192, 8_000_000
# Entries that are added up at once.
ADDED = 2_000_000
NO_GAIN = 1e-12


def sparse_parts(vector: str) -> list:
    """Indices and values of a vector column, sparse or dense, as array columns ``i`` and ``v``."""
    parts = F.unwrap_udt(vector)
    every = F.when(F.size(parts["values"]) == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.size(parts["values"]) - 1))
    return [F.coalesce(parts["indices"], every).alias("i"), parts["values"].alias("v")]


def thresholds_of(rows: DataFrame, n: int, bins: int) -> pd.DataFrame:
    """f, t: ascending thresholds of each feature that has more than one value. At most ``bins`` - 1 for a feature."""
    values = stage(rows.select(F.inline(F.arrays_zip("i", "v"))).where("v <> 0").groupBy("i", "v").agg(F.count("*").alias("n")), "feature-values")
    zeros = values.groupBy("i").agg((F.lit(n) - F.sum("n")).alias("n")).where("n > 0").select("i", F.lit(0.0).alias("v"), "n")
    by_value = Window.partitionBy("i").orderBy("v")
    ranked = values.unionByName(zeros).select(
        "i",
        "v",
        F.lead("v").over(by_value).alias("next"),
        F.sum("n").over(by_value.rowsBetween(Window.unboundedPreceding, 0)).alias("seen"),
        F.lead("n").over(by_value).alias("more"),
        F.count("*").over(Window.partitionBy("i")).alias("values"),
    )
    share = lambda c: F.floor((c - 1) * F.lit(bins) / F.lit(n))
    cut = (F.col("values") <= bins) | (share(F.col("seen")) != share(F.col("seen") + F.col("more")))
    found = ranked.where(F.col("next").isNotNull() & cut).select(F.col("i").alias("f"), ((F.col("v") + F.col("next")) / 2).alias("t"))
    return found.toPandas().sort_values(["f", "t"], ignore_index=True)


class Bins:
    """Numbers of all bins: those of feature k are ``start[k]`` to ``start[k + 1]``, k counting the features with bins."""

    def __init__(self, found: pd.DataFrame):
        self.features, self.first, counts = np.unique(found["f"].to_numpy("i8"), return_index=True, return_counts=True)
        self.threshold = found["t"].to_numpy("f8")
        # Complex numbers are ordered by their first part, then by the second.
        self.order = np.repeat(np.arange(len(counts)), counts) + 1j * self.threshold
        self.start = np.concatenate([[0], np.cumsum(counts + 1)]).astype("i8")
        self.owner = np.repeat(np.arange(len(counts)), counts + 1)
        self.zero = self._within(np.arange(len(counts)), np.zeros(len(counts)))
        self.blocks, at = [], 0
        while at < len(counts):
            to = max(at + 1, int(np.searchsorted(self.start, self.start[at] + BLOCK, "right")) - 1)
            self.blocks.append((at, min(to, len(counts))))
            at = self.blocks[-1][1]

    def _within(self, k: np.ndarray, values: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.order, k + 1j * values, "left") - self.first[k]

    def of(self, feature: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bin numbers of the values, and which of the values have one."""
        k = np.searchsorted(self.features, feature).clip(max=max(0, len(self.features) - 1))
        has = (self.features[k] == feature) if len(self.features) else np.zeros(len(feature), bool)
        return self.start[k[has]] + self._within(k[has], values[has]), has


def _list_rows(column) -> tuple[np.ndarray, np.ndarray]:
    """Flat values of a list column and the row of each."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(column)), lengths)


def _binned(sent):
    def run(batches):
        bins = sent.value
        for batch in batches:
            feature, row = _list_rows(batch.column("i"))
            values = batch.column("v").flatten().to_numpy(zero_copy_only=False)
            found, has = bins.of(feature, values)
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[has], minlength=batch.num_rows))])
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found, pa.int32()))], ["label", "bins"])

    return run


# A tree is a table by node: the children of node j are 2j and 2j + 1. ``feature`` is -1 at a leaf.
class Tree:
    def __init__(self, depth: int):
        self.feature = np.full(2 << depth, -1)
        self.split = np.zeros(2 << depth, "i8")
        self.value = np.zeros(2 << depth)

    def walk(self, held: np.ndarray, column: np.ndarray) -> np.ndarray:
        """The node that each row of bins ends at. ``column`` finds a feature in ``held``."""
        at, rows = np.ones(len(held), "i8"), np.arange(len(held))
        while True:
            feature = self.feature[at]
            inner = feature >= 0
            if not inner.any():
                return at
            right = held[rows, column[feature]] > self.split[at]
            at = np.where(inner, 2 * at + right, at)


def _margins(trees: list[Tree], held: np.ndarray, column: np.ndarray, step: float) -> np.ndarray:
    total = np.zeros(len(held))
    for number, tree in enumerate(trees):
        total += (step if number else 1.0) * tree.value[tree.walk(held, column)]
    return total


def _sums(sent, trees: list[Tree], growing: Tree, nodes: list[int], step: float):
    """Counts and sums of residuals by node and bin, as one row for each node and block, its totals last."""

    def run(batches):
        bins: Bins = sent.value
        width = int(bins.start[-1]) + 1
        used = np.unique(np.concatenate([t.feature for t in [*trees, growing]]))
        used = used[used >= 0]
        column = np.zeros(len(bins.features), "i8")
        column[used] = np.arange(len(used))
        wanted = np.full(len(bins.features), False)
        wanted[used] = True
        wanted = wanted[bins.owner]
        place = np.full(len(growing.feature), -1)
        place[nodes] = np.arange(len(nodes))
        counts, sums = np.zeros(len(nodes) * width), np.zeros(len(nodes) * width)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def add():
            where, what = (np.concatenate(x) for x in zip(*waiting))
            counts[:] += np.bincount(where, minlength=len(counts))
            sums[:] += np.bincount(where, what, len(sums))
            waiting.clear()

        for batch in batches:
            flat, row = _list_rows(batch.column("bins"))
            y = 2.0 * batch.column("label").to_numpy(zero_copy_only=False) - 1.0
            held = np.tile(bins.zero[used], (len(y), 1))
            one = wanted[flat]
            k = bins.owner[flat[one]]
            held[row[one], column[k]] = flat[one] - bins.start[k]
            residual = 4.0 * y / (1.0 + np.exp(2.0 * y * _margins(trees, held, column, step))) if trees else y
            at = place[growing.walk(held, column)]
            inside = (at >= 0)[row]
            waiting.append((at[row[inside]] * width + flat[inside], residual[row[inside]]))
            waiting.append((at[at >= 0] * width + width - 1, residual[at >= 0]))
            if sum(len(x) for x, _ in waiting) > max(ADDED, len(counts)):
                add()
        if waiting:
            add()
        for j, node in enumerate(nodes):
            n, s = counts[j * width : (j + 1) * width], sums[j * width : (j + 1) * width]
            if n[-1]:
                for b, (k, to) in enumerate(bins.blocks):
                    some = slice(bins.start[k], bins.start[to])
                    yield pa.RecordBatch.from_pydict(
                        {"node": [node], "block": [b], "n": [np.append(n[some], n[-1]).tobytes()], "s": [np.append(s[some], s[-1]).tobytes()]},
                        pa.schema([("node", pa.int32()), ("block", pa.int32()), ("n", pa.binary()), ("s", pa.binary())]),
                    )

    return run


BEST = "node INT, feature INT, split INT, gain DOUBLE, left_n DOUBLE, left_s DOUBLE, n DOUBLE, s DOUBLE"


def _best(sent):
    """The best split of one node in one block of features; the first of equal ones."""

    def run(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        bins: Bins = sent.value
        node, block = int(key[0]), int(key[1])
        k, to = bins.blocks[block]
        n, s = (np.add.reduce([np.frombuffer(x) for x in parts[c]]) for c in "ns")
        total_n, total_s = n[-1], s[-1]
        n, s = n[:-1].copy(), s[:-1].copy()
        starts = bins.start[k:to] - bins.start[k]
        zero = starts + bins.zero[k:to]
        n[zero] += total_n - np.add.reduceat(n, starts)
        s[zero] += total_s - np.add.reduceat(s, starts)
        sizes = np.diff(bins.start[k : to + 1])
        left_n, left_s = (np.cumsum(x) - np.repeat(np.cumsum(x)[starts] - x[starts], sizes) for x in (n, s))
        # What sums leave over by rounding is no value.
        left_n = np.round(left_n)
        right_n, right_s = total_n - left_n, total_s - left_s
        fine = (left_n >= 1) & (right_n >= 1)
        fine[starts + sizes - 1] = False
        gain = np.full(len(n), -np.inf)
        gain[fine] = (left_s[fine] ** 2 / left_n[fine] + right_s[fine] ** 2 / right_n[fine] - total_s**2 / total_n) / total_n
        at = int(gain.argmax())
        owner = int(bins.owner[bins.start[k] + at])
        row = (node, owner, at - int(starts[owner - k]), gain[at], left_n[at], left_s[at], total_n, total_s)
        return pd.DataFrame([row], columns=[c.split()[0] for c in BEST.split(", ")])

    return run


def _grown(rows: DataFrame, sent, bins: Bins, trees: list[Tree], depth: int, step: float) -> Tree:
    tree, nodes = Tree(depth), [1]
    at_once = max(1, HELD // int(bins.start[-1] + 1))
    for level in range(depth):
        found = []
        for i in range(0, len(nodes), at_once):
            sums = rows.mapInArrow(_sums(sent, trees, tree, nodes[i : i + at_once], step), "node INT, block INT, n BINARY, s BINARY")
            found += sums.groupBy("node", "block").applyInPandas(_best(sent), BEST).collect()
        best: dict[int, object] = {}
        for one in sorted(found, key=lambda r: (r["node"], r["feature"])):
            if one["node"] not in best or one["gain"] > best[one["node"]]["gain"]:
                best[one["node"]] = one
        nodes = []
        for node, one in best.items():
            if level == 0:
                tree.value[node] = one["s"] / one["n"]
            if one["gain"] > NO_GAIN:
                tree.feature[node], tree.split[node] = one["feature"], one["split"]
                tree.value[2 * node] = one["left_s"] / one["left_n"]
                tree.value[2 * node + 1] = (one["s"] - one["left_s"]) / (one["n"] - one["left_n"])
                nodes += [2 * node, 2 * node + 1]
        if not nodes:
            break
    return tree


class _Columns(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol):
    pass


class SparseGBTClassifier(Estimator, _Columns, HasMaxIter, HasSeed, HasStepSize, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees of two classes. Nothing is drawn by chance; ``seed`` is taken as other classifiers take it."""

    maxDepth = Param(Params._dummy(), "maxDepth", "levels of splits", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "most bins of a feature", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", maxIter=20, stepSize=0.1, maxDepth=5, maxBins=32, seed=None):
        super().__init__()
        self._setDefault(maxIter=20, stepSize=0.1, maxDepth=5, maxBins=32)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> SparseGBTModel:
        label, depth, step = F.col(self.getLabelCol()).cast("double"), self.getOrDefault(self.maxDepth), self.getStepSize()
        rows = dataset.select(label.alias("label"), *sparse_parts(self.getFeaturesCol()))
        known = F.coalesce(F.col("label").isin(0.0, 1.0) & F.col("v").isNotNull(), F.lit(False))
        total = rows.agg(F.count("*").alias("n"), F.count_if(~known).alias("odd"), F.sum("label").alias("ones")).first()
        if not total["n"] or total["odd"]:
            raise ValueError(f"{total['odd']} of {total['n']} rows have no label of 0 or 1 or no features")
        bins = Bins(thresholds_of(rows, total["n"], min(self.getOrDefault(self.maxBins), total["n"])))
        trees: list[Tree] = []
        if len(bins.features):
            context = dataset.sparkSession.sparkContext
            sent = context.broadcast(bins)
            binned = stage(rows.mapInArrow(_binned(sent), "label DOUBLE, bins ARRAY<INT>"), "binned-rows")
            # One set of sums leaves a task, so tasks are as many as cores.
            binned = binned.coalesce(max(1, context.defaultParallelism))
            for _ in range(self.getMaxIter()):
                trees.append(_grown(binned, sent, bins, trees, depth, step))
        else:  # equal rows have one answer
            trees.append(Tree(0))
            trees[0].value[1] = 2 * total["ones"] / total["n"] - 1
        model = SparseGBTModel(json.dumps([_told(tree, bins, step if number else 1.0) for number, tree in enumerate(trees)]))
        return self._copyValues(model)


def _told(tree: Tree, bins: Bins, weight: float) -> dict:
    """A tree by the features' own numbers and thresholds, with its weight."""
    inner = tree.feature >= 0
    features, values = np.full(len(inner), -1), np.zeros(len(inner))
    if inner.any():
        k = tree.feature[inner]
        features[inner], values[inner] = bins.features[k], bins.threshold[bins.first[k] + tree.split[inner]]
    return {"weight": weight, "feature": features.tolist(), "threshold": values.tolist(), "value": tree.value.tolist()}


class SparseGBTModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted trees, kept as JSON. Adds the columns that Spark ML's classifiers add."""

    trees = Param(Params._dummy(), "trees", "the trees as JSON", TypeConverters.toString)

    def __init__(self, trees: str | None = None):
        super().__init__()
        if trees is not None:
            self._set(trees=trees)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees = [{k: np.array(v) for k, v in tree.items()} for tree in json.loads(self.getOrDefault(self.trees))]
        used = np.unique(np.concatenate([tree["feature"] for tree in trees]))
        used = used[used >= 0]

        @F.pandas_udf("double")
        def margin(i: pd.Series, v: pd.Series) -> pd.Series:
            held = np.zeros((len(i), len(used) + 1))
            if len(used) and len(i):
                row = np.repeat(np.arange(len(i)), [len(x) for x in i])
                feature, value = np.concatenate(i.to_list()), np.concatenate(v.to_list())
                at = np.searchsorted(used, feature).clip(max=len(used) - 1)
                one = used[at] == feature
                held[row[one], at[one]] = value[one]
            total, rows = np.zeros(len(i)), np.arange(len(i))
            for tree in trees:
                at = np.ones(len(i), "i8")
                while (inner := tree["feature"][at] >= 0).any():
                    right = held[rows, np.searchsorted(used, tree["feature"][at])] > tree["threshold"][at]
                    at = np.where(inner, 2 * at + right, at)
                total += tree["weight"] * tree["value"][at]
            return pd.Series(total)

        m = margin(*sparse_parts(self.getFeaturesCol()))
        share = 1 / (1 + F.exp(-2 * m))
        return dataset.select(
            "*",
            array_to_vector(F.array(-m, m)).alias(self.getRawPredictionCol()),
            array_to_vector(F.array(1 - share, share)).alias(self.getProbabilityCol()),
            F.when(m > 0, 1.0).otherwise(0.0).alias(self.getPredictionCol()),
        )
