"""Gradient boosting with histograms and trees that grow leaf by leaf.

Columns are cut into bins once. A tree needs, for each leaf, variable and bin, the sums of gradient,
hessian and rows: one grouped sum over the rows, from which windows over the bins find the best split of every
leaf. Leaves are split in the order of their gain until a tree has enough of them, and a leaf's value is
shrunk by the penalty. The rows never leave the executors; the driver holds the trees and one split per leaf.
"""
from __future__ import annotations

import heapq
import math
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.lake import run_folder
from .ordering import BEFORE, TOTAL, cumulated_counts

BINS = 255
#: Rows times columns up to which the histograms of a fit are summed in one task: 16 MB of bins.
ONE_TASK_CELLS = 1 << 24
#: Trees after which the rows are stored anew with their scores.
STORE_EVERY = 16
LEAST_HESSIAN, LEAST_GAIN, EDGE = 1e-3, 1e-10, 1e-12


@dataclass(frozen=True)
class Params:
    learning_rate: float = 0.1
    max_iter: int = 100
    max_leaf_nodes: int = 31
    min_samples_leaf: int = 20
    l2_regularization: float = 0.0


@dataclass
class Split:
    """The best split of a node, gain 0 if there is none, and the node's sums with those left of the split."""

    gain: float
    column: int
    bin: int
    left: tuple[float, float, int]
    whole: tuple[float, float, int]

    @property
    def right(self) -> tuple[float, float, int]:
        return tuple(a - b for a, b in zip(self.whole, self.left))


class Tree:
    """Nodes as lists: column (-1 at a leaf), bin, left, right, value, gain, and the sums of gradient, hessian and rows."""

    def __init__(self):
        self.column, self.bin, self.left, self.right, self.value, self.gain, self.sums = [], [], [], [], [], [], []

    def add(self, sums: tuple) -> int:
        for items, v in ((self.column, -1), (self.bin, 0), (self.left, 0), (self.right, 0), (self.value, 0.0), (self.gain, 0.0), (self.sums, sums)):
            items.append(v)
        return len(self.column) - 1

    def split(self, node: int, s: Split) -> tuple[int, int]:
        self.column[node], self.bin[node], self.gain[node] = s.column, s.bin, s.gain
        self.left[node], self.right[node] = self.add(s.left), self.add(s.right)
        return self.left[node], self.right[node]

    def places(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row of bins."""
        return walked(bins, np.array(self.column), np.array(self.bin), np.array(self.left), np.array(self.right))


def walked(x: np.ndarray, column: np.ndarray, limit: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
    while len(rows):
        c = column[at[rows]]
        rows, c = rows[c >= 0], c[c >= 0]
        at[rows] = np.where(x[rows, c] <= limit[at[rows]], left[at[rows]], right[at[rows]])
    return at


def gains(g, h, whole_g, whole_h, l2: float):
    """What a split with the sums g and h on its left gains."""
    part = lambda a, b: a * a / (b + l2 + EDGE)
    return part(g, h) + part(whole_g - g, whole_h - h) - part(whole_g, whole_h)


def grown(best_of: Callable[[Tree, list[int]], dict[int, Split]], p: Params, ahead: bool) -> Tree:
    """A tree grown leaf by leaf, the one with the largest gain first (the older among equals).

    `best_of` finds the best splits of some nodes of a tree. With `ahead`, all leaves that may still be
    split are split on trial together, so that the number of calls follows the depth of the tree; splits
    that are not taken in the end are undone, and the tree is the same.
    """
    tree = Tree()
    tree.add((0.0, 0.0, 0))
    known = best_of(tree, [0])
    tree.sums[0] = known[0].whole
    open_ = [(-known[0].gain, 0)] if known[0].gain > LEAST_GAIN else []
    leaves, taken, children = 1, set(), {}
    while open_ and leaves < p.max_leaf_nodes:
        node = heapq.heappop(open_)[1]
        if node not in children:
            rest = heapq.nsmallest(p.max_leaf_nodes - leaves - 1, open_) if ahead else []
            fresh = [n for n in (node, *(n for _, n in rest)) if n not in children]
            children.update({n: tree.split(n, known[n]) for n in fresh})
            known.update(best_of(tree, [c for n in fresh for c in children[n]]))
        taken.add(node)
        leaves += 1
        for c in children[node]:
            if known[c].gain > LEAST_GAIN:
                heapq.heappush(open_, (-known[c].gain, c))
    return kept(tree, taken, p)


def kept(tree: Tree, taken: set[int], p: Params) -> Tree:
    """The tree of the splits taken, with the values of its leaves."""
    out = Tree()

    def copy(node: int) -> int:
        new = out.add(tree.sums[node])
        if node in taken:
            out.column[new], out.bin[new], out.gain[new] = tree.column[node], tree.bin[node], tree.gain[node]
            out.left[new], out.right[new] = copy(tree.left[node]), copy(tree.right[node])
        else:
            g, h, _ = tree.sums[node]
            out.value[new] = -p.learning_rate * g / (h + p.l2_regularization + EDGE)
        return new

    copy(0)
    return out


def histograms(bins: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """(3, column, bin): gradient, hessian and rows."""
    flat = (bins + np.arange(bins.shape[1], dtype=np.int64) * BINS).ravel()
    size = bins.shape[1] * BINS
    return np.stack([np.bincount(flat, v, size) for v in (np.repeat(g, bins.shape[1]), np.repeat(h, bins.shape[1]), None)]).reshape(3, -1, BINS)


#: Rows from which histograms are summed column by column, which needs no copies of the rows' slopes.
MANY_ROWS = 2048


def histograms_at(columns: np.ndarray, at: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """`histograms` of the rows numbered `at`, in this order, from bins with one row per column; the same sums."""
    g, h = g[at], h[at]
    if len(at) < MANY_ROWS:
        return histograms(columns[:, at].T, g, h)
    out = np.empty((3, len(columns), BINS))
    for k, column in enumerate(columns):
        c = column[at].astype(np.intp)
        out[0, k], out[1, k], out[2, k] = np.bincount(c, g, BINS), np.bincount(c, h, BINS), np.bincount(c, None, BINS)
    return out


def best_split(sums: np.ndarray, p: Params) -> Split:
    """The first split of the largest gain in the histograms of one node."""
    left = sums.cumsum(axis=2)
    whole = left[:, 0, -1]
    g, h, n = left
    fits = (n >= p.min_samples_leaf) & (whole[2] - n >= p.min_samples_leaf) & (h >= LEAST_HESSIAN) & (whole[1] - h >= LEAST_HESSIAN)
    gain = np.where(fits, gains(g, h, whole[0], whole[1], p.l2_regularization), 0.0)
    at = np.unravel_index(int(gain.argmax()), gain.shape)
    totals = (float(whole[0]), float(whole[1]), int(whole[2]))
    return Split(float(gain[at]), int(at[0]), int(at[1]), (float(g[at]), float(h[at]), int(n[at])), totals)


def slopes(raw: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian of the weighted log-loss."""
    chance = 1 / (1 + np.exp(-raw))
    return w * (chance - y), w * chance * (1 - chance)


def grown_here(bins: np.ndarray, y: np.ndarray, w: np.ndarray, start: float, p: Params) -> list[Tree]:
    """All trees over rows that one task may hold. A node keeps the numbers of its rows, so a split looks at its own rows only."""
    raw, trees, columns = np.full(len(y), start), [], np.ascontiguousarray(bins.T)
    for _ in range(p.max_iter):
        g, h = slopes(raw, y, w)
        rows = {0: np.arange(len(y))}

        def rows_of(tree: Tree, node: int) -> np.ndarray:
            if node not in rows:
                parent = tree.left.index(node) if node in tree.left else tree.right.index(node)
                at = rows.pop(parent)
                left = columns[tree.column[parent]][at] <= tree.bin[parent]
                rows[tree.left[parent]], rows[tree.right[parent]] = at[left], at[~left]
            return rows[node]

        def best_of(tree: Tree, nodes: list[int]) -> dict[int, Split]:
            return {n: best_split(histograms_at(columns, rows_of(tree, n), g, h), p) for n in nodes}

        tree = grown(best_of, p, False)
        raw = raw + np.array(tree.value)[tree.places(bins)]
        trees.append(tree)
    return trees


# -- rows on the executors ---------------------------------------------------------------------
def cuts(rows: DataFrame, width: int) -> dict[str, list[np.ndarray]]:
    """For each `fit`, the limits between the bins of each column of `x`: half-way between neighbouring values where there are
    BINS or fewer, else between groups of about equal frequency. At most BINS rows a column come to the driver."""
    long = rows.select("fit", F.posexplode("x").alias("column", "value"))
    cum = cumulated_counts(long, "value", ["fit", "column"])
    few = cum.groupBy("fit", "column").agg(F.count(F.lit(1)).alias("values"))
    place = F.floor(F.lit(float(BINS)) * (F.col(BEFORE) + (F.col("n") - 1) / 2) / F.col(TOTAL))
    group = F.when(F.col("values") <= BINS, F.col("value")).otherwise(place.cast("double"))
    ends = cum.join(F.broadcast(few), ["fit", "column"]).groupBy("fit", "column", group.alias("group")).agg(F.min("value").alias("low"), F.max("value").alias("high"))
    found: dict[str, list[list]] = {}
    for r in sorted(ends.collect(), key=lambda r: (r.fit, r.column, r.low)):
        found.setdefault(r.fit, [[] for _ in range(width)])[r.column].append((r.low, r.high))
    return {k: [np.array([(p[1] + q[0]) / 2 for p, q in zip(e, e[1:])]) for e in columns] for k, columns in found.items()}


def _binned(rows: DataFrame, limits: dict[str, list[np.ndarray]], starts: dict[str, float]) -> DataFrame:
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for fit, b in batch.groupby("fit", sort=False):
                x = np.stack(b["x"].to_numpy())
                bins = np.stack([np.searchsorted(c, x[:, k]) for k, c in enumerate(limits[fit])], axis=1).astype(np.uint8)
                yield pd.DataFrame({"fit": fit, "bins": [r.tobytes() for r in bins], "y": b["y"].to_numpy(), "w": b["w"].to_numpy(), "raw": starts[fit]})

    return rows.mapInPandas(work, "fit string, bins binary, y double, w double, raw double")


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, width)


def split_table(rows: DataFrame, width: int, done: Sequence[Tree], tree: Tree, nodes: Sequence[int], p: Params) -> DataFrame:
    """(node, column, bin, gain, g, h, n, whole_g, whole_h, whole_n): the best split of each node of `tree`.

    Tasks sum their own rows by node, column and bin; the sums are added up, and run along the bins.
    """
    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(nodes), 3, width, BINS))
        for b in batches:
            bins = _matrix(b["bins"], width)
            raw = b["raw"].to_numpy() + sum((np.array(t.value)[t.places(bins)] for t in done), np.zeros(len(b)))
            g, h = slopes(raw, b["y"].to_numpy(), b["w"].to_numpy())
            at = tree.places(bins)
            for k, n in enumerate(nodes):
                total[k] += histograms(bins[at == n], g[at == n], h[at == n])
        k, column, bin_ = np.nonzero(total[:, 2])
        yield pd.DataFrame({"node": np.array(nodes)[k], "column": column, "bin": bin_, "g": total[k, 0, column, bin_],
                            "h": total[k, 1, column, bin_], "n": total[k, 2, column, bin_].astype(np.int64)})

    hist = rows.mapInPandas(sums, "node int, column int, bin int, g double, h double, n long").groupBy("node", "column", "bin").agg(
        *[F.sum(c).alias(c) for c in "ghn"])
    every = Window.partitionBy("node", "column")
    upto = every.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = hist.select("node", "column", "bin", *[F.sum(c).over(upto).alias(c) for c in "ghn"], *[F.sum(c).over(every).alias(f"whole_{c}") for c in "ghn"])
    rest = lambda c: F.col(f"whole_{c}") - F.col(c)
    fits = ((F.col("n") >= p.min_samples_leaf) & (rest("n") >= p.min_samples_leaf) & (F.col("h") >= LEAST_HESSIAN) & (rest("h") >= LEAST_HESSIAN))
    gain = F.when(fits, gains(F.col("g"), F.col("h"), F.col("whole_g"), F.col("whole_h"), p.l2_regularization)).otherwise(0.0)
    best = F.min_by(F.struct("column", "bin", "gain", "g", "h", "n", "whole_g", "whole_h", "whole_n"), F.struct(-F.col("gain"), F.col("column"), F.col("bin")))
    return d.withColumn("gain", gain).groupBy("node").agg(best.alias("b")).select("node", "b.*")


def _grown_there(rows: DataFrame, path: str, width: int, p: Params) -> list[Tree]:
    """All trees over rows on the executors. They are stored anew now and then, so that no task scores more trees than
    `STORE_EVERY`, and a lost executor costs the trees since."""
    spark, trees, pending = rows.sparkSession, [], []
    for k in range(p.max_iter):
        def best_of(tree: Tree, nodes: list[int]) -> dict[int, Split]:
            found = split_table(rows, width, list(pending), tree, nodes, p).collect()
            return {r.node: Split(r.gain, r.column, r.bin, (r.g, r.h, r.n), (r.whole_g, r.whole_h, r.whole_n)) for r in found}

        pending.append(grown(best_of, p, True))
        if len(pending) == STORE_EVERY and k + 1 < p.max_iter:
            scored = list(pending)

            def again(batches: Iterator[pd.DataFrame], scored=scored) -> Iterator[pd.DataFrame]:
                for b in batches:
                    bins = _matrix(b["bins"], width)
                    yield b.assign(raw=b["raw"] + sum(np.array(t.value)[t.places(bins)] for t in scored))

            rows.mapInPandas(again, rows.schema).write.mode("overwrite").parquet(f"{path}/{k}")
            rows = spark.read.parquet(f"{path}/{k}")
            trees, pending = trees + pending, []
    return trees + pending


TREE_SCHEMA = ("tree int, node int, column int, bin int, threshold double, left int, right int, value double, gain double, "
               "g double, h double, n long")


class LeafwiseModel:
    """A start score and trees (the rows of TREE_SCHEMA)."""

    def __init__(self, start: float, width: int, nodes: list[tuple]):
        self.start, self.width, self.nodes = start, width, nodes

    @property
    def featureImportances(self) -> DenseVector:
        """Share of the gain by column, as the other families name it."""
        total = np.zeros(self.width)
        for r in self.nodes:
            if r[2] >= 0:
                total[r[2]] += r[8]
        return Vectors.dense(total / (total.sum() or 1.0))

    @cached_property
    def trees(self) -> list[tuple[np.ndarray, ...]]:
        """(value, column, threshold, left, right) of each tree; made once in a worker, not once a batch."""
        frame = pd.DataFrame(self.nodes, columns=[f.split()[0] for f in TREE_SCHEMA.split(", ")]).sort_values(["tree", "node"])
        return [tuple(t[c].to_numpy() for c in ("value", "column", "threshold", "left", "right")) for _, t in frame.groupby("tree", sort=True)]

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for value, *splits in self.trees:
            out += value[walked(x, *splits)]
        return out

    def score(self, df: DataFrame, name: str = "p") -> DataFrame:
        """Adds the probability of the response 1 from the vector `features`, which goes."""
        shared = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def chance(x: pd.Series) -> pd.Series:
            return pd.Series(1 / (1 + np.exp(-shared.value.raw(np.stack(x.to_numpy()))))) if len(x) else pd.Series([], dtype=float)

        return df.withColumn(name, chance(vector_to_array("features"))).drop("features")

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.nodes, TREE_SCHEMA).write.mode("overwrite").parquet(f"{path}/trees")
        spark.createDataFrame([(self.start, self.width)], "start double, width int").write.mode("overwrite").parquet(f"{path}/start")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "LeafwiseModel":
        one = spark.read.parquet(f"{path}/start").first()
        return cls(one.start, one.width, sorted(map(tuple, spark.read.parquet(f"{path}/trees").collect())))


class Leafwise:
    """The estimator: rows with `features`, `y` (0 or 1) and `w` become a LeafwiseModel.

    Features hold no nulls (the preparation fills them). A fit of up to ONE_TASK_CELLS cells sums its histograms in
    one task, which saves the many small jobs; a larger one sums them over all executors. Both grow the same trees.
    """

    def __init__(self, p: Params, one_task_cells: int = ONE_TASK_CELLS):
        self.p, self.one_task_cells = p, one_task_cells

    def fit(self, rows: DataFrame) -> LeafwiseModel:
        found = self.fit_many(rows.select(F.lit("").alias("fit"), "features", "y", "w"))
        if not found:
            raise ValueError("no rows to fit on")
        return found[""]

    def fit_many(self, rows: DataFrame, only: dict[str, Sequence[int]] | None = None) -> dict[str, LeafwiseModel]:
        """One model for each value of `fit` (string); `only` names the columns that a fit may use, all by default.

        Small fits grow side by side, each in a task; a fit beyond the bound is summed over all executors.
        """
        return self.fit_binned(binned(rows), only)

    def fit_binned(self, b: "Binned", only: dict[str, Sequence[int]] | None = None) -> dict[str, LeafwiseModel]:
        """As `fit_many`, from rows that are cut into bins already; fits that `only` doesn't name are left out."""
        p, spark = self.p, b.rows.sparkSession
        columns = {k: list(range(b.width)) if only is None else sorted(only[k]) for k in b.sizes if only is None or k in only}
        large = sorted(k for k in columns if b.sizes[k] * b.width > self.one_task_cells)
        small = sorted(set(columns) - set(large))
        nodes = _from_tasks(b.rows.filter(F.col("fit").isin(small)), b.width, b.starts, columns, p) if small else {}
        for k in large:
            path = run_folder(spark, "boosting", uuid.uuid4().hex)
            picked = [f"substring(bins, {c + 1}, 1)" for c in columns[k]]
            narrow = F.col("bins") if len(picked) == b.width else F.expr(f"concat({', '.join(picked)})")
            b.rows.filter(F.col("fit") == k).withColumn("bins", narrow).write.mode("overwrite").parquet(f"{path}/rows")
            trees = _grown_there(spark.read.parquet(f"{path}/rows"), path, len(columns[k]), p)
            nodes[k] = [r for n, t in enumerate(trees) for r in _nodes(n, t, columns[k])]
        return {k: LeafwiseModel(b.starts[k], b.width, [(*r[:4], float(b.limits[k][r[2]][r[3]]) if r[2] >= 0 else 0.0, *r[5:]) for r in rows])
                for k, rows in nodes.items()}


@dataclass
class Binned:
    """Rows (fit, bins, y, w, raw) with what each fit needs to know of them."""

    rows: DataFrame
    width: int
    sizes: dict[str, int]
    starts: dict[str, float]
    limits: dict[str, list[np.ndarray]]

    def copied(self, names: dict[str, list[str]]) -> "Binned":
        """The rows of each fit once for each of its new `names`, with the same bins."""
        old = {n: k for k, ns in names.items() for n in ns if k in self.sizes}
        new = F.create_map(*[e for k, ns in names.items() for e in (F.lit(k), F.array(*map(F.lit, ns)))])
        rows = self.rows.withColumn("fit", F.explode(new[F.col("fit")]))
        return Binned(rows, self.width, *({n: found[k] for n, k in old.items()} for found in (self.sizes, self.starts, self.limits)))


def binned(rows: DataFrame, path: str | None = None) -> Binned:
    """Rows with `fit`, `features`, `y` and `w`, cut into bins; stored under `path`, if given, for several fits."""
    d = rows.select("fit", vector_to_array("features").alias("x"), F.col("y").cast("double").alias("y"), F.col("w").cast("double").alias("w"))
    sums = d.groupBy("fit").agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("w"), F.sum(F.col("w") * F.col("y")).alias("wy"),
                                F.max(F.size("x")).alias("width")).collect()
    rates = {r.fit: min(1 - EDGE, max(EDGE, r.wy / r.w)) for r in sums}
    starts = {k: math.log(v / (1 - v)) for k, v in rates.items()}
    width = max((r.width for r in sums), default=0)
    limits = cuts(d, width) if sums else {}
    cut = _binned(d, limits, starts)
    if path:
        cut.write.mode("overwrite").parquet(path)
        cut = rows.sparkSession.read.parquet(path)
    return Binned(cut, width, {r.fit: r.n for r in sums}, starts, limits)


def score_many(df: DataFrame, models: dict[str, LeafwiseModel], name: str = "p") -> DataFrame:
    """Adds the probability that the model named by `fit` gives to `features`, which goes."""
    shared = df.sparkSession.sparkContext.broadcast(models)

    @F.pandas_udf("double")
    def chance(fit: pd.Series, x: pd.Series) -> pd.Series:
        out = pd.Series(np.nan, index=x.index)
        for k, part in x.groupby(fit, sort=False):
            out[part.index] = 1 / (1 + np.exp(-shared.value[k].raw(np.stack(part.to_numpy()))))
        return out

    return df.withColumn(name, chance("fit", vector_to_array("features"))).drop("features")


def _nodes(k: int, t: Tree, columns: Sequence[int]) -> list[tuple]:
    """Rows of TREE_SCHEMA with the columns as they are numbered in the whole table; the threshold is put in later."""
    return [(k, n, columns[t.column[n]] if t.column[n] >= 0 else -1, t.bin[n], 0.0, t.left[n], t.right[n], float(t.value[n]),
             float(t.gain[n]), float(t.sums[n][0]), float(t.sums[n][1]), int(t.sums[n][2])) for n in range(len(t.column))]


def _from_tasks(rows: DataFrame, width: int, starts: dict[str, float], columns: dict[str, list[int]], p: Params) -> dict[str, list[tuple]]:
    names = ["fit", *[f.split()[0] for f in TREE_SCHEMA.split(", ")]]

    def work(part: pd.DataFrame) -> pd.DataFrame:
        fit = part["fit"].iloc[0]
        part = part.sort_values(["bins", "y", "w"], kind="stable")      # sums don't depend on the order in which rows come
        bins = np.ascontiguousarray(_matrix(part["bins"], width)[:, columns[fit]])
        trees = grown_here(bins, part["y"].to_numpy(), part["w"].to_numpy(), starts[fit], p)
        return pd.DataFrame([(fit, *r) for k, t in enumerate(trees) for r in _nodes(k, t, columns[fit])], columns=names)

    found: dict[str, list[tuple]] = {}
    for r in sorted(map(tuple, rows.groupBy("fit").applyInPandas(work, f"fit string, {TREE_SCHEMA}").collect())):
        found.setdefault(r[0], []).append(r[1:])
    return found
