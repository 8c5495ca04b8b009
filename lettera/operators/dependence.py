"""Partial dependence of a forest by one walk down its trees.

A tree's score changes along the grid of a variable only at nodes that split on that variable. So a row does not go down a tree
once for each point: it goes down once with its own values, and where a node splits on a moved variable, the points on the other
side go down there together. Tasks return sums by group, variable and point; no row leaves them.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .prepare import Preparation

#: Rows that walk together.
CHUNK = 8192
#: Nodes times groups up to which trees are walked here: 28 bytes a node and one a node and group in each worker.
MOST_CELLS = 1 << 25
SUMS = "__g int, __v int, __k int, soma double, linhas long"


class Walker:
    """Trees as arrays, and for each group and node how many points of the node's own variable go left.

    `columns` has the columns of each variable: the one that takes the points, then indicators, which are 0 at any point.
    `points` has the ordered points of each group and variable.
    """

    def __init__(self, trees: dict[str, np.ndarray], columns: Sequence[Sequence[int]], points: Sequence[Sequence[np.ndarray]], width: int):
        self.column, self.limit, self.left, self.right, self.value, self.roots = (
            trees[k] for k in ("column", "limit", "left", "right", "value", "roots"))
        self.sizes = np.array([[len(p) for p in ps] for ps in points], np.int32)
        self.most = int(self.sizes.max(initial=0))
        self.variable = np.full(width, -1, np.int32)
        self.cuts = np.zeros((len(points), len(self.column)), np.min_scalar_type(self.most))
        for v, cs in enumerate(columns):
            for place, c in enumerate(cs):
                self.variable[c] = v
                nodes = np.flatnonzero(self.column == c)
                for g, ps in enumerate(points):
                    at = ps[v] if place == 0 else np.zeros(len(ps[v]))
                    self.cuts[g, nodes] = np.searchsorted(at, self.limit[nodes], "right")

    def sums(self, x: np.ndarray, group: np.ndarray) -> np.ndarray:
        """(group, variable, point): the sum of the scores of the rows."""
        shape = (*self.sizes.shape, self.most + 1)
        steps = np.zeros(int(np.prod(shape)))       # the difference to the point before

        def add(r, v, low, high, value):
            cell = (group[r] * shape[1] + v) * shape[2]
            steps[:] += np.bincount(cell + low, value, len(steps)) - np.bincount(cell + high, value, len(steps))

        for root in self.roots:
            self._walk(x, group, root, add)
        return steps.reshape(shape).cumsum(axis=2)[:, :, :-1] / len(self.roots)

    def _walk(self, x: np.ndarray, group: np.ndarray, root: int, add) -> None:
        n, many = len(x), self.sizes.shape[1]
        at, rows = np.full(n, root), np.arange(n)
        low, high = np.zeros((n, many), np.int32), self.sizes[group]      # the points that are still with their row
        away = []
        while len(rows):
            node = at[rows]
            c = self.column[node]
            rows, node, c = rows[c >= 0], node[c >= 0], c[c >= 0]
            side = x[rows, c] <= self.limit[node]
            at[rows] = np.where(side, self.left[node], self.right[node])
            v = self.variable[c]
            m = np.flatnonzero(v >= 0)
            r, v, node, side = rows[m], v[m], node[m], side[m]
            a, b = low[r, v], high[r, v]
            cut = np.clip(self.cuts[group[r], node], a, b)
            low[r, v], high[r, v] = np.where(side, a, cut), np.where(side, cut, b)
            a, b = np.where(side, cut, a), np.where(side, b, cut)
            other = np.where(side, self.right[node], self.left[node])
            some = a < b
            away.append((r[some], other[some], v[some], a[some], b[some]))
        add(np.repeat(np.arange(n), many), np.tile(np.arange(many), n), low.ravel(), high.ravel(), np.repeat(self.value[at], many))
        r, node, v, low, high = (np.concatenate(parts) for parts in zip(*away))
        while len(r):
            c = self.column[node]
            leaf = c < 0
            add(r[leaf], v[leaf], low[leaf], high[leaf], self.value[node[leaf]])
            r, node, v, low, high, c = (a[~leaf] for a in (r, node, v, low, high, c))
            # the points from `low` up to `cut` go left
            cut = np.where(x[r, c] <= self.limit[node], high, low)
            m = np.flatnonzero(self.variable[c] == v)
            cut[m] = np.clip(self.cuts[group[r[m]], node[m]], low[m], high[m])
            to_left, to_right = low < cut, cut < high
            node = np.concatenate([self.left[node[to_left]], self.right[node[to_right]]])
            low, high = np.concatenate([low[to_left], cut[to_right]]), np.concatenate([cut[to_left], high[to_right]])
            r, v = (np.concatenate([a[to_left], a[to_right]]) for a in (r, v))


def can_walk(model, preparation: Preparation, groups: int) -> bool:
    """Whether `forest_dependence` applies: a forest of two classes over columns that take the points as they are, with no more
    nodes than a worker may hold."""
    return (isinstance(model, RandomForestClassificationModel) and not preparation.linear and model.numClasses == 2
            and model.totalNumNodes * groups <= MOST_CELLS)


def trees_of(model: RandomForestClassificationModel, spark, path: str) -> dict[str, np.ndarray] | None:
    """The nodes of all trees, children by their place in the arrays, -1 as the column of a leaf; None where a split is on
    categories."""
    model.write().overwrite().save(path)
    n = F.col("nodeData")
    t = spark.read.parquet(f"{path}/data").select(
        "treeID", n["id"].alias("id"), n["split"]["featureIndex"].alias("column"), n["split"]["numCategories"].alias("categories"),
        F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("limit"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        F.try_divide(n["impurityStats"][1], n["impurityStats"][0] + n["impurityStats"][1]).alias("value")).toArrow().to_pandas()
    if (t["categories"] >= 0).any() or t["value"].isna().any():
        return None
    t = t.sort_values(["treeID", "id"], ignore_index=True)
    roots = np.flatnonzero(t["id"].to_numpy() == 0)
    # the nodes of a tree are numbered from 0 without gaps
    first = np.repeat(roots, np.diff([*roots, len(t)]))
    if not (t["id"].to_numpy() == np.arange(len(t)) - first).all():
        return None
    place = lambda c: (t[c].to_numpy() + first).astype(np.int32)
    return {"column": t["column"].to_numpy(np.int32), "limit": t["limit"].to_numpy(float, na_value=0.0), "left": place("left"),
            "right": place("right"), "value": t["value"].to_numpy(float), "roots": roots}


def forest_dependence(trees: dict[str, np.ndarray], preparation: Preparation, rows: DataFrame, variables: Sequence[str],
                      grid: DataFrame) -> DataFrame:
    """(grupo, variavel, ponto, media, linhas) for rows with `grupo` and the columns that `preparation` asks for."""
    spark = rows.sparkSession
    names = preparation.columns()
    place = {c: i for i, c in enumerate(names)}
    columns = [[place[c] for c in preparation.lineage.get(v, [])] for v in variables]
    found: dict = {}
    for r in grid.where("grupo is not null").collect():          # at most 21 points per group and variable
        found.setdefault(r.grupo, {}).setdefault(r.variavel, []).append(r.ponto)
    groups = list(found)
    points = [[np.sort(np.array(found[g].get(v, []), float)) for v in variables] for g in groups]
    kind = grid.schema["grupo"].dataType.simpleString()
    numbers = spark.createDataFrame(list(enumerate(groups)), f"__g int, grupo {kind}")
    shared = spark.sparkContext.broadcast(Walker(trees, columns, points, len(names)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walker, total, many = shared.value, 0.0, 0
        for b in chunks(batches):
            group = b.column(0).to_numpy()
            x = b.column(1).combine_chunks().flatten().to_numpy().reshape(len(group), -1)
            total, many = total + walker.sums(x, group), many + np.bincount(group, minlength=len(walker.sizes))
        if np.any(many):
            g, v, k = np.nonzero((np.arange(walker.most) < walker.sizes[:, :, None]) & (many > 0)[:, None, None])
            yield pa.RecordBatch.from_pydict({"__g": g.astype(np.int32), "__v": v.astype(np.int32), "__k": k.astype(np.int32),
                                              "soma": total[g, v, k], "linhas": many[g].astype(np.int64)})

    d = rows.join(F.broadcast(numbers), "grupo")
    sums = preparation.transform(d).select("__g", vector_to_array("features").alias("x")).mapInArrow(work, SUMS)
    where = [(g, v, k, groups[g], variables[v], float(p)) for g, vs in enumerate(points) for v, ps in enumerate(vs) for k, p in enumerate(ps)]
    at = spark.createDataFrame(where, f"__g int, __v int, __k int, grupo {kind}, variavel string, ponto double")
    both = sums.groupBy("__g", "__v", "__k").agg(F.sum("soma").alias("soma"), F.sum("linhas").alias("linhas"))
    return both.join(F.broadcast(at), ["__g", "__v", "__k"]).select(
        "grupo", "variavel", "ponto", (F.col("soma") / F.col("linhas")).alias("media"), "linhas")


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The same rows, `CHUNK` at a time, however many come in a batch."""
    held, n = [], 0
    for b in batches:
        held, n = [*held, b], n + b.num_rows
        if n >= CHUNK:
            t = pa.Table.from_batches(held)
            full = n - n % CHUNK
            yield from (t.slice(i, CHUNK) for i in range(0, full, CHUNK))
            held, n = t.slice(full).to_batches(), n - full
    if n:
        yield pa.Table.from_batches(held)
