"""Filter interaction audit: contingency tensors of pass and fail, contracted for every order of the filters.

Every document passes or fails each filter on its own. Counts of the 2**n combinations per part are
reshaped to a tensor with one axis of length two for each filter. What a filter removes at a step of an
order is one contraction: `pass` along the axes of the filters before it, `fail` along its own, `all`
along the others. All selections that the orders need are contracted by a single einsum.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import permutations
from string import ascii_lowercase

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, let, stored

PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)


@dataclass(frozen=True)
class Filter:
    """A letter, and the condition under which a document fails, from its text and its array of words."""

    letter: str
    fails: Callable[[Column, Column], Column]


#: The conditions A to D. The last letter is that of the copies.
FILTERS = (
    Filter("A", lambda text, words: F.size(words) < 50),
    Filter("B", lambda text, words: 100 * F.size(F.array_distinct(words)) < 65 * F.size(words)),
    Filter("C", lambda text, words: 100 * F.char_length(F.regexp_replace(text, "[^A-Z]+", "")) > 5 * F.char_length(text)),
    Filter("D", lambda text, words: text.rlike("[#$%&*|]")),
)
COPIES = "E"


def failed_bits(text: Column, filters: Sequence[Filter] = FILTERS) -> Column:
    """The place of a text in the tensor, as far as `filters` go: the first filter is the highest bit, the copies' bit stays 0."""
    n = len(filters)
    return let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda words: sum(
        (F.when(f.fails(text, words), 1 << (n - k)).otherwise(0) for k, f in enumerate(filters)), F.lit(0)))


def cells(docs: DataFrame, labels: DataFrame, filters: Sequence[Filter] = FILTERS, part: str = "source", text: str = "text") -> DataFrame:
    """(part, cell, n, good, toxic): the documents of each cell of each part's tensor, and those of them with each label.

    A text is known by its SHA-256 from here on. A document is a copy if a smaller doc_id has its text: rows are summed by
    id and text first, the smallest id of a text is a sum with partials, and it is looked up by text and id together, so
    that the copies of a frequent text are dealt to all tasks. A null doc_id is smaller and larger than none. A document
    with several label rows has a label if one of them says so.
    """
    raw = F.coalesce(F.col(text), F.lit(""))
    lean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part), F.lit("")).alias("part"),
                       F.unhex(F.sha2(raw, 256)).alias("key"), failed_bits(raw, filters).alias("bits"))
    lean = stored(lean.groupBy("doc_id", "key", "part", "bits").agg(F.count("*").alias("n")), "audited")
    first = lean.filter(F.col("doc_id").isNotNull()).groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    marks = (labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(*[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(m) for c, m in (("quality", "good"), ("toxic", "toxic"))]))
    d = lean.join(first.withColumn("first", F.lit(True)), ["key", "doc_id"], "left").join(marks, "doc_id", "left")
    copy = F.when(F.col("doc_id").isNotNull() & F.col("first").isNull(), 1).otherwise(0)
    share = lambda c: F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(c)
    return d.groupBy("part", (F.col("bits") + copy).alias("cell")).agg(F.sum("n").alias("n"), share("good"), share("toxic"))


class Orders:
    """All orders of `letters`, and the selections their steps need."""

    def __init__(self, letters: str):
        n = len(letters)
        self.letters, self.places = letters, list(permutations(range(n)))
        known: dict[tuple, int] = {}

        def place(passing, failing, rest) -> int:
            wanted = tuple(PASS if k in passing else FAIL if k == failing else rest for k in range(n))
            return known.setdefault(wanted, len(known))

        steps = [(o[:i], o[i]) for o in self.places for i in range(n)]
        self.filter = np.array([f for _, f in steps])
        self.removed = np.array([place(before, f, ALL) for before, f in steps])
        self.kept = np.array([place((*before, f), None, ALL) for before, f in steps])
        self.fails = np.array([place((), f, ALL) for _, f in steps])
        self.alone = np.array([place((), f, PASS) for _, f in steps])
        self.selections = np.array(list(known), np.int64)              # selection x axis x (pass, fail)
        self.names = np.array(["".join(letters[k] for k in o) for o in self.places], object).repeat(n)
        self.steps = np.tile(np.arange(1, n + 1, dtype=np.int32), len(self.places))

    def contracted(self, tensors: np.ndarray) -> np.ndarray:
        """(part, count, selection) sums of tensors (part, count, 2, ..., 2)."""
        axes = ascii_lowercase[:len(self.letters)]
        picks = [self.selections[:, k] for k in range(len(axes))]
        return np.einsum(f"xy{axes}," + ",".join(f"z{a}" for a in axes) + "->xyz", tensors, *picks, optimize=True)


def report(counted: DataFrame, letters: str) -> DataFrame:
    """One row per part, order and step, from the cells of `counted`."""
    orders, n = Orders(letters), len(letters)
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 32):
                some = batch.iloc[at:at + 32]
                x = np.zeros((len(some), 3, 2 ** n), np.int64)
                for k, found in enumerate(some["found"]):
                    for c in found:
                        x[k, :, c["cell"]] += (c["n"], c["good"], c["toxic"])
                got = orders.contracted(x.reshape(len(some), 3, *(2,) * n))
                count, good, toxic = got[:, 0], got[:, 1], got[:, 2]
                removed = count[:, orders.removed]
                summed = np.stack([removed[:, orders.filter == f].sum(axis=1) for f in range(n)], axis=1)
                values = [count[:, orders.kept], removed, count[:, orders.fails] - removed, count[:, orders.alone],
                          good[:, orders.removed], toxic[:, orders.removed], summed[:, orders.filter]]
                yield pd.DataFrame({"part": some["part"].to_numpy(object).repeat(len(orders.names)), "filter_order": np.tile(orders.names, len(some)),
                                    "step": np.tile(orders.steps, len(some)), **{k: v.ravel() for k, v in zip(names, values)}})

    tensors = counted.groupBy("part").agg(F.collect_list(F.struct("cell", "n", "good", "toxic")).alias("found"))   # 2**n cells at most
    return tensors.mapInPandas(work, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in names))


def audit(docs: DataFrame, labels: DataFrame, filters: Sequence[Filter] = FILTERS, copies: str = COPIES, part: str = "source",
          text: str = "text") -> DataFrame:
    """What every filter removes at every step of every order, per part of `docs`.

    Returns part (string), filter_order (string), step (int, from 1), and counts within the part (long): kept after the
    step, removed at it, redundant (failing its filter, removed before), unique_fails (failing its filter only), good_lost
    and toxic_lost (removed at it, with labels quality and toxic of 1) and shapley (removed by its filter, summed over all
    orders). The last filter, `copies`, fails documents whose text a smaller doc_id has, anywhere in `docs`.

    Null texts count as empty, null parts as the part ''. A null doc_id is no copy and has no label; repeated rows count
    each, and are not copies of each other, having equal ids. Null labels are none. Other columns of both tables are not
    read, whatever their names. An empty table gives an empty one; orders are factorial in the number of filters.
    """
    return report(stored(cells(docs, labels, filters, part, text), "cells"), "".join(f.letter for f in filters) + copies)
