"""N-gram Jaccard join with Bayesian candidate pruning, and near-duplicate classes.

Texts are sets of word shingles. Equal sets are one node. MinHash bands bring nodes together that
may be similar; nodes that meet, directly or through others, form a pool. Inside a pool, in tiles of
bounded size, pairs are compared a few MinHash values at a time, and a pair is dropped as soon as the
posterior probability that it reaches the threshold falls below the tolerance. What is left is
verified on the whole sets. Links are counted and joined to classes in the tiles, so no list of all
pairs ever exists.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NO_ID, aside, bounded_batches, restored, stored
from .components import components
from .hashing import joined, mixed, word_hashes


@dataclass(frozen=True)
class Settings:
    """What counts as similar, and how candidates are found.

    A pair at the threshold shares no band with probability (1 - 0.8**5)**40, about 1e-7; one that is
    more similar, with less. `tolerance` bounds the posterior probability at which a pair is dropped.
    """

    words: int = 5
    threshold: float = 0.8
    bands: int = 40
    rows: int = 5
    step: int = 20
    tolerance: float = 1e-6
    tile: int = 512


DEFAULT = Settings()


def shingles(text: str | None, s: Settings = DEFAULT) -> np.ndarray:
    """The distinct shingles of a text, ascending; a text of fewer words is one shingle."""
    return np.unique(joined(word_hashes(text or ""), s.words))


def set_id(found: np.ndarray) -> bytes | None:
    if not len(found):
        return None
    return b"".join(int(mixed(found, k).sum(dtype=np.uint64) & np.uint64(2 ** 64 - 1)).to_bytes(8, "big") for k in (11, 12))


def signature(found: np.ndarray, s: Settings = DEFAULT) -> np.ndarray:
    """The smallest value of each of bands x rows hash functions."""
    rng = np.random.default_rng(7)
    a = rng.integers(1, 2 ** 63, s.bands * s.rows, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 2 ** 63, s.bands * s.rows, dtype=np.uint64)[:, None]
    least = np.full(s.bands * s.rows, 2 ** 32 - 1, np.uint64)
    for i in range(0, len(found), 2048):
        least = np.minimum(least, ((a * found[None, i:i + 2048] + b) >> np.uint64(32)).min(axis=1))
    return least.astype(np.uint32)


def band_keys(values: np.ndarray, s: Settings = DEFAULT) -> np.ndarray:
    parts = values.reshape(s.bands, s.rows).astype(np.uint64)
    keys = np.arange(s.bands, dtype=np.uint64)
    for i in range(s.rows):
        keys = mixed(keys, i) + parts[:, i]
    return mixed(keys, s.rows).view(np.int64)


def least_matches(s: Settings = DEFAULT) -> dict[int, int]:
    """After n compared values, the fewest matches at which a pair stays.

    With a uniform prior the similarity after m of n matches is Beta(m+1, n-m+1), and the chance that it
    reaches t is the chance of at most m successes in n+1 trials of probability t.
    """
    found = {}
    for n in range(s.step, s.bands * s.rows + 1, s.step):
        chance, m = 0.0, -1
        while chance < s.tolerance:
            m += 1
            chance += math.comb(n + 1, m) * s.threshold ** m * (1 - s.threshold) ** (n + 1 - m)
        found[n] = m
    return found


def similar_pairs(left: tuple, right: tuple | None, s: Settings = DEFAULT) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the pairs of two lists (sets, signatures) that reach the threshold; within one list if `right` is None."""
    (sets_a, sig_a), (sets_b, sig_b) = left, right or left
    if right is None:
        i, j = np.triu_indices(len(sets_a), 1)
    else:
        i, j = (x.ravel() for x in np.indices((len(sets_a), len(sets_b))))
    size_a, size_b = (np.array([len(x) for x in q], np.int64) for q in (sets_a, sets_b))
    near = np.minimum(size_a[i], size_b[j]) >= s.threshold * np.maximum(size_a[i], size_b[j])
    i, j = i[near], j[near]
    matches = np.zeros(len(i), np.int32)
    for n, least in least_matches(s).items():
        part = slice(n - s.step, n)
        matches += (sig_a[i, part] == sig_b[j, part]).sum(axis=1, dtype=np.int32)
        stay = matches >= least
        i, j, matches = i[stay], j[stay], matches[stay]
        if not len(i):
            return i, j
    common = np.zeros(len(i), np.float64)
    if len(i) <= 64:
        common[:] = [len(np.intersect1d(sets_a[x], sets_b[y], assume_unique=True)) for x, y in zip(i, j)]
    else:
        rows_a, rows_b = np.unique(i), np.unique(j)
        at_a, at_b = np.searchsorted(rows_a, i), np.searchsorted(rows_b, j)
        flat_a, flat_b = (np.concatenate([q[x] for x in rows]) for q, rows in ((sets_a, rows_a), (sets_b, rows_b)))
        owner_a, owner_b = (np.repeat(np.arange(len(rows)), [len(q[x]) for x in rows]) for q, rows in ((sets_a, rows_a), (sets_b, rows_b)))
        shared = np.intersect1d(flat_a, flat_b)
        if right is None:
            values, counts = np.unique(flat_a, return_counts=True)
            shared = values[counts > 1]
        total = np.zeros((len(rows_a), len(rows_b)), np.float32)
        place_a, place_b = np.searchsorted(shared, flat_a), np.searchsorted(shared, flat_b)
        ok_a, ok_b = (shared[np.minimum(p, len(shared) - 1)] == f if len(shared) else np.zeros(len(f), bool) for p, f in ((place_a, flat_a), (place_b, flat_b)))
        for c in range(0, len(shared), 4096):
            blocks = []
            for place, ok, owner, rows in ((place_a, ok_a, owner_a, rows_a), (place_b, ok_b, owner_b, rows_b)):
                here = ok & (place >= c) & (place < c + 4096)
                block = np.zeros((len(rows), min(4096, len(shared) - c)), np.float32)
                block[owner[here], place[here] - c] = 1
                blocks.append(block)
            total += blocks[0] @ blocks[1].T
        common = total[at_a, at_b].astype(np.float64)
    linked = common >= s.threshold * (size_a[i] + size_b[j] - common) - 1e-9
    return i[linked], j[linked]


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index that each of n rows is linked to, directly or through others."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, i, root[j])
        np.minimum.at(new, j, root[i])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def fingerprints(docs: DataFrame, s: Settings = DEFAULT, text: str = "text") -> DataFrame:
    """(id, place, set_id, bands) of each row: `place` is a hash of the text; set_id and bands are null without words."""
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, place, t in zip(batch["id"], batch["place"], batch["text"]):
                found = shingles(t, s)
                out.append((doc, place, set_id(found), band_keys(signature(found, s), s) if len(found) else None))
            yield pd.DataFrame(out, columns=["id", "place", "set_id", "bands"])

    lean = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("place"), F.col(text).alias("text"))
    return lean.mapInPandas(work, "id long, place long, set_id binary, bands array<long>")


def _tiles(rows: pd.DataFrame, s: Settings) -> pd.DataFrame:
    """Links within or between the blocks of one tile group; `side` tells which block a row stands for."""
    out = []
    for _, tile in rows.groupby("tile", sort=False):
        parts = []
        for side in (0, 1):
            p = tile[tile["side"] == side]
            parts.append((p, [np.frombuffer(x, np.uint64) for x in p["shingles"]],
                          np.stack([np.frombuffer(x, np.uint32) for x in p["signature"]]) if len(p) else None))
        (pa, sets_a, sig_a), (pb, sets_b, sig_b) = parts
        if not len(pa):
            continue
        if len(pb):
            i, j = similar_pairs((sets_a, sig_a), (sets_b, sig_b), s)
            j = j + len(pa)
        else:
            i, j = similar_pairs((sets_a, sig_a), None, s)
        both = pd.concat([pa, pb])
        copies, n = both["copies"].to_numpy(np.int64), len(both)
        links, texts = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for x, y in ((i, j), (j, i)):
            np.add.at(links, x, copies[y])
            np.add.at(texts, x, 1)
        ids = both["set_id"].to_numpy()
        hit = texts > 0
        out.append(pd.DataFrame({"set_id": ids[hit], "links": links[hit], "texts": texts[hit], "root": ids[_roots(n, i, j)[hit]]}))
    return pd.concat(out) if out else pd.DataFrame(columns=["set_id", "links", "texts", "root"])


def first_texts(docs: DataFrame, member: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `member` (least, place, ...) with the texts of that id and hash; an id alone, such as the
    one of all null ids, may stand for many texts."""
    lean = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("least"), F.xxhash64(text).alias("place"),
                       F.col(text).alias("text"))
    return lean.join(member, ["least", "place"])


def block_partners(keys: DataFrame, member: DataFrame) -> DataFrame:
    """(set_id, others): for each set of a pool of several blocks, the blocks in which another set shares a band with it."""
    mine = stored(keys.join(member.filter("blocks > 1").select("set_id", "block"), "set_id"), "blocks")
    there = (mine.groupBy("band", "block").agg(F.count("*").alias("n")).groupBy("band")
             .agg(F.collect_list(F.struct("block", "n")).alias("there"), F.sum("n").alias("n")).filter("n > 1"))
    met = F.transform(F.filter("there", lambda x: (x["block"] != F.col("block")) | (x["n"] > 1)), lambda x: x["block"])
    return (mine.join(there.drop("n"), "band").select("set_id", met.alias("met")).groupBy("set_id")
            .agg(F.array_distinct(F.flatten(F.collect_set("met"))).alias("others")))


def near_classes(docs: DataFrame, s: Settings = DEFAULT, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Fingerprints of all rows, and (set_id, copies, links, texts, class_id, root) of each distinct set.

    `links` counts the other rows that reach the threshold, copies included; `texts` the other sets.
    `class_id` is the smallest id among all rows joined by links, `root` the smallest set.
    """
    bounded_batches(docs.sparkSession)
    prints = stored(fingerprints(docs, s, text), "prints")
    nodes = stored(prints.filter(F.col("set_id").isNotNull()).groupBy("set_id").agg(
        F.min(F.struct("id", "place")).alias("first"), F.count("*").alias("copies"), F.min_by("bands", "id").alias("bands"))
        .select("set_id", F.col("first.id").alias("least"), F.col("first.place").alias("place"), "copies", "bands"), "nodes")
    keys = nodes.select("set_id", F.explode("bands").alias("band"))
    leaders = keys.groupBy("band").agg(F.min("set_id").alias("leader"), F.count("*").alias("n")).filter("n > 1")
    star = keys.join(leaders, "band").select("set_id", "leader").distinct()
    pools = stored(components(star).select(F.col("node").alias("set_id"), F.col("root").alias("pool")), "pools")
    sizes = pools.groupBy("pool").agg(F.count("*").alias("size"))
    # blocks of a pool: by the set's own hash, so that every row knows its block without an order
    member = (pools.join(sizes, "pool").join(nodes.select("set_id", "least", "place", "copies"), "set_id")
              .withColumn("blocks", F.ceil(F.col("size") / s.tile).cast("int"))
              .withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")))

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for t, wanted, pool, copies, blocks, block in zip(*[batch[c] for c in ("text", "set_id", "pool", "copies", "blocks", "block")]):
                found = shingles(t, s)
                if set_id(found) == bytes(wanted):
                    out.append((wanted, pool, copies, blocks, block, found.tobytes(), signature(found, s).tobytes()))
            yield pd.DataFrame(out, columns=["set_id", "pool", "copies", "blocks", "block", "shingles", "signature"])

    sketches = stored(first_texts(docs, member, text).mapInPandas(
        sketch, "set_id binary, pool binary, copies long, blocks int, block int, shingles binary, signature binary"), "sketches")
    # a row of block b takes part in the tiles (x, b) with x <= b as the second side and (b, y) as the first, where x and y
    # hold a set that shares a band with it; a pool of one block is one tile
    tiles = (sketches.dropDuplicates(["set_id"]).join(block_partners(keys, member), "set_id", "left")
             .withColumn("other", F.explode(F.coalesce("others", F.array(F.lit(0))))))
    lower, upper = F.least("block", "other"), F.greatest("block", "other")
    tiles = (tiles.withColumn("side", F.when(F.col("block") <= F.col("other"), 0).otherwise(1))
             .withColumn("tile", F.concat_ws("/", F.hex("pool"), lower, upper)))
    # small pools share a group, so that a task has a few thousand rows whatever the size of pools
    groups = max(1, math.ceil(sketches.count() / 1024))
    bin_ = F.when(F.col("blocks") > 1, F.concat(F.lit("t"), F.col("tile"))).otherwise(
        F.concat(F.lit("g"), F.pmod(F.xxhash64("pool"), F.lit(groups)).cast("string")))
    linked = stored(tiles.withColumn("bin", bin_).select("bin", "tile", "side", "set_id", "copies", "shingles", "signature")
                    .groupBy("bin").applyInPandas(lambda rows: _tiles(rows, s), "set_id binary, links long, texts long, root binary"), "linked")
    counts = linked.groupBy("set_id").agg(F.sum("links").alias("links"), F.sum("texts").alias("texts"))
    joined_ = components(linked.select("set_id", "root"))
    d = (nodes.select("set_id", "least", "copies").join(counts, "set_id", "left")
         .join(joined_.select(F.col("node").alias("set_id"), "root"), "set_id", "left")
         .withColumn("root", F.coalesce("root", "set_id")))
    classes = d.groupBy("root").agg(F.min("least").alias("class_id"))
    d = d.join(classes, "root").select("set_id", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
                                       F.coalesce("texts", F.lit(0)).alias("texts"), "class_id", "root")
    return prints, stored(d, "classes")


def join_documents(docs: DataFrame, s: Settings = DEFAULT, text: str = "text") -> DataFrame:
    """One row for each row of `docs`: doc_id, class_id, n_links (long) and n_texts (long).

    class_id is the smallest doc_id among the rows it is joined with by links of Jaccard `threshold` or
    more on sets of `words`-word shingles; n_links counts the rows linked to it, n_texts the distinct sets.
    Texts without words (null, empty, blank) are linked to nothing and are their own class. A null
    doc_id counts as one id before all others and comes back as null; repeated rows are copies of each
    other. An empty table gives an empty one.
    """
    prints, classes = near_classes(docs, s, text)
    d = prints.select("id", "set_id").join(classes, "set_id", "left")
    shown = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return d.withColumn("class_id", F.coalesce("class_id", "id")).select(
        shown("id").alias("doc_id"), shown("class_id").alias("class_id"), F.coalesce("links", F.lit(0)).alias("n_links"),
        F.coalesce("texts", F.lit(0)).cast("long").alias("n_texts"))


def keep_one(docs: DataFrame, s: Settings = DEFAULT, text: str = "text") -> DataFrame:
    """`docs` with one row of each class: the one with the smallest doc_id, and of its equal rows one.

    Texts without words are in no class: of rows with equal doc_id and text one stays.
    """
    docs, moved = aside(docs, ["_id", "_place"])
    text = moved.get(text, text)
    prints, classes = near_classes(docs, s, text)
    d = prints.select("id", "place", "set_id").join(classes.select("set_id", "root"), "set_id", "left")
    first = d.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min(F.struct("id", "place")).alias("k"))
    keepers = first.select("k.id", "k.place").union(d.filter(F.col("root").isNull()).select("id", "place")).distinct().toDF("_id", "_place")
    kept = docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).withColumn("_place", F.xxhash64(text))
    return restored(kept.join(keepers, ["_id", "_place"], "left_semi").dropDuplicates(["_id", "_place"]).drop("_id", "_place"), moved)
