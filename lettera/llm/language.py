"""Language identification by the nearest of several centroids per language.

A text is a vector of hashed character n-grams (one to three letters, with word edges), weighted by
TF-IDF and normalised. The centroids of a language are clusters of its training texts; the language of
the centroid with the largest cosine wins. A text that lies further from it than the training texts of
its length did, with a margin, is rejected.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import aside, bounded_batches, restored, stored

UNKNOWN = "und"
_STEPS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
_letters: list[np.ndarray] = []


@dataclass(frozen=True)
class Settings:
    """`sample` bounds the training texts per language, and so what a task holds of one language."""

    buckets: int = 8192
    sample: int = 1500
    clusters: int = 4
    rounds: int = 8
    margin: float = 0.8       # a text is rejected below this share of the lowest training cosine
    chunk: int = 1 << 18      # letters worked on at a time


@dataclass(frozen=True)
class Model:
    languages: list[str]      # of each centroid
    centroids: np.ndarray     # centroid x bucket, normalised
    idf: np.ndarray
    floors: np.ndarray        # least cosine by length class


DEFAULT = Settings()


def _is_letter() -> np.ndarray:
    if not _letters:
        table = np.zeros(0x110000, bool)
        table[[i for i in range(0x110000) if not 0xD800 <= i < 0xE000 and chr(i).isalpha()]] = True
        _letters.append(table)
    return _letters[0]


def counts(text: str | None, s: Settings = DEFAULT) -> tuple[np.ndarray, int]:
    """How often each bucket's n-grams occur in the whole text, and its number of letters."""
    total, letters = np.zeros(s.buckets, np.int64), 0
    low = (text or "").lower()
    codes = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
    for at in range(0, len(codes), s.chunk):
        part = codes[max(0, at - 2):at + s.chunk]
        fresh = at - max(0, at - 2)
        good = _is_letter()[part]
        letters += int(good[fresh:].sum())
        part = np.where(good, part, 32).astype(np.uint32)
        for n in (1, 2, 3):
            if len(part) < n:
                break
            keys, some = np.full(len(part) - n + 1, n * 0x27D4EB2F, np.uint32), np.zeros(len(part) - n + 1, bool)
            for i in range(n):
                piece = part[i:len(part) - n + 1 + i]
                keys = (keys ^ piece) * _STEPS[i]
                some |= piece != 32
            keys ^= keys >> np.uint32(15)
            # an n-gram belongs to the chunk that its last letter is new in
            some[:max(0, fresh - n + 1)] = False
            total += np.bincount(keys[some] % np.uint32(s.buckets), minlength=s.buckets)
    return total, letters


def _unit(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.where(found > 0, 1 + np.log(np.maximum(found, 1)), 0).astype(np.float32) * idf
    norm = float(np.sqrt((v * v).sum()))
    return v / norm if norm else v


def _length_class(letters: int) -> int:
    return min(31, max(0, letters).bit_length())


def held_out(doc_id: Column, fold: int = 2, folds: int = 4) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def training_rows(docs: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """(lang, text): about `sample` labelled training texts of each language and no more, chosen by a hash of id and text."""
    able = docs.select("doc_id", "lang", "text").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    # drawn by id and text, equal rows once: neither an id of many texts nor a text of many rows can fill or empty a sample
    able = able.withColumn("row", F.xxhash64("doc_id", "text"))
    rows = able.select("lang", "row").groupBy("lang", "row").agg(F.count("*").alias("n"))
    # a hash threshold first, so that no task gets all rows of a language; as many counts as the model has languages
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).collect()
    if not sizes:
        return able.select("lang", "text")
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, s.sample / r["n"]))])[F.col("lang")]
    low = rows.filter(F.pmod(F.xxhash64("row"), F.lit(2 ** 30)) < share * 2 ** 30)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("row"), "row"))
    chosen = low.withColumn("rank", rank).filter(F.col("rank") <= s.sample).select("lang", "row")
    return able.join(F.broadcast(chosen), ["lang", "row"], "left_semi").dropDuplicates(["lang", "row"]).select("lang", "text")


def _clusters(v: np.ndarray, s: Settings) -> np.ndarray:
    """Spherical k-means; starts from the vector nearest to the mean, then the farthest from those chosen."""
    k = min(s.clusters, len(v))
    start = [int((v @ v.mean(axis=0)).argmax())]
    while len(start) < k:
        start.append(int((v @ v[start].T).max(axis=1).argmin()))
    c = v[start]
    for _ in range(s.rounds):
        own = (v @ c.T).argmax(axis=1)
        for j in range(k):
            if (own == j).any():
                m = v[own == j].sum(axis=0)
                c[j] = m / max(float(np.sqrt((m * m).sum())), 1e-12)
    return c


def fit(docs: DataFrame, s: Settings = DEFAULT) -> Model:
    """Learns from text and lang of the training documents alone. What comes to the driver is the model:
    one vector of inverse frequencies, `clusters` vectors per language and one floor per length class."""
    bounded_batches(docs.sparkSession)
    rows = stored(training_rows(docs, s), "sample")

    def seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, df = 0, np.zeros(s.buckets, np.int64)
        for batch in batches:
            for t in batch["text"]:
                found, letters = counts(t, s)
                n += letters > 0
                df += found > 0
        yield pd.DataFrame({"bucket": np.arange(-1, s.buckets), "n": np.concatenate(([n], df))})

    df = np.zeros(s.buckets + 1, np.int64)
    for r in rows.select("text").mapInPandas(seen, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        df[r["bucket"] + 1] = r["n"]
    idf = (np.log((1 + df[0]) / (1 + df[1:])) + 1).astype(np.float32)

    def clustered(part: pd.DataFrame) -> pd.DataFrame:
        v, size = np.empty((len(part), s.buckets), np.float32), []
        for t in part["text"]:
            found, letters = counts(t, s)
            if letters:
                v[len(size)] = _unit(found, idf)
                size.append(_length_class(letters))
        if not size:
            return pd.DataFrame(columns=["lang", "vector", "floors"])
        v, size = v[:len(size)], np.array(size)
        c = _clusters(v, s)
        best = (v @ c.T).max(axis=1)
        floors = [float(best[size == k].min()) if (size == k).any() else 2.0 for k in range(32)]
        return pd.DataFrame({"lang": part["lang"].iloc[0], "vector": list(c.astype(np.float32)), "floors": [floors] * len(c)})

    got = sorted(rows.groupBy("lang").applyInPandas(clustered, "lang string, vector array<float>, floors array<double>").collect(),
                 key=lambda r: (r["lang"], r["vector"]))
    low = np.min([r["floors"] for r in got], axis=0) if got else np.full(32, 2.0)
    near = [low[max(0, k - 1):k + 2].min() for k in range(32)]
    floors = np.array([x if x <= 1 else low.min() for x in near]) * s.margin
    return Model([r["lang"] for r in got], np.array([r["vector"] for r in got], np.float32).reshape(-1, s.buckets), idf, np.where(floors > 1, 0, floors))


def predict(docs: DataFrame, model: Model, s: Settings = DEFAULT, text: str = "text") -> DataFrame:
    """`docs` with lang_pred, lang_score (0 to 1) and lang_rejected.

    A text without a letter (null, empty, digits) is `und` with score 0 and rejected; so is every text
    if nothing was learned. Equal cosines go to the first language by name. Only the text is read, so
    repeated rows get equal results. Columns of `docs` with these names are replaced.
    """
    docs, moved = aside(docs, ["_found"])
    text = moved.get(text, text)
    bounded_batches(docs.sparkSession)
    languages, shared = model.languages, docs.sparkSession.sparkContext.broadcast((model.centroids, model.idf, model.floors))

    @F.pandas_udf("lang string, score double, rejected boolean")
    def nearest(texts: pd.Series) -> pd.DataFrame:
        centroids, idf, floors = shared.value
        out = []
        for t in texts:
            found, letters = counts(t, s)
            if not letters or not languages:
                out.append((UNKNOWN, 0.0, True))
                continue
            near = centroids @ _unit(found, idf)
            k = int(near.argmax())
            score = min(1.0, max(0.0, float(near[k])))
            out.append((languages[k], score, score < floors[_length_class(letters)]))
        return pd.DataFrame(out, columns=["lang", "score", "rejected"])

    new = ["lang_pred", "lang_score", "lang_rejected"]
    names = [c for c in docs.columns if c not in new]
    d = docs.select(*names, nearest(F.col(text)).alias("_found"))
    return restored(d.select(*names, *[F.col(f"_found.{f}").alias(n) for f, n in zip(("lang", "score", "rejected"), new)]), moved)


def identify(docs: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """Fits on the training documents of `docs` and predicts all of them. An empty table gives an empty one."""
    return predict(docs, fit(docs, s), s)
