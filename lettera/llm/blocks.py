"""Texts packed into blocks of bounded size, each with its own list of distinct words.

What many occurrences need to know about a word is then asked once per block, not once per occurrence.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

#: Characters after which a block is closed; one text is never split, so a block is at most this and one text.
BLOCK_CHARS = 12_000_000


def squeeze(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32 as compressed bytes, low bytes first: the high ones hold little."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4)
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes.T).tobytes())


def unsqueeze(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def in_blocks(rows: DataFrame, pack: Callable[[list, list], dict], schema: str, text: str = "text",
              block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per block: `block`, and what `pack(ids, texts)` makes of its rows. Null texts come as ''.

    The number of a block tells its task and place, so a task that runs again makes the same blocks.
    `rows` has a column `id` without nulls. Store the result: a second run may deal the rows in another way.
    """
    bounded_batches(rows.sparkSession)
    names = [x.split()[0] for x in schema.split(", ")]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, made, ids, texts, size = TaskContext.get().partitionId(), 0, [], [], 0

        def closed():
            packed = pack(ids, texts)
            return pd.DataFrame({"block": [task << 32 | made], **{k: [packed[k]] for k in names}})

        for batch in batches:
            for i, t in zip(batch["id"], batch["text"]):
                ids.append(int(i))
                texts.append(t or "")
                size += len(texts[-1])
                if size >= block_chars:
                    yield closed()
                    made, ids, texts, size = made + 1, [], [], 0
        if ids:
            yield closed()

    return rows.select("id", F.col(text).alias("text")).mapInPandas(work, f"block long, {schema}")
