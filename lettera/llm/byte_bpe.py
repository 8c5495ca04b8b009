"""Byte-level BPE: ranked merges folded over the words of a task that are not remembered.

Texts are split by the tokenizer's pattern. The bytes of a word are a list, and a fold joins the pair of
lowest rank until no pair has one. The fold exists as higher-order functions with a literal rank
map (`merged`), and inside a task (`fold_numbers`, and `fold` on byte strings), which encodes documents. Decoding looks up the
bytes of each token in a literal and concatenates them.
"""
from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator, Sequence
from heapq import heapify, heappop, heappush
from itertools import batched

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NO_ID, bounded_batches, let

#: Buckets of the literal rank map; an entry's bucket is its hash.
BUCKETS = 1 << 16
_NONE = 2 ** 31 - 1
#: Bytes of a word beyond which its pairs wait in a heap, so that time does not grow with the square.
LONG = 200
#: Bytes of a word up to which it is folded together with others, and how many of them at once.
SHORT, AT_ONCE = 32, 4096
#: Words that are looked up at once; a text of more characters is cut into words bit by bit.
RUN = 20_000


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a file with a base64 token and a number per line; read on the driver, 50,000 entries or so."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def rank_literal(ranks: dict[bytes, int]) -> Column:
    """The rank map as a literal: an array of buckets, each ",hex:rank,hex:rank"."""
    buckets = [""] * BUCKETS
    for piece, rank in ranks.items():
        h = piece.hex().upper()
        buckets[xxhash.xxh64_intdigest(h.encode(), 42) % BUCKETS] += f",{h}:{rank}"
    return F.split(F.lit("\n".join(buckets)), "\n")


def rank_of(piece: Column, literal: Column) -> Column:
    """Rank of a piece given in hexadecimal, or null."""
    place = F.xxhash64(piece).bitwiseAND(F.lit(BUCKETS - 1))
    bucket = F.element_at(literal, (place + 1).cast("int"))
    sought = F.concat(F.lit(","), piece, F.lit(":"))
    rest = F.call_function("substring_index", bucket, sought, F.lit(-1))
    return F.when(F.contains(bucket, sought), F.substring_index(rest, ",", 1).cast("int"))


def merged(piece: Column, ranks: dict[bytes, int], literal: Column) -> Column:
    """Token ids of a word given in hexadecimal: the pair of lowest rank is joined first, from the left among equals.

    The state holds the pieces, their tokens, and for each piece the rank of it joined with the next one. Only
    the two ranks beside a join are looked up again. The fold has a step for each byte, so a word of n bytes
    takes n * n time.
    """
    byte_ids = F.split(F.lit(",".join(str(ranks.get(bytes([b]), -1)) for b in range(256))), ",").cast("array<int>")
    bytes_ = F.split(F.regexp_replace(piece, "(..)(?!$)", "$1,"), ",")
    rank = lambda x: F.coalesce(rank_of(x, literal), F.lit(_NONE))

    def started(p):
        pairs = F.zip_with(p, F.slice(p, F.lit(2), F.size(p)), lambda x, y: F.when(y.isNull(), F.lit(_NONE)).otherwise(rank(F.concat(x, y))))
        return F.struct(p.alias("p"), F.transform(p, lambda x: F.element_at(byte_ids, F.conv(x, 16, 10).cast("int") + 1)).alias("t"),
                        pairs.alias("r"))

    def joined_at(state, low, k):
        p, t, r = state["p"], state["t"], state["r"]
        new = F.concat(F.element_at(p, k), F.element_at(p, k + 1))
        last = F.size(p)
        beside = F.array(F.when(k > 1, F.concat(F.element_at(p, F.greatest(k - 1, F.lit(1))), new)),
                         F.when(k + 1 < last, F.concat(new, F.element_at(p, F.least(k + 2, last)))))
        fresh = F.transform(beside, lambda x: F.when(x.isNull(), F.lit(_NONE)).otherwise(rank(x)))
        return F.struct(
            F.concat(F.slice(p, F.lit(1), k - 1), F.array(new), F.slice(p, k + 2, last)).alias("p"),
            F.concat(F.slice(t, F.lit(1), k - 1), F.array(low), F.slice(t, k + 2, last)).alias("t"),
            F.concat(F.slice(r, F.lit(1), F.greatest(k - 2, F.lit(0))), F.slice(fresh, F.when(k > 1, 1).otherwise(2), F.lit(2)),
                     F.slice(r, k + 2, last)).alias("r"))

    def step(state, _):
        return let(F.array_min(state["r"]), lambda low: F.when(low == _NONE, state).otherwise(
            let(F.array_position(state["r"], low).cast("int"), lambda k: joined_at(state, low, k))))

    return F.aggregate(F.slice(bytes_, F.lit(2), F.size(bytes_)), let(bytes_, started), step, lambda x: x["t"])


def fold(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The tokens of a word: its own one, else those of the same merges as in `merged`."""
    own = ranks.get(piece)
    if own is not None:
        return [own]
    if len(piece) > LONG:
        return _fold_long(piece, ranks)
    parts = [piece[i:i + 1] for i in range(len(piece))]
    pair = [ranks.get(a + b, _NONE) for a, b in zip(parts, parts[1:])] + [_NONE]
    while (low := min(pair)) != _NONE:
        k = pair.index(low)
        parts[k:k + 2] = [parts[k] + parts[k + 1]]
        del pair[k]
        pair[k] = ranks.get(parts[k] + parts[k + 1], _NONE) if k + 1 < len(parts) else _NONE
        if k:
            pair[k - 1] = ranks.get(parts[k - 1] + parts[k], _NONE)
    return [ranks[x] for x in parts]


def pair_ranks(ranks: dict[bytes, int]) -> tuple[int, dict[int, int]]:
    """A base, and for each token that two tokens make its rank, under left * base + right: 50,000 tokens have 200,000 or so."""
    base = max(ranks.values(), default=0) + 1
    return base, {ranks[piece[:i]] * base + ranks[piece[i:]]: rank for piece, rank in ranks.items()
                  for i in range(1, len(piece)) if piece[:i] in ranks and piece[i:] in ranks}


def fold_numbers(piece: bytes, ranks: dict[bytes, int], base: int, pairs: dict[int, int], single: list[int]) -> list[int]:
    """`fold` on numbers: tokens stand for their bytes, and `pairs` names the token of two (`pair_ranks`). `single` has the
    token of each byte."""
    own = ranks.get(piece)
    if own is not None:
        return [own]
    if len(piece) > LONG:
        return _fold_long(piece, ranks)
    ids, get = [single[b] for b in piece], pairs.get
    pair = [get(a * base + b, _NONE) for a, b in zip(ids, ids[1:])] + [_NONE]
    while (low := min(pair)) != _NONE:
        k = pair.index(low)
        ids[k] = low
        del ids[k + 1], pair[k]
        pair[k] = get(low * base + ids[k + 1], _NONE) if k + 1 < len(ids) else _NONE
        if k:
            pair[k - 1] = get(ids[k - 1] * base + low, _NONE)
    return ids


def _fold_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for a word of many bytes: its pairs wait in a heap, by rank and then by place."""
    n = len(piece)
    ends, before = list(range(1, n + 1)), list(range(-1, n - 1))     # a part starts at i and ends at ends[i]
    alive = bytearray(b"\1") * n
    waiting = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapify(waiting)
    while waiting:
        _, i, stop = heappop(waiting)
        mid = ends[i]
        if not alive[i] or mid >= n or ends[mid] != stop:
            continue                                                 # one of the two was joined since
        alive[mid], ends[i] = 0, stop
        if stop < n:
            before[stop] = i
            if (r := ranks.get(piece[i:ends[stop]])) is not None:
                heappush(waiting, (r, i, ends[stop]))
        if i and (r := ranks.get(piece[before[i]:stop])) is not None:
            heappush(waiting, (r, before[i], stop))
    return [ranks[piece[i:ends[i]]] for i in range(n) if alive[i]]


def encode_words(words: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """`words` (word, not empty) with `ids`, folded by higher-order functions with the literal rank map."""
    literal = rank_literal(ranks)
    d = words.withColumn("_hex", F.hex(F.encode("word", "UTF-8"))).withColumn("_own", rank_of(F.col("_hex"), literal))
    return d.select(*words.columns, F.when(F.col("_own").isNotNull(), F.array("_own")).otherwise(
        merged(F.col("_hex"), ranks, literal)).alias("ids"))


def pair_arrays(base: int, pairs: dict[int, int], single: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """`pair_ranks` in order of its keys, the tokens of the bytes, and for each two bytes their pair's rank."""
    keys = np.fromiter(pairs, np.int64, len(pairs))
    order, one = np.argsort(keys), np.array(single, np.int64)
    two = np.array([pairs.get(a * base + b, _NONE) for a in single for b in single], np.int32)
    return keys[order], np.fromiter(pairs.values(), np.int32, len(pairs))[order], one, two


def fold_many(pieces: list[bytes], base: int, keys: np.ndarray, values: np.ndarray, one: np.ndarray, two: np.ndarray) -> list[bytes]:
    """The tokens of words with a byte at least, as 32-bit numbers: the merges of `fold_numbers`, one of each word at a time.

    A row is a word: a part's token stands in the column of its first byte, -1 in the others and in one more at both ends.
    """
    n, width = len(pieces), max(map(len, pieces))
    raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
    inside = np.arange(width) < np.fromiter(map(len, pieces), np.int64, n)[:, None]
    ids = np.full((n, width + 2), -1, np.int64)
    ids[:, 1:-1] = np.where(inside, one[raw], -1)
    rank = np.full((n, width + 2), _NONE, np.int32)
    rank[:, 1:-2] = np.where(inside[:, 1:], two[raw[:, :-1].astype(np.int32) * 256 + raw[:, 1:]], _NONE)
    after, before = (np.tile(np.arange(i, width + 2 + i, dtype=np.int32), (n, 1)) for i in (1, -1))
    rows = np.arange(n)
    while True:
        k = rank[rows].argmin(1)
        low = rank[rows, k]
        more = low != _NONE
        rows, k, low = rows[more], k[more], low[more]
        if not len(rows):
            break
        gone, left = after[rows, k], before[rows, k]
        right = after[rows, gone]
        ids[rows, k], ids[rows, gone], rank[rows, gone] = low, -1, _NONE
        after[rows, k], before[rows, right] = right, k
        first, second = np.concatenate([low, ids[rows, left]]), np.concatenate([ids[rows, right], low])
        sought = first * base + second
        at = np.minimum(np.searchsorted(keys, sought), len(keys) - 1)
        fresh = np.where((keys[at] == sought) & (first >= 0) & (second >= 0), values[at], _NONE)
        rank[rows, k], rank[rows, left] = fresh[:len(rows)], fresh[len(rows):]
    kept = ids >= 0
    tokens, ends = ids[kept].astype(np.int32).tobytes(), np.cumsum(kept.sum(1) * 4).tolist()
    return [tokens[i:j] for i, j in zip([0, *ends], ends)]


def folded(words: list[str], ranks: dict[bytes, int], numbered: tuple | None) -> dict[str, bytes]:
    """The tokens of each word as 32-bit numbers; short words by `fold_many`, `AT_ONCE` of about the same length at a time."""
    found, short = {}, []
    for w in words:
        piece = w.encode()
        if numbered and 0 < len(piece) <= SHORT and piece not in ranks:
            short.append((len(piece), piece, w))
        else:
            found[w] = array("i", fold_numbers(piece, ranks, *numbered[0]) if numbered else fold(piece, ranks)).tobytes()
    short.sort()
    for part in batched(short, AT_ONCE):
        found.update(zip([w for _, _, w in part], fold_many([piece for _, piece, _ in part], numbered[0][0], *numbered[1])))
    return found


def runs(texts: Iterable[pa.Scalar], pattern: str) -> Iterator[list[tuple[int, Sequence[str]]]]:
    """The words of the texts in order, as lists of (place of the text, some of its words) with about `RUN` words in each."""
    compiled, run, size = regex.compile(pattern), [], 0
    for i, text in enumerate(texts):
        text = text.as_py() or ""
        parts = [compiled.findall(text)] if len(text) <= RUN else batched((m[0] for m in compiled.finditer(text)), RUN)
        for words in parts:
            run.append((i, words))
            size += len(words)
            if size >= RUN:
                yield run
                run, size = [], 0
    yield run


def encode_batches(batches: Iterator[pa.RecordBatch], ranks: dict[bytes, int], numbered: tuple | None, pattern: str,
                   most_words: int) -> Iterator[pa.RecordBatch]:
    """Batches of doc_id and text as batches of doc_id and ids.

    Beside a batch and its tokens, memory holds the words of a run, and the tokens of at most twice `most_words` and a run's words.
    """
    known, older = {}, {}
    for batch in batches:
        tokens, sizes = bytearray(), np.zeros(batch.num_rows + 1, np.int32)
        for run in runs(batch.column(1), pattern):
            if len(known) > most_words:
                known, older = {}, known
            new = {w for _, words in run for w in words if w not in known}
            known.update((w, older[w]) for w in new if w in older)
            known.update(folded([w for w in new if w not in older], ranks, numbered))
            for i, words in run:
                own = b"".join(map(known.__getitem__, words))
                tokens += own
                sizes[i + 1] += len(own) // 4
        ends = np.cumsum(sizes, dtype=np.int32)
        ids = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(tokens)])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), ids)], ["doc_id", "ids"])


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", most_words: int = 50_000) -> DataFrame:
    """(doc_id, ids): the tokens of each row's whole text, as array<int>.

    `pattern` cuts a text into words, each encoded apart, without special tokens. A task remembers words it has
    folded, and beyond `most_words` of them only those that come again. Nothing is
    shuffled, and the rank map is as long as the vocabulary. Null and empty texts have no tokens; null doc_ids
    stay; repeated rows get equal tokens; other columns of `docs` are not looked at. An empty table gives an
    empty one.
    """
    bounded_batches(docs.sparkSession)
    single = [ranks.get(bytes([b]), -1) for b in range(256)]
    numbered = None                                                  # without a token for each byte, words are folded on byte strings
    if min(single) >= 0:
        base, pairs = pair_ranks(ranks)
        numbered = ((base, pairs, single), pair_arrays(base, pairs, single)) if pairs else None
    shared = docs.sparkSession.sparkContext.broadcast((ranks, numbered))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return encode_batches(batches, *shared.value, pattern, most_words)

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.col(text).alias("text"))
    d = rows.mapInArrow(work, "doc_id long, ids array<int>")
    return d.select(F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "ids")


def decode(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes of a list of tokens."""
    pieces = [""] * (max(ranks.values(), default=0) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece.hex()
    literal = F.split(F.lit(",".join(pieces)), ",")
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.element_at(literal, i + 1)), ""))
