"""Language-model scores from an n-gram trie in Elias-Fano levels.

The model is a bigram model with a Dirichlet prior: p(w|u) = (c(uw) + m p(w)) / (c(u) + m), where p(w) is
the add-one word probability. Counts cover all training texts.

Texts are packed into blocks. A block asks once about each of its words and word pairs, and the counts
it adds travel with the question. Words, and pairs by their first word, are dealt over shards; pairs of a
frequent first word are dealt over several, in proportion to its count. A shard sums the counts, builds
its levels (contexts, pointers and successors as Elias-Fano sequences, probabilities as 8-bit codes), maps
them into memory from a file, and answers by searching the successor within the range of its context.
"""
from __future__ import annotations

import os
import tempfile
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import in_blocks, squeeze, unsqueeze
from .common import NO_ID, stored
from .elias_fano import EliasFano
from .hashing import mixed, word_hashes

#: The token after the last word of a text, which is also the context of the first one.
END = mixed(np.zeros(1, np.uint64), 99)[0]
#: Bits of a successor's number within its context.
BITS = 40


@dataclass(frozen=True)
class Settings:
    """`shard_tokens` bounds what a shard gets: its share of the corpus, rounded to a power of two of shards."""

    folds: int = 7
    held_out: int = 2
    prior: float = 8.0
    shard_tokens: int = 2_000_000
    block_chars: int = 12_000_000
    decades: float = 10.0         # range of the coded probabilities


DEFAULT = Settings()


def is_training(doc_id, s: Settings) -> bool:
    """A null doc_id is neither learned from nor held out."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % s.folds != s.held_out


def code_of(share: np.ndarray, s: Settings) -> np.ndarray:
    """8-bit code of a probability above 0: 1 is the highest, 255 stands for all below the range."""
    return np.clip(np.rint(-np.log10(share) * (254 / s.decades)), 0, 254).astype(np.uint8) + np.uint8(1)


def share_of(code: np.ndarray, s: Settings) -> np.ndarray:
    return np.where(code > 0, 10.0 ** (-(code.astype(np.float64) - 1) * (s.decades / 254)), 0.0)


class Level:
    """One trie level: the successors of every context, and a code for each."""

    def __init__(self, contexts: np.ndarray, owner: np.ndarray, successor: np.ndarray, code: np.ndarray, folder: str | None = None):
        """`contexts` rise; `owner` (place of the context) and `successor` rise together."""
        ends = np.searchsorted(owner, np.arange(len(contexts) + 1))
        parts = []
        packs = [EliasFano.pack(contexts >> np.uint64(1), 1 << 63), EliasFano.pack(ends, len(owner) + 1),
                 EliasFano.pack(owner.astype(np.uint64) << np.uint64(BITS) | successor, max(1, len(contexts)) << BITS)]
        # one file, mapped and then unlinked: the pages go when the level does
        with tempfile.NamedTemporaryFile(dir=folder) as f:
            spots = []
            for _, _, low, high in packs:
                for a in (low, high):
                    spots.append((f.tell() // 8, len(a)))
                    f.write(a.astype("<u8").tobytes())
            at = f.tell()
            f.write(code.tobytes() + b"\0" * 8)
            f.flush()
            size = os.path.getsize(f.name)
            raw = np.memmap(f.name, np.uint8, "r", shape=(size,))
        words = raw[:at].view("<u8")
        for k, (n, low, _, _) in enumerate(packs):
            (a, x), (b, y) = spots[2 * k], spots[2 * k + 1]
            parts.append(EliasFano(n, low, words[a:a + x], words[b:b + y]))
        self.contexts, self.pointers, self.successors = parts
        self.codes, self.bytes = raw[at:at + len(code)], size

    def find(self, context: np.ndarray, successor: np.ndarray, runs: np.ndarray) -> np.ndarray:
        """Codes (0: unseen) of pairs: context k comes with the next runs[k] successors."""
        sought = context >> np.uint64(1)
        place = self.contexts.successor(sought)
        known = place < self.contexts.n
        known[known] = self.contexts.get(place[known]) == sought[known]
        first, last = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        first[known] = self.pointers.get(place[known]).astype(np.int64)
        last[known] = self.pointers.get(place[known] + 1).astype(np.int64)
        row = np.repeat(np.arange(len(place)), runs)
        out, some = np.zeros(len(successor), np.uint8), np.flatnonzero(known[row])
        key = place[row[some]].astype(np.uint64) << np.uint64(BITS) | successor[some]
        at = self.successors.successor(key)
        inside = (at >= first[row[some]]) & (at < last[row[some]])
        some, at, key = some[inside], at[inside], key[inside]
        same = self.successors.get(at) == key
        out[some[same]] = self.codes[at[same]]
        return out


def _narrow(x: np.ndarray) -> bytes:
    """Numbers below 2**40 as 5 bytes each."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _wide(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def _packer(s: Settings):
    def pack(ids: list, texts: list) -> dict:
        tokens = [np.concatenate((word_hashes(t, fold_ascii=True), [END])) for t in texts]
        words, place = np.unique(np.concatenate(tokens), return_inverse=True)
        return {"ids": ids, "lens": [len(t) for t in tokens], "words": words.tobytes(), "packed": squeeze(place)}
    return pack


def _opened(block: pd.Series, s: Settings):
    """ids, first token of each text, words, place of every token's word, and whether the token trains."""
    ids = [None if i == NO_ID else int(i) for i in block["ids"]]
    lens = np.asarray(block["lens"], np.int64)
    words, place = np.frombuffer(block["words"], np.uint64), unsqueeze(block["packed"]).astype(np.int64)
    train = np.repeat(np.array([is_training(i, s) for i in ids], bool), lens)
    return ids, np.cumsum(lens) - lens, lens, words, place, train


def _pairs(starts: np.ndarray, words: np.ndarray, place: np.ndarray, train: np.ndarray, counts: np.ndarray, shards: int, share: float):
    """Distinct pairs of a block by shard: context and successor places, training count, shard; and each token's pair."""
    before = np.empty_like(place)
    before[1:] = place[:-1]
    before[starts] = int(np.searchsorted(words, END))
    pairs, at = np.unique(before.astype(np.uint64) << np.uint64(32) | place.astype(np.uint64), return_inverse=True)
    n = np.bincount(at[train], minlength=len(pairs))
    context, successor = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(2 ** 32 - 1)).astype(np.int64)
    parts = np.ceil(counts[context] / share).astype(np.uint64)
    spread = mixed(words[successor], 3) % np.maximum(parts, np.uint64(1))
    shard = ((mixed(words[context], 4) + mixed(spread, 5)) % np.uint64(shards)).astype(np.int64)
    return context, successor, n, shard, at


def score(docs: DataFrame, s: Settings = DEFAULT, text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens (long), base_score, score (double) for each row.

    Tokens are the words with A-Z lowered, and one end. base_score is the add-one word model, score the bigram
    model; both are log10 and learned from rows whose crc32(doc_id) mod `folds` is not `held_out`. Words are told
    apart by 64-bit hashes. A null text counts as empty, so it has its end alone; a row with a null doc_id is
    scored, but neither learned from nor held out; repeated rows each count. An empty table gives an empty one.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.col(text).alias("text"))
    blocks = stored(in_blocks(rows, _packer(s), "ids array<long>, lens array<int>, words binary, packed binary", block_chars=s.block_chars), "lm")
    tokens = blocks.select(F.sum(F.aggregate("lens", F.expr("0L"), lambda a, x: a + x))).first()[0] or 0
    shards = 1 << max(0, int(np.ceil(np.log2(max(tokens, 1) / s.shard_tokens))))

    def ask_words(batches):
        for batch in batches:
            for _, b in batch.iterrows():
                _, _, _, words, place, train = _opened(b, s)
                counts = np.bincount(place[train], minlength=len(words))
                cuts = np.searchsorted(words >> np.uint64(32), np.arange(shards + 1, dtype=np.uint64) * np.uint64(2 ** 32 // shards))
                yield pd.DataFrame([(b["block"], k, words[x:y].tobytes(), squeeze(counts[x:y])) for k, (x, y) in
                                    enumerate(zip(cuts, cuts[1:])) if y > x], columns=["block", "shard", "words", "counts"])

    def sum_words(key: tuple, asked: pd.DataFrame) -> pd.DataFrame:
        lists = [np.frombuffer(x, np.uint64) for x in asked["words"]]
        found, at = np.unique(np.concatenate(lists), return_inverse=True)
        counts = np.bincount(at, weights=np.concatenate([unsqueeze(x) for x in asked["counts"]]), minlength=len(found)).astype(np.int64)
        ends = np.cumsum([0] + [len(x) for x in lists])
        out = pd.DataFrame({"block": asked["block"], "shard": asked["shard"], "kind": 0, "answer": [
            counts[at[a:b]].astype("<i8").tobytes() for a, b in zip(ends, ends[1:])]})
        total = np.array([(counts > 0).sum(), counts.sum()], "<i8").tobytes()
        return pd.concat([out, pd.DataFrame({"block": [-1], "shard": [key[0]], "kind": [0], "answer": [total]})])

    answer = "block long, shard int, kind int, answer binary"
    lean = blocks.select("block", "ids", "lens", "words", "packed")
    unigrams = stored(lean.mapInPandas(ask_words, "block long, shard int, words binary, counts binary")
                      .groupBy("shard").applyInPandas(sum_words, answer), "words")
    size, train_tokens = 0, 0
    for r in unigrams.filter("block = -1").select("answer").toLocalIterator():      # two numbers for each shard
        v, n = np.frombuffer(r["answer"], "<i8")
        size, train_tokens = size + int(v), train_tokens + int(n)
    unigrams = unigrams.filter("block <> -1")
    share = max(1.0, tokens / shards / 8)

    def counts_of(answers: pd.DataFrame) -> np.ndarray:
        mine = answers[answers["kind"] == 0].sort_values("shard")
        return np.concatenate([np.frombuffer(x, "<i8") for x in mine["answer"]])

    def ask_pairs(key: tuple, block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, b in block.iterrows():
            _, starts, _, words, place, train = _opened(b, s)
            counts = counts_of(answers)
            context, successor, n, shard, _ = _pairs(starts, words, place, train, counts, shards, share)
            numbers = mixed(words, 6) & np.uint64((1 << BITS) - 1)
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            for k, (x, y) in enumerate(zip(cuts, cuts[1:])):
                if y > x:
                    mine = order[x:y]
                    first = np.flatnonzero(np.diff(context[mine], prepend=-1))
                    runs = np.diff(np.append(first, len(mine)))
                    own = context[mine[first]]
                    out.append((b["block"], k, words[own].tobytes(), squeeze(np.minimum(counts[own], 2 ** 32 - 1)), squeeze(runs),
                                _narrow(numbers[successor[mine]]), squeeze(n[mine])))
        return pd.DataFrame(out, columns=["block", "shard", "contexts", "totals", "runs", "successors", "counts"])

    def sum_pairs(key: tuple, asked: pd.DataFrame) -> pd.DataFrame:
        lists = [np.frombuffer(x, np.uint64) for x in asked["contexts"]]
        runs = [unsqueeze(x).astype(np.int64) for x in asked["runs"]]
        every, at = np.unique(np.concatenate(lists), return_inverse=True)
        totals = np.zeros(len(every), np.int64)
        totals[at] = np.concatenate([unsqueeze(x) for x in asked["totals"]])
        successors = [_wide(x) for x in asked["successors"]]
        pair = np.repeat(at, np.concatenate(runs)).astype(np.uint64) << np.uint64(BITS) | np.concatenate(successors)
        pair, back = np.unique(pair, return_inverse=True)
        counts = np.bincount(back, weights=np.concatenate([unsqueeze(x) for x in asked["counts"]]), minlength=len(pair))
        seen = counts > 0
        owner = (pair[seen] >> np.uint64(BITS)).astype(np.int64)
        level = Level(every, owner, pair[seen] & np.uint64((1 << BITS) - 1), code_of(counts[seen] / (totals[owner] + s.prior), s))
        asked_runs = np.bincount((pair >> np.uint64(BITS)).astype(np.int64), minlength=len(every))
        codes = level.find(every, pair & np.uint64((1 << BITS) - 1), asked_runs)[back]
        ends = np.cumsum([0] + [len(x) for x in successors])
        return pd.DataFrame({"block": asked["block"], "shard": asked["shard"], "kind": 1, "answer": [
            zlib.compress(codes[a:b].tobytes(), 1) for a, b in zip(ends, ends[1:])]})

    pairs = (lean.groupBy("block").cogroup(unigrams.groupBy("block")).applyInPandas(
        ask_pairs, "block long, shard int, contexts binary, totals binary, runs binary, successors binary, counts binary")
        .groupBy("shard").applyInPandas(sum_pairs, answer))
    answers = unigrams.select(*[F.col(c).alias(c) for c in unigrams.columns]).union(pairs)

    def scored(key: tuple, block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, b in block.iterrows():
            ids, starts, lens, words, place, train = _opened(b, s)
            counts = counts_of(answers)
            context, _, _, shard, at = _pairs(starts, words, place, train, counts, shards, share)
            codes = np.empty(len(context), np.uint8)
            codes[np.argsort(shard, kind="stable")] = np.concatenate([np.frombuffer(zlib.decompress(x), np.uint8) for x in
                                                                       answers[answers["kind"] == 1].sort_values("shard")["answer"]])
            word = (counts + 1) / (train_tokens + size + 1)
            base = np.log10(word)[place]
            total = counts[context[at]]
            p = np.log10(share_of(codes, s)[at] + s.prior / (total + s.prior) * word[place])
            known = (counts > 0).astype(np.int64)[place]
            out.append(pd.DataFrame({
                "doc_id": pd.array(ids, "Int64"), "held_out": [i is not None and not is_training(i, s) for i in ids], "n_tokens": lens,
                "n_known": np.add.reduceat(known, starts), "train_tokens": train_tokens,
                "base_score": np.add.reduceat(base, starts), "score": np.add.reduceat(p, starts)}))
        return pd.concat(out) if out else pd.DataFrame(columns=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return (lean.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        scored, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))
