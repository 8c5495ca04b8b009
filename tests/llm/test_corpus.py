"""Operators over a corpus: forest, language, Jaccard join, byte BPE, language model."""
import collections
import itertools
import math
import re
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from lettera.llm import byte_bpe, common, forest, jaccard, language, lm
from lettera.llm.components import components
from lettera.llm.elias_fano import EliasFano

DOCS = "doc_id long, text string, lang string, source string, links long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [(1, None), (2, ""), (3, " \n "), (4, "one two"), (5, "Same row here."), (5, "Same row here."), (None, "No id é 中文 here."), (6, "12 34 !!")]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return common.documents(spark, sf_dir)


def odd(spark):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in ODD], DOCS)


@pytest.mark.parametrize("n,universe", [(0, 10), (1, 1), (5, 1000), (1000, 2000), (3000, 2 ** 60), (300, 50)])
def test_elias_fano(n, universe):
    rng = np.random.default_rng(n)
    v = np.sort(rng.integers(0, universe, n, dtype=np.uint64))
    e = EliasFano.of(v, universe)
    at = rng.integers(0, n, 100) if n else np.empty(0, np.int64)
    assert (e.get(at) == v[at]).all()
    q = np.concatenate([rng.integers(0, universe + 1, 200, dtype=np.uint64), v[:100]])
    assert (e.successor(q) == np.searchsorted(v, q)).all()


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (7, 7), (102, 100), (0, 1)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0


def test_forest_recall_and_odd_vectors(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    rows = [(r.vec_id, r.embedding) for r in e.collect()]
    rows += [(10_000 + i, rows[0][1]) for i in range(30)] + [(20_000, None), (20_001, [0.0] * 64), (20_002, [float("nan")] * 64), (20_003, [1.0]), (None, rows[1][1])]
    d = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    got = forest.search(d, d.filter("vec_id % 100 = 0")).collect()
    good = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and len(v) == 64 and np.isfinite(v).all() and any(v)}
    hits = total = 0
    for q in [i for i in good if i % 100 == 0]:
        want = sorted((math.sqrt(((good[q] - v) ** 2).sum()), i) for i, v in good.items() if i != q)[:10]
        mine = sorted((r["rank"], r.score, r.vec_id) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, 11)) and [m[1:] for m in mine] == sorted(m[1:] for m in mine)
        assert all(abs(s - math.sqrt(((good[q] - good[i]) ** 2).sum())) < 1e-9 for _, s, i in mine)
        hits, total = hits + len({w[1] for w in want} & {m[2] for m in mine}), total + 10
    assert hits >= 0.9 * total
    assert forest.search(d.limit(0), d).count() == 0


def test_language_accuracy_and_odd_texts(spark, docs):
    model = language.fit(docs)
    got = language.predict(docs, model).filter(language.held_out(F.col("doc_id"))).select("lang", "lang_pred", "lang_score", "lang_rejected").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.93 * len(got) and all(0 <= r.lang_score <= 1 for r in got)
    assert sum(r.lang_rejected for r in got) <= 0.05 * len(got)
    rows = language.predict(odd(spark), model).collect()
    for r in rows:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) and (r.lang_pred != "und" or r.lang_rejected)
    assert len({tuple(r) for r in rows if r.doc_id == 5}) == 1
    assert language.identify(odd(spark).limit(0)).count() == 0
    text = "Ünïcode wörds and 中文, " * 40
    whole, small = language.counts(text), language.counts(text, language.Settings(chunk=7))
    assert whole[1] == small[1] and (whole[0] == small[0]).all()


def shingles(text):
    w = WORD.findall(text or "")
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def plain_classes(rows):
    sets, links, root = [shingles(t) for _, t in rows], collections.Counter(), list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        x, y = sets[a], sets[b]
        if x and y and min(len(x), len(y)) >= 0.8 * max(len(x), len(y)) and (n := len(x & y)) >= 0.8 * (len(x) + len(y) - n) - 1e-9:
            links.update((a, b))
            p, q = root[a], root[b]
            if p != q:
                root = [min(p, q) if r in (p, q) else r for r in root]
    low = {}
    for i, (doc, _) in enumerate(rows):
        key = -1 if doc is None else doc
        low[root[i]] = min(low.get(root[i], key), key)
    return [(None if low[root[i]] == -1 else low[root[i]], links[i], root[i]) for i in range(len(rows))]


def test_jaccard_join_matches_brute_force(spark, docs):
    base = " ".join(f"w{i}" for i in range(120)).split()
    near = [(5000 + k, " ".join(base[:k * 3] + [f"x{k}"] + base[k * 3 + 1:])) for k in range(30)]
    rows = [(r.doc_id, r.text) for r in docs.collect()] + near + ODD + [(7000, " ".join(base)), (7001, " ".join(base))]
    want = sorted((str(d), *map(str, c[:2])) for (d, _), c in zip(rows, plain_classes(rows)))
    d = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], DOCS)
    for s in (jaccard.DEFAULT, jaccard.Settings(tile=8)):
        got = jaccard.join_documents(d, s).collect()
        assert sorted((str(r.doc_id), str(r.class_id), str(r.n_links)) for r in got) == want
    kept = jaccard.keep_one(d)
    assert kept.columns == d.columns
    assert kept.count() == len({c[2] if shingles(t) else (x, t) for (x, t), c in zip(rows, plain_classes(rows))})
    assert jaccard.join_documents(d.limit(0)).count() == 0


def test_jaccard_join_of_many_texts_with_one_id(spark):
    def near(k, x):
        return " ".join(f"a{k}b{i}" for i in range(60)) + f" {x}"

    rows = [(i, near(k, x)) for i in (None, 5) for k in range(30) for x in ("one", "two", "two")]
    want = sorted((str(d), *map(str, c[:2])) for (d, _), c in zip(rows, plain_classes(rows)))
    d = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], DOCS)
    got = jaccard.join_documents(d).collect()
    assert sorted((str(r.doc_id), str(r.class_id), str(r.n_links)) for r in got) == want
    prints = jaccard.fingerprints(d).filter("set_id is not null")
    member = prints.groupBy("set_id").agg(F.min(F.struct("id", "place")).alias("f")).select("set_id", F.col("f.id").alias("least"), F.col("f.place").alias("place"))
    assert member.count() == 60 and jaccard.first_texts(d, member).groupBy("set_id").count().filter("count > 2").count() == 0


def test_sets_go_to_blocks_they_share_a_band_with(spark):
    keys = [(n, b) for n in range(100) for b in (n, n + 1)]             # a chain: one pool, two partners each
    member = spark.createDataFrame([(n, 100, n) for n in range(100)], "set_id long, blocks int, block int")
    got = {r.set_id: sorted(r.others) for r in jaccard.block_partners(spark.createDataFrame(keys, "set_id long, band long"), member).collect()}
    assert got == {n: [m for m in (n - 1, n + 1) if 0 <= m < 100] for n in range(100)}
    one = spark.createDataFrame([(n, 2, n // 50) for n in range(100)], "set_id long, blocks int, block int")
    got = {r.set_id: sorted(r.others) for r in jaccard.block_partners(spark.createDataFrame(keys, "set_id long, band long"), one).collect()}
    assert got == {n: [0, 1] if n in (49, 50) else [n // 50] for n in range(100)}


def test_bayes_limits_keep_what_reaches_the_threshold():
    limits = jaccard.least_matches()
    assert all(sum(math.comb(n, k) * 0.8 ** k * 0.2 ** (n - k) for k in range(m)) < 1e-5 for n, m in limits.items())
    assert limits[200] > 100


RANKS = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
TRICKY = ["a b　c\n\n d  ", "it's I'm 12.5€ \x1c\x1d x\x85y", "😀😀 ok", "naïve 中文 हिन्दी", "​﻿z", " lead\ttab\r\n", "=" * 300, "long " * 20000]


def test_byte_bpe_equals_the_library(spark, docs):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(9000 + i, t) for i, t in enumerate(TRICKY)] + ODD
    d = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], DOCS)
    got = byte_bpe.encode(d, RANKS, public_tokenizers.PATTERN).withColumn("raw", byte_bpe.decode(F.col("ids"), RANKS)).collect()
    want = sorted((str(i), library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows)
    assert sorted((str(r.doc_id), list(r.ids), bytes(r.raw)) for r in got) == want
    assert byte_bpe.encode(d.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_the_fold_on_numbers_equals_the_one_on_bytes(spark):
    """Also with a vocabulary that has no token for some byte, which stays with the fold on bytes."""
    base, pairs = byte_bpe.pair_ranks(RANKS)
    single = [RANKS[bytes([b])] for b in range(256)]
    words = [w.encode() for t in TRICKY[:6] for w in t.split(" ")] + [" thonerha".encode(), b"a" * 150, b"ab" * 99, bytes(range(256)), b""]
    for w in words:
        assert byte_bpe.fold_numbers(w, RANKS, base, pairs, single) == byte_bpe.fold(w, RANKS)
    few = {b"a": 0, b"b": 1, b"ab": 2, b"aab": 3}
    d = spark.createDataFrame([(1, "aabab"), (2, "b")], "doc_id long, text string")
    assert sorted((r.doc_id, list(r.ids)) for r in byte_bpe.encode(d, few, r"\S+").collect()) == [(1, [3, 2]), (2, [1])]


def numbered():
    base, pairs = byte_bpe.pair_ranks(RANKS)
    single = [RANKS[bytes([b])] for b in range(256)]
    return (base, pairs, single), byte_bpe.pair_arrays(base, pairs, single)


def test_words_folded_together_equal_words_folded_alone():
    rng = np.random.default_rng(3)
    letters = list("aeinorst é中😀\x00\x85")
    words = sorted({"".join(rng.choice(letters, n)) for n in rng.integers(1, 40, 3000)} | {"", "=" * 300, "the", "z" * 32, "z" * 33})
    got = byte_bpe.folded(words, RANKS, numbered())
    assert {w: np.frombuffer(b, np.int32).tolist() for w, b in got.items()} == {w: byte_bpe.fold(w.encode(), RANKS) for w in words}


def test_encoding_remembers_a_bounded_number_of_words(monkeypatch):
    """New words in every text, which once were all remembered with the words of two long batches; the last text is cut bit by bit."""
    rng, pattern = np.random.default_rng(4), public_tokenizers.PATTERN
    texts = [" ".join(map("".join, rng.choice(list("aeinorst"), (500, 9)))) for _ in range(200)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(203)), "text": [*texts, None, "", " ".join(texts[:6])]})
    n = numbered()
    monkeypatch.setattr(byte_bpe, "RUN", 2000)
    tracemalloc.start()
    try:
        got = [b for b in byte_bpe.encode_batches(iter([batch, batch.slice(200), batch.slice(0, 0)]), RANKS, n, pattern, 3000)]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [b.num_rows for b in got] == [203, 3, 0] and peak < 10_000_000
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=RANKS, special_tokens={})
    want = [library.encode_ordinary(t or "") for t in batch.column(1).to_pylist()]
    assert got[0].column(1).to_pylist() == want and got[1].column(1).to_pylist() == want[200:]


def test_the_native_fold_equals_the_other(spark):
    words = sorted({w for t in TRICKY[:6] for w in t.split(" ") if w} | {" thonerha", "éçmentelle", "zzzz", "the"})
    got = byte_bpe.encode_words(spark.createDataFrame([(w,) for w in words], "word string"), RANKS).collect()
    assert all(list(r.ids) == byte_bpe.fold(r.word.encode(), RANKS) for r in got) and len(got) == len(words)


def test_lm_scores_match_plain_code(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()] + ODD
    d = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], DOCS)
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = [WORD.findall((t or "").translate(low)) + [None] for _, t in rows]
    trains = [i is not None and zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows]
    c, pairs = collections.Counter(), collections.Counter()
    for t, yes in zip(tokens, trains):
        if yes:
            c.update(t)
            pairs.update(zip([None] + t[:-1], t))
    n, v = sum(c.values()), len(c)
    p = lambda w: (c[w] + 1) / (n + v + 1)
    want = sorted((str(i), i is not None and not yes, len(t), sum(c[w] > 0 for w in t), sum(math.log10(p(w)) for w in t),
                   sum(math.log10((pairs[u, w] + 8 * p(w)) / (c[u] + 8)) for u, w in zip([None] + t[:-1], t))) for (i, _), t, yes in zip(rows, tokens, trains))
    for s in (lm.DEFAULT, lm.Settings(shard_tokens=5000, block_chars=50_000)):
        got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.base_score, r.score) for r in lm.score(d, s).collect())
        assert len(got) == len(want)
        for g, w in zip(got, want):
            assert g[:4] == w[:4] and g[4] == pytest.approx(w[4], abs=1e-6) and abs(g[5] - w[5]) <= 0.021 * g[2]
    assert lm.score(d.limit(0)).count() == 0
