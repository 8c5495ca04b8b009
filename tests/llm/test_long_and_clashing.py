"""Texts that are long or hard on an expression, and tables whose columns have the names the operators use inside."""
import time

import pytest
from pyspark.sql import functions as F

from lettera.llm import jaccard, language, licenses, mixture, pseudonyms, quality, secrets

CLASHES = ["_text", "_found", "_new", "__found", "_size", "_rate", "_before", "_key", "_part", "_source", "_inside", "_kinds", "_dir", "_words", "_lines",
           "_clean", "_id", "_place", "_copy", "_given", "_score", "_own", "_n", "_from", "_low", "_target", "_repeats"]
TEXTS = ["Write to ann.lee@example.com now. " + "Some more words of it here. " * 8, "password = 'abcdef12' is licensed under the MIT License.", None, "", "Plain words only."]


def docs(spark, texts, extra=()):
    rows = [(k, t, "en", "s", f"d/{k}") for k, t in enumerate(texts)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, path string")
    return d.select("*", *[F.concat(F.lit(f"own {c} "), F.col("doc_id").cast("string")).alias(c) for c in extra])


OPERATORS = {
    "quality": quality.judge, "secrets": secrets.scan, "pseudonyms": lambda d: pseudonyms.pseudonymize(d, "k"), "licenses": licenses.scan,
    "mixture": mixture.mix, "take": mixture.take, "language": language.identify, "keep_one": jaccard.keep_one}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_columns_of_the_caller_come_back_unchanged(spark, name):
    plain, more = docs(spark, TEXTS), docs(spark, TEXTS, CLASHES)
    want, got = OPERATORS[name](plain), OPERATORS[name](more)
    assert sorted(got.columns) == sorted([*want.columns, *CLASHES])
    rows = lambda d: sorted(str(r) for r in d.select(*want.columns).collect())
    assert rows(got) == rows(want)
    for r in got.select("doc_id", *CLASHES).collect():
        assert all(r[c] == f"own {c} {r.doc_id}" for c in CLASHES)


HARD = ["x@" + "a." * 2500 + "com", "x@" + "a." * 500_000 + "com", "copyright " + "a-" * 2500 + "b", "copyright " + "a-" * 500_000 + "b", "a" * 1_000_000 + "@b.com",
        "1-" * 500_000, "0" * 1_000_000, "+1 " + "22 " * 300_000, "GB82 " + "WEST " * 200_000, "(" * 200_000, "-----BEGIN " + "A " * 400_000]


@pytest.mark.parametrize("name", ["quality", "secrets", "pseudonyms", "licenses"])
def test_hard_texts_end_and_stay(spark, name):
    got = OPERATORS[name](docs(spark, HARD)).select("doc_id", F.char_length("text").alias("n")).collect()
    assert {r.doc_id: r.n for r in got if r.doc_id != 4 or name != "pseudonyms"}.items() >= {
        k: len(t) for k, t in enumerate(HARD) if k != 4}.items()


def test_a_secret_in_a_long_text_is_found_in_time(spark):
    prose = "the cafe faced a bad decade and added a facade " * 42_000
    many = "token=abcdefg, " * 60_000
    texts = [prose + "0123456789abcdef0123456789abcdef end", many, "token=ab " * 60_000 + "token=abcdef"]
    start = time.time()
    got = {r.doc_id: r.found for r in secrets.scan(docs(spark, texts)).select("doc_id", "found").collect()}
    assert time.time() - start < 60
    assert [(s.kind, s.start, s.stop) for s in got[0]] == [("hex", len(prose), len(prose) + 32)]
    assert [(s.start, s.stop) for s in got[1]] == [(15 * k, 15 * k + 14 - 1) for k in range(60_000)]
    assert [(s.start, s.stop) for s in got[2]] == [(540_000, 540_012)]


def test_domains_end_where_they_did(spark):
    text = "Mail ann@example.com. Next bob@mail.example.co.uk, c@d..e.com f@g.1 or h@i.org.2"
    new = pseudonyms.pseudonymize(docs(spark, [text]), "k").first().text
    assert "ann@" not in new and "bob@" not in new and "c@d..e.com" in new and "f@g.1" in new and "h@i" not in new and new.endswith(".2")


def test_a_language_of_one_id_or_one_text_is_learned(spark):
    s = language.Settings(sample=50)
    rows = [(training, f"uma frase em português número {k} com palavras", "pt") for k in range(4000) for training in (8,)]
    rows += [(1000 + k, f"this is an english sentence number {k} with words", "en") for k in range(300)] + [(9, "sempre o mesmo texto aqui", "xx")] * 4000
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for doc_id in (8, 9, 12):
        moved = d.withColumn("doc_id", F.when(F.col("lang") == "pt", doc_id).otherwise(F.col("doc_id")))
        n = {r.lang: r.n for r in language.training_rows(moved, s).groupBy("lang").agg(F.count("*").alias("n")).collect()}
        held = moved.filter(language.held_out(F.col("doc_id"))).select("lang").distinct().count()
        assert n.keys() >= {"en"} and all(v <= 50 for v in n.values()) and ("pt" in n or held) and n.get("pt", 30) >= 20 and n.get("xx", 1) == 1


def test_reruns_of_the_mix_agree_where_ids_are_null(spark):
    rows = [(None, f"text {k} of two", "a" if k % 3 else "b") for k in range(400)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = [sorted(r.text for r in mixture.take(d.repartition(n)).collect()) for n in (1, 3, 7)]
    assert taken[0] == taken[1] == taken[2]
