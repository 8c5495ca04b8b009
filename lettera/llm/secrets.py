"""Secret scans through a trigram inverted index.

Each rule's expression gives a Boolean trigram query. The index holds, for every trigram that some
query asks for, the texts it occurs in. Postings are intersected per rule, and only the texts left
are matched against the expression. Rules without a mandatory trigram are matched against all texts.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import aside, let, restored, stored
from .trigrams import trigram_query


@dataclass(frozen=True)
class Rule:
    """An expression for a kind of secret; a match counts if `group` has `least` characters or more.

    `long` is an expression, where there is one, whose matches are exactly those that count: it finds them without
    walking through all the others.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    long: str | None = None


#: The three base kinds, in the order in which equal starts are listed.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]+", 0, 24, r"[0-9a-f]{24,}"),
)
#: Formats of well-known services.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abpr]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("basic", r"[a-z]+://[A-Za-z0-9._-]+:[A-Za-z0-9._-]{6,}@[A-Za-z0-9.-]+"),
)
RULES = BASE + MORE


def row_key(text: str = "text") -> Column:
    """What postings call a row. Rows that share it share text and doc_id, so also their candidates."""
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col(text))


def postings(docs: DataFrame, trigrams: Sequence[str], text: str = "text") -> DataFrame:
    """The inverted index: (trigram, key), one row for each text that holds a trigram of `trigrams`."""
    d = docs.select(row_key(text).alias("key"), F.lower(F.col(text)).alias("_low")).filter(F.col("_low").isNotNull())
    held = [F.when(F.contains(F.col("_low"), F.lit(t)), F.lit(t)) for t in trigrams]
    return d.select("key", F.explode(F.array_compact(F.array(*held))).alias("trigram")).select("trigram", "key")


def candidates(index: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(key, kinds): the rules whose clauses all have a posting for the text."""
    asked = [(r.kind, n, t) for r in rules for n, clause in enumerate(trigram_query(r.pattern)) for t in sorted(clause)]
    needed = {r.kind: len(trigram_query(r.pattern)) for r in rules}
    clauses = index.sparkSession.createDataFrame(asked, "kind string, clause int, trigram string")
    hits = index.join(F.broadcast(clauses), "trigram").groupBy("key", "kind").agg(F.collect_set("clause").alias("c"))
    goal = F.create_map(*[x for k, n in needed.items() for x in (F.lit(k), F.lit(n))])
    return hits.filter(F.size("c") == goal[F.col("kind")]).groupBy("key").agg(F.collect_set("kind").alias("kinds"))


#: Matches whose places are summed one by one; longer lists are cut into runs of so many, which are summed first.
RUN = 256


def _before(sizes: Column) -> Column:
    """For each of an array of numbers the sum of those before it, with two levels of sums: appending copies an array."""
    def walk(run, start):
        return F.aggregate(run, F.struct(start.alias("at"), F.array().cast("array<bigint>").alias("out")), lambda a, n: F.struct(
            (a["at"] + n).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")))["out"]

    def joined(runs):
        totals = F.transform(runs, lambda r: F.aggregate(r, F.lit(0).cast("bigint"), lambda a, n: a + n))
        return F.flatten(F.zip_with(runs, walk(totals, F.lit(0).cast("bigint")), walk))

    def cut(all_):
        places = F.sequence(F.lit(0), F.call_function("div", F.size(all_) - 1, F.lit(RUN)).cast("int"))
        return let(F.transform(places, lambda k: F.slice(all_, k * RUN + 1, RUN)), joined)

    return let(sizes, cut)


def spans(text: Column, rule: Rule, place: int) -> Column:
    """Matches of one rule, leftmost and not overlapping: array of (start, place, kind, stop) in code points."""
    pattern = rule.long or rule.pattern

    def located(found):
        gaps = F.transform(F.slice(F.split(text, pattern, -1), 1, F.size(found)), lambda x: F.char_length(x).cast("bigint"))
        sizes = F.transform(found, lambda x: F.char_length(x).cast("bigint"))
        held = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group)), F.char_length) if rule.group else sizes

        def marked(both):
            starts = F.zip_with(_before(F.zip_with(both["gaps"], both["sizes"], lambda g, n: g + n)), both["gaps"], lambda b, g: (b + g).cast("int"))
            every = F.zip_with(starts, F.zip_with(both["sizes"], both["held"], lambda n, h: F.struct(n.alias("n"), h.alias("h"))), lambda at, x: F.when(
                x["h"] >= rule.least, F.struct(at.alias("start"), F.lit(place).alias("place"), F.lit(rule.kind).alias("kind"),
                                               (at + x["n"].cast("int")).alias("stop"))))
            return F.filter(every, lambda x: x.isNotNull())

        return let(F.struct(gaps.alias("gaps"), sizes.alias("sizes"), held.alias("held")), marked)

    nothing = F.array().cast("array<struct<start:int,place:int,kind:string,stop:int>>")
    # a text without a match that is long enough needs no places
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.when(
        F.exists(m, lambda x: F.char_length(x) >= rule.least), located(m)).otherwise(nothing))


def digest(found: Column) -> Column:
    """kind:start:stop, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """`docs` with `found`: array of (start, place, kind, stop) by start, then by the order of `rules`.

    Ends are exclusive. A null text counts as empty and has no matches; a null doc_id is a value like
    others; repeated rows get equal results; an empty table gives an empty one. A column of `docs`
    named `found` is replaced.
    """
    docs, moved = aside(docs, ["_kinds", "_key", "_low"])
    text = moved.get(text, text)
    names = [c for c in docs.columns if c != "found"]
    asked = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = [r for r in rules if asked[r.kind]]
    vocabulary = sorted({t for q in asked.values() for clause in q for t in clause})
    whole = F.coalesce(F.col(text), F.lit(""))
    d = docs.select(*names).withColumn("_kinds", F.array().cast("array<string>"))
    if indexed:
        index = stored(postings(docs, vocabulary, text), "postings")
        chosen = candidates(index, indexed)
        d = (docs.select(*names).withColumn("_key", row_key(text))
             .join(chosen.select(F.col("key").alias("_key"), F.col("kinds").alias("_kinds")), "_key", "left"))
    none = F.array().cast("array<struct<start:int,place:int,kind:string,stop:int>>")
    parts = []
    for place, rule in enumerate(rules):
        every = spans(whole, rule, place)
        parts.append(F.when(F.array_contains("_kinds", rule.kind), every).otherwise(none) if rule in indexed else every)
    return restored(d.select(*names, F.array_sort(F.concat(*parts)).alias("found")), moved)
