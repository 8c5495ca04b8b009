"""Line-first cleaning of documents.

Every line is judged by rules of its own: it has to hold the end of a sentence, must not be a row of
menu entries, must not be known boilerplate and must not be mostly one repeated word. Failing
lines go, and a document that loses too much of its text goes with them. All of it is built from
SQL functions on one row, so there is no shuffle and no Python on the way.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, aside, let, restored

#: Fixed values of the base signals.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules, and the share of text a document has to keep."""

    ending: str = r"[.!?…。！？][\"'”’»)\]]*(?:[\x20\x09-\x0D]|\z)"
    separators: str = r"(?<![^\x20\x09-\x0D])[|>»›•·/](?![^\x20\x09-\x0D])"
    boilerplate: str = (r"(?i)(all rights reserved|terms of (use|service)|privacy policy|cookie (policy|settings)|"
                        r"enable javascript|lorem ipsum|click here|subscribe to our|skip to (main )?content|"
                        r"sign (in|up) to)")
    most_separators: float = 0.15     # separators standing alone, per word
    most_symbols: float = 0.20        # symbol characters per word
    most_shouts: float = 0.20         # runs of two or more ! or ? per word
    least_distinct: float = 0.15      # distinct words per word, for lines of 20 words or more
    least_kept: float = 0.50          # share of non-blank characters a document has to keep


DEFAULT = LineRules()


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _visible(text: Column) -> Column:
    """Code points outside white space."""
    return F.char_length(F.translate(text, " \t\n\x0b\f\r", ""))


def line_fault(line: Column, rules: LineRules = DEFAULT) -> Column:
    """The first rule a line breaks, or null: `punctuation`, `navigation`, `boilerplate`, `repetition`."""
    def judge(words):
        n = F.size(words)
        bare = F.translate(line, SYMBOLS, "")
        return (F.when(n == 0, None)
                .when(~line.rlike(rules.ending), "punctuation")
                .when(F.size(F.regexp_extract_all(line, F.lit(rules.separators), F.lit(0))) > rules.most_separators * n,
                      "navigation")
                .when(F.char_length(line) - F.char_length(bare) > rules.most_symbols * n, "punctuation")
                .when(F.size(F.regexp_extract_all(line, F.lit("[!?]{2,}"), F.lit(0))) > rules.most_shouts * n, "punctuation")
                .when(line.rlike(rules.boilerplate), "boilerplate")
                .when((n >= 20) & (F.size(F.array_distinct(words)) < rules.least_distinct * n), "repetition"))

    return let(_words(line), judge)


def clean_lines(lines: Column, rules: LineRules = DEFAULT) -> Column:
    """The lines without a fault; blank lines stay."""
    return F.filter(lines, lambda x: line_fault(x, rules).isNull())


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window of `window` words found twice or more in the text, the first included.

    Windows are compared by a 64-bit hash. Most texts repeat none, and one distinct count tells;
    only the others sort their windows to find the places.
    """
    def places(hashes):
        def starts(s):
            last = F.size(s) - 1
            same = lambda k, x: F.element_at(s, k)["h"] == x["h"]
            return F.array_sort(F.transform(
                F.filter(s, lambda x, k: F.when(k > 0, same(k, x)).otherwise(F.lit(False))
                         | F.when(k < last, same(k + 2, x)).otherwise(F.lit(False))), lambda x: x["i"]))

        found = let(F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), starts)
        return F.aggregate(
            found, F.struct(F.lit(0).cast("long").alias("c"), F.lit(-window).alias("last")),
            lambda a, p: F.struct((a["c"] + F.least(F.lit(window), p - a["last"])).alias("c"), p.alias("last")))["c"]

    def windows(w):
        n = F.size(w)
        return F.when(n <= window, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(1), n - window + 1), lambda i: F.xxhash64(F.slice(w, i, window))))

    return let(let(words, windows), lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(places(h)))


def judge(docs: DataFrame, rules: LineRules = DEFAULT, text: str = "text") -> DataFrame:
    """`docs` with the signals, the verdict and the cleaned text.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed,
    n_lines_removed (long), kept_share (double), kept (boolean) and clean_text (string). A column of
    `docs` with one of these names is replaced. A null text has no words, fails the base test and
    has a null clean_text; an empty or blank one fails too. Rows are judged one by one, so repeated
    rows get equal verdicts, and an empty table gives an empty one.
    """
    own = ["_text", "_words", "_lines", "_clean"]
    docs, moved = aside(docs, own)
    text = moved.get(text, text)
    raw = F.coalesce(F.col(text), F.lit(""))
    d = docs.withColumn("_text", raw)
    d = d.withColumn("_words", _words(F.col("_text"))).withColumn("_lines", F.split(F.col("_text"), "\n"))
    d = d.withColumn("_clean", clean_lines(F.col("_lines"), rules))
    n, c = F.size("_words"), F.col("_text")
    full = F.filter("_lines", lambda x: x.rlike(WORD))
    d = (d.withColumn("n_words", n.cast("long"))
         .withColumn("word_chars", _visible(c).cast("long"))
         .withColumn("n_symbols", (F.char_length(c) - F.char_length(F.translate(c, SYMBOLS, ""))).cast("long"))
         .withColumn("n_dup_lines", let(full, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")))
         .withColumn("n_repeat_words", repeated_words(F.col("_words")))
         .withColumn("clean_text", F.when(F.col(text).isNotNull(), F.array_join("_clean", "\n")))
         .withColumn("n_lines_removed", (F.size("_lines") - F.size("_clean")).cast("long")))
    d = (d.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS)
                      | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")))
         .withColumn("kept_share", F.when(F.col("word_chars") > 0,
                                          F.coalesce(_visible(F.col("clean_text")), F.lit(0)) / F.col("word_chars"))
                     .otherwise(0.0)))
    d = d.withColumn("kept", ~F.col("base_failed") & (F.col("kept_share") >= rules.least_kept))
    return restored(d.drop(*own), moved)
