import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from lettera.functions import exprs as X


def column(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def test_bands_are_right_closed_with_lowest_included(spark):
    d = column(spark, [0.0, 25.0, 25.1, 100.0, -1.0, None, 101.0])
    got = [r[0] for r in d.select(X.band("v", [0, 25, 50, 75, 100], list("abcd"))).collect()]
    assert got == ["a", "a", "b", "d", None, None, None]


def test_histogram_is_left_closed_with_last_bin_closed(spark):
    d = column(spark, [0.0, 9.99, 10.0, 25.0, 100.0, None])
    got = [r[0] for r in d.select(X.histogram_bin("v", 0, 10, 10)).collect()]
    assert got == [0, 0, 1, 2, 9, None]


def test_clip_keeps_missing(spark):
    got = [r[0] for r in column(spark, [99.0, 101.0, None]).select(X.clip_upper("v", 100)).collect()]
    assert got == [99.0, 100.0, None]


def test_nan_is_missing_and_zero_division_is_missing(spark):
    d = column(spark, [float("nan"), None, 0.0])
    assert [r[0] for r in d.select(X.nan_to_null("v")).collect()] == [None, None, 0.0]
    assert [r[0] for r in d.select(X.ratio(F.lit(1), X.nan_to_null("v"))).collect()] == [None] * 3


def test_hash_number_is_plain_md5(spark):
    got = column(spark, [123], "int").select(X.hash_number("v", 42)).first()[0]
    assert got == int(hashlib.md5(b"123|42").hexdigest()[:8], 16)


def test_missing_label_counts_as_zero(spark):
    got = [r[0] for r in column(spark, ["1", "0", None], "string").select(X.is_label_one("v")).collect()]
    assert got == [1, 0, 0]


def test_value_bucket_never_decreases(spark):
    rng = random.Random(1)
    values = [0.0, -0.0, 1e-300, -1e-300, 1e300, -1e300, 1.0, 2.0, 4.0, math.nextafter(2.0, 0)]
    values += [rng.uniform(-100, 100) for _ in range(2000)] + [rng.expovariate(1e-6) for _ in range(500)]
    rows = column(spark, sorted(values)).select("v", X.value_bucket("v").alias("b")).collect()
    rows = sorted(rows, key=lambda r: r.v)
    assert all(a.b <= b.b for a, b in zip(rows, rows[1:]))
    assert len({r.b for r in rows}) > 1000


def test_key_that_passed_through_a_float(spark):
    got = [r[0] for r in column(spark, ["1100015.0", "1100015", "110.0150"], "string").select(X.clean_key("v")).collect()]
    assert got == ["1100015", "1100015", "110.0150"]


def test_unknown_code_becomes_missing(spark):
    got = [r[0] for r in column(spark, ["2", "3", "9", None], "string")
           .select(X.recode("v", {"2": "Estadual", "3": "Municipal"})).collect()]
    assert got == ["Estadual", "Municipal", None, None]


@pytest.mark.parametrize("value,want", [(24.999, "a"), (25.0, "a"), (50.0, "b")])
def test_infinite_edges(spark, value, want):
    inf = float("inf")
    assert column(spark, [value]).select(X.band("v", [-inf, 25, inf], ["a", "b"])).first()[0] == want
