"""Column functions against the small cases of FIXTURES.md §3."""

import datetime as dt

import pytest
import regex
from pyspark.sql import functions as F

from spendlens.functions import (channel_label, clean_string, country_name, fix_campaign_id,
                                 guarded_ratio, normalize_na, null_on_zero_ratio, nullif_blank,
                                 remove_spaced_letters, split_channel, week_start)
from spendlens.functions import derive

CLEAN_CASES = [
    (" P r o s p e c t i n g__x ", "prospecting_x"),
    ("pos   lite", "pos-lite"),
    ("Demand - Gen", "demandgen"),
    ("bing search ch", "bing-search_ch"),
    ("search shopping  es", "search-shopping_es"),
    ("\tab \t- c_", "ab-c"),
    ("demand generic", "demandgeneric"),
    (None, None),
    ("   ", ""),
]
ID_CASES = [
    ("1.20211151098440066e17", "120211151098440066"),
    ("391180926.0", "391180926"),
    ("te5t", None),
    ("abc12", "12"),
    ("  12.000000 ", "12"),
    ("2.5e0", "2"),
    ("1.5E0", "2"),
    ("nan", None),
    ("None", None),
    ("<NA>", None),
    ("", None),
    (None, None),
]


def _eval(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_clean_string_cases(spark):
    got = _eval(spark, [c[0] for c in CLEAN_CASES], clean_string)
    assert got == [c[1] for c in CLEAN_CASES]


def test_clean_string_idempotent(spark):
    words = ["P r o s p e c t i n g", "pos lite", "Demand-Gen", "bing search", "search shopping",
             "_x_", "  a  b ", "landing", "s h o p p i n g", "FB", "demand _ gen"]
    values = [" ".join(words[i:i + 3]) + "__" + words[(i * 7) % len(words)]
              for i in range(len(words))]
    once = _eval(spark, values, clean_string)
    twice = _eval(spark, once, clean_string)
    assert once == twice


def test_fix_campaign_id_cases(spark):
    got = _eval(spark, [c[0] for c in ID_CASES], fix_campaign_id)
    assert got == [c[1] for c in ID_CASES]


def test_remove_spaced_letters_matches_python_regex(spark):
    values = ["p o s lite", "a b c d", "ab c d", "x y", "word a", "é t é"]
    got = _eval(spark, values, remove_spaced_letters)
    pat = regex.compile(r"(?<=\b\p{L})\s+(?=\p{L}\b)")
    assert got == [pat.sub("", v) for v in values]
    assert got[0] == "pos lite"


def test_split_channel(spark):
    df = spark.createDataFrame([("a_b_c_d",), ("a_b_c",), ("a_b",), ("a",), (None,)], "c string")
    c6, c7 = split_channel("c")
    rows = [tuple(r) for r in df.select(c6, c7).collect()]
    assert rows == [("c", "d"), ("b", "c"), ("b", None), (None, None), (None, None)]


def test_week_start_is_tuesday(spark):
    got = _eval(spark, [dt.date(2022, 2, 14), dt.date(2022, 2, 15), dt.date(2022, 2, 20)],
                week_start, "date")
    assert got == [dt.date(2022, 2, 8), dt.date(2022, 2, 15), dt.date(2022, 2, 15)]
    monday = _eval(spark, [dt.date(2022, 2, 16)], lambda c: week_start(c, 1), "date")
    assert monday == [dt.date(2022, 2, 14)]


def test_ratios(spark):
    df = spark.createDataFrame([(1, 0), (None, 4), (6, 3), (6, None)], "n int, d int")
    rows = [tuple(r) for r in df.select(null_on_zero_ratio("n", "d"), guarded_ratio("n", "d"))
            .collect()]
    assert rows == [(None, None), (0.0, 0.0), (2.0, 2.0), (None, None)]


def test_na_and_labels(spark):
    assert _eval(spark, ["NaN", "none", "<na>", "", "Unknown", "x", None], normalize_na) == [
        None, None, None, None, None, "x", None]
    assert _eval(spark, [" a ", "  ", None], nullif_blank) == ["a", None, None]
    assert _eval(spark, ["fb", "demandgen", None], channel_label) == [
        "Facebook", "Unknown", "Unknown"]
    assert _eval(spark, ["GB", "ie", None], country_name) == ["United Kingdom", "Unknown",
                                                              "Unknown"]
    assert _eval(spark, ["my_TEST_x", "abc", None], derive.test_flag) == [True, False, False]


@pytest.mark.parametrize("values,expected", [(["b", "a", "b", "a", None], "a"),
                                             (["c", None, None], "c"), ([None], None)])
def test_mode_ties_to_smallest(spark, values, expected):
    from spendlens.operators.aggregates import mode_non_null
    df = spark.createDataFrame([("k", v) for v in values], "k string, v string")
    assert df.groupBy("k").agg(mode_non_null("v")).first()[1] == expected
