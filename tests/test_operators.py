"""Operators on small hand-made frames, checked against plain-Python answers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from spendlens.operators import aggregates as A
from spendlens.operators import dims as D
from spendlens.operators import joins as J
from spendlens.operators import quality as Q
from spendlens.operators import reshape as R
from spendlens.operators import setops as U
from spendlens.operators import windows as W
from spendlens.plans import impute as I
from spendlens.plans.incremental import merge_by_key, sync_columns

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_dedupe_dim_null_key_is_one_group(spark):
    df = spark.createDataFrame([("1", "b"), ("1", "a"), (None, "z"), (None, "y"), ("2", None)],
                               "k string, c string")
    assert rows(D.dedupe_dim(df, "k", ["c"]), "k") == [(None, "y"), ("1", "a"), ("2", None)]


def test_first_last_non_null_in_order(spark):
    df = spark.createDataFrame([("k", None, 1), ("k", "x", 2), ("k", "y", 3), ("j", None, 1)],
                               "k string, v string, o int")
    assert rows(D.first_non_null(df, "k", ["v"], ["o"]), "k") == [("j", None), ("k", "x")]
    assert rows(D.last_non_null(df, "k", ["v"], ["o"]), "k") == [("j", None), ("k", "y")]


def test_repair_channels_only_listed_ids(spark):
    df = spark.createDataFrame([("1", "fb", None), ("1", "unknown", "p"), ("2", None, None),
                                ("2", "x", "q")], "id string, c3 string, c4 string")
    out = D.repair_channels(df, "id", ["c3", "c4"], ids=["1"], fill=True)
    assert rows(out, "id", "c3", "c4") == [("1", "fb", "p"), ("1", "fb", "p"),
                                           ("2", "unknown", "unknown"), ("2", "x", "q")]


def test_combine_funnels_never_pairs_and_keeps_unmatched(spark):
    web = spark.createDataFrame(
        [(D1, "1", "GB", 5, 10), (D1, "1", "GB", 7, 20), (D1, None, "GB", 1, 1),
         (D1, None, "GB", 1, 1), (D2, "2", None, 3, 3)],
        "date date, campaign_id string, country_code string, total_spend_eur int, s int")
    leads = spark.createDataFrame(
        [(D1, "1", "GB", 9, 100), (D2, "2", None, 4, 40), (D2, "3", "ES", 2, 2)],
        "date date, campaign_id string, country_code string, total_spend int, i int")
    out = J.combine_funnels(web, leads)
    got = rows(out, "date", "campaign_id", "country_code", "s")
    assert got == [(D1, None, "GB", 1, 1, None, None), (D1, None, "GB", 1, 1, None, None),
                   (D1, "1", "GB", 7, 20, 9, 100), (D2, "2", None, 3, 3, 4, 40),
                   (D2, "3", "ES", None, None, 2, 2)]
    best = J.combine_funnels(web, leads, unmatched="best")
    assert best.where(F.col("campaign_id").isNull()).count() == 1


def test_attach_and_fill(spark):
    facts = spark.createDataFrame([("1", None), ("2", "b"), (None, None)], "k string, v string")
    ref = spark.createDataFrame([("1", "a"), ("2", "z")], "k string, v string")
    assert rows(J.fill_from_reference(facts, ref, "k", ["v"]), "k") == [
        (None, None), ("1", "a"), ("2", "b")]
    assert rows(J.update_from_lookup(facts, ref, "k", ["v"]), "k") == [
        (None, None), ("1", "a"), ("2", "z")]
    dim = spark.createDataFrame([(None, "n"), ("1", "one")], "k string, name string")
    assert rows(J.attach_dim(facts, dim, "k", null_safe=True), "k") == [
        (None, None, "n"), ("1", None, "one"), ("2", "b", None)]


def test_broadcast_if_small_respects_bound(spark):
    df = spark.range(10)
    small = J.broadcast_if_small(df, max_rows=10)
    big = J.broadcast_if_small(df, max_rows=9)
    plan_small = small.join(spark.range(100), "id")._jdf.queryExecution().analyzed().toString()
    plan_big = big.join(spark.range(100), "id")._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan_small.lower() and "broadcast" not in plan_big.lower()


def test_overlap_and_common(spark):
    a = spark.createDataFrame([("1", D1), ("2", D1), (None, D1)], "k string, d date")
    b = spark.createDataFrame([("1", D1), ("1", D1), ("2", D2)], "k string, d date")
    assert rows(J.restrict_to_overlap(a, b, ["k", "d"])) == [("1", D1)]
    assert rows(U.common_ids(a, b, "k"), "k") == [("1",), ("2",)]
    assert rows(J.missing_in_dim(a, b.where("k = '1'"), "k")) == [("2", D1)]


def test_mode_reference_and_maps(spark):
    a = spark.createDataFrame([("1", "n1", "GB"), ("1", "n1", "ES"), ("1", None, "ES"),
                               (None, "n9", "IE")], "campaign_id string, campaign_name string, country_code string")
    b = spark.createDataFrame([("1", "n1"), ("2", "n2"), ("3", "n2")],
                              "campaign_id string, campaign_name string")
    ref = A.build_reference(a, b, "campaign_id", ["country_code"])
    assert rows(ref, "campaign_id") == [("1", "ES"), ("2", None), ("3", None)]
    i2n, n2i = I.campaign_maps(a, b)
    assert rows(i2n, "campaign_id") == [("1", "n1"), ("2", "n2"), ("3", "n2")]
    assert rows(n2i, "campaign_name") == [("n1", "1")]  # n2 has two ids


def test_apply_maps_fills_name_then_id(spark):
    df = spark.createDataFrame([("1", None), (None, "n2"), (None, None)],
                               "campaign_id string, campaign_name string")
    i2n = spark.createDataFrame([("1", "n1")], "campaign_id string, _name string")
    n2i = spark.createDataFrame([("n1", "1"), ("n2", "2")], "campaign_name string, _id string")
    out = I.apply_campaign_maps(df, i2n, n2i)
    assert rows(out, "campaign_id") == [(None, None), ("1", "n1"), ("2", "n2")]


def test_long_wide_roundtrip_sums(spark):
    df = spark.createDataFrame(
        [(D1, "1", 1.0, 10, None), (D1, "1", 1.0, 5, 2), (D1, "2", 2.0, None, None),
         (D1, None, 3.0, 7, 7)],
        "date date, campaign_id string, spend_value double, nb_of_sessions bigint, "
        "nb_of_orders bigint")
    stages = {"nb_of_sessions": "sessions", "nb_of_orders": "orders"}
    long = R.to_long(df, ["date", "campaign_id", "spend_value"], stages)
    assert long.count() == 8
    wide = R.long_to_wide(long, ["date", "campaign_id", "spend_value"], list(stages.values()))
    assert rows(wide, "campaign_id") == [(D1, "1", 1.0, 15.0, 2.0), (D1, "2", 2.0, 0.0, 0.0)]
    keep = R.long_to_wide(long, ["date", "campaign_id", "spend_value"], list(stages.values()),
                          drop_null_keys=False)
    assert keep.count() == 3


def test_max_by_grain_columnwise(spark):
    df = spark.createDataFrame([("k", 1, 9, "b", 2), ("k", 5, 3, "a", 1), (None, 7, 7, "z", 0)],
                               "g string, m1 int, m2 int, d string, o int")
    out = A.max_by_grain(df, ["g"], ["m1", "m2"], ["d"], order=["o"])
    assert rows(out) == [("k", "a", 5, 9)]


def test_duplicates_and_profiles(spark):
    df = spark.createDataFrame([("1", "a", "x"), ("1", "b", "x"), ("2", "c", None)],
                               "id string, name string, ch string")
    assert rows(W.duplicate_rows(df, ["id"]), "name") == [("1", "a", "x"), ("1", "b", "x")]
    assert rows(A.duplicate_groups(df, ["id"])) == [("1", 2)]
    prof = A.profile_by(df, "id", ["ch"], "name", sep="|")
    assert rows(prof, "id") == [("1", "ch", "x", 1, "a|b", 2), ("2", "ch", "<<NaN>>", 1, "c", 1)]
    card = A.cardinality(df, "ch", "id", sep="|")
    assert rows(card, "ch") == [("<<NaN>>", "2", 1), ("x", "1", 1)]


def test_profile_of_a_hot_null_key(spark):
    """A third of the rows have no key, each with a value of its own: counted in all tasks, listed nowhere."""
    n = 30_000
    df = spark.range(n).select(F.when(F.col("id") % 3 != 0, F.col("id") % 50).alias("k"), F.col("id").cast("string").alias("v"))
    long = A.value_counts(df, "k", ["v"])
    sizes = [r[0] for r in long.repartition(1).groupBy().agg(F.count("*")).collect()]
    assert sizes == [n]
    spread = long.where("k = '<<NaN>>'").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in spread) == n // 3
    got = {r.k: (r.col_values, r.col_nunique) for r in A.listed(long, "k", max_list=1000).collect()}
    assert got["<<NaN>>"] == (None, n // 3) and len(got) == 51
    assert sorted(got["7"][0]) == got["7"][0] and len(got["7"][0]) == got["7"][1]
    prof = A.profile_by(df.withColumn("w", F.lit(None).cast("string")), "k", ["w"], "v", sep="|", max_list=1000)
    assert {(r.k, r.col_values, r.v_nunique) for r in prof.where("k = '<<NaN>>'").collect()} == {("<<NaN>>", "<<NaN>>", n // 3)}


def test_value_counts_deal_by_value(spark):
    """The exchange of the long form hashes the value, so a null key is no single task."""
    df = spark.createDataFrame([(None, "x")], "k string, v string")
    plan = A.value_counts(df, "k", ["v"])._jdf.queryExecution().executedPlan().toString()
    dealt_by = plan.split("Exchange hashpartitioning(")[1].split(")")[0].split(", ")
    assert plan.count("Exchange hashpartitioning(") == 1 and len(dealt_by) == 4      # key, column, value; number of partitions


@pytest.mark.parametrize("null_safe", [False, True])
def test_large_lookup_equals_a_plain_join(spark, monkeypatch, null_safe):
    """Null keys, a hot key with a third of the rows, keys without reference row, a reference row without key."""
    monkeypatch.setattr(J, "HOT_SHARE", 0.05)
    n = 3000
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, "hot")
                               .otherwise((F.col("id") % 40).cast("string")).alias("k"))
    ref = spark.createDataFrame([("hot", "H", 1), (None, "N", 2), *[(str(i), f"r{i}", i) for i in range(0, 40, 2)]], "k string, name string, x int")
    small = J.attach_dim(df, ref, "k", null_safe=null_safe)
    large = J.attach_dim(df, ref, "k", null_safe=null_safe, max_rows=3)
    assert small.columns == large.columns and rows(large, "id") == rows(small, "id")
    assert rows(J.fill_from_reference(df.withColumn("name", F.lit(None).cast("string")), ref, "k", max_rows=3), "id") == rows(
        J.fill_from_reference(df.withColumn("name", F.lit(None).cast("string")), ref, "k"), "id")
    assert rows(J.update_from_lookup(df.withColumn("name", F.lit("old")), ref, "k", max_rows=3), "id") == rows(
        J.update_from_lookup(df.withColumn("name", F.lit("old")), ref, "k"), "id")


def test_large_lookup_shuffles_neither_null_nor_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(J, "HOT_SHARE", 0.05)
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    ref = spark.range(3000).select(F.col("id").cast("string").alias("k"), F.lit("n").alias("name"))
    plan = J.attach_dim(df, ref, "k", max_rows=3)._jdf.queryExecution().optimizedPlan().toString()
    # Three parts; the one without key has no join at all, the hot one and the split by hot keys are broadcast.
    assert plan.count("Union") >= 1 and plan.count("strategy=broadcast") >= 4


def test_sketches_merge_to_any_grain(spark):
    df = spark.range(40_000).select((F.col("id") % 20).alias("d"), (F.col("id") % 2).alias("g"), (F.col("id") % 7000).alias("v"),
                                    F.lit(None).cast("long").alias("none"))
    daily = A.distinct_sketches(df, ["d", "g"], ["v", "none"])
    for by, exact in ((["g"], 3500), ([], 7000)):
        for r in A.roll_up_sketches(daily, by, ["v", "none"]).collect():
            assert abs(r.v_distinct - exact) <= 5 * 0.016 * exact and r.none_distinct == 0


def test_best_by_and_snapshot(spark):
    df = spark.createDataFrame([("k", None, "b"), ("k", 3, "a"), ("k", 3, "c"), ("j", None, "z")],
                               "k string, spend int, t string")
    assert rows(W.best_by(df, ["k"], "spend", ["t"]), "k") == [("j", None, "z"), ("k", 3, "a")]
    h = spark.createDataFrame(
        [("k", 1, dt.datetime(2024, 1, 1)), ("k", 1, dt.datetime(2024, 1, 2)),
         ("k", 2, dt.datetime(2024, 1, 3))], "k string, v int, ts timestamp")
    snap = W.snapshot(h, ["k"], "ts", ["v"])
    got = rows(snap.select("v", "valid_from", "valid_to", "is_current"), "valid_from")
    assert got == [(1, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3), False),
                   (2, dt.datetime(2024, 1, 3), None, True)]


def test_merge_by_key_idempotent_and_sync(spark):
    t = spark.createDataFrame([(D1, "1", None, 1), (D2, "1", "n", 2)],
                              "date date, campaign_id string, campaign_name string, v int")
    new = spark.createDataFrame([(D1, "1", None, 10, "x")],
                                "date date, campaign_id string, campaign_name string, v int, w string")
    once = merge_by_key(t, new)
    twice = merge_by_key(once, new)
    assert rows(once, "date") == rows(twice, "date") == [(D1, "1", None, 10, "x"),
                                                         (D2, "1", "n", 2, None)]
    assert sync_columns(t, new).columns == new.columns


def test_quality_checks(spark):
    df = spark.createDataFrame([(100, 10, 20, None), (100, 50, 5, 1), (None, None, None, 5)],
                               "impressions int, clicks int, leads int, deals int")
    mono = Q.check_monotonic(df, ["impressions", "clicks", "leads"])
    assert rows(mono.select("broken_steps")) == [("leads>clicks",)]
    assert Q.check_broken_funnel(df, "impressions", ["clicks"], "deals").count() == 1
    assert rows(Q.null_counts(df, ["impressions", "deals"]), "column_name") == [
        ("deals", 1), ("impressions", 1)]
    out = Q.flag_outliers(df, {"impressions": 100, "deals": 5})
    assert sorted(r[0] for r in out.select("outlier_metrics").collect()) == [
        "deals", "impressions", "impressions"]
    assert Q.check_accepted(df, "deals", [1]).count() == 1
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0),)], "ts timestamp")
    fr = Q.check_freshness(ts, dt.datetime(2024, 1, 1, 13), "ts").first()
    assert fr["status"] == "warn"
    assert Q.check_freshness(ts, dt.datetime(2024, 1, 2, 1), "ts").first()["status"] == "error"
    assert U.missing_columns(df, ["impressions", "x"]) == ["x"]


def test_required_columns_raise_and_row_filters(spark):
    import pytest
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "n int, t string")
    with pytest.raises(Exception, match="missing"):
        U.require_columns(df, ["n", "missing"], "table")
    kept = Q.apply_row_filters(df, {"big": F.col("n") > 1, "named": F.col("t").isNotNull()})
    assert rows(kept) == [(3, "c")]


def test_staging_keeps_other_columns(spark):
    from spendlens.plans.facts import stg_leads_funnel, stg_web_orders
    web = spark.createDataFrame([(" 17 ", D1, 5)], "campaign_id string, date date, total_spend_eur int")
    assert rows(stg_web_orders(web)) == [("17", D1, 5)]
    leads = spark.createDataFrame([(" 17 ", "P o s Lite", "Search ", None, "a - b", 3)],
                                  "campaign_id string, campaign_name string, channel_3 string, channel_4 string, "
                                  "channel_5 string, total_leads int")
    assert rows(stg_leads_funnel(leads)) == [("17", "pos-lite", "search", None, "a-b", 3)]


def test_white_space_of_any_alphabet(spark):
    from spendlens.functions import clean_string, remove_spaced_letters
    df = spark.createDataFrame([("\u00a0bing\u00a0search x", "pos\u2003lite", "p\u00a0o s lite")], "a string, b string, c string")
    assert rows(df.select(clean_string("a"), clean_string("b"), remove_spaced_letters("c"))) == [
        ("bing-search_x", "pos-lite", "pos lite")]


def test_equal_spend_keeps_the_smallest_content(spark):
    """One tie order for the combination and the ranking."""
    web = spark.createDataFrame([(D1, "1", "GB", 5, 9), (D1, "1", "GB", 5, 1), (D1, "1", "GB", 5, None)],
                                "date date, campaign_id string, country_code string, total_spend_eur int, s int")
    leads = spark.createDataFrame([], "date date, campaign_id string, country_code string, total_spend int")
    assert [r.s for r in J.combine_funnels(web, leads).collect()] == [1]
    assert rows(J.repeated_keys(web)) == [(D1, "1", "GB", 2)]


def test_surrogate_key_parts_do_not_run_together(spark):
    from spendlens.functions import surrogate_key
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "c"), ("<null>", "c")], "x string, y string")
    assert df.select(surrogate_key("x", "y").alias("k")).distinct().count() == 4


def test_max_by_grain_ranks_rows_that_lack_a_dim(spark):
    """Complete rows and rows that lack a dim: each dim is the first non-null in order; one struct is carried for all dims."""
    df = spark.createDataFrame([("g", 2, "b2", "x2", 5), ("g", 1, None, "x1", 7), ("g", 3, "b3", None, 1),
                                ("h", 1, None, None, None), ("h", 2, None, "y", 2), ("i", 1, "c", "z", 3), ("i", None, "d", None, 9)],
                               "g string, o int, b string, x string, m int")
    out = A.max_by_grain(df, ["g"], ["m"], ["b", "x"], order=["o", "b"])
    assert rows(out, "g") == [("g", "b2", "x1", 7), ("h", None, "y", 2), ("i", "d", "z", 9)]
    assert "min_by(" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("null_safe", [False, True])
def test_large_lookup_without_hot_keys_reads_the_rows_once(spark, null_safe):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 != 0, (F.col("id") % 1500).cast("string")).alias("k"))
    ref = spark.range(0, 1500, 2).select(F.col("id").cast("string").alias("k"), F.col("id").alias("x")).union(
        spark.createDataFrame([(None, -1)], "k string, x long"))
    small, large = J.attach_dim(df, ref, "k", null_safe=null_safe), J.attach_dim(df, ref, "k", null_safe=null_safe, max_rows=3)
    assert small.columns == large.columns and rows(large, "id") == rows(small, "id")
    assert large._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1


def test_leads_text_is_cleaned_by_value(spark):
    """Equal to cleaning every row, nulls included; the rows themselves meet no pattern of the cleaning."""
    df = spark.createDataFrame([(1, " 12.0 ", "A  b", "fb ", None, None), (2, None, None, None, None, None), (3, "12", "A  b", "fb ", None, None)],
                               "id int, campaign_id string, campaign_name string, channel_3 string, channel_4 string, channel_5 string")
    from spendlens.plans import impute as I
    out = I.prepare_leads(df)
    assert rows(out, "id") == [(1, "12", "a_b", "fb", None, None), (2, None, None, None, None, None), (3, "12", "a_b", "fb", None, None)]
    assert rows(I.clean_texts(df, ["campaign_name", "channel_3"], max_rows=1), "id") == rows(I.clean_texts(df, ["campaign_name", "channel_3"]), "id")
    assert "p\\s*r\\s*o" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_final_grain_is_one_exchange_a_fact(spark):
    from spendlens.operators.reshape import FUNNEL_INDEX, WEB_STAGES, facts_to_wide
    from spendlens.plans import extract as X
    text = [c for c in FUNNEL_INDEX if c not in ("date", "pathway")]
    df = spark.createDataFrame([(dt.date(2024, 1, 1), *[f"{c}{i}" for c in text], *[i for _ in WEB_STAGES]) for i in range(10)],
                               "date date, " + ", ".join(f"{c} string" for c in text) + ", " + ", ".join(f"{m} long" for m in WEB_STAGES))
    wide = facts_to_wide(df.withColumn("pathway", F.lit("w")), FUNNEL_INDEX, WEB_STAGES,
                         dealt_by=[c for c in X.GRAIN if c != "pathway"])
    out = X.final_grain(wide)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1 and out.count() == 10


ID_TEXT = "campaign_id string, campaign_name string, campaign_period_budget_category string, country_code string, channel_3 string, channel_4 string, channel_5 string"


def test_a_fact_is_filled_by_one_join(spark):
    """Equal to the maps and references applied one by one; each fact meets one table only."""
    from spendlens.plans import impute as I
    web = spark.createDataFrame([("1", "n1", "c", "ES", "fb", None, None), ("1", "n1", None, None, None, "x4", None), (None, "n1", None, None, None, None, "y"),
                                 ("2", None, None, None, None, None, None), (None, None, None, None, None, None, None), ("9", "n2", "d", "GB", "fb", "z", None)], ID_TEXT)
    leads = spark.createDataFrame([("2", "n2", None, "IE", "max", "m", "v"), (None, "n3", None, None, "q", None, None), ("3", "n3", None, None, None, None, None)], ID_TEXT)
    i2n, n2i, by_id, by_name = I.references([web, leads])
    key = list(web.columns)
    for got, df in zip(I.impute_normalized([web, leads]), (web, leads)):
        step = J.fill_from_reference(I.apply_campaign_maps(df, i2n, n2i), by_id, "campaign_id", I.ATTR_COLS)
        want = J.fill_from_reference(step, by_name, "campaign_name", I.ATTR_COLS)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.columns == key
        assert got._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 1
        pairs = want.withColumn("_pair", I.id_name_pair("campaign_id", "campaign_name")).where("_pair IS NOT NULL").dropDuplicates(["_pair"])
        assert rows(I.fill_by_pair(df, pairs, max_rows=0).where("campaign_id = '9'")) == rows(I.fill_by_pair(df, pairs).where("campaign_id = '9'"))


@pytest.mark.parametrize("max_rows", [0, 1000])
def test_facts_are_prepared_by_value(spark, max_rows):
    from spendlens.plans import impute as I
    ch = spark.createDataFrame([("1", "N  a", "always", "fb ", "x  y", None), (" 1 ", "N  a", None, "fb", None, "u"), (None, "none", None, "unknown", None, None)],
                               "campaign_id string, campaign_name string, campaign_period_budget_category string, channel_3 string, channel_4 string, channel_5 string")
    web = spark.createDataFrame([(1, " es ", " 1.0"), (1, " es ", " 1.0"), (2, None, None), (3, "unknown", "1"), (4, "GB", "7")], "n int, country_code string, campaign_id string")
    leads = spark.createDataFrame([(1, "nan", "1.0", "A  b", "none", None, "Z"), (2, "GB", None, None, None, None, None), (2, "GB", None, None, None, None, None)],
                                  "n int, country_code string, campaign_id string, campaign_name string, channel_3 string, channel_4 string, channel_5 string")
    want = I.normalized(I.prepare_web(web, ch), I.prepare_leads(leads))
    for got, w in zip(I.normalized_by_value(web, leads, ch, max_rows=max_rows), want):
        assert got.columns == w.columns and got.exceptAll(w).isEmpty() and w.exceptAll(got).isEmpty()
        assert max_rows == 0 or "regexp_replace" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_channel_text_is_worked_once_on_all_cores(spark):
    """The channel table comes as one small task; its text is cleaned in several, and not again by the repair."""
    from spendlens.plans import facts, impute as I
    ch = spark.createDataFrame([(f" {i % 40} ", f"N  {i}", "c", "fb ", None, "x  y") for i in range(80)], "campaign_id string, campaign_name string, "
                               "campaign_period_budget_category string, channel_3 string, channel_4 string, channel_5 string").coalesce(1)
    for out in (I.prepare_channels(ch), facts.dim_campaign_channels(ch)):
        assert "regexp_replace" not in out._jdf.queryExecution().optimizedPlan().toString()
        assert out.count() == 40 and out.where("channel_5 = 'x_y'").count() == 40


def test_extract_groups_by_the_deciding_columns(spark):
    """The wide and final tables of the whole index; the exchange carries nothing that another column decides."""
    from spendlens.operators.reshape import FUNNEL_INDEX, LEADS_STAGES, WEB_STAGES, facts_to_wide
    from spendlens.plans import extract as X
    attrs = "date date, country_code string, campaign_id string, campaign_name string, channel_3 string, channel_4 string, channel_5 string, "
    base = [(dt.date(2024, 1, 1 + i % 3), ("ES", "XX", None)[i % 7 % 3], f"{i % 2}", ("a test", "b", None)[i % 5 % 3], ("fb", "max")[i % 2], f"c{i % 3}",
             ("a_b_c", "a_b_d", "a_b", None, "p_q_r_s")[i % 11 % 5]) for i in range(200)]
    web = spark.createDataFrame([(*r, float(i % 4), i, None, 1, 2) for i, r in enumerate(base)], attrs + "total_spend_eur double, " + ", ".join(f"{m} long" for m in WEB_STAGES))
    leads = spark.createDataFrame([(*r, float(i % 3), *[i] * 8) for i, r in enumerate(base)], attrs + "total_spend double, " + ", ".join(f"{m} long" for m in LEADS_STAGES))
    out = X.build_extract(web, leads)
    full = [facts_to_wide(X.prep_frame(X.derive_all(d), p, (s, s)), FUNNEL_INDEX, st)
            for d, p, s, st in ((web, X.WEB_PATHWAY, "total_spend_eur", WEB_STAGES), (leads, X.SALES_PATHWAY, "total_spend", LEADS_STAGES))]
    wide = full[0].unionByName(full[1], allowMissingColumns=True)
    for got, want in ((out["web_wide"], full[0]), (out["leads_wide"], full[1]), (out["all_wide"], wide), (out["final"], X.final_grain(wide))):
        assert sorted(got.columns) == sorted(want.columns) and got.count() == want.count() > 0
        assert got.exceptAll(want.select(got.columns)).isEmpty()
    for name in ("all_wide", "final"):
        plan = out[name]._jdf.queryExecution().executedPlan().toString()
        keys = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert len(keys) == 2 and not any(c in k for k in keys for c in ("country_name", "week", "channel_6", "channel_7"))


CHANNELS_TEXT = "campaign_id string, campaign_name string, campaign_period_budget_category string, channel_3 string, channel_4 string, channel_5 string"


def _mart_facts(spark):
    """Facts of two days: negative and missing spend, ids that no dimension row has, rows without id, repeated rows."""
    from spendlens.sources.schemas import LEADS_METRICS, WEB_METRICS
    d = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    web = [(d[0], " es ", "1", -5), (d[0], "GB", "1", 7), (d[0], "GB", "1", 7), (d[0], None, "2", None), (d[1], "GB", None, 3), (d[1], "ES", None, -1), (None, "ES", "1", 2)]
    leads = [(d[0], "ES", " 1", 9, "A  b", None), (d[0], "IE", "1", -3, None, " "), (d[0], "GB", "3", 4, None, "x  y"), (d[1], "GB", None, 2, "fb ", None), (d[1], "GB", None, 2, "fb ", None)]
    w = spark.createDataFrame([(*r, *[r[3] or 0 for _ in WEB_METRICS]) for r in web],
                              "date date, country_code string, campaign_id string, total_spend_eur long, " + ", ".join(f"{m} long" for m in WEB_METRICS))
    l = spark.createDataFrame([(*r[:4], *[i + r[3] for i, _ in enumerate(LEADS_METRICS)], r[4], None, r[5]) for r in leads],
                              "date date, country_code string, campaign_id string, total_spend long, " + ", ".join(f"{m} long" for m in LEADS_METRICS)
                              + ", channel_3 string, channel_4 string, channel_5 string")
    ch = spark.createDataFrame([("1", "N  a", "always", "fb ", "x  y", None), (" 1 ", "N  a", None, "fb", None, "u"), ("2", " ", None, None, "q", None), (None, "none", None, "max", None, None)], CHANNELS_TEXT)
    return w, l, ch


def test_campaign_ranking_comes_before_the_dimension(spark):
    """The ranking's rows hold no text of the dimension; the result is that of ranking the enriched rows."""
    from spendlens.plans import mart as M
    from spendlens.plans.facts import dim_campaign_channels, fct_leads, fct_web
    web, leads, ch = _mart_facts(spark)
    got = M.build_mart(web, leads, ch, grain="campaign")
    plan = got._jdf.queryExecution().analyzed().toString()
    assert 0 <= plan.find("Join LeftOuter") < plan.find("AS _p_date")
    enriched = M.enrich(J.combine_funnels(fct_web(web), fct_leads(leads, clean=False)), dim_campaign_channels(ch))
    want = M.finalize(M.recombine_best(enriched, ("campaign_id", "campaign_name", "date")))
    assert got.columns == want.columns and got.count() > 4 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("grain", ["country", "campaign"])
def test_large_dimension_combines_the_funnels_once(spark, monkeypatch, grain):
    """Beyond the broadcast bound the counting of hot keys and the join read the combined rows from where they were written."""
    from spendlens.plans import mart as M
    web, leads, ch = _mart_facts(spark)
    want = M.build_mart(web, leads, ch, grain=grain)
    monkeypatch.setattr(J, "sized", lambda df, *a, **k: (False, df))
    for share in (0.2, 1):                       # with and without hot keys
        monkeypatch.setattr(J, "HOT_SHARE", share)
        got = M.build_mart(web, leads, ch, grain=grain)
        assert "_rank" not in got._jdf.queryExecution().optimizedPlan().toString()
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("max_rows", [0, 1000])
def test_facts_are_imputed_by_value(spark, max_rows):
    """Equal to preparing and filling every row; no row is cleaned by itself, however many values there are."""
    from spendlens.plans import impute as I
    ch = spark.createDataFrame([("1", "N  a", "always", "fb ", "x  y", None), (" 1 ", "N  a", None, "fb", None, "u"), (None, "none", None, "unknown", None, None)], CHANNELS_TEXT)
    web = spark.createDataFrame([(1, " es ", " 1.0"), (1, " es ", " 1.0"), (2, None, None), (2, None, None), (3, "unknown", "1"), (4, "GB", "7"), (5, "GB", "x")],
                                "n int, country_code string, campaign_id string")
    leads = spark.createDataFrame([(1, "nan", "1.0", "A  b", "none", None, "Z"), (2, "GB", None, None, None, None, None), (2, "GB", None, None, None, None, None),
                                   (3, None, "7", "A  c", "fb ", " ", None), (4, "IE", None, "a_c", None, "q", "Z"), (5, "IE", "7", None, None, None, None)],
                                  "n int, country_code string, campaign_id string, campaign_name string, channel_3 string, channel_4 string, channel_5 string")
    want = I.impute_campaigns(I.prepare_web(web, ch), I.prepare_leads(leads))
    for got, w in zip(I.impute_by_value(web, leads, ch, max_rows=max_rows), want):
        assert got.columns == w.columns and got.exceptAll(w).isEmpty() and w.exceptAll(got).isEmpty()
        assert "regexp_replace" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_final_table_is_kept_as_parquet(spark):
    """What reads the final table twice reads stored columns, not a checkpoint of all of them."""
    import __spark_entry__ as entry
    plan = entry.queries()["sorted_duplicates"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and plan.count("parquet") >= 2


def test_compressed_csv_is_read_back(spark, tmp_path):
    from spendlens.sources.io import read_source, write_csv
    df = spark.createDataFrame([(i % 3, f' a "{i % 5}", b', None if i % 2 else dt.date(2024, 1, 1)) for i in range(2000)], "i int, t string, d date")
    for codec in (None, "gzip"):
        write_csv(df.coalesce(1), str(tmp_path / str(codec)), compression=codec)
        back = read_source(spark, str(tmp_path / str(codec)), df.schema, fmt="csv")
        assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()
    size = {c: sum(p.stat().st_size for p in (tmp_path / str(c)).glob(f"*{e}")) for c, e in ((None, ".csv"), ("gzip", ".csv.gz"))}
    assert 0 < 5 * size["gzip"] < size[None]
