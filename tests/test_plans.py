"""Properties of the composite jobs on the sf0.001 tables."""

import datetime as dt
import uuid

import pytest
import regex
from pyspark.sql import functions as F

import __spark_entry__ as entry
from spendlens.plans.incremental import (build_target, changed_dates, date_marks, incremental_refresh, keyless_side, marks_path,
                                         path_exists, read_target)
from spendlens.plans.mart import MART_COLUMNS, build_mart
from spendlens.session import scratch_path
from spendlens.sources import fixtures as fx


def _sources(spark, sf):
    return fx.web_orders(spark, sf), fx.leads_funnel(spark, sf), fx.channels(spark, sf)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert tuple(df.columns) == MART_COLUMNS
    assert df.count() > 0


def test_mart_unique_on_country_grain(spark, sf_small):
    m = build_mart(*_sources(spark, sf_small))
    dup = m.groupBy("date", "campaign_id", "country_code", keyless_side(m).alias("side")).count().where("count > 1")
    assert dup.isEmpty()
    # every fact row is represented: web rows + leads rows - matched pairs
    web, leads, _ = _sources(spark, sf_small)
    assert m.count() <= web.count() + leads.count()


def test_campaign_grain_may_split_a_key(spark, sf_small):
    m = build_mart(*_sources(spark, sf_small), grain="campaign")
    per_key = m.groupBy("date", "campaign_id", "campaign_name").count()
    assert per_key.agg(F.max("count")).first()[0] <= 2


def _sorted(df):
    return sorted(map(tuple, df.select(*MART_COLUMNS).collect()), key=repr)


def _target(spark, *facts):
    path = scratch_path(spark, f"t_{uuid.uuid4().hex}")
    build_target(spark, path, *facts)
    return path


def test_incremental_refresh_matches_full_and_is_idempotent(spark, sf_small):
    web, leads, ch = _sources(spark, sf_small)
    full = build_mart(web, leads, ch)
    newest = web.agg(F.max("date")).first()[0]
    cut = newest - dt.timedelta(days=60)
    path = _target(spark, web.where(F.col("date") < cut), leads.where(F.col("date") < cut), ch)
    once = _sorted(incremental_refresh(spark, path, web, leads, ch))
    assert once == _sorted(full)
    assert _sorted(incremental_refresh(spark, path, web, leads, ch)) == once


def test_restatement_beyond_lookback_reaches_the_target(spark, sf_small):
    """Every changed day is recomputed, however old."""
    web, leads, ch = _sources(spark, sf_small)
    path = _target(spark, web, leads, ch)
    restated = web.withColumn("total_spend_eur", (F.col("total_spend_eur") * 2).cast("decimal(18,4)"))
    assert _sorted(incremental_refresh(spark, path, restated, leads, ch)) == _sorted(build_mart(restated, leads, ch))


def test_only_touched_dates_are_recomputed(spark, sf_small):
    web, leads, ch = _sources(spark, sf_small)
    path = _target(spark, web, leads, ch)
    day = web.agg(F.min("date")).first()[0]
    late = web.withColumn("nb_of_orders", F.when(F.col("date") == day, F.col("nb_of_orders") + 1)
                          .otherwise(F.col("nb_of_orders")))
    assert changed_dates(spark.read.parquet(marks_path(path)), date_marks(late, leads)) == [day]
    assert _sorted(incremental_refresh(spark, path, late, leads, ch)) == _sorted(build_mart(late, leads, ch))


def test_retracted_month_leaves_the_target(spark, sf_small):
    web, leads, ch = _sources(spark, sf_small)
    path = _target(spark, web, leads, ch)
    month = F.trunc("date", "month")
    first = web.unionByName(leads.select("date"), allowMissingColumns=True).agg(F.min(month)).first()[0]
    w, l = web.where(month != F.lit(first)), leads.where(month != F.lit(first))
    out = incremental_refresh(spark, path, w, l, ch)
    assert _sorted(out) == _sorted(build_mart(w, l, ch))


def test_schema_change_lands_in_the_target(spark, sf_small):
    web, leads, ch = _sources(spark, sf_small)
    path = _target(spark, web, leads, ch)
    wider = web.withColumn("total_spend_eur", F.col("total_spend_eur") * 2)
    incremental_refresh(spark, path, wider, leads, ch)
    out, fresh = read_target(spark, path), build_mart(wider, leads, ch)
    assert dict(out.dtypes)["total_spend_web"] == dict(fresh.dtypes)["total_spend_web"] != "decimal(18,4)"
    assert _sorted(out) == _sorted(fresh)


def test_storage_errors_are_not_a_missing_target(spark, tmp_path):
    bad = tmp_path / "target"
    bad.mkdir()
    (bad / "part-0.parquet").write_bytes(b"not parquet at all")
    assert not path_exists(spark, str(tmp_path / "nothing"))
    with pytest.raises(Exception):
        path_exists(spark, str(bad))


def test_first_stream_batch_sees_its_own_rows_only(spark, sf_small):
    from spendlens.streaming.mart_stream import refresh_batch, to_landing
    web, leads, ch = _sources(spark, sf_small)
    rows = to_landing(web, leads)
    base = scratch_path(spark, f"s_{uuid.uuid4().hex}")
    day = F.col("date") < F.lit(dt.date(1997, 1, 1))
    gb = F.trim("country_code") == "GB"
    first, second = rows.where(day & gb), rows.where(~day | ~F.coalesce(gb, F.lit(False)))
    for _ in range(2):     # a retried batch changes nothing
        refresh_batch(spark, first, 0, ch, f"{base}/t", f"{base}/f")
        assert _sorted(read_target(spark, f"{base}/t")) == _sorted(build_mart(web.where(day & gb), leads.where(day & gb), ch))
    refresh_batch(spark, second, 1, ch, f"{base}/t", f"{base}/f")
    assert _sorted(read_target(spark, f"{base}/t")) == _sorted(build_mart(web, leads, ch))


def test_remove_spaced_letters_query_matches_python(spark, sf_small):
    out = entry.queries()["remove_spaced_letters"](spark, sf_small).collect()
    pat = regex.compile(r"(?<=\b\p{L})\s+(?=\p{L}\b)")
    assert out and all(pat.sub("", r["raw_text"]) == r["joined"] for r in out)


def test_csv_crlf_seed_shape(spark, tmp_path):
    """A seed-shaped CSV: header, CRLF line ends, no final newline, 18-digit ids."""
    from spendlens.sources import read_source, schemas
    p = tmp_path / "channels.csv"
    p.write_bytes(b"campaign_id,campaign_name,campaign_period_budget_category,channel_3,"
                  b"channel_4,channel_5\r\n120211151098440066,fb_ie_x,alwayson,fb,"
                  b"fb prospecting,fb prospecting landing\r\n391180926,bing_x ,,bing-search,"
                  b"bing-search prospecting,")
    df = read_source(spark, str(p), schemas.CHANNELS)
    got = [tuple(r) for r in df.orderBy("campaign_id").collect()]
    assert got == [("120211151098440066", "fb_ie_x", "alwayson", "fb", "fb prospecting",
                    "fb prospecting landing"),
                   ("391180926", "bing_x ", None, "bing-search", "bing-search prospecting",
                    None)]


def test_point_lookup_pushes_filters(spark, sf_small):
    from spendlens.operators.setops import point_lookup
    o = spark.read.parquet(f"{sf_small}/orders.parquet")
    plan = point_lookup(o, o_orderkey=1)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderkey), EqualTo(o_orderkey,1)]" in plan


def test_run_daily_order_and_outputs(spark, sf_small):
    from spendlens.plans.daily import ChecksFailed, LoadedSource, run_daily
    from spendlens.sources.versions import VersionedTable
    web, leads, ch = _sources(spark, sf_small)
    base = scratch_path(spark, f"daily_{uuid.uuid4().hex}")
    paths = {k: f"{base}/{k}" for k in ("report", "web_history", "leads_history", "mart")}
    now = dt.datetime(2001, 8, 3, 0, 0)
    w, l = fx.with_loaded_at(web), fx.with_loaded_at(leads)
    with pytest.raises(ChecksFailed) as stopped:
        run_daily(spark, w, l, ch, paths, now)
    assert VersionedTable(spark, paths["mart"]).current() is None and not path_exists(spark, paths["web_history"])
    known = stopped.value.rows + [("freshness", t, "_etl_loaded_at") for t in ("web_orders", "leads_funnel")]
    half = F.col("date") < F.lit(dt.date(1996, 1, 1))
    # A delta first, then a full copy, which is run twice: no row is lost, none counts twice.
    run_daily(spark, w.where(half), l.where(half), ch, paths, now, "load-1", known)
    for _ in range(2):
        out = run_daily(spark, w, l, ch, paths, now, "load-2", known)
        assert _sorted(out["mart"]) == _sorted(build_mart(web, leads, ch))
        assert out["web_history"].where("is_current").count() == web.count() == out["web_history"].count()
    assert LoadedSource(spark, paths["web_history"], (), ()).landing.read().count() == web.count() + web.where(half).count()


def test_csv_by_header_quotes_and_corrupt_rows(spark, tmp_path):
    from spendlens.sources import schemas
    from spendlens.sources.io import CorruptRows, read_source, write_csv
    p = tmp_path / "c.csv"
    head = "Campaign_Name,campaign_id,extra,channel_3,channel_4,channel_5,campaign_period_budget_category\r\n"
    p.write_bytes((head + '"he said ""x"", y", 17 ,e,a,b,c,flight\r\n').encode())
    assert [tuple(r) for r in read_source(spark, str(p), schemas.CHANNELS).collect()] == [
        (" 17 ", 'he said "x", y', "flight", "a", "b", "c")]
    p.write_bytes((head + "n,1,e,a,b,c,f\r\nshort,2\r\n").encode())
    with pytest.raises(CorruptRows):
        read_source(spark, str(p), schemas.CHANNELS)
    assert read_source(spark, str(p), schemas.CHANNELS, corrupt="drop").count() == 1
    kept = read_source(spark, str(p), schemas.CHANNELS, corrupt="keep")
    assert kept.cache().where("_corrupt_record is not null").count() == 1
    p.write_bytes(b"campaign_id\n1\n")
    with pytest.raises(ValueError):
        read_source(spark, str(p), schemas.CHANNELS)
    df = spark.createDataFrame([(" 17 ", 'a "b"; c', None)], "x string, y string, z string")
    write_csv(df, str(tmp_path / "out"), sep=";")
    assert [tuple(r) for r in read_source(spark, str(tmp_path / "out"), df.schema, fmt="csv", sep=";").collect()] == [
        (" 17 ", 'a "b"; c', None)]


def test_export_is_guarded_by_uniqueness(spark, tmp_path):
    from spendlens.plans.extract import DUPLICATE_KEY, write_extract
    row = {"campaign_id": "1", "date": "2024-01-01", "pathway": "w"}
    good = spark.createDataFrame([row])
    write_extract({"final": good}, str(tmp_path / "ok"))
    assert spark.read.option("header", True).csv(str(tmp_path / "ok" / "final")).count() == 1
    with pytest.raises(AssertionError):
        write_extract({"final": good.union(good)}, str(tmp_path / "bad"), unique=DUPLICATE_KEY)
    assert not (tmp_path / "bad").exists()


def test_stream_batch_is_stored_in_few_files_and_read_once(spark, sf_small, tmp_path):
    """A month has one file a batch, however many tasks deal it; the leads' texts are clean in the mart."""
    import glob
    from spendlens.streaming.mart_stream import refresh_batch, to_landing
    web = spark.createDataFrame([(dt.date(2024, 1 + i % 3, 5), "GB", str(i), i, 1, 1, 1, 1) for i in range(300)],
                                "date date, country_code string, campaign_id string, total_spend_eur int, nb_of_sessions int, nb_of_signups int, "
                                "nb_of_orders int, nb_of_poslite_items_ordered int")
    leads = spark.createDataFrame([(dt.date(2024, 1, 5), "GB", "x", "N", "Fb  A", None, " p o s lite", 1, *[2] * 8)],
                                  "date date, country_code string, campaign_id string, campaign_name string, channel_3 string, channel_4 string, "
                                  "channel_5 string, total_spend int, total_impressions int, total_clicks int, total_leads int, total_sqls int, "
                                  "total_meeting_done int, total_signed_leads int, total_pos_lite_deals int, total_fake_leads int")
    from spendlens.plans.incremental import read_target
    from spendlens.sources import fixtures as fx
    target, facts = str(tmp_path / "t"), str(tmp_path / "f")
    ch = fx.channels(spark, sf_small)
    batch = to_landing(web, leads)
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")                         # as many tasks as a large batch has
    try:
        for _ in range(2):                                 # a retried batch replaces itself
            refresh_batch(spark, batch, 0, ch, target, facts)
        refresh_batch(spark, batch.limit(0), 1, ch, target, facts)
    finally:
        spark.conf.set(merge, "true")
    out = read_target(spark, target)
    assert out.count() == 301
    assert [tuple(r) for r in out.where("campaign_id = 'x'").select("channel_3", "channel_4", "channel_5").collect()] == [("fb_a", None, "pos-lite")]
    assert len(glob.glob(f"{facts}/month=*/batch=0/*.parquet")) == 3
    plan = build_mart(web, leads, ch, clean_leads=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan
