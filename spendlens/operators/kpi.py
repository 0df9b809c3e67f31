"""KPI operators (K-1 .. K-12, A-18).

Ratios are computed in double precision from exact (decimal/long) sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.derive import guarded_ratio, null_on_zero_ratio


def with_kpis(mart: DataFrame) -> DataFrame:
    """The four mart KPIs (K-1 .. K-4)."""
    return mart.withColumns({
        "cac_per_pos_lite_deal": guarded_ratio("total_spend_sales", "pos_lite_deals"),
        "cac_per_pos_lite_order_web": guarded_ratio("total_spend_web", "poslite_items_ordered"),
        "web_funnel_throughput": null_on_zero_ratio("poslite_items_ordered", "sessions"),
        "sales_funnel_throughput": null_on_zero_ratio("pos_lite_deals", "impressions"),
    })


def total_spend(df: DataFrame, by: Sequence[str], spend: str = "spend_value") -> DataFrame:
    """Total spend per grain (K-6)."""
    return df.groupBy(*by).agg(F.sum(spend).alias("total_spend"))


def conversion(df: DataFrame, num: str, den: str, by: Sequence[str] = (),
               name: str = "conversion") -> DataFrame:
    """Σnum / Σden per group, null when Σden is 0 (K-5 leads->meetings, K-10
    spend per lead)."""
    g = df.groupBy(*by) if by else df.groupBy()
    return (g.agg(F.sum(num).alias(f"sum_{num}"), F.sum(den).alias(f"sum_{den}"))
            .withColumn(name, null_on_zero_ratio(f"sum_{num}", f"sum_{den}")))


def segment_cac(df: DataFrame, by: Sequence[str], spend: str = "spend",
                success: str = "success") -> DataFrame:
    """Σspend / Σsuccess per segment (K-7 .. K-9, A-18); null without success."""
    return (df.groupBy(*by)
            .agg(F.sum(spend).alias("total_spend"), F.sum(success).alias("total_success"))
            .withColumn("cac", guarded_ratio("total_spend", "total_success")))


def step_conversion(df: DataFrame, steps: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Step-over-previous-step rates of a funnel (K-11): one row per group and
    step pair with the two totals and the rate."""
    g = df.groupBy(*by) if by else df.groupBy()
    tot = g.agg(*[F.sum(s).alias(s) for s in steps])
    pairs = list(zip(steps, steps[1:]))
    stacked = F.explode(F.array(*[
        F.struct(F.lit(a).alias("from_step"), F.lit(b).alias("to_step"),
                 F.col(a).cast("double").alias("from_total"),
                 F.col(b).cast("double").alias("to_total")) for a, b in pairs]))
    return (tot.select(*by, stacked.alias("p")).select(*by, "p.*")
            .withColumn("rate", null_on_zero_ratio("to_total", "from_total")))


def compare_segments(cac: DataFrame, segment_col: str, a, b) -> DataFrame:
    """Efficiency of segment ``a`` against ``b`` (K-12): ratio b/a and gain
    1 - a/b of their CACs, from one conditional aggregate."""
    ca = F.max(F.when(F.col(segment_col) == F.lit(a), F.col("cac")))
    cb = F.max(F.when(F.col(segment_col) == F.lit(b), F.col("cac")))
    return (cac.agg(ca.alias("cac_a"), cb.alias("cac_b"))
            .withColumn("times_better", null_on_zero_ratio("cac_b", "cac_a"))
            .withColumn("gain", F.lit(1.0) - null_on_zero_ratio("cac_a", "cac_b")))
