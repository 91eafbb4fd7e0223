"""Daily revenue by segment and z-score anomaly detection.

Plan shape: one aggregate over the order rows, then grouping sets over its
small result. The anomaly window then runs
on daily aggregates only: its partitions are (segment, metric) and its rows
are days, bounded by the calendar, not by the order volume.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions import lexicon as lx

SEGMENT_MONEY = "decimal(30,2)"
ALL = "all"


def daily_revenue_by_segment(orders: DataFrame, *, rollups: bool = False) -> DataFrame:
    """A1 + A2 (+ U1): per (day, channel, region) and per day (``all``/``all``).

    The order rows are scanned and summed once, per (day, channel, region);
    the coarser sets roll up that small result. Rows with a null
    channel or region leave the segment set (told apart from the rolled-up
    rows by ``grouping_id``) but count in the daily set; rows without a date
    are dropped; all-null sums become 0. ``rollups=True`` adds per
    (day, channel) and per (day, region) sets.
    Columns: order_date, channel, region, net_revenue_eur, units, n_orders.
    """
    base = orders.select(
        F.col("order_date").cast("date").alias("order_date"), "channel", "region",
        F.col("net_revenue_eur").cast("decimal(24,2)").alias("net_revenue_eur"),
        F.col("units").cast("long").alias("units"), "order_id",
    ).filter(F.col("order_date").isNotNull())
    sets = [["order_date", "channel", "region"], ["order_date"]]
    if rollups:
        sets += [["order_date", "channel"], ["order_date", "region"]]
    fine = base.groupBy("order_date", "channel", "region").agg(
        F.sum("net_revenue_eur").alias("net_revenue_eur"), F.sum("units").alias("units"),
        F.count("order_id").alias("n_orders"))
    agg = fine.groupingSets(sets, "order_date", "channel", "region").agg(
        F.sum("net_revenue_eur").alias("net_revenue_eur"), F.sum("units").alias("units"),
        F.sum("n_orders").alias("n_orders"), F.grouping_id().alias("gid"))
    # gid bits: 2 = channel rolled up, 1 = region rolled up.
    ch_all = (F.col("gid").bitwiseAND(F.lit(2)) != 0)
    rg_all = (F.col("gid").bitwiseAND(F.lit(1)) != 0)
    kept = agg.filter((ch_all | F.col("channel").isNotNull()) & (rg_all | F.col("region").isNotNull()))
    return kept.select(
        "order_date",
        F.when(ch_all, F.lit(ALL)).otherwise(F.col("channel")).alias("channel"),
        F.when(rg_all, F.lit(ALL)).otherwise(F.col("region")).alias("region"),
        F.coalesce(F.col("net_revenue_eur"), F.lit(0)).cast(SEGMENT_MONEY).alias("net_revenue_eur"),
        F.coalesce(F.col("units"), F.lit(0)).cast("long").alias("units"),
        F.coalesce(F.col("n_orders"), F.lit(0)).cast("long").alias("n_orders"))


def _dimension(channel, region):
    dim = (F.when((channel == ALL) & (region == ALL), F.lit("overall"))
           .when(region == ALL, F.lit("channel"))
           .when(channel == ALL, F.lit("region"))
           .otherwise(F.lit("channel_region")))
    value = (F.when(dim == "channel_region", F.concat(channel, F.lit("/"), region))
             .when(dim == "channel", channel)
             .otherwise(region))
    return dim, value


def detect_anomalies(segment_revenue: DataFrame, *,
                     threshold: float = lx.ANOMALY_THRESHOLD_DEFAULT) -> DataFrame:
    """W1 + W2: z-score of each day against its segment's whole history.

    Per (channel, region) x metric in (net_revenue_eur, units): mean and
    population std over all days including the day itself; segments with
    zero std yield nothing; |z| >= threshold is an anomaly, critical when
    |z| >= threshold + 2. Output follows the ``revenue_anomalies`` contract.
    """
    _checked(threshold)
    stacked = segment_values(segment_revenue).withColumn("value", F.col("exact").cast("double"))
    w = Window.partitionBy("channel", "region", "metric")
    stats = stacked.select("*", F.avg("value").over(w).alias("mu"),
                           F.stddev_pop("value").over(w).alias("sigma"))
    z = (F.col("value") - F.col("mu")) / F.col("sigma")
    scored = (stats.filter((F.col("sigma") > 0) & ~F.isnan("sigma") &
                           (F.abs(z) >= F.lit(float(threshold))))
              .select("*", z.alias("z")))
    return _anomaly_rows(scored, threshold)


def _checked(threshold: float) -> float:
    if not (lx.ANOMALY_THRESHOLD_MIN <= threshold <= lx.ANOMALY_THRESHOLD_MAX):
        raise ValueError(f"threshold must be within [{lx.ANOMALY_THRESHOLD_MIN}, "
                         f"{lx.ANOMALY_THRESHOLD_MAX}], got {threshold}")
    return float(threshold)


def segment_values(segment_revenue: DataFrame) -> DataFrame:
    """One row per (order_date, channel, region, metric) with its value, ``exact`` as decimal."""
    return segment_revenue.select(
        "order_date", "channel", "region",
        F.stack(F.lit(len(lx.ANOMALY_METRICS)),
                *[x for m in lx.ANOMALY_METRICS for x in (F.lit(m), F.col(m).cast(SEGMENT_MONEY))]
                ).alias("metric", "exact"))


def _anomaly_rows(scored: DataFrame, threshold: float) -> DataFrame:
    """Rows with ``exact``, ``mu`` and ``z`` in the form of the ``revenue_anomalies`` contract."""
    dim, dim_value = _dimension(F.col("channel"), F.col("region"))
    return scored.select(
        F.concat_ws(":", F.col("order_date").cast("string"), dim, dim_value, F.col("metric"))
         .alias("anomaly_id"),
        F.col("order_date").alias("detected_date"),
        dim.alias("dimension"),
        dim_value.alias("dimension_value"),
        "metric",
        F.col("exact").alias("observed_value"),
        F.round("mu", 2).cast(SEGMENT_MONEY).alias("expected_value"),
        F.round("z", 3).cast("decimal(10,3)").alias("deviation"),
        F.when(F.col("z") > 0, F.lit("spike")).otherwise(F.lit("drop")).alias("direction"),
        F.when(F.abs("z") >= F.lit(float(threshold + lx.ANOMALY_CRITICAL_MARGIN)),
               F.lit("critical")).otherwise(F.lit("warning")).alias("severity"),
    )


# ── history that grows day by day ───────────────────────────────────────────
DAY = ["order_date", "channel", "region"]
SEGMENT = ["channel", "region", "metric"]
CENTS = "decimal(38,0)"


def merge_daily(*parts: DataFrame) -> DataFrame:
    """Daily revenue tables added up: sums of disjoint sets of orders are the sums of all of them."""
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy(*DAY).agg(F.sum("net_revenue_eur").cast(SEGMENT_MONEY).alias("net_revenue_eur"),
                                  F.sum("units").cast("long").alias("units"), F.sum("n_orders").cast("long").alias("n_orders"))


def segment_moments(segment_revenue: DataFrame, sign: int = 1) -> DataFrame:
    """A6 in a form that adds up: per segment and metric ``n`` days, ``total`` and ``squares`` of their
    values in hundredths, as whole decimals, so nothing is rounded. ``sign=-1`` takes days away."""
    hundredths = (F.col("exact") * 100).cast(CENTS)
    return segment_values(segment_revenue).groupBy(*SEGMENT).agg(
        (F.lit(sign) * F.count(F.lit(1))).alias("n"), F.sum(F.lit(sign) * hundredths).cast(CENTS).alias("total"),
        F.sum((F.lit(sign) * hundredths * hundredths).cast(CENTS)).cast(CENTS).alias("squares"))


def merge_moments(*parts: DataFrame) -> DataFrame:
    """Moments added up; segments without days left drop out."""
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy(*SEGMENT).agg(F.sum("n").alias("n"), F.sum("total").cast(CENTS).alias("total"),
                                      F.sum("squares").cast(CENTS).alias("squares")).where("n > 0")


def anomalies_from_moments(segment_revenue: DataFrame, moments: DataFrame, *,
                           threshold: float = lx.ANOMALY_THRESHOLD_DEFAULT) -> DataFrame:
    """W1 + W2 as detect_anomalies, with mean and deviation from kept moments instead of a pass over
    all days: z = (n x - total) / sqrt(n squares - total^2), whose parts are whole numbers. Values
    are exact up to totals of 10^17; beyond, the job fails instead of rounding unseen."""
    _checked(threshold)
    spread = (F.col("n") * F.col("squares")).cast(CENTS) - (F.col("total") * F.col("total")).cast(CENTS)
    known = moments.withColumn("spread", spread.cast(CENTS)).where("spread > 0").select(*SEGMENT, "n", "total", "spread")
    rows = segment_values(segment_revenue).join(known, SEGMENT)
    off = (F.col("n") * (F.col("exact") * 100).cast(CENTS)).cast(CENTS) - F.col("total")
    scored = rows.withColumn("z", off.cast("double") / F.sqrt(F.col("spread").cast("double"))).withColumn(
        "mu", F.col("total").cast("double") / F.col("n") / 100).where(F.abs("z") >= F.lit(float(threshold)))
    return _anomaly_rows(scored, threshold)


def daily_revenue_by_region(orders: DataFrame) -> DataFrame:
    """Net revenue per (order_date, region) for the revenue chart."""
    return (orders.groupBy("order_date", "region")
            .agg(F.coalesce(F.sum("net_revenue_eur"), F.lit(0)).cast(SEGMENT_MONEY)
                 .alias("net_revenue_eur")))
