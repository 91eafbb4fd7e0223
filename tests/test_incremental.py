"""Revenue history kept between runs against a pass over everything."""

import random
import tempfile
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewater.operators import revenue as R
from tidewater.operators import reviews as RV
from tidewater.plans import incremental as I
from tidewater.sinks import commits as CM

ORDERS = "order_id string, order_date string, channel string, region string, net_revenue_eur decimal(24,2), units long"


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tidewater-test-", dir="/tmp")


def _orders(spark, n=1500, seed=1):
    rng = random.Random(seed)
    rows = [(f"o{k}", f"2026-07-{rng.randint(1, 28):02}", rng.choice(["web", "shop", None]), rng.choice(["EU", "FR"]),
             Decimal(rng.randint(-500, 30000)) / 100, rng.randint(0, 5)) for k in range(n)]
    rows += [(f"s{k}", "2026-07-05", "web", "EU", Decimal("90000.10"), 900) for k in range(3)]
    rows += [(f"c{d}", f"2026-07-{d:02}", "flat", "EU", Decimal("10.00"), 1) for d in range(1, 20)]  # no spread: no anomaly
    rows += [("n", None, "web", "EU", Decimal("5.00"), 1)]
    return spark.createDataFrame(rows, ORDERS)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("rollups", [False, True])
def test_state_equals_a_full_pass(spark, scratch, rollups):
    orders = _orders(spark).withColumn("part", F.crc32("order_id") % 3).cache()
    for part in range(3):  # late orders of every day in each delivery
        writes = CM.RunWrites(spark, scratch, f"r{part}")
        I.add_orders(writes, orders.where(F.col("part") == part), rollups)
        writes.publish()
        daily = R.daily_revenue_by_segment(orders.where(F.col("part") <= part), rollups=rollups)
        assert _rows(CM.read_table(spark, scratch, I.DAILY)) == _rows(daily)
        assert _rows(CM.read_table(spark, scratch, I.MOMENTS)) == _rows(R.segment_moments(daily))
        got = _rows(I.current_anomalies(CM.RunWrites(spark, scratch), 2.0))
        assert got == _rows(R.detect_anomalies(daily, threshold=2.0)) and not any("flat" in r[3] for r in got)
    assert got
    unseen = CM.RunWrites(spark, scratch, "none")
    I.add_orders(unseen, orders.limit(0), rollups)
    assert unseen.publish() == 3 or _rows(unseen.read(I.DAILY)) == _rows(daily)


def test_one_day_touches_its_buckets(spark, scratch):
    orders = _orders(spark).where("order_date IS NOT NULL")
    writes = CM.RunWrites(spark, scratch, "a")
    I.add_orders(writes, orders)
    writes.publish()
    before = CM.read_commit(spark, scratch)["tables"][I.DAILY]["buckets"]
    writes = CM.RunWrites(spark, scratch, "b")
    I.add_orders(writes, spark.createDataFrame([("x", "2026-07-30", "web", "EU", Decimal("7.00"), 1)], ORDERS))
    writes.publish()
    after = CM.read_commit(spark, scratch)["tables"][I.DAILY]["buckets"]
    assert sum(before.get(b) != v for b, v in after.items()) <= 2  # its segment and the day's total


def test_money_is_not_rounded(spark):
    days = [(f"2026-07-{d:02}", "web", "EU", Decimal("900000000000000.01") + (Decimal("1e15") if d == 9 else 0), 1, 1) for d in range(1, 21)]
    daily = spark.createDataFrame(days, "order_date string, channel string, region string, net_revenue_eur decimal(30,2), units long, n_orders long").withColumn(
        "order_date", F.col("order_date").cast("date"))
    for found in (R.detect_anomalies(daily), R.anomalies_from_moments(daily, R.segment_moments(daily))):
        assert [r.observed_value for r in found.collect()] == [Decimal("1900000000000000.01")]


def test_moments_take_days_away(spark):
    daily = R.daily_revenue_by_segment(_orders(spark))
    some = daily.where("order_date < '2026-07-10'")
    left = R.merge_moments(R.segment_moments(daily), R.segment_moments(some, sign=-1))
    assert _rows(left) == _rows(R.segment_moments(daily.where("order_date >= '2026-07-10'")))
    assert R.merge_moments(R.segment_moments(some), R.segment_moments(some, sign=-1)).count() == 0


REVIEWS = "review_id string, product_id string, created_at timestamp_ntz, rating int, title string, body string, language string"


def _reviews(spark, n=600, seed=3):
    rng = random.Random(seed)
    bodies = [f"Body {k} price is great and delivery was late" for k in range(12)] + ["", None]
    rows = [(f"r{k:04}", rng.choice(["p1", "p2", "p3", None]), datetime(2026, rng.randint(1, 3), rng.randint(1, 5)), rng.choice([1, 3, 5, None]),
             rng.choice(["Broken", "Battery", None]), rng.choice(bodies), rng.choice(["en", "fr", "de", None])) for k in range(n)]
    rows += [("x1", "p1", None, 3, "t", "no time", "en"), ("x2", "p9", datetime(2026, 1, 1), None, None, None, None)]
    return spark.createDataFrame(rows, REVIEWS)


def _summaries(df):
    return sorted((str(tuple(r)) for r in df.collect()))


def test_review_state_equals_a_full_pass(spark, scratch):
    reviews = _reviews(spark).withColumn("part", F.crc32("review_id") % 3).cache()
    for part in range(3):
        writes = CM.RunWrites(spark, scratch, f"r{part}")
        writes.upsert("mart/review_summaries", I.add_reviews(writes, reviews.where(F.col("part") == part)), RV.GROUP)
        writes.publish()
        full = RV.summarize_reviews(reviews.where(F.col("part") <= part))
        assert _summaries(CM.read_table(spark, scratch, "mart/review_summaries")) == _summaries(full)
    facts = RV.review_facts(reviews)
    assert _summaries(CM.read_table(spark, scratch, I.BODIES)) == _summaries(RV.body_counts(facts))
    assert _summaries(CM.read_table(spark, scratch, I.COUNTS)) == _summaries(RV.group_counts(facts))
    none = CM.RunWrites(spark, scratch, "none")
    assert I.add_reviews(none, reviews.limit(0)).count() == 0


def test_one_review_touches_its_group(spark, scratch):
    writes = CM.RunWrites(spark, scratch, "a")
    I.add_reviews(writes, _reviews(spark))
    writes.publish()
    before = CM.read_commit(spark, scratch)["tables"]
    writes = CM.RunWrites(spark, scratch, "b")
    late = spark.createDataFrame([("a0", "p1", datetime(2026, 2, 1), 5, "Broken", "A body of its own", "en")], REVIEWS)
    changed = I.add_reviews(writes, late)
    writes.publish()
    assert [(r.product_id, r.review_window) for r in changed.collect()] == [("p1", "2026-02")]
    after = CM.read_commit(spark, scratch)["tables"]
    for name in (I.COUNTS, I.BODIES):
        assert sum(before[name]["buckets"].get(b) != v for b, v in after[name]["buckets"].items()) == 1
    assert after[I.TOPS] == before[I.TOPS] and after[I.BODIES]["rows"] == before[I.BODIES]["rows"] + 1
