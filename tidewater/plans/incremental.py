"""History kept between runs: new orders and reviews are counted, old ones are not read again
(A1-A6, W1-W3, T7-T9).

Two keyed tables of a warehouse hold the state: daily revenue per segment, and the moments of
each segment's days. A run adds its orders to the days they belong to (late ones too) and moves
the moments from the old to the new values of these days; other days' buckets stay as they are.

Three more hold the reviews' state, dealt to buckets by (product, month): sums per group, counts and
first appearance per distinct body (as hashes), and the top bodies with their texts. A run's reviews
are read once, and only groups with new reviews are summarised again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewater.functions import lexicon as lx
from tidewater.operators import revenue as R
from tidewater.operators import reviews as RV
from tidewater.sinks.commits import RunWrites
from tidewater.staging import staged

DAILY, MOMENTS = "state/daily_revenue", "state/revenue_moments"
COUNTS, BODIES, TOPS = "state/review_counts", "state/review_bodies", "state/review_tops"


def add_orders(writes: RunWrites, new_orders: DataFrame, rollups: bool = False) -> None:
    """Adds orders that no run has added before. Their days' sums and the segments' moments are
    written by ``writes``, so both become visible with the rest of its run. No orders change nothing."""
    delta = staged(R.daily_revenue_by_segment(new_orders, rollups=rollups), "daily-delta")
    if DAILY not in writes.tables:
        writes.replace_keyed(DAILY, delta, R.DAY)
        writes.replace_keyed(MOMENTS, R.segment_moments(delta), R.SEGMENT)
        return
    before = writes.read(DAILY).join(delta.select(*R.DAY), R.DAY, "left_semi").select(*delta.columns)
    after = staged(R.merge_daily(before, delta), "daily-after")
    change = R.merge_moments(writes.read(MOMENTS), R.segment_moments(after), R.segment_moments(before, sign=-1))
    writes.upsert(MOMENTS, change, R.SEGMENT, ignore=())
    writes.upsert(DAILY, after, R.DAY, ignore=())


def current_anomalies(writes: RunWrites, threshold: float = lx.ANOMALY_THRESHOLD_DEFAULT) -> DataFrame:
    """The anomalies of all days, from the state as ``writes`` sees it."""
    return R.anomalies_from_moments(writes.read(DAILY), writes.read(MOMENTS), threshold=threshold)


def add_reviews(writes: RunWrites, new_reviews: DataFrame) -> DataFrame:
    """Adds reviews that no run has added before to the state, which ``writes`` makes visible with the
    rest of its run. Returns the summaries (as ``summarize_reviews``) of the (product, month) groups
    that gained a review, to be put into the mart by its key. Reviews without a time belong to no month."""
    facts = staged(RV.review_facts(new_reviews), "review-facts")
    added = staged(RV.group_counts(facts), "review-counts")
    fresh = staged(RV.body_counts(facts), "review-bodies")
    counts, bodies, before = added, fresh, None
    if COUNTS in writes.tables:
        groups = added.select(*RV.GROUP)
        counts = staged(RV.merge_counts(added, writes.held(COUNTS, groups)), "review-counts")
        bodies = staged(RV.merge_bodies(fresh, writes.held(BODIES, fresh.select(*RV.BODY))), "review-bodies")
        before = writes.held(TOPS, groups)
    tops = staged(RV.top_bodies(bodies, fresh, facts, before), "review-tops")
    for table, rows, keys in ((COUNTS, counts, RV.GROUP), (BODIES, bodies, RV.BODY), (TOPS, tops, RV.TOP)):
        writes.upsert(table, rows, keys, ignore=(), deal=RV.GROUP)
    return RV.summaries_from_counts(counts, tops)
