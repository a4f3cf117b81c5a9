import datetime as dt

import pytest

from gridplace.operators import jobs as J
from gridplace.operators import queues as Q
from gridplace.operators import shares as S

AS_OF = "1998-07-01"
T = dt.datetime(1998, 6, 30)
SCHEMA = "pandaid long, computingsite string, jobstatus string, modificationtime timestamp_ntz, prodsourcelabel string"


def jobs(spark, rows):
    return spark.createDataFrame([(p, q, s, t or T, lab or "user") for p, q, s, t, lab in rows], SCHEMA)


def test_pivot_keeps_queue_with_unlisted_statuses_and_counts_non_null_ids(spark):
    a = jobs(spark, [(1, "Q1", "running", None, None), (None, "Q1", "running", None, None),
                     (2, "Q2", "closed", None, None), (3, "Q1", "running", dt.datetime(1998, 1, 1), None)])
    d = jobs(spark, [(4, "Q1", "defined", None, None)])
    c = {r.queue: r for r in J.job_status_counts([a, d], AS_OF, 7).collect()}
    assert c["Q1"].running == 1 and c["Q1"].defined == 1 and c["Q1"].assigned is None
    assert c["Q2"].running is None  # row kept, all NULL
    assert c["Q1"].datetime == dt.date(1998, 6, 28)


def test_occupancy_zero_when_no_activated(spark):
    a = jobs(spark, [(i, "Q1", "running", None, None) for i in range(29)]
             + [(100 + i, "Q2", s, None, None) for i, s in enumerate(["running"] * 4 + ["activated"] * 2 + ["assigned"] * 8)])
    occ = {r.queue: r for r in Q.queue_occupancy(J.job_status_counts(a, AS_OF, 7)).collect()}
    assert occ["Q1"].queue_occupancy == 0.0 and occ["Q1"].queued == 0
    # Q2: (4+1)/((2+8+0+0+10) * greatest(1, least(2, 8/2))) = 5/40
    assert occ["Q2"].queue_occupancy == pytest.approx(0.13)


def test_unsaturated_filter(spark):
    a = jobs(spark, [(1, "Q1", "running", None, None), (2, "Q1", "defined", None, None), (3, "Q1", "defined", None, None),
                     (4, "Q1", "defined", None, None), (5, "Q2", "running", None, None)])
    keep = [r.queue for r in Q.queue_occupancy(J.job_status_counts(a, AS_OF, 7), unsaturated=True).collect()]
    assert keep == ["Q2"]


def test_efficiency_null_failed_gives_zero_and_test_queues_dropped(spark):
    a = jobs(spark, [(1, "Q1", "finished", None, None), (2, "Q1", "finished", None, None),
                     (3, "Q2", "finished", None, None), (4, "Q2", "failed", None, None),
                     (5, "Q3_TEST", "finished", None, None)])
    e = {r.queue: r for r in Q.queue_efficiency(a, AS_OF, 7).collect()}
    assert set(e) == {"Q1", "Q2"}
    assert e["Q1"].failed is None and e["Q1"].queue_efficiency == 0.0
    assert e["Q2"].queue_efficiency == 0.5
    e2 = {r.queue: r for r in Q.queue_efficiency(a, AS_OF, 7, null_as_zero=True).collect()}
    assert e2["Q1"].queue_efficiency == 1.0


def test_shares_sum_to_one_and_zero_total_is_null(spark):
    rows = [(i, f"Q{i % 3}", s, None, None) for i, s in enumerate(["running", "defined", "finished"] * 7)]
    sh = S.job_shares_report(jobs(spark, rows), AS_OF, 7).collect()
    assert sum(r.total_share for r in sh) == pytest.approx(1.0, abs=1e-5)
    assert sum(r.running_share for r in sh) == pytest.approx(1.0, abs=1e-5)
    only_queued = S.job_shares_report(jobs(spark, [(1, "Q1", "defined", None, None)]), AS_OF, 7).collect()
    assert only_queued[0].running_share is None and only_queued[0].queued_share == 1.0
