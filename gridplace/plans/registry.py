"""Registered queries: ``key -> (spark, sf_dir) -> DataFrame``.

Each query derives its inputs from the test tables (``TestTables``) and
runs one library operator with the parameters of ``plans.params``.  All of
them read whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridplace.operators import candidates as CA
from gridplace.operators import catalogue as C
from gridplace.operators import daily_counts as D
from gridplace.operators import jobs as J
from gridplace.operators import latency as L
from gridplace.operators import popularity as POP
from gridplace.operators import popularity_sketches as PS
from gridplace.operators import queues as Q
from gridplace.operators import replicas as R
from gridplace.operators import scoring as SC
from gridplace.operators import shares as S
from gridplace.operators import topology as T
from gridplace.plans import params as P
from gridplace.session import materialize, materialize_all, new_folder, passing_folder
from gridplace.sources.commits import read_committed, write_committed
from gridplace.sources.nested import parse_queue_catalogue, parse_storage_json
from gridplace.sources.readers import read_dataset_list, read_records, read_snapshot, split_dataset_ids
from gridplace.sources.sinks import read_suggestions, write_snapshot, write_suggestions
from gridplace.sources.testdata import TestTables

Query = Callable[[SparkSession, str], DataFrame]

OCC_TABLES = ("jobs_active", "jobs_defined")
RECORDS_PER_FILE = 500_000
ALL_TABLES = ("jobs_active", "jobs_defined", "jobs_archived4", "jobs_archived")


def _occ_counts(tt: TestTables, as_of=P.JOBS_AS_OF, n_days=P.JOBS_DAYS, label=None) -> DataFrame:
    return J.job_status_counts(tt.jobs(*OCC_TABLES), as_of, n_days, J.OCCUPANCY_STATUSES, label=label)


def _metrics(tt: TestTables, as_of=P.JOBS_AS_OF, n_days=P.JOBS_DAYS) -> DataFrame:
    occ = Q.queue_occupancy(_occ_counts(tt, as_of, n_days), unsaturated=True)
    eff = Q.queue_efficiency(tt.jobs("jobs_archived4"), as_of, n_days)
    return Q.queues_metrics(occ, eff)


def q_job_status_counts(spark, sf_dir):
    return _occ_counts(TestTables(spark, sf_dir))


def q_queue_occupancy(spark, sf_dir):
    return Q.queue_occupancy(_occ_counts(TestTables(spark, sf_dir)))


def q_queue_occupancy_unsaturated(spark, sf_dir):
    return Q.queue_occupancy(_occ_counts(TestTables(spark, sf_dir)), unsaturated=True)


def q_queue_efficiency(spark, sf_dir):
    return Q.queue_efficiency(TestTables(spark, sf_dir).jobs("jobs_archived4"), P.JOBS_AS_OF, P.JOBS_DAYS)


def q_queues_metrics(spark, sf_dir):
    return _metrics(TestTables(spark, sf_dir))


def _shares(tt: TestTables) -> DataFrame:
    return S.job_shares_report(tt.jobs(*ALL_TABLES), P.JOBS_AS_OF, P.SHARES_DAYS, label=P.SHARES_LABEL)


def _queues(tt: TestTables) -> DataFrame:
    return parse_queue_catalogue(tt.catalogue_json)


def q_job_shares(spark, sf_dir):
    return _shares(TestTables(spark, sf_dir))


def q_queue_shares(spark, sf_dir):
    tt = TestTables(spark, sf_dir)
    eligible = C.eligible_queues(_queues(tt), P.SNAPSHOT_AS_OF, with_resources=False)
    return S.queue_shares(_shares(tt), eligible, P.SNAPSHOT_AS_OF)


def q_eligible_queues(spark, sf_dir):
    return C.eligible_queues(_queues(TestTables(spark, sf_dir)), P.SNAPSHOT_AS_OF)


def q_queue_site_rse(spark, sf_dir):
    return C.queue_site_rse(_queues(TestTables(spark, sf_dir)), P.SNAPSHOT_AS_OF)


def q_storage_info(spark, sf_dir):
    return C.storage_info(parse_storage_json(TestTables(spark, sf_dir).storage_json), P.SNAPSHOT_AS_OF)


def q_rse_topology(spark, sf_dir):
    tt = TestTables(spark, sf_dir)
    return T.rse_topology(tt.attrs, tt.rses)


def q_rse_free_space(spark, sf_dir):
    tt = TestTables(spark, sf_dir)
    return T.rse_free_space(tt.usage, tt.attrs, tt.rses, P.SNAPSHOT_AS_OF)


def q_rse_activities(spark, sf_dir):
    tt = TestTables(spark, sf_dir)
    return T.rse_activities(tt.requests, tt.attrs, tt.rses)


def q_rse_distances(spark, sf_dir):
    tt = TestTables(spark, sf_dir)
    return T.rse_distances(tt.distances, tt.attrs, tt.rses, P.SNAPSHOT_AS_OF)


def q_replica_locations(spark, sf_dir):
    tt = TestTables(spark, sf_dir)
    return T.replica_locations(tt.collection_replicas, tt.attrs, tt.rses)


def _replicas(tt: TestTables, datasets: DataFrame | None = None) -> DataFrame:
    return R.dataset_replicas(
        tt.replica_records, tt.rule_history, tt.rule_details, tt.attrs, tt.rses, P.SNAPSHOT_AS_OF, datasets=datasets
    )


def q_dataset_replicas(spark, sf_dir):
    return _replicas(TestTables(spark, sf_dir))


def q_dataset_popularity(spark, sf_dir):
    tt = TestTables(spark, sf_dir)
    return POP.dataset_popularity(
        tt.tasks, tt.task_datasets, P.POPULARITY_AS_OF, P.POPULARITY_DAYS, P.POPULARITY_MIN_TASKS
    )


def q_queueing_time(spark, sf_dir):
    tt = TestTables(spark, sf_dir)
    return L.queueing_time(tt.status_log, tt.active_jobs, P.LATENCY_AS_OF, P.LATENCY_DAYS, P.LATENCY_LABEL)


def _candidates(tt: TestTables) -> DataFrame:
    queues = C.eligible_queues(_queues(tt), P.SNAPSHOT_AS_OF)
    storage = C.storage_info(parse_storage_json(tt.storage_json), P.SNAPSHOT_AS_OF)
    return CA.merged_candidates(queues, _metrics(tt, P.JOBS_AS_OF, P.SCORING_DAYS), storage)


def _closeness(tt: TestTables) -> DataFrame:
    sources, distances = materialize_all(
        official_sources=CA.official_sources(_replicas(tt)), distances=T.endpoint_distances(tt.distances, tt.rses)
    )
    return CA.closeness(_candidates(tt), distances, sources)


def _weights(tt: TestTables, level: str, datasets: DataFrame | None = None, **options) -> DataFrame:
    """In the reference the inputs of the scoring are files written by
    separate jobs; here they are tables.  They are written one after the
    other, so that the shuffles of one are gone when the next begins, and
    deleted once the pairs and their candidate rows are written.  A dataset
    list already restricts the replicas that are written."""
    with passing_folder(tt.spark) as folder:
        distances, candidates = materialize_all(folder, distances=T.endpoint_distances(tt.distances, tt.rses), candidates=_candidates(tt))
        reps = materialize(_scoring_replicas(tt, folder, datasets), "replicas", folder)
        return SC.rse_weight(candidates, distances, reps, level=level, **options)


def _scoring_replicas(tt: TestTables, folder: str, datasets: DataFrame | None) -> DataFrame:
    return R.scoring_replicas(
        tt.replica_records, tt.rule_history, tt.rule_details, tt.attrs, tt.rses, datasets, lambda rules: materialize(rules, "rules", folder)
    )


def _wanted(tt: TestTables) -> DataFrame:
    return split_dataset_ids(tt.wanted_datasets)


def q_merged_candidates(spark, sf_dir):
    return _candidates(TestTables(spark, sf_dir))


def q_closeness(spark, sf_dir):
    return _closeness(TestTables(spark, sf_dir)).select(
        "source_replica", "queue", "rse", "site", "distance_from_source", "closeness"
    )


def q_mean_range_normalise(spark, sf_dir):
    cl = _closeness(TestTables(spark, sf_dir)).select("source_replica", "queue", "rse", *SC.CANDIDATE_METRICS)
    return SC.mean_range_normalise(cl, ["source_replica"], SC.CANDIDATE_METRICS)


def q_rse_weight(spark, sf_dir):
    return _weights(TestTables(spark, sf_dir), "queue")


def q_rse_weight_by_rse(spark, sf_dir):
    return _weights(TestTables(spark, sf_dir), "rse")


def q_rse_weight_selected(spark, sf_dir):
    """The variant behind a suggestion: thresholds, distance band, roll-up, listed datasets."""
    tt = TestTables(spark, sf_dir)
    return _weights(tt, "rse", thresholds=P.SELECTED_THRESHOLDS, band=P.SELECTED_BAND, datasets=_wanted(tt))


def q_replica_locations_selected(spark, sf_dir):
    tt = TestTables(spark, sf_dir)
    return T.replica_locations(tt.collection_replicas, tt.attrs, tt.rses, _wanted(tt))


def q_queue_occupancy_user(spark, sf_dir):
    return Q.queue_occupancy_report(TestTables(spark, sf_dir).job_tables(*OCC_TABLES), P.JOBS_AS_OF, P.SHARES_DAYS, label="user")


def q_queue_efficiency_user(spark, sf_dir):
    return Q.queue_efficiency_report(TestTables(spark, sf_dir).job_tables("jobs_archived4"), P.JOBS_AS_OF)


def q_job_shares_union(spark, sf_dir):
    """Job shares over four tables that are read on their own."""
    tables = TestTables(spark, sf_dir).job_tables(*ALL_TABLES)
    return S.job_shares_report(tables, P.JOBS_AS_OF, P.SHARES_DAYS, label=P.SHARES_LABEL)


# --- reports from partial counts and sketches ---------------------------------


def _daily(spark, sf_dir, names, statuses, label=None, exclude_test=False, count_col="pandaid") -> DataFrame:
    """Every day is counted into a table; the window then takes its whole days
    from there and the parts of a day at its ends from the jobs."""
    tables = TestTables(spark, sf_dir).jobs_by_hour(*names)
    daily = materialize(D.daily_status_counts(tables), "daily_counts")
    return D.job_status_counts_from_daily(daily, tables, P.DAILY_AS_OF, P.DAILY_DAYS, statuses, label, exclude_test, count_col)


def q_job_status_counts_daily(spark, sf_dir):
    return _daily(spark, sf_dir, OCC_TABLES, J.OCCUPANCY_STATUSES)


def q_queue_efficiency_daily(spark, sf_dir):
    return Q.efficiency_of(_daily(spark, sf_dir, ("jobs_archived4",), J.EFFICIENCY_STATUSES, exclude_test=True, count_col=None))


def q_job_shares_daily(spark, sf_dir):
    return S.job_shares(_daily(spark, sf_dir, ALL_TABLES, J.SHARE_STATUSES, label=P.SHARES_LABEL))


def q_dataset_popularity_sketched(spark, sf_dir):
    tt = TestTables(spark, sf_dir)
    stored = materialize(PS.popularity_sketches(tt.tasks, tt.task_datasets), "popularity_sketches")
    return PS.popularity_from_sketches(stored, P.POPULARITY_AS_OF, P.POPULARITY_DAYS, P.POPULARITY_MIN_TASKS)


# --- sources and sinks: written as they land, and read back ------------------------


def q_snapshot_read_back(spark, sf_dir):
    """The storage snapshot as CSV files with a row index."""
    info, path = q_storage_info(spark, sf_dir), new_folder(spark, "storage_csv")
    info.select(F.monotonically_increasing_id().alias(""), *[F.col(f"`{c}`") for c in info.columns]).write.option("header", True).csv(path)
    return read_snapshot(spark, path, info.schema)


def q_records_read_back(spark, sf_dir):
    """The replica records as JSON lines, packed: most of a line is names
    and digits that its neighbours have too.  A packed file is read by one
    task, so files are bounded."""
    records, path = TestTables(spark, sf_dir).replica_records, new_folder(spark, "replica_json")
    records.write.option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).json(path)
    return read_records(spark, path, records.schema)


def q_dataset_list_read_back(spark, sf_dir):
    """The dataset list as text."""
    path = new_folder(spark, "datasets_txt")
    TestTables(spark, sf_dir).wanted_datasets.write.text(path)
    return read_dataset_list(spark, path)


def q_snapshot_sink_read_back(spark, sf_dir):
    """Two days of the queue list, the first one written twice."""
    queues, path = _queues(TestTables(spark, sf_dir)), new_folder(spark, "queue_snapshots")
    first, second = P.SINK_DAYS
    for day in (first, second, first):
        write_snapshot(C.queue_site_rse(queues, day), path)
    schema = C.queue_site_rse(queues, first).schema
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def q_committed_snapshots_read_back(spark, sf_dir):
    """S7 with commit records: as above, and a run that was never committed."""
    queues, path = _queues(TestTables(spark, sf_dir)), new_folder(spark, "committed_snapshots")
    first, second = P.SINK_DAYS
    for day in (first, second, first):
        write_committed(C.queue_site_rse(queues, day), path)
    C.queue_site_rse(queues, second).write.partitionBy("datetime").parquet(f"{path}/runs/unfinished")
    return read_committed(spark, path)


def q_suggestions_read_back(spark, sf_dir):
    """One folder per dataset and source of the listed scoring."""
    weights, path = q_rse_weight_selected(spark, sf_dir), new_folder(spark, "suggestions")
    write_suggestions(weights, path)
    return read_suggestions(spark, path, weights.schema)


QUERIES: dict[str, Query] = {
    "job_status_counts": q_job_status_counts,
    "queue_occupancy": q_queue_occupancy,
    "queue_occupancy_unsaturated": q_queue_occupancy_unsaturated,
    "queue_efficiency": q_queue_efficiency,
    "queues_metrics": q_queues_metrics,
    "job_shares": q_job_shares,
    "queue_shares": q_queue_shares,
    "eligible_queues": q_eligible_queues,
    "queue_site_rse": q_queue_site_rse,
    "storage_info": q_storage_info,
    "rse_topology": q_rse_topology,
    "rse_free_space": q_rse_free_space,
    "rse_activities": q_rse_activities,
    "rse_distances": q_rse_distances,
    "replica_locations": q_replica_locations,
    "dataset_replicas": q_dataset_replicas,
    "dataset_popularity": q_dataset_popularity,
    "queueing_time": q_queueing_time,
    "merged_candidates": q_merged_candidates,
    "closeness": q_closeness,
    "mean_range_normalise": q_mean_range_normalise,
    "rse_weight": q_rse_weight,
    "rse_weight_by_rse": q_rse_weight_by_rse,
    "rse_weight_selected": q_rse_weight_selected,
    "replica_locations_selected": q_replica_locations_selected,
    "queue_occupancy_user": q_queue_occupancy_user,
    "queue_efficiency_user": q_queue_efficiency_user,
    "job_shares_union": q_job_shares_union,
    "job_status_counts_daily": q_job_status_counts_daily,
    "queue_efficiency_daily": q_queue_efficiency_daily,
    "job_shares_daily": q_job_shares_daily,
    "dataset_popularity_sketched": q_dataset_popularity_sketched,
    "snapshot_read_back": q_snapshot_read_back,
    "records_read_back": q_records_read_back,
    "dataset_list_read_back": q_dataset_list_read_back,
    "snapshot_sink_read_back": q_snapshot_sink_read_back,
    "committed_snapshots_read_back": q_committed_snapshots_read_back,
    "suggestions_read_back": q_suggestions_read_back,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)
