"""Adapters from the driver's test tables to the placement inputs.

The driver's tables are a sales schema (``lineitem orders customer supplier
part nation region events``).  Each method below derives one input of the
placement operators from them with plain DataFrame operations, so the
derived tables grow with the test tables and every operator runs over
whole tables.  ``gridplace.plans.oracle`` holds the same definitions as
DuckDB SQL; the two must stay in step.

Mapping (see README):
  jobs            lineitem x orders: one job per line, a queue per supplier
  rses / attrs    supplier x nation x region: one storage endpoint per supplier
  usage           supplier account balance as free bytes
  requests        lineitem x orders: one transfer request per line
  distances       each line's supplier with its order's hub supplier (both
                  directions) plus every endpoint with itself
  replicas/rules  lineitem grouped by (part, supplier): one dataset per part
  tasks           orders; task inputs lineitem x part
  status log      events; active jobs customer x events
  JSON catalogues one queue / one storage record per supplier
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridplace.sources.readers import read_table

# Job status from o_orderstatus || l_returnflag.
STATUS_BY_CODE = {
    "FA": "running",
    "FN": "defined",
    "FR": "assigned",
    "OA": "activated",
    "ON": "starting",
    "OR": "transferring",
    "PA": "failed",
    "PN": "finished",
    "PR": "cancelled",
}

# Which job table holds which status.  Completed jobs are in
# the live archive table while their line is open (l_linestatus 'O') and in
# the long-term archive once it is closed ('F').
TABLE_CODES = {
    "jobs_active": ("FA", "OA", "ON", "OR"),
    "jobs_defined": ("FN", "FR"),
    "jobs_archived4": ("PA", "PN", "PR"),
    "jobs_archived": ("PA", "PN", "PR"),
}
TABLE_LINESTATUS = {"jobs_archived4": "O", "jobs_archived": "F"}

# Status-log status from the event type.
STATUS_BY_EVENT = {
    "click": "activated",
    "purchase": "running",
    "view": "starting",
    "signup": "defined",
    "error": "failed",
}

# The three dataset prefixes chosen by p_size % 3.
DATASET_PREFIXES = ("valid", "mc", "data")

REPLICA_BYTES_PER_UNIT = 20000000000  # bytes per unit of l_quantity
REQUEST_BYTES_FACTOR = 1009
USAGE_BYTES_FACTOR = 1000000007


def queue_name(suppkey: Column) -> Column:
    """'Q<suppkey>', with suffix '_TEST' on every 11th queue (test queues)."""
    return F.concat(
        F.lit("Q"), suppkey.cast("string"), F.when(suppkey % 11 == 0, F.lit("_TEST")).otherwise(F.lit(""))
    )


def rse_kind(suppkey: Column) -> Column:
    return F.when(suppkey % 5 == 0, F.lit("SCRATCHDISK")).otherwise(F.lit("DATADISK"))


def rse_name(s_name: Column, suppkey: Column) -> Column:
    return F.concat(s_name, F.lit("_"), rse_kind(suppkey))


def _case(expr: Column, mapping: dict[str, str]) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(expr == k, F.lit(v)) if out is None else out.when(expr == k, F.lit(v))
    return out


class TestTables:
    """Placement inputs derived from the test tables under ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, name, path=self.sf_dir)

    # --- jobs -------------------------------------------------------------

    def jobs(self, *tables: str) -> DataFrame:
        """The union of the named job tables as ONE scan of lineitem x orders.

        The tables are disjoint views of the same lines, so their UNION ALL
        is a single filtered scan; the membership filter is on the source
        columns and reaches both Parquet scans.
        """
        tables = tables or tuple(TABLE_CODES)
        codes = [c for t in tables for c in TABLE_CODES[t]]
        # implied single-column filters, so each scan is pruned before the join
        li = self.raw("lineitem").filter(F.col("l_returnflag").isin(*sorted({c[1] for c in codes}))).select(
            "l_orderkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_returnflag", "l_linestatus"
        )
        o = self.raw("orders").filter(F.col("o_orderstatus").isin(*sorted({c[0] for c in codes}))).select(
            "o_orderkey", "o_orderpriority", "o_orderstatus"
        )
        j = li.join(o, li.l_orderkey == o.o_orderkey)
        code = F.concat(F.col("o_orderstatus"), F.col("l_returnflag"))
        member = None
        for t in tables:
            cond = code.isin(*TABLE_CODES[t])
            if t in TABLE_LINESTATUS:
                cond = cond & (F.col("l_linestatus") == TABLE_LINESTATUS[t])
            member = cond if member is None else (member | cond)
        k = F.col("l_suppkey")
        return j.filter(member).select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("pandaid"),
            F.col("l_orderkey").alias("jeditaskid"),
            queue_name(k).alias("computingsite"),
            F.col("l_shipdate").alias("modificationtime"),
            F.when(F.col("o_orderpriority") < "3", F.lit("user")).otherwise(F.lit("managed")).alias("prodsourcelabel"),
            _case(code, STATUS_BY_CODE).alias("jobstatus"),
        )

    def job_tables(self, *tables: str) -> list[DataFrame]:
        """The named job tables, each read on its own."""
        return [self.jobs(t) for t in tables]

    def jobs_by_hour(self, *tables: str) -> list[DataFrame]:
        """The named job tables with jobs spread over their day: three hours
        per line number (``pandaid % 8``)."""
        at = F.col("modificationtime") + F.make_dt_interval(hours=(F.col("pandaid") % 8 * 3).cast("int"))
        return [t.withColumn("modificationtime", at) for t in self.job_tables(*tables)]

    @cached_property
    def wanted_datasets(self) -> DataFrame:
        """Identifiers of the datasets to score, as a dataset list holds them:
        those of the small parts, every other one without its scope."""
        p = self.raw("part").filter(F.col("p_size") <= 10)
        name = F.concat(F.lit("mc."), F.col("p_partkey").cast("string"))
        return p.select(F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("mc:"), name)).otherwise(name).alias("did"))

    # --- storage endpoints ------------------------------------------------

    @cached_property
    def _suppliers(self) -> DataFrame:
        s = self.raw("supplier")
        n = self.raw("nation").select("n_nationkey", "n_name", "n_regionkey")
        r = self.raw("region").select("r_regionkey", "r_name")
        return s.join(n, s.s_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)

    @cached_property
    def rses(self) -> DataFrame:
        """rses(rse_id, rse): the ``id2rse`` dimension."""
        s = self.raw("supplier")
        return s.select(F.col("s_suppkey").alias("rse_id"), rse_name(F.col("s_name"), F.col("s_suppkey")).alias("rse"))

    @cached_property
    def attrs(self) -> DataFrame:
        """rse_attr_map(rse_id, key, value); every 7th endpoint lacks 'cloud'."""
        k = F.col("s_suppkey")
        pairs = F.array(
            F.struct(F.lit("site").alias("key"), F.col("n_name").alias("value")),
            F.struct(F.lit("cloud").alias("key"), F.when(k % 7 != 3, F.col("r_name")).alias("value")),
            F.struct(F.lit("type").alias("key"), rse_kind(k).alias("value")),
            F.struct(F.lit("tier").alias("key"), (k % 4).cast("string").alias("value")),
            F.struct(
                F.lit("freespace").alias("key"),
                F.round(F.col("s_acctbal") + 1000).cast("bigint").cast("string").alias("value"),
            ),
        )
        return (
            self._suppliers.select(k.alias("rse_id"), F.inline(pairs))
            .filter(F.col("value").isNotNull())
        )

    @cached_property
    def usage(self) -> DataFrame:
        """rse_usage(rse_id, source, free)."""
        free = F.round((F.col("s_acctbal") + 1000) * 100).cast("bigint") * USAGE_BYTES_FACTOR
        pairs = F.array(
            F.struct(F.lit("storage").alias("source"), free.alias("free")),
            F.struct(F.lit("accounting").alias("source"), F.lit(0).cast("bigint").alias("free")),
            F.struct(F.lit("expired").alias("source"), F.col("s_suppkey").cast("bigint").alias("free")),
        )
        return self.raw("supplier").select(F.col("s_suppkey").alias("rse_id"), F.inline(pairs))

    @cached_property
    def requests(self) -> DataFrame:
        """requests(dest_rse_id, activity, bytes): one request per line."""
        li = self.raw("lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice")
        o = self.raw("orders").select("o_orderkey", "o_orderpriority")
        return li.join(o, li.l_orderkey == o.o_orderkey).select(
            F.col("l_suppkey").alias("dest_rse_id"),
            F.col("o_orderpriority").alias("activity"),
            (F.round(F.col("l_extendedprice") * 100).cast("bigint") * REQUEST_BYTES_FACTOR).alias("bytes"),
        )

    @cached_property
    def distances(self) -> DataFrame:
        """distances(src_rse_id, dest_rse_id, agis_distance).

        Pairs come from orders: every line's supplier with the order's hub
        supplier (its smallest supplier key), in both directions, plus each
        endpoint with itself.  One partner per line, so the table grows
        linearly with lineitem; the hub is a partial aggregate, so a huge
        order is no hot group.  distance = |nation difference| mod 12.
        """
        li = self.raw("lineitem").select("l_orderkey", "l_suppkey")
        hub = li.groupBy(F.col("l_orderkey").alias("h_orderkey")).agg(F.min("l_suppkey").alias("h_suppkey"))
        pairs = li.join(hub, F.col("l_orderkey") == F.col("h_orderkey")).filter(
            F.col("l_suppkey") != F.col("h_suppkey")
        )
        s = self.raw("supplier").select("s_suppkey", "s_nationkey")
        both = (
            pairs.select(F.col("h_suppkey").alias("src"), F.col("l_suppkey").alias("dst"))
            .unionByName(pairs.select(F.col("l_suppkey").alias("src"), F.col("h_suppkey").alias("dst")))
            .unionByName(s.select(F.col("s_suppkey").alias("src"), F.col("s_suppkey").alias("dst")))
            .distinct()
        )
        s1 = s.select(F.col("s_suppkey").alias("k1"), F.col("s_nationkey").alias("n1"))
        s2 = s.select(F.col("s_suppkey").alias("k2"), F.col("s_nationkey").alias("n2"))
        return (
            both.join(s1, F.col("src") == F.col("k1"))
            .join(s2, F.col("dst") == F.col("k2"))
            .select(
                F.col("src").alias("src_rse_id"),
                F.col("dst").alias("dest_rse_id"),
                (F.abs(F.col("n1") - F.col("n2")) % 12).cast("int").alias("agis_distance"),
            )
        )

    # --- replicas and rules -----------------------------------------------

    @cached_property
    def collection_replicas(self) -> DataFrame:
        """collection_replicas: one dataset per part, one replica per (part, supplier)."""
        li = self.raw("lineitem").select(
            "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_shipdate"
        )
        ok = F.col("l_returnflag") != "R"
        qty = F.col("l_quantity").cast("bigint")
        g = li.groupBy("l_partkey", "l_suppkey").agg(
            F.sum(qty).alias("q"),
            F.sum(F.when(ok, qty).otherwise(F.lit(0).cast("bigint"))).alias("aq"),
            F.max(F.when(~ok, 1).otherwise(0)).alias("has_r"),
            F.max(F.when(ok, F.col("l_shipdate"))).alias("accessed_at"),
            F.max("l_shipdate").alias("updated_at"),
            F.min("l_shipdate").alias("created_at"),
            F.sum(F.when(ok, 1).otherwise(0)).cast("bigint").alias("available_replicas_cnt"),
            F.count(F.lit(1)).alias("length"),
        )
        return g.select(
            F.lit("mc").alias("scope"),
            F.concat(F.lit("mc."), F.col("l_partkey").cast("string")).alias("name"),
            F.col("l_suppkey").alias("rse_id"),
            F.lit("DATASET").alias("did_type"),
            (F.col("q") * REPLICA_BYTES_PER_UNIT).alias("bytes"),
            F.when(F.col("has_r") == 1, F.lit("UNAVAILABLE")).otherwise(F.lit("AVAILABLE")).alias("state"),
            "accessed_at",
            "updated_at",
            "created_at",
            "available_replicas_cnt",
            "length",
            (F.col("aq") * REPLICA_BYTES_PER_UNIT).alias("available_bytes"),
        )

    @cached_property
    def replica_records(self) -> DataFrame:
        """The replica service's dataset-replica records (rse names resolved)."""
        r = self.collection_replicas.join(self.rses, "rse_id")
        return r.select(
            "scope", "name", "rse", "rse_id", "bytes", "length", "available_bytes",
            F.col("available_replicas_cnt").alias("available_length"),
            "state", "created_at", "updated_at", "accessed_at",
        )

    @cached_property
    def _rules(self) -> DataFrame:
        li = self.raw("lineitem").filter(F.col("l_linestatus") == "F").select(
            "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"
        )
        g = li.groupBy("l_partkey", "l_suppkey").agg(
            F.min("l_linenumber").alias("first_line"),
            F.min("l_shipdate").alias("created_at"),
            F.max("l_shipdate").alias("updated_at"),
        )
        g = g.join(self.rses, F.col("l_suppkey") == F.col("rse_id"))
        # one to three rules on an endpoint: all expiring, two permanent, or mixed
        n_rules = (F.col("l_partkey") + F.col("l_suppkey")) % 3 + 1
        g = g.select("*", F.explode(F.sequence(F.lit(1), n_rules.cast("int"))).alias("rule_no"))
        permanent = F.col("first_line") <= 1
        official = permanent & ((F.col("rule_no") == 1) | ((F.col("rule_no") == 2) & (F.col("l_partkey") % 2 == 0)))
        return g.select(
            F.concat_ws("-", F.concat(F.lit("r"), F.col("l_partkey").cast("string")), F.col("l_suppkey").cast("string"), F.col("rule_no").cast("string")).alias("rule_id"),
            F.lit("mc").alias("scope"),
            F.concat(F.lit("mc."), F.col("l_partkey").cast("string")).alias("name"),
            F.col("rse").alias("rse_expression"),
            "created_at",
            "updated_at",
            F.lit("OK").alias("state"),
            F.when(official, F.lit("production")).otherwise(F.lit("user")).alias("account"),
            F.when(official, F.lit(None)).otherwise(F.col("updated_at")).alias("expires_at"),
            F.when(official, F.lit("Production Output")).otherwise(F.lit("User Subscriptions")).alias("activity"),
        )

    @cached_property
    def rule_history(self) -> DataFrame:
        """Replication-rule history records."""
        return self._rules.select(
            "rule_id", "scope", "name", "rse_expression", "created_at", "updated_at", "state", "account"
        )

    @cached_property
    def rule_details(self) -> DataFrame:
        """Replication-rule detail records (one per rule id)."""
        return self._rules.select(
            F.col("rule_id").alias("id"), "scope", "name", "rse_expression", "account",
            F.lit("DATASET").alias("did_type"), F.lit(1.0).alias("copies"), "expires_at", "activity",
            F.lit(False).alias("split_container"), F.lit(False).alias("locked"),
            "state", "created_at", "updated_at",
        )

    # --- tasks --------------------------------------------------------------

    @cached_property
    def tasks(self) -> DataFrame:
        o = self.raw("orders")
        return o.select(
            F.col("o_orderkey").alias("jeditaskid"),
            F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("username"),
            F.when(F.col("o_orderpriority") < "4", F.lit("anal")).when(F.col("o_orderpriority") < "5", F.lit("prod"))
            .otherwise(F.lit("test")).alias("tasktype"),
            F.col("o_orderdate").alias("modificationtime"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("endtime"),
        )

    @cached_property
    def task_datasets(self) -> DataFrame:
        li = self.raw("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag")
        p = self.raw("part").select("p_partkey", "p_brand", "p_type", "p_size")
        prefix = _case((F.col("p_size") % 3).cast("string"), {str(i): v for i, v in enumerate(DATASET_PREFIXES)})
        return li.join(p, li.l_partkey == p.p_partkey).select(
            F.col("l_orderkey").alias("jeditaskid"),
            F.concat(prefix, F.lit("."), F.col("p_brand"), F.lit(".DAOD_"), F.col("p_type")).alias("datasetname"),
            F.when(F.col("l_returnflag") == "R", F.lit("output")).when(F.col("l_linenumber") == 3, F.lit("log"))
            .otherwise(F.lit("input")).alias("type"),
            F.when(F.col("l_linenumber") >= 6, F.col("l_linenumber")).alias("masterid"),
        )

    # --- status log -----------------------------------------------------------

    @cached_property
    def status_log(self) -> DataFrame:
        e = self.raw("events")
        return e.select(
            F.col("user_id").alias("pandaid"),
            _case(F.col("event_type"), STATUS_BY_EVENT).alias("jobstatus"),
            F.col("ts").alias("modificationtime"),
            F.when(F.col("value") < 200, F.lit("user")).otherwise(F.lit("managed")).alias("prodsourcelabel"),
        )

    @cached_property
    def active_jobs(self) -> DataFrame:
        """Active jobs for the queueing-time report: one per customer; its
        modification time is the customer's last event (NULL without events)."""
        c = self.raw("customer").select("c_custkey")
        last = self.raw("events").groupBy("user_id").agg(F.max("ts").alias("last_ts"))
        return c.join(last, c.c_custkey == last.user_id, "left").select(
            F.col("c_custkey").alias("pandaid"),
            F.floor(F.col("c_custkey") / 3).cast("bigint").alias("jeditaskid"),
            F.concat(F.lit("Q"), (F.col("c_custkey") % 10).cast("string")).alias("computingsite"),
            F.col("last_ts").alias("modificationtime"),
            F.lit("user").alias("prodsourcelabel"),
        )

    # --- JSON documents -----------------------------------------------------

    @cached_property
    def _supplier_disks(self) -> DataFrame:
        k = F.col("s_suppkey")
        nxt = self.raw("supplier").select(
            (F.col("s_suppkey") - 1).alias("prev_key"), rse_name(F.col("s_name"), F.col("s_suppkey")).alias("next_rse")
        )
        own = rse_name(F.col("s_name"), k)
        s = self._suppliers.join(nxt, k == F.col("prev_key"), "left")
        return s.select(
            "*",
            own.alias("own_rse"),
            F.when(k % 10 == 0, own).otherwise(F.coalesce(F.col("next_rse"), own)).alias("other_rse"),
        )

    @cached_property
    def catalogue_json(self) -> DataFrame:
        """Queue catalogue as JSON lines: ``{queue: {rc_site, cloud, ..., astorages}}``."""
        k = F.col("s_suppkey")
        attrs = F.struct(
            F.col("n_name").alias("rc_site"),
            F.when(k % 6 != 1, F.col("r_name")).alias("cloud"),
            (k % 4).cast("int").alias("tier_level"),
            F.round(F.col("s_acctbal") / 1000, 2).alias("corepower"),
            F.when(k % 9 != 4, (F.col("s_nationkey") % 8 + 1)).cast("int").alias("corecount"),
            (F.col("s_nationkey") * 10).cast("int").alias("nodes"),
            F.when(k % 3 == 1, F.lit(0)).when(k % 3 == 2, F.lit(3000)).cast("int").alias("transferringlimit"),
            F.create_map(
                F.lit("read_lan"), F.array(F.col("other_rse")),
                F.lit("write_lan"), F.array(F.col("own_rse"), F.col("own_rse")),
                F.lit("write_wan"), F.array(F.col("other_rse")),
            ).alias("astorages"),
        )
        return self._supplier_disks.select(F.to_json(F.create_map(queue_name(k), attrs)).alias("value"))

    @cached_property
    def storage_json(self) -> DataFrame:
        """Storage accounting as JSON lines: ``{rse: {metric: text}}``."""
        k = F.col("s_suppkey")
        metrics = F.create_map(
            F.lit("Unlocked"), F.when(k % 13 == 6, F.lit("n/a")).otherwise(F.col("s_acctbal").cast("string")),
            F.lit("Difference"), (k % 50).cast("string"),
            F.lit("Total(storage)"), ((F.col("s_nationkey") + 1) * 1000).cast("string"),
            F.lit("Min space"), F.lit("300"),
        )
        return self._supplier_disks.select(F.to_json(F.create_map(F.col("own_rse"), metrics)).alias("value"))
