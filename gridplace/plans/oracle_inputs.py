"""DuckDB SQL for the test-table adapters (mirror of ``sources/testdata.py``).

Each entry is one CTE over the driver's pre-registered views.  ``with_ctes``
emits the CTEs a query needs, dependencies first.  The oracle SQL is an
independent, straightforward restatement of each report; it does not reuse
the Spark code.
"""

from __future__ import annotations

from gridplace.sources.testdata import (
    DATASET_PREFIXES,
    REPLICA_BYTES_PER_UNIT,
    REQUEST_BYTES_FACTOR,
    STATUS_BY_CODE,
    STATUS_BY_EVENT,
    TABLE_CODES,
    TABLE_LINESTATUS,
    USAGE_BYTES_FACTOR,
)


def q_name(k: str) -> str:
    return f"('Q' || CAST({k} AS VARCHAR) || CASE WHEN {k} % 11 = 0 THEN '_TEST' ELSE '' END)"


def rse_kind(k: str) -> str:
    return f"(CASE WHEN {k} % 5 = 0 THEN 'SCRATCHDISK' ELSE 'DATADISK' END)"


def rse_name(name: str, k: str) -> str:
    return f"({name} || '_' || {rse_kind(k)})"


def _case(expr: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"(CASE {expr} {whens} END)"


def _jobs_table(table: str) -> str:
    codes = ", ".join(f"'{c}'" for c in TABLE_CODES[table])
    cond = f"(o.o_orderstatus || l.l_returnflag) IN ({codes})"
    if table in TABLE_LINESTATUS:
        cond += f" AND l.l_linestatus = '{TABLE_LINESTATUS[table]}'"
    return f"""SELECT l.l_orderkey * 8 + l.l_linenumber AS pandaid,
       l.l_orderkey AS jeditaskid,
       {q_name('l.l_suppkey')} AS computingsite,
       l.l_shipdate AS modificationtime,
       CASE WHEN o.o_orderpriority < '3' THEN 'user' ELSE 'managed' END AS prodsourcelabel,
       {_case("o.o_orderstatus || l.l_returnflag", STATUS_BY_CODE)} AS jobstatus
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE {cond}"""


INPUTS: dict[str, tuple[tuple[str, ...], str]] = {}

for _t in TABLE_CODES:
    INPUTS[_t] = ((), _jobs_table(_t))

INPUTS["sup"] = ((), """SELECT s.s_suppkey, s.s_name, s.s_nationkey, s.s_acctbal, n.n_name, r.r_name
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""")

INPUTS["rses"] = ((), f"SELECT s_suppkey AS rse_id, {rse_name('s_name', 's_suppkey')} AS rse FROM supplier")

INPUTS["attrs"] = (("sup",), f"""SELECT s_suppkey AS rse_id, 'site' AS key, n_name AS value FROM sup
UNION ALL SELECT s_suppkey, 'cloud', r_name FROM sup WHERE s_suppkey % 7 <> 3
UNION ALL SELECT s_suppkey, 'type', {rse_kind('s_suppkey')} FROM sup
UNION ALL SELECT s_suppkey, 'tier', CAST(s_suppkey % 4 AS VARCHAR) FROM sup
UNION ALL SELECT s_suppkey, 'freespace', CAST(CAST(round(s_acctbal + 1000) AS BIGINT) AS VARCHAR) FROM sup""")

INPUTS["usage"] = ((), f"""SELECT s_suppkey AS rse_id, 'storage' AS source,
       CAST(round((s_acctbal + 1000) * 100) AS BIGINT) * {USAGE_BYTES_FACTOR} AS free FROM supplier
UNION ALL SELECT s_suppkey, 'accounting', CAST(0 AS BIGINT) FROM supplier
UNION ALL SELECT s_suppkey, 'expired', CAST(s_suppkey AS BIGINT) FROM supplier""")

INPUTS["requests"] = ((), f"""SELECT l.l_suppkey AS dest_rse_id, o.o_orderpriority AS activity,
       CAST(round(l.l_extendedprice * 100) AS BIGINT) * {REQUEST_BYTES_FACTOR} AS bytes
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")

INPUTS["distances"] = ((), """SELECT p.src AS src_rse_id, p.dst AS dest_rse_id,
       CAST(abs(s1.s_nationkey - s2.s_nationkey) % 12 AS INTEGER) AS agis_distance
FROM (
  WITH hub AS (SELECT l_orderkey AS h_orderkey, min(l_suppkey) AS h_suppkey FROM lineitem GROUP BY l_orderkey),
       pr AS (SELECT h.h_suppkey AS a, l.l_suppkey AS b FROM lineitem l JOIN hub h ON l.l_orderkey = h.h_orderkey
              WHERE l.l_suppkey <> h.h_suppkey)
  SELECT a AS src, b AS dst FROM pr
  UNION SELECT b, a FROM pr
  UNION SELECT s_suppkey, s_suppkey FROM supplier
) p JOIN supplier s1 ON s1.s_suppkey = p.src JOIN supplier s2 ON s2.s_suppkey = p.dst""")

INPUTS["collection_replicas"] = ((), f"""SELECT 'mc' AS scope, 'mc.' || CAST(l_partkey AS VARCHAR) AS name,
       l_suppkey AS rse_id, 'DATASET' AS did_type,
       CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) * {REPLICA_BYTES_PER_UNIT} AS bytes,
       CASE WHEN max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) = 1 THEN 'UNAVAILABLE' ELSE 'AVAILABLE' END AS state,
       max(CASE WHEN l_returnflag <> 'R' THEN l_shipdate END) AS accessed_at,
       max(l_shipdate) AS updated_at, min(l_shipdate) AS created_at,
       CAST(sum(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END) AS BIGINT) AS available_replicas_cnt,
       CAST(count(*) AS BIGINT) AS length,
       CAST(sum(CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) * {REPLICA_BYTES_PER_UNIT} AS available_bytes
FROM lineitem GROUP BY l_partkey, l_suppkey""")

INPUTS["replica_records"] = (("collection_replicas", "rses"), """SELECT c.scope, c.name, r.rse, c.rse_id, c.bytes, c.length,
       c.available_bytes, c.available_replicas_cnt AS available_length, c.state, c.created_at, c.updated_at, c.accessed_at
FROM collection_replicas c JOIN rses r ON c.rse_id = r.rse_id""")

INPUTS["rules_all"] = (("rses",), """SELECT concat('r', g.l_partkey, '-', g.l_suppkey, '-', g.rule_no) AS rule_id,
       'mc' AS scope, 'mc.' || CAST(g.l_partkey AS VARCHAR) AS name, r.rse AS rse_expression,
       g.created_at, g.updated_at, 'OK' AS state,
       CASE WHEN g.permanent THEN 'production' ELSE 'user' END AS account,
       CASE WHEN g.permanent THEN NULL ELSE g.updated_at END AS expires_at,
       CASE WHEN g.permanent THEN 'Production Output' ELSE 'User Subscriptions' END AS activity
FROM (SELECT h.*, n.rule_no, first_line <= 1 AND rule_no <= 2 - l_partkey % 2 AS permanent
      FROM (SELECT l_partkey, l_suppkey, min(l_linenumber) AS first_line, min(l_shipdate) AS created_at,
                   max(l_shipdate) AS updated_at
            FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_partkey, l_suppkey) h
      JOIN (VALUES (1), (2), (3)) n(rule_no) ON n.rule_no <= (l_partkey + l_suppkey) % 3 + 1) g
JOIN rses r ON r.rse_id = g.l_suppkey""")

INPUTS["tasks"] = ((), """SELECT o_orderkey AS jeditaskid, 'u' || CAST(o_custkey AS VARCHAR) AS username,
       CASE WHEN o_orderpriority < '4' THEN 'anal' WHEN o_orderpriority < '5' THEN 'prod' ELSE 'test' END AS tasktype,
       o_orderdate AS modificationtime,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS endtime
FROM orders""")

_prefix = _case("CAST(p.p_size % 3 AS VARCHAR)", {str(i): v for i, v in enumerate(DATASET_PREFIXES)})
INPUTS["task_datasets"] = ((), f"""SELECT l.l_orderkey AS jeditaskid,
       {_prefix} || '.' || p.p_brand || '.DAOD_' || p.p_type AS datasetname,
       CASE WHEN l.l_returnflag = 'R' THEN 'output' WHEN l.l_linenumber = 3 THEN 'log' ELSE 'input' END AS type,
       CASE WHEN l.l_linenumber >= 6 THEN l.l_linenumber END AS masterid
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""")

INPUTS["wanted"] = ((), "SELECT 'mc' AS scope, 'mc.' || p_partkey AS name FROM part WHERE p_size <= 10")

INPUTS["status_log"] = ((), f"""SELECT user_id AS pandaid, {_case('event_type', STATUS_BY_EVENT)} AS jobstatus,
       ts AS modificationtime, CASE WHEN value < 200 THEN 'user' ELSE 'managed' END AS prodsourcelabel
FROM events""")

INPUTS["active_jobs"] = ((), """SELECT c.c_custkey AS pandaid, c.c_custkey // 3 AS jeditaskid,
       'Q' || CAST(c.c_custkey % 10 AS VARCHAR) AS computingsite, e.last_ts AS modificationtime,
       'user' AS prodsourcelabel
FROM customer c LEFT JOIN (SELECT user_id, max(ts) AS last_ts FROM events GROUP BY user_id) e
  ON c.c_custkey = e.user_id""")

# Relational rows behind the two JSON documents.
INPUTS["sup_disks"] = (("sup",), f"""SELECT s.*, {rse_name('s.s_name', 's.s_suppkey')} AS own_rse,
       CASE WHEN s.s_suppkey % 10 = 0 THEN {rse_name('s.s_name', 's.s_suppkey')}
            ELSE COALESCE({rse_name('nx.s_name', 'nx.s_suppkey')}, {rse_name('s.s_name', 's.s_suppkey')}) END AS other_rse
FROM sup s LEFT JOIN supplier nx ON nx.s_suppkey = s.s_suppkey + 1""")

INPUTS["catalogue_rows"] = (("sup_disks",), f"""SELECT {q_name('s_suppkey')} AS queue, n_name AS site, CASE WHEN s_suppkey % 6 <> 1 THEN r_name END AS cloud,
       CAST(s_suppkey % 4 AS INTEGER) AS tier_level,
       CAST(round(CAST(s_acctbal / 1000 AS DECIMAL(38,12)), 2) AS DOUBLE) AS corepower,
       CAST(CASE WHEN s_suppkey % 9 <> 4 THEN s_nationkey % 8 + 1 END AS INTEGER) AS corecount,
       CAST(s_nationkey * 10 AS INTEGER) AS nodes,
       CAST(CASE WHEN s_suppkey % 3 = 1 THEN 0 WHEN s_suppkey % 3 = 2 THEN 3000 END AS INTEGER) AS transferringlimit,
       own_rse, other_rse
FROM sup_disks""")

INPUTS["storage_rows"] = (("sup_disks",), """SELECT own_rse AS rse,
       CASE WHEN s_suppkey % 13 = 6 THEN NULL ELSE s_acctbal END AS unlocked,
       CAST(s_suppkey % 50 AS DOUBLE) AS difference,
       CAST((s_nationkey + 1) * 1000 AS DOUBLE) AS total_storage,
       CAST(300 AS DOUBLE) AS min_space
FROM sup_disks""")


def with_ctes(names: list[str] | tuple[str, ...], extra: str = "") -> str:
    """``WITH`` clause holding the named inputs (and what they need), plus
    ``extra`` query-specific CTE text appended after them."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in INPUTS[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS (\n{INPUTS[n][1]}\n)" for n in order]
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n"
