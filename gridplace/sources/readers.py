"""Scans (survey 2.1, S1, S2, S5, S6).

All readers take an explicit schema or read a self-describing format, so no
production path infers types.  Filters and projections applied to the
returned DataFrames reach the Parquet/JDBC scan through Catalyst.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridplace.functions import dataset_name, dataset_scope
from gridplace.session import materialize

#: Characters of a malformed line that an error message repeats.
SHOWN_CHARS = 200
_CORRUPT = "_corrupt_record"


def read_table(
    spark: SparkSession,
    name: str,
    path: str | None = None,
    jdbc: dict | None = None,
) -> DataFrame:
    """A job/topology table from Parquet (``path/name.parquet``) or JDBC.

    For JDBC pass ``jdbc={'url':..., 'partitionColumn':..., 'lowerBound':...,
    'upperBound':..., 'numPartitions':...}`` so the scan is split across
    executors instead of running as one connection.
    """
    if jdbc is not None:
        reader = spark.read.format("jdbc").option("dbtable", name)
        for k, v in jdbc.items():
            reader = reader.option(k, v)
        return reader.load()
    if path is None:
        raise ValueError("read_table needs a path or jdbc options")
    return spark.read.parquet(f"{path.rstrip('/')}/{name}.parquet")


def read_snapshot(
    spark: SparkSession, path: str, schema: T.StructType, has_index: bool = True
) -> DataFrame:
    """A CSV snapshot, or a folder of them; the unnamed leading row-index
    column is dropped.

    Paths containing ':' cannot be read by Spark; snapshots are stored under
    names without it (dataset identifiers become partition values instead).
    In every file, a header with other names or another order is an error,
    and so is a cell that is not of its column's type: each task compares the
    header of each file it opens (``enforceSchema=false``) with all columns,
    whichever of them the query uses.
    """
    index = [T.StructField("", T.LongType(), True)] if has_index else []
    fields = [*index, *schema.fields]
    header = spark.read.option("header", True).csv(path).columns  # the first file, before any task runs
    if header != ["_c0"] * has_index + schema.names:
        raise ValueError(f"{path}: columns {header} instead of {schema.names}")
    df = (
        spark.read.schema(T.StructType(fields))
        .option("header", True)
        .option("enforceSchema", False)
        .option("columnPruning", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return df.toDF("_c0", *schema.names).drop("_c0") if has_index else df


def parse_records(lines: DataFrame, schema: T.StructType | str) -> DataFrame:
    """JSON text lines (file, value) -> file, value, ok, record.

    ``ok`` is false for a line that is not one JSON object, that is cut off,
    or that has a value of another type than its field; then no part of the
    record is kept.  Missing fields are NULL, unknown fields are ignored and
    blank lines are no records.
    """
    struct = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    checked = T.StructType([*struct.fields, T.StructField(_CORRUPT, T.StringType())])
    record = F.from_json("value", checked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    # the parser stops behind the first value: one line must be one element of an array
    values = F.from_json(F.concat(F.lit("["), F.col("value"), F.lit("]")), "array<string>", {"mode": "PERMISSIVE"})
    whole = F.coalesce(F.size(values) == 1, F.lit(False)) & F.col("value").rlike(r"^\s*\{")
    ok = F.col("whole") & F.col("parsed").isNotNull() & F.col(f"parsed.{_CORRUPT}").isNull()
    return (
        lines.filter(F.trim("value") != "").select("file", "value", record.alias("parsed"), whole.alias("whole"))
        .select("file", "value", ok.alias("ok"), F.when(ok, F.struct(*[F.col("parsed")[n].alias(n) for n in struct.names])).alias("record"))
    )


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")


def read_records(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Landed API records (replicas, rules, rule details, rse attributes)
    as JSON lines.

    A malformed line (see ``parse_records``) is an error that names its file,
    also for a query that uses none of its fields.  ``land_records`` is the
    reader that goes on without such lines and keeps them.
    """
    parsed = parse_records(_lines(spark, path), schema)
    said = F.concat(F.lit("malformed record in "), F.col("file"), F.lit(": "), F.substring("value", 1, SHOWN_CHARS))
    strict = F.when(F.col("ok"), F.lit(True)).otherwise(F.raise_error(said).cast("boolean"))
    return parsed.filter(strict).select("record.*")


@dataclass(frozen=True)
class LandedRecords:
    """The records of one landing, its malformed lines (file, value) and how
    many there are of each."""

    records: DataFrame
    rejected: DataFrame
    n_records: int
    n_rejected: int


def land_records(
    spark: SparkSession, path: str, schema: T.StructType | str, rejected_path: str | None = None, max_rejected: float = 1.0
) -> LandedRecords:
    """S5 with a second output: the lines are parsed once into a table, the
    malformed ones are kept as they are (and written to ``rejected_path`` as
    Parquet), and both are counted.

    More than ``max_rejected`` of all lines malformed is an error; the
    rejected lines are written before it is raised.
    """
    parsed = materialize(parse_records(_lines(spark, path), schema), "landed_records")
    counts = {r["ok"]: r["n"] for r in parsed.groupBy("ok").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    good, bad = counts.get(True, 0), counts.get(False, 0)
    rejected = parsed.filter(~F.col("ok")).select("file", "value")
    if rejected_path is not None:
        rejected.write.mode("overwrite").parquet(rejected_path)
    if bad > max_rejected * (good + bad):
        raise ValueError(f"{path}: {bad} of {good + bad} records are malformed")
    return LandedRecords(parsed.filter("ok").select("record.*"), rejected, good, bad)


def read_dataset_list(spark: SparkSession, path: str) -> DataFrame:
    """One ``scope:name`` per line -> (did, scope, name).

    The list becomes a join key, so every listed dataset is scored in one job
    rather than one process run per dataset.
    """
    return split_dataset_ids(spark.read.text(path).select(F.trim("value").alias("did")).filter(F.col("did") != ""))


def split_dataset_ids(dids: DataFrame) -> DataFrame:
    """did -> (did, scope, name)."""
    return dids.select("did", dataset_scope("did").alias("scope"), dataset_name("did").alias("name"))
