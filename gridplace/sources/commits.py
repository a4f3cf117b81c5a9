"""Snapshots with a commit record (survey 2.1, S7 and S8).

Dynamic partition overwrite replaces the partitions of a table one after the
other, so a reader can see half of a run, and a failed run leaves what it had
replaced.  Here a run writes its files into a folder of its own and then ONE
small commit record, which names the run and the stamps (partition values) it
replaces.  Readers take the record as the truth: a stamp's rows are those of
the last committed run that holds it, and files without a record are ignored.

    path/runs/<run>/<stamp>=<value>/part-*     the files of a run
    path/commits/<number>                      its record, one line of JSON

Records are numbered and put in place by a rename, which on HDFS fails if the
number is taken: two runs that end together both get a place.  On a store
whose rename overwrites, let one writer at a time commit to a table.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUNS, COMMITS = "runs", "commits"
MOST_STAMPS = 10_000


class _Folder:
    """The few file-system calls a commit needs, through Spark's Hadoop."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm = spark._jvm
        self.path = path.rstrip("/")
        self.fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, folder: str) -> list[str]:
        at = self._at(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> bool:
        """Write a new file whole; false if there is one of that name."""
        draft = self._at(f"{COMMITS}/.draft-{uuid.uuid4().hex}")
        stream = self.fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        if not self.fs.exists(self._at(name)) and self.fs.rename(draft, self._at(name)):
            return True
        self.fs.delete(draft, False)
        return False

    def delete(self, name: str) -> None:
        self.fs.delete(self._at(name), True)


def _shown(value) -> str | None:
    return None if value is None else value.isoformat() if isinstance(value, (dt.date, dt.datetime)) else str(value)


def commits(spark: SparkSession, path: str) -> list[dict]:
    """The records of a snapshot table, oldest first: run, partition_by,
    stamps (lists of values as text; None: all), schema."""
    folder = _Folder(spark, path)
    return [json.loads(folder.read(f"{COMMITS}/{name}")) for name in folder.names(COMMITS) if not name.startswith(".")]


def write_committed(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("datetime",),
    stamps: Sequence[dict] | None = None,
    replace: str = "stamps",
    fmt: str = "parquet",
) -> str:
    """Write ``df`` as one run and commit it; returns the run's name.

    ``replace='stamps'``: the run replaces the stamps that its rows have, for
    tables stamped by day (the record lists them, at most ``MOST_STAMPS``).
    ``stamps`` names them (dicts of partition values) when some may have no
    rows: those become empty.  ``replace='all'``: the run is the whole table
    from now on, for tables of any number of partitions, such as suggestions
    per dataset and source.  If writing fails, nothing is committed and
    readers see the table as it was; the files stay under ``runs`` until
    ``drop_uncommitted``.
    """
    if replace not in ("stamps", "all"):
        raise ValueError(f"unknown replacement {replace!r}")
    spark = df.sparkSession
    run = uuid.uuid4().hex
    df.write.partitionBy(*partition_by).format(fmt).save(f"{path.rstrip('/')}/{RUNS}/{run}")
    if replace == "all":
        values = None
    elif stamps is None:
        # one row per stamp of this run, from the files just written
        found = _read_run(spark, path, run, df.schema, fmt).select(*partition_by).distinct().limit(MOST_STAMPS + 1).collect()
        if len(found) > MOST_STAMPS:
            raise ValueError(f"more than {MOST_STAMPS} stamps in one run: use replace='all'")
        values = [[_shown(r[c]) for c in partition_by] for r in found]
    else:
        values = [[_shown(s[c]) for c in partition_by] for s in stamps]
    record = json.dumps({"run": run, "partition_by": list(partition_by), "stamps": values, "schema": json.loads(df.schema.json()), "format": fmt})
    folder = _Folder(spark, path)
    folder.fs.mkdirs(folder._at(COMMITS))
    while True:
        taken = [n for n in folder.names(COMMITS) if not n.startswith(".")]
        number = int(taken[-1]) + 1 if taken else 0
        if folder.put(f"{COMMITS}/{number:012d}", record):
            return run


def _read_run(spark: SparkSession, path: str, run: str, schema: T.StructType, fmt: str) -> DataFrame:
    # a run without rows has no part file, but an explicit schema reads it
    return spark.read.schema(schema).format(fmt).load(f"{path.rstrip('/')}/{RUNS}/{run}")


def _live(records: list[dict]) -> list[tuple[dict, list | None]]:
    """The runs that still hold stamps, and which (None: all they have)."""
    start = max((i for i, r in enumerate(records) if r["stamps"] is None), default=0)
    records = records[start:]
    newest: dict[tuple, int] = {}
    for i, r in enumerate(records):
        for s in r["stamps"] or ():
            newest[tuple(s)] = i
    out: list[tuple[dict, list | None]] = []
    for i, r in enumerate(records):
        if r["stamps"] is None:
            # a whole table: the stamps of later runs are not its own any more
            out.append((r, None))
        else:
            mine = [s for s in r["stamps"] if newest[tuple(s)] == i]
            if mine or i == len(records) - 1:
                out.append((r, mine))
    return out


def read_committed(spark: SparkSession, path: str) -> DataFrame:
    """All stamps of a snapshot table, each as its last committed run wrote it.

    A run contributes only the stamps that no later run replaced; that is a
    filter on its partition values, so replaced files are not opened.  Filters
    of the caller on the stamp prune the same way.
    """
    records = commits(spark, path)
    if not records:
        raise FileNotFoundError(f"{path}: no committed run")
    parts = []
    columns = [f["name"] for f in records[-1]["schema"]["fields"]]
    live = _live(records)
    later = [s for r, mine in live for s in mine or ()]
    for r, mine in live:
        schema = T.StructType.fromJson(r["schema"])
        kinds = {f.name: f.dataType for f in schema}

        def among(stamps: list) -> Column:
            found = F.lit(False)
            for s in stamps:
                same = F.lit(True)
                for c, v in zip(r["partition_by"], s):
                    same = same & F.col(c).eqNullSafe(F.lit(v).cast(kinds[c]))
                found = found | same
            return found

        df = _read_run(spark, path, r["run"], schema, r["format"])
        if mine is None:
            df = df.filter(~among(later)) if later else df
        elif len(mine) < len(r["stamps"]) or not mine:
            df = df.filter(among(mine))
        parts.append(df.select(*columns))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def drop_uncommitted(spark: SparkSession, path: str) -> list[str]:
    """Delete the files of runs without a record (failed, or still writing:
    call it when no writer is active) and of runs whose stamps were all
    replaced; returns their names."""
    live = {r["run"] for r, _ in _live(commits(spark, path))}
    folder = _Folder(spark, path)
    gone = [run for run in folder.names(RUNS) if run not in live]
    for run in gone:
        folder.delete(f"{RUNS}/{run}")
    return gone
