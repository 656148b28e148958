"""Publishing next-state tables all or nothing (U-5, U-6, U-7, S-13).

A store is a folder with one sub-folder per run and an append-only commit log:

    <root>/runs/<run>/<table>/   Parquet written by that run
    <root>/_commits/             Parquet rows, see COMMIT_SCHEMA

A run writes what it changes into a fresh run folder first; only when all
writes have succeeded does it append its commit rows in one write.  A run that
dies half-way leaves an orphan folder that no commit names, so readers never
see a partial state.  A dry run is simply a job whose result is not published.

A table is the union of the folders that its commit rows name:

* ``replace`` starts the table anew (a plain frame given to ``publish``);
* ``append`` adds a folder (:class:`Append`): audit, batch and the reference
  tables only grow, so a run writes its new rows and nothing else;
* ``overwrite`` puts a new folder in place of one bucket (:class:`Buckets`).

``result`` changes in place, so it is kept in buckets of ``width`` consecutive
batch ids (``lotgate.result.bucketBatches``, fixed when the table is started).
A load names batches that are near each other (new batches have the greatest
ids), so it reads and writes few buckets, and the number of buckets grows with
the data instead of their size.  Commit rows also carry the row count and the
greatest id of what they name, so totals and the next id need no scan.

Single writer per store is assumed (as with one embedded database file).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotgate.schemas import KEYS, SCHEMAS, conform, empty_model, empty_table

COMMIT_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType(), False),
    T.StructField("run_id", T.StringType(), False),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("path", T.StringType(), False),
    T.StructField("kind", T.StringType()),
    T.StructField("bucket", T.LongType()),
    T.StructField("width", T.LongType()),  # of a bucketed table, in its replace row
    T.StructField("n_rows", T.LongType()),
    T.StructField("max_id", T.LongType()),
])

#: The column whose ranges make the buckets of a table that changes in place.
BUCKETED = {"result": "batch_id"}
BUCKET = "bucket"
BUCKET_BATCHES = 65_536


@dataclass
class Append:
    """Rows to add to a table."""
    rows: DataFrame


@dataclass
class Buckets:
    """The whole next state of the named buckets of a bucketed table."""
    rows: DataFrame
    touched: list[int]


def bucket_of(column: str, width: int) -> Column:
    return F.floor(F.col(column) / F.lit(width)).cast("long")


class Snapshot(Mapping):
    """The tables of a store as of one commit, opened when asked for."""

    def __init__(self, spark: SparkSession, log: list):
        self.spark = spark
        self.widths: dict[str, int] = {}
        self._entries: dict[str, list] = {}
        self._max_ids: dict[str, int | None] = {}
        self._open: dict[str, DataFrame] = {}
        for row in sorted(log, key=lambda r: (r["seq"], (r["kind"] or "replace") != "replace")):
            name, kind = row["table_name"], row["kind"] or "replace"
            entries = self._entries.setdefault(name, [])
            self._max_ids.setdefault(name, 0)
            if kind == "replace":
                entries.clear()
                self.widths.pop(name, None)
                self._max_ids[name] = 0
                if row["width"]:
                    self.widths[name] = row["width"]
                    continue  # its rows are in the buckets that follow
            elif kind == "overwrite":
                entries[:] = [e for e in entries if e["bucket"] != row["bucket"]]
            entries.append(row)
            known = self._max_ids[name]
            self._max_ids[name] = None if known is None or row["n_rows"] is None else max(known, row["max_id"] or 0)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self._read(name, [e["path"] for e in self._entries[name]])
        return self._open[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._entries)

    def __len__(self) -> int:
        return len(self._entries)

    def _read(self, name: str, paths: list[str]) -> DataFrame:
        if not paths:
            return empty_table(self.spark, name)
        schema = SCHEMAS.get(name)
        # Appended folders of a table without a declared schema may differ in columns.
        reader = self.spark.read.schema(schema) if schema is not None else self.spark.read.option("mergeSchema", str(len(paths) > 1).lower())
        return reader.parquet(*paths)

    def paths(self, name: str) -> list[str]:
        return [e["path"] for e in self._entries[name]]

    def max_id(self, name: str) -> int | None:
        """The greatest id given out so far; None if the log does not tell."""
        return self._max_ids[name]

    def n_rows(self, name: str) -> int | None:
        rows = [e["n_rows"] for e in self._entries[name]]
        return None if None in rows else sum(rows)

    def buckets(self, name: str, only: set[int] | None = None, but: set[int] | None = None) -> DataFrame:
        """The rows of some buckets; no other bucket is listed or read."""
        return self._read(name, [e["path"] for e in self._entries[name]
                                 if (only is None or e["bucket"] in only) and (but is None or e["bucket"] not in but)])


class ModelStore:
    def __init__(self, root: str, spark: SparkSession | None = None):
        self.root = root.rstrip("/")
        self.spark = spark or SparkSession.getActiveSession()

    @property
    def _commits_path(self) -> str:
        return f"{self.root}/_commits"

    def commits(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(COMMIT_SCHEMA).parquet(self._commits_path)
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return None  # no commit yet

    def read_model(self) -> Snapshot:
        """All tables as of one commit: the log is read once."""
        log = self.commits()
        return Snapshot(self.spark, [] if log is None else log.collect())

    def exists(self) -> bool:
        return bool(self.read_model())

    def read(self, table: str) -> DataFrame:
        model = self.read_model()
        if table not in model:
            raise KeyError(f"table {table} has never been published in {self.root}")
        return model[table]

    def _write(self, name: str, change, path: str, snapshot: Snapshot) -> list[dict]:
        """Write one table's change; its commit rows, counts still open."""
        kind = {Append: "append", Buckets: "overwrite"}.get(type(change), "replace")
        rows = change if kind == "replace" else change.rows
        rows = conform(rows, name) if name in SCHEMAS else rows
        start = {"table_name": name, "path": path, "kind": kind, "bucket": None, "width": None}
        if name not in BUCKETED:
            rows.write.mode("errorifexists").parquet(path)  # never overwrite in place (U-5)
            return [start]
        width = snapshot.widths.get(name) if kind != "replace" else None
        out = []
        if width is None:  # started (or, from an older log, started over) here
            if kind != "replace" and name in snapshot:
                rows = snapshot[name].unionByName(rows) if kind == "append" else snapshot.buckets(name, but=set(change.touched)).unionByName(rows)
            width = int(self.spark.conf.get("lotgate.result.bucketBatches", str(BUCKET_BATCHES)))
            kind = "append"
            out.append(start | {"kind": "replace", "width": width})
        key = BUCKETED[name]
        if isinstance(change, Buckets):  # files of neighbouring ids, a hot batch over several
            rows = rows.repartitionByRange(*KEYS[name].business_key).sortWithinPartitions(*KEYS[name].business_key)
        rows.withColumn(BUCKET, bucket_of(key, width)).write.mode("errorifexists").partitionBy(BUCKET).parquet(path)
        return out + [start | {"kind": kind, "path": path}]

    def _counted(self, written: list[dict]) -> list[dict]:
        """Commit rows with counts and greatest ids, a row per bucket: one job
        over the id column of the new files."""
        parts = []
        for i, row in enumerate(written):
            if row["width"]:
                continue
            name = row["table_name"]
            bucket, schema = F.lit(None).cast("long"), SCHEMAS.get(name)
            if name in BUCKETED:
                bucket, schema = F.col(BUCKET), T.StructType([*schema.fields, T.StructField(BUCKET, T.LongType())])
            files = (self.spark.read.schema(schema) if schema is not None else self.spark.read).parquet(row["path"])
            top = F.max(KEYS[name].id_col) if name in KEYS else F.lit(None).cast("long")
            files = files.withColumn("_i", F.lit(i)).withColumn("_b", bucket)
            parts.append(files.groupBy("_i", "_b").agg(F.count(F.lit(1)).alias("n"), top.cast("long").alias("m")))
        found: dict[int, list] = {}
        if parts:
            counts = parts[0]
            for p in parts[1:]:
                counts = counts.unionByName(p)
            for r in counts.collect():
                found.setdefault(r["_i"], []).append(r)
        out = []
        for i, row in enumerate(written):
            if row["width"] or (row["table_name"] not in BUCKETED and i not in found):
                out.append(row | {"n_rows": 0, "max_id": 0})
            for r in found.get(i, []):
                place = {} if r["_b"] is None else {"bucket": r["_b"], "path": f"{row['path']}/{BUCKET}={r['_b']}"}
                out.append(row | place | {"n_rows": r["n"], "max_id": r["m"]})
        return out

    def publish(self, tables: dict[str, DataFrame | Append | Buckets], run_id: str | None = None) -> str:
        """Write what this run changes, then commit it all together (U-6)."""
        run = f"{run_id or 'run'}-{uuid.uuid4().hex[:12]}"
        log = self.commits()
        rows = [] if log is None else log.collect()
        snapshot = Snapshot(self.spark, rows)
        written: list[dict] = []
        for name, change in tables.items():
            written += self._write(name, change, f"{self.root}/runs/{run}/{name}", snapshot)
        seq = max((r["seq"] for r in rows), default=-1) + 1
        commit = [{"seq": seq, "run_id": run} | row for row in self._counted(written)]
        self.spark.createDataFrame([tuple(r[f.name] for f in COMMIT_SCHEMA) for r in commit], COMMIT_SCHEMA).coalesce(1) \
            .write.mode("append").parquet(self._commits_path)
        return run

    def initialize(self, reset: bool = False) -> str:
        """Create the seven empty model tables (S-12); refuse to replace an
        existing store unless *reset* (S-13).  A reset publishes empty tables as
        the current state; older runs stay on disk as history."""
        if self.exists() and not reset:
            raise FileExistsError(
                f"Model store already exists: {self.root}. Pass reset=True to rebuild it.")
        return self.publish(empty_model(self.spark), run_id="init")
