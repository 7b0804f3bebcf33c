"""Where the pipeline's tables live.

Three back ends with one interface — ``get(name)``, ``put(name, df, mode)``
with modes ``overwrite`` (whole table), ``append`` and ``partitions``
(replace only the ``dt``/``query_dt`` partitions present in ``df``),
``truncate``, ``delete_partition``, ``scratch`` and ``transaction`` (all
writes inside appear at its end, or not at all):

- ``MemoryTables``: DataFrames held by the session, each written version
  kept as files under the cluster's checkpoint folder (tests, queries);
- ``ParquetTables``: versioned, day-partitioned Parquet folders per table and
  one published state for all tables;
- ``CatalogTables``: catalog tables with the vacancy and link tables
  bucketed by vacancy id (co-located joins); each write is published on its own.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labormart import schemas
from labormart.functions.dates import as_date, to_day
from labormart.operators.merge import replace_partitions
from labormart.semantics import REFERENCE, Semantics
from labormart.session import materialize, scratch_path

PARTITION_COLUMN = {
    "stg_vacancies": "query_dt",
    "stg_exchange_rates": "query_dt",
    "d_vacancies": "dt",
    "fct_skill_vacancy": "dt",
    "fct_exchange_rates": "dt",
    "dm_metrics": "dt",
    "dm_skills": "dt",
    "rejects": "query_dt",
    "dm_metric_states": "dt",
}


def table_schemas(sem: Semantics = REFERENCE) -> dict[str, T.StructType]:
    return {
        "stg_vacancies": schemas.STG_VACANCIES,
        "stg_exchange_rates": schemas.STG_EXCHANGE_RATES,
        "d_city": schemas.D_CITY,
        "d_query_profession": schemas.D_QUERY_PROFESSION,
        "d_vacancies": schemas.d_vacancies("decimal(18,2)"),
        "d_skill": schemas.D_SKILL,
        "fct_skill_vacancy": schemas.FCT_SKILL_VACANCY,
        "d_exchange_rates": schemas.D_EXCHANGE_RATES,
        "fct_exchange_rates": schemas.FCT_EXCHANGE_RATES,
        "dm_metrics": schemas.dm_metrics(sem.salary_precision, sem.grain_column),
        "dm_skills": schemas.DM_SKILLS,
        "rejects": schemas.REJECTS,
        "dm_metric_states": schemas.DM_METRIC_STATES,
        "load_audit": schemas.LOAD_AUDIT,
    }


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A zero-row table of ``schema`` that the optimizer removes from unions."""
    # limit(0) becomes an empty local relation, which the optimizer drops from unions and joins
    return spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]).limit(0)


def _conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


class MemoryTables:
    """Tables as DataFrames held by the driver session.

    With ``cut_lineage`` (default) every ``put`` writes its incoming rows to
    the cluster's checkpoint folder, the in-memory twin of writing a table:
    a version is the previous files (untouched days as a partition filter)
    plus the new files, and ``COMPACT_AFTER`` chained versions of one table
    are compacted into one. Without it the versions stay lazy plans (short
    runs, tests).
    """

    COMPACT_AFTER = 8

    def __init__(
        self,
        spark: SparkSession,
        sem: Semantics = REFERENCE,
        initial: dict[str, DataFrame] | None = None,
        cut_lineage: bool = True,
    ):
        self.spark = spark
        self.cut_lineage = cut_lineage
        self._versions: dict[str, int] = {}
        self._batches: dict[str, int] = {}
        self.schemas = table_schemas(sem)
        self._t: dict[str, DataFrame] = {}
        for name, schema in self.schemas.items():
            self._t[name] = _conform((initial or {}).get(name) or empty_table(spark, schema), schema)

    def get(self, name: str) -> DataFrame:
        return self._t[name]

    def put(self, name: str, df: DataFrame, mode: str = "overwrite", landed: bool = False) -> None:
        df = _conform(df, self.schemas[name])
        if mode not in ("overwrite", "append", "partitions"):
            raise ValueError(f"unknown mode {mode!r}")
        # like a write: the incoming rows are materialized now (only those),
        # so later steps read files instead of re-planning every earlier step;
        # rows that the caller just read from files are not copied
        if self.cut_lineage and not landed:
            df = materialize(self.spark, df, name)
        if mode == "overwrite":
            new, self._versions[name] = df, 0
        elif mode == "append":
            new = self._t[name].unionByName(df)
        else:
            # untouched days stay a partition filter over the previous files
            new = replace_partitions(self._t[name], df, [PARTITION_COLUMN[name]])
        if mode != "overwrite":
            self._versions[name] = self._versions.get(name, 0) + 1
            if self.cut_lineage and self._versions[name] >= self.COMPACT_AFTER:
                new, self._versions[name] = materialize(self.spark, new, name), 0
        self._t[name] = new

    @contextmanager
    def transaction(self) -> Iterator[None]:
        """A failure inside puts every table back to what it was."""
        before = dict(self._t), dict(self._versions), dict(self._batches)
        try:
            yield
        except BaseException:
            self._t, self._versions, self._batches = before
            raise

    def last_batch(self, stream: str) -> int:
        return self._batches.get(stream, -1)

    def note_batch(self, stream: str, batch_id: int) -> None:
        self._batches[stream] = batch_id

    def scratch(self, df: DataFrame, name: str) -> DataFrame:
        """An intermediate read by several steps: written once when cutting lineage."""
        return materialize(self.spark, df, name) if self.cut_lineage else df

    def truncate(self, name: str) -> None:
        self._t[name] = empty_table(self.spark, self.schemas[name])

    def delete_partition(self, name: str, day) -> None:
        d = day if isinstance(day, Column) else to_day(day)
        self.put(name, self._t[name].where(~(F.col(PARTITION_COLUMN[name]) == d)), "overwrite", landed=True)


class ParquetTables:
    """Versioned Parquet folders under ``root`` (split by their day column), published together.

    Every write goes to a folder of its own, ``<table>/load=<id>[/<day column>=<day>]``,
    and changes no older file. The published state is the ``_published/<n>.json``
    with the largest ``n``: it lists the folders that make up each table. A
    ``transaction`` writes the next state once, at its end, so a load appears as
    a whole or not at all, a failed one can simply be run again, and readers of
    the state before are not disturbed. Rows are written once, clustered by
    day (AQE splits large days and joins small ones). One writer at a time: the
    second of two fails when it publishes. ``vacuum`` removes what no state needs.
    """

    def __init__(self, spark: SparkSession, root: str, sem: Semantics = REFERENCE):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schemas = table_schemas(sem)
        self._open: dict | None = None
        self._staging: str | None = None

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, path: str) -> list[str]:
        p, fs = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def _remove(self, path: str) -> None:
        p, fs = self._fs(path)
        if fs.exists(p):
            fs.delete(p, True)

    def _published(self) -> tuple[int, dict]:
        """Number and content of the current state: folders per table, last batch per stream."""
        numbers = [int(n[:-5]) for n in self._names(f"{self.root}/_published") if n.endswith(".json")]
        if not numbers:
            return 0, {"tables": {}, "batches": {}}
        p, fs = self._fs(f"{self.root}/_published/{max(numbers)}.json")
        stream = fs.open(p)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return max(numbers), json.loads(text)

    def _publish(self, number: int, state: dict) -> None:
        draft, fs = self._fs(f"{self.root}/_published/.{uuid.uuid4().hex}")
        final, _ = self._fs(f"{self.root}/_published/{number}.json")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        if fs.exists(final) or not fs.rename(draft, final):
            raise RuntimeError(f"state {number} of {self.root} was published by another writer")

    @contextmanager
    def transaction(self) -> Iterator[dict]:
        """All writes inside become visible to others at the end, or never; nested ones join the outer one."""
        if self._open is not None:
            yield self._open
            return
        number, self._open = self._published()
        self._staging = scratch_path(self.spark, f"labormart-stage/{uuid.uuid4().hex}")
        try:
            yield self._open
            self._publish(number + 1, self._open)
        finally:
            self._open = None
            self._remove(self._staging)
            self._staging = None

    def _state(self) -> dict:
        return self._open if self._open is not None else self._published()[1]

    def get(self, name: str) -> DataFrame:
        schema = self.schemas[name]
        live = self._state()["tables"].get(name)
        if not live:
            return empty_table(self.spark, schema)
        base = self.path(name)
        rows = self.spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{x}" for x in live])
        return _conform(rows, schema)

    def put(self, name: str, df: DataFrame, mode: str = "overwrite", landed: bool = False) -> None:
        if mode not in ("overwrite", "append", "partitions"):
            raise ValueError(f"unknown mode {mode!r}")
        df = _conform(df, self.schemas[name])
        part = PARTITION_COLUMN.get(name)
        with self.transaction() as state:
            folder = f"load=v{uuid.uuid4().hex}"
            target = f"{self.path(name)}/{folder}"
            if part:
                df.hint("rebalance", part).write.partitionBy(part).parquet(target)
                new = [f"{folder}/{day}" for day in self._names(target) if "=" in day]
            else:
                df.write.parquet(target)
                new = [folder]
            old = state["tables"].get(name, [])
            if mode == "overwrite":
                old = []
            elif mode == "partitions":
                days = {x.rsplit("/", 1)[-1] for x in new}
                old = [x for x in old if x.rsplit("/", 1)[-1] not in days]
            state["tables"][name] = old + new

    def scratch(self, df: DataFrame, name: str) -> DataFrame:
        """An intermediate read by several steps, written once; it goes when its transaction ends."""
        return materialize(self.spark, df, name, self._staging)

    def last_batch(self, stream: str) -> int:
        return self._state()["batches"].get(stream, -1)

    def note_batch(self, stream: str, batch_id: int) -> None:
        with self.transaction() as state:
            state["batches"][stream] = batch_id

    def truncate(self, name: str) -> None:
        """SNK6: the table has no rows any more."""
        with self.transaction() as state:
            state["tables"].pop(name, None)

    def delete_partition(self, name: str, day) -> None:
        """SNK5: drop one day (no rewrite of other days)."""
        if isinstance(day, Column):
            raise TypeError("ParquetTables.delete_partition needs a date value")
        gone = f"{PARTITION_COLUMN[name]}={as_date(day).isoformat()}"
        with self.transaction() as state:
            state["tables"][name] = [x for x in state["tables"].get(name, []) if x.rsplit("/", 1)[-1] != gone]

    def vacuum(self) -> None:
        """Remove the folders that the published state does not name, and the states before it.

        To be run while nobody writes or reads an older state.
        """
        number, state = self._published()
        for name in self.schemas:
            live = set(state["tables"].get(name, []))
            for folder in self._names(self.path(name)):
                inner = [f"{folder}/{d}" for d in self._names(f"{self.path(name)}/{folder}") if "=" in d]
                if folder in live:
                    continue
                for x in inner:
                    if x not in live:
                        self._remove(f"{self.path(name)}/{x}")
                if not live.intersection(inner):
                    self._remove(f"{self.path(name)}/{folder}")
        for n in self._names(f"{self.root}/_published"):
            if n != f"{number}.json":
                self._remove(f"{self.root}/_published/{n}")


# tables bucketed by the vacancy id, so the link ↔ vacancy joins are co-located
BUCKET_COLUMN = {"d_vacancies": "vacancy_id", "fct_skill_vacancy": "vacancy_id"}


class CatalogTables:
    """Catalog tables (one database) at explicit locations under ``root``.

    Same layout as :class:`ParquetTables` (Parquet, partitioned by the day
    column), plus bucketing: ``d_vacancies`` and ``fct_skill_vacancy`` are
    bucketed and sorted by ``vacancy_id`` into ``buckets`` buckets, so the
    skills mart's link ↔ vacancy join and the per-vacancy link aggregate
    read both tables without an exchange; building links from staged
    entries shuffles only the entries side. That needs
    ``spark.sql.requireAllClusterKeysForCoPartition`` off (set here): the
    join keys include, not equal, the bucket column.
    Writes go through ``insertInto`` (append, or dynamic partition overwrite).
    """

    def __init__(self, spark: SparkSession, database: str, root: str, sem: Semantics = REFERENCE, buckets: int = 64):
        self.spark = spark
        self.database = database
        self.root = root.rstrip("/")
        self.schemas = table_schemas(sem)
        self.buckets = buckets
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def qualified(self, name: str) -> str:
        return f"{self.database}.{name}"

    def _exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.qualified(name))

    def get(self, name: str) -> DataFrame:
        if not self._exists(name):
            return empty_table(self.spark, self.schemas[name])
        return self.spark.table(self.qualified(name))

    def _create(self, name: str, df: DataFrame) -> None:
        writer = df.write.format("parquet").option("path", f"{self.root}/{name}")
        part = PARTITION_COLUMN.get(name)
        if part:
            writer = writer.partitionBy(part)
        bucket = BUCKET_COLUMN.get(name)
        if bucket:
            writer = writer.bucketBy(self.buckets, bucket).sortBy(bucket)
        writer.mode("error").saveAsTable(self.qualified(name))

    def put(self, name: str, df: DataFrame, mode: str = "overwrite", landed: bool = False) -> None:
        df = _conform(df, self.schemas[name])
        if mode not in ("overwrite", "append", "partitions"):
            raise ValueError(f"unknown mode {mode!r}")
        if not self._exists(name):
            self._create(name, df)
            return
        if mode in ("overwrite", "partitions"):
            df = materialize(self.spark, df, name)  # never overwrite what the rows are read from
        ordered = df.select(*self.spark.table(self.qualified(name)).columns)
        # insertInto reads the overwrite mode from the session, not from writer
        # options: set it for this insert only and restore the caller's value
        key = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(key, "STATIC")
        self.spark.conf.set(key, "dynamic" if mode == "partitions" else "static")
        try:
            ordered.write.insertInto(self.qualified(name), overwrite=mode != "append")
        finally:
            self.spark.conf.set(key, before)

    @contextmanager
    def transaction(self) -> Iterator[None]:
        """No more than a block: a catalog publishes each write at once, and knows no batches."""
        yield

    def last_batch(self, stream: str) -> int:
        return -1

    def note_batch(self, stream: str, batch_id: int) -> None:
        return None

    def scratch(self, df: DataFrame, name: str) -> DataFrame:
        return materialize(self.spark, df, name)

    def _fs_path(self, rel: str):
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{rel}")
        return p, p.getFileSystem(conf)

    def truncate(self, name: str) -> None:
        """Delete the table's files and sync the catalog (external tables reject TRUNCATE)."""
        if not self._exists(name):
            return
        p, fs = self._fs_path(name)
        if fs.exists(p):
            for st in fs.listStatus(p):
                fs.delete(st.getPath(), True)
        if PARTITION_COLUMN.get(name):
            self.spark.sql(f"MSCK REPAIR TABLE {self.qualified(name)} SYNC PARTITIONS")
        self.spark.catalog.refreshTable(self.qualified(name))

    def delete_partition(self, name: str, day) -> None:
        if isinstance(day, Column):
            raise TypeError("CatalogTables.delete_partition needs a date value")
        if self._exists(name):
            col = PARTITION_COLUMN[name]
            self.spark.sql(
                f"ALTER TABLE {self.qualified(name)} DROP IF EXISTS PARTITION ({col} = DATE'{as_date(day).isoformat()}')"
            )
            p, fs = self._fs_path(f"{name}/{col}={as_date(day).isoformat()}")
            if fs.exists(p):
                fs.delete(p, True)
            self.spark.catalog.refreshTable(self.qualified(name))
