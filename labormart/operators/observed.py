"""Q-NN, Q-LEN, Q-UQ, Q-FK while a load writes: constraints checked without scanning tables again.

Every write carries an observation: Spark counts rows, NULLs in NOT NULL columns
and values over their length as the rows go by, so these checks cost no scan.
Keys and references are checked on the rows that were written: a key is looked
for among the rows of the partitions just touched, a reference among the
parent's. The findings are rows of the table ``load_audit``, published with the load.
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from labormart.operators.joins import semi_join_days
from labormart.operators.quality import constraints_of
from labormart.plans.tables import PARTITION_COLUMN


def observed_aggregates(spec: dict, columns: list[str]) -> tuple[list, list[tuple[str, str]]]:
    """Aggregates of one pass over written rows, and the (check, column) that each after the first is for."""
    aggs, names = [F.count(F.lit(1)).alias("n_rows")], []
    for c in spec.get("not_null", []):
        if c in columns:
            aggs.append(F.count_if(F.col(c).isNull()).alias(f"m{len(names)}"))
            names.append(("not_null", c))
    for c, n in spec.get("length", {}).items():
        if c in columns:
            aggs.append(F.count_if(F.length(c) > n).alias(f"m{len(names)}"))
            names.append(("length", c))
    return aggs, names


class ObservedTables:
    """A back end whose writes are checked as they happen.

    Wraps any of the back ends; ``get``, ``scratch`` and the rest go through to
    it. ``findings()`` gives ``(table_name, check, target, n_findings, n_rows)`` of
    the writes of the current or last transaction.
    """

    def __init__(self, inner) -> None:
        self.inner = inner
        self._found: list[tuple] = []
        self._depth = 0

    def __getattr__(self, name: str):
        return getattr(self.inner, name)

    def _note(self, name: str, check: str, target: str, n: int, rows: int) -> None:
        self._found.append((name, check, target, int(n), int(rows)))

    def put(self, name: str, df: DataFrame, mode: str = "overwrite", landed: bool = False) -> None:
        if name == "load_audit":
            self.inner.put(name, df, mode)
            return
        spec = constraints_of(name, df.columns)
        aggs, names = observed_aggregates(spec, df.columns)
        watch = Observation(f"{name}-{len(self._found)}")
        df = self.inner.scratch(df.observe(watch, *aggs), f"observed-{name}")
        self.inner.put(name, df, mode, landed=True)
        seen = watch.get
        rows = seen["n_rows"]
        self._note(name, "rows", mode, 0, rows)
        for i, (check, column) in enumerate(names):
            self._note(name, check, column, seen[f"m{i}"], rows)
        if rows:
            self._keys(name, df, spec, rows)

    def _keys(self, name: str, written: DataFrame, spec: dict, rows: int) -> None:
        stored = self.inner.get(name)
        part = PARTITION_COLUMN.get(name)
        near = semi_join_days(stored, written, [part]) if part else stored
        for keys in spec.get("unique", []):
            touched = written.select(*keys).distinct()
            twice = near.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").join(touched, keys, "left_semi")
            self._note(name, "unique", ",".join(keys), twice.count(), rows)
        for child, parent, parent_keys in spec.get("fk", []):
            present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in child])
            used = written.where(present).groupBy(*child).agg(F.count(F.lit(1)).alias("_n"))
            known = self.inner.get(parent).select(*[F.col(p).alias(c) for p, c in zip(parent_keys, child, strict=True)]).distinct()
            lost = used.join(known, child, "left_anti").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).first()["n"]
            self._note(name, "foreign_key", f"{','.join(child)}->{parent}", lost, rows)

    def findings(self) -> DataFrame:
        return self.inner.spark.createDataFrame(self._found, "table_name string, check string, target string, n_findings long, n_rows long")

    @contextmanager
    def transaction(self):
        """As the inner back end's; the outermost one ends by writing the findings to ``load_audit``."""
        with self.inner.transaction() as inner:
            if self._depth == 0:
                self._found = []
            self._depth += 1
            try:
                yield inner
                if self._depth == 1:
                    self.inner.put("load_audit", self.findings(), "overwrite")
            finally:
                self._depth -= 1
