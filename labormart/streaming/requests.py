"""A17, L4, D2 on a stream: requests of each cell, counted across micro-batches.

Landed documents, and the cells that are expected, stream in by file. A cell's
state is its accepted documents per page; once the watermark has passed its day
the cell closes and emits its requests up to the first empty page, those of a
cell that nothing landed for included. However the files fall into
micro-batches, and wherever the query is started again, that is the report that
:func:`labormart.sources.pages.requests_made` gives for all files at once.
Documents that land after their day has closed do not count.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labormart.sources.landed import COUNT_PAGE
from labormart.sources.pages import not_an_error

DAY_MS = 86_400_000


def request_rows(docs: DataFrame, cell: list[str], day: str, page_col: str = "page") -> DataFrame:
    """Streaming rows ``(cell…, page, accepted)`` of landed documents (column ``obj``)."""
    return docs.select(*cell, F.col(page_col).cast("int").alias("page"), not_an_error().cast("int").alias("accepted"))


def expected_rows(cells: DataFrame, cell: list[str]) -> DataFrame:
    """The expected cells as rows that count nothing, so that a cell without documents is known."""
    return cells.select(*cell, F.lit(None).cast("int").alias("page"), F.lit(0).alias("accepted"))


def stream_requests(rows: DataFrame, cell: list[str], day: str, count_page: int = COUNT_PAGE, lateness: str = "0 days") -> DataFrame:
    """``(cell…, page, n_docs)`` of every cell that has closed; append mode.

    ``day`` is the cell's date column; a cell closes when the watermark, the latest
    day seen less ``lateness``, has passed it. Rows of a cell come to the state
    in bounded Arrow batches and are added up, never held.
    """
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    at = cell.index(day)
    marked = rows.withColumn("_ts", F.col(day).cast("timestamp")).withWatermark("_ts", lateness)

    def counted(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            counts = [int(n) for n in state.get[0].split(",")]
            state.remove()
            stop = next((p for p, n in enumerate(counts) if n == 0), count_page)
            pages = list(range(min(stop, count_page - 1) + 1))
            out = pd.DataFrame({c: [key[i]] * len(pages) for i, c in enumerate(cell)})
            yield out.assign(page=pages, n_docs=[counts[p] for p in pages])
            return
        counts = [int(n) for n in state.get[0].split(",")] if state.exists else [0] * count_page
        for batch in batches:
            on_page = batch.loc[batch["page"].between(0, count_page - 1) & (batch["accepted"] == 1), "page"]
            for page, n in on_page.value_counts().items():
                counts[int(page)] += int(n)
        state.update((",".join(map(str, counts)),))
        ends = (key[at] - _dt.date(1970, 1, 1)).days * DAY_MS + DAY_MS
        state.setTimeoutTimestamp(max(ends, state.getCurrentWatermarkMs() + 1))

    schema = T.StructType([*[T.StructField(c, kinds[c]) for c in cell], T.StructField("page", T.IntegerType()), T.StructField("n_docs", T.LongType())])
    return marked.groupBy(*cell).applyInPandasWithState(counted, schema, "counts string", "append", "EventTimeTimeout")
