"""Request pages of a cell (day, city, profession): the stop at the first empty page.

A cell is asked page by page, at most ``count_page`` pages, and no further once
a page has brought no accepted document. On landed documents, each with the
page it came on, that is a border per cell: its least page without an accepted
document. The border comes from a partial aggregate over at most ``count_page``
page numbers a cell; documents are then kept by (cell, page), so neither a sort
nor a window over a cell is needed, however many documents it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labormart.functions.json import has_key
from labormart.sources.landed import COUNT_PAGE


def not_an_error(col: str = "obj") -> Column:
    """An accepted document: it has no top-level key ``errors``."""
    return ~has_key(col, "errors")


def page_borders(docs: DataFrame, cell: list[str], accepted: Column, count_page: int = COUNT_PAGE, page_col: str = "page") -> DataFrame:
    """``(cell…, stop)``: how many pages of each cell count, from 0 to ``count_page``.

    Page ``stop`` is the first one without an accepted document; cells without
    any document are not known here (see :func:`requests_made`). Documents
    without a page number count on no page.
    """
    page = F.col(page_col)
    wanted = page.between(0, count_page - 1) & F.coalesce(accepted, F.lit(False))
    pages = F.collect_set(F.when(wanted, page.cast("int")))  # at most count_page numbers
    first_empty = F.array_min(F.array_except(F.sequence(F.lit(0), F.lit(count_page - 1)), pages))
    return docs.groupBy(*cell).agg(F.coalesce(first_empty, F.lit(count_page)).alias("stop"))


def kept_pages(borders: DataFrame, cell: list[str], page_col: str = "page") -> DataFrame:
    """``(cell…, page)`` of every page before its cell's border."""
    some = borders.where(F.col("stop") > 0)
    return some.select(*cell, F.explode(F.sequence(F.lit(0), F.col("stop") - 1)).alias(page_col))


def stop_at_empty_page(docs: DataFrame, cell: list[str], accepted: Column | None = None, count_page: int = COUNT_PAGE, page_col: str = "page") -> DataFrame:
    """L4: the accepted documents of the pages before each cell's first empty one.

    Null cell values match each other, as in the grouping that finds the border.
    """
    accepted = not_an_error() if accepted is None else accepted
    pages = kept_pages(page_borders(docs, cell, accepted, count_page, page_col), cell, page_col)
    left = docs.where(F.coalesce(accepted, F.lit(False)))
    right = pages.select(*[F.col(c).alias(f"_kept_{c}") for c in [*cell, page_col]])
    same = F.lit(True)
    for c in [*cell, page_col]:
        same &= F.col(c).eqNullSafe(F.col(f"_kept_{c}"))
    return left.join(right, same, "left_semi")


def requests_made(docs: DataFrame, cells: DataFrame, cell: list[str], accepted: Column | None = None, count_page: int = COUNT_PAGE, page_col: str = "page") -> DataFrame:
    """``(cell…, page, n_docs)`` for every request that is made, the empty one that ends a cell included.

    ``cells`` names the cells that are asked for; one without any document is
    asked for its first page only.
    """
    accepted = not_an_error() if accepted is None else accepted
    borders = page_borders(docs, cell, accepted, count_page, page_col)
    counts = docs.where(F.coalesce(accepted, F.lit(False)) & F.col(page_col).between(0, count_page - 1)).groupBy(*cell, F.col(page_col).cast("int").alias(page_col)).agg(F.count(F.lit(1)).alias("n_docs"))
    last = F.least(F.coalesce("stop", F.lit(0)), F.lit(count_page - 1))
    asked = cells.select(*cell).distinct().join(borders, cell, "left").select(*cell, F.explode(F.sequence(F.lit(0), last)).alias(page_col))
    return asked.join(counts, [*cell, page_col], "left").select(*cell, page_col, F.coalesce("n_docs", F.lit(0).cast("long")).alias("n_docs"))
