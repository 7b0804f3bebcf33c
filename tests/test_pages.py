"""L4: pages of a request cell up to the first one without an accepted document."""

from pyspark.sql import functions as F

from labormart.sources import pages

OK, ERR = '{"id": 1}', '{"errors": null}'


def test_cells_stop_at_their_first_empty_page(spark):
    rows = [
        ("full", 0, OK), ("full", 1, OK), ("full", 2, OK), ("full", 3, OK),  # a fourth page is never asked for
        ("gap", 0, OK), ("gap", 2, OK),  # page 1 never landed
        ("errors", 0, OK), ("errors", 0, ERR), ("errors", 1, ERR), ("errors", 2, OK),
        ("none", 0, ERR), ("none", 1, OK), ("late", 1, OK),
        (None, 0, OK), (None, 1, OK), ("odd", None, OK), ("odd", 0, OK), ("odd", -1, OK),
    ]
    df = spark.createDataFrame([(*r, 5) for r in rows], "cell string, page int, obj string, stop int")
    borders = {r.cell: r.stop for r in pages.page_borders(df, ["cell"], pages.not_an_error()).collect()}
    assert borders == {"full": 3, "gap": 1, "errors": 1, "none": 0, "late": 0, None: 2, "odd": 1}
    kept = pages.stop_at_empty_page(df, ["cell"])
    assert kept.columns == df.columns
    got = sorted((str(r.cell), r.page) for r in kept.collect())
    assert got == [("None", 0), ("None", 1), ("errors", 0), ("full", 0), ("full", 1), ("full", 2), ("gap", 0), ("odd", 0)]


def test_requests_include_the_one_that_ends_a_cell(spark):
    df = spark.createDataFrame([("a", 0, OK), ("a", 0, OK), ("a", 1, ERR), ("b", 0, OK), ("b", 1, OK), ("b", 2, OK)], "cell string, page int, obj string")
    cells = spark.createDataFrame([("a",), ("b",), ("c",)], "cell string")
    got = sorted(tuple(r) for r in pages.requests_made(df, cells, ["cell"]).collect())
    assert got == [("a", 0, 2), ("a", 1, 0), ("b", 0, 1), ("b", 1, 1), ("b", 2, 1), ("c", 0, 0)]
    assert pages.stop_at_empty_page(df.where("false"), ["cell"]).count() == 0


def test_a_hot_cell_is_neither_sorted_nor_gathered(spark):
    hot = spark.range(200_000).select(F.lit("hot").alias("cell"), (F.col("id") % 3).cast("int").alias("page"), F.lit(OK).alias("obj"))
    kept = pages.stop_at_empty_page(hot, ["cell"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert kept.count() == 200_000 and "Window" not in plan
