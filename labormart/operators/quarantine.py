"""X1b, X6, Q-RNG, Q-LEN: documents that do not fit, kept with a reason instead of lost.

One pass parses the staged documents and gives each the reasons that speak
against it (``try_cast`` per typed field). Documents without a reason go on;
the others become rows of the table ``rejects``, one per reason, published
with the load. With ``Semantics.quarantine`` off, the same findings fail the
load, as the source's typed columns do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labormart.functions.json import parse_doc, variant_field
from labormart.operators import variants
from labormart.schemas import RATES_DOC, VACANCY_DOC
from labormart.semantics import REFERENCE, Semantics
from labormart.sources.landed import is_json_object

REJECT_COLUMNS = ["reject_id", "source", "reason", "obj", "query_profession_eng_name", "query_dt", "update_ts", "n_rows"]
#: Reasons that concern one skill entry; the document itself goes on.
ENTRY_REASONS = ("skill_name",)


def _unfit(text: Column, kind: str) -> Column:
    """A value that is there and does not become a ``kind``."""
    return text.isNotNull() & text.try_cast(kind).isNull()


def _reasons(*checks: tuple[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(code)) for code, bad in checks]))


def check_vacancies(staging: DataFrame, sem: Semantics = REFERENCE) -> DataFrame:
    """Staged vacancy rows, parsed once: the struct ``d``, the text, and ``reasons`` (empty if all is well)."""
    columns = ["query_profession_eng_name", "query_dt", "update_ts"]
    if "v" in staging.columns:  # staged as VARIANT
        parsed, whole = staging.select("obj", "v", variants.as_struct("v", VACANCY_DOC).alias("d"), *columns), variants.is_object()
    else:
        parsed, whole = staging.select("obj", parse_doc("obj", VACANCY_DOC).alias("d"), *columns), F.coalesce(is_json_object("obj"), F.lit(False))
    # a column of its own: the array of reasons is evaluated expression by expression
    # and would read the text again for each of them
    parsed = parsed.withColumn("_whole", whole)
    d, whole = F.col("d"), F.col("_whole")
    too_long = F.exists(d["key_skills"], lambda s: F.length(s["name"]) > sem.skill_name_len)
    fields = [
        ("id", d["id"].try_cast("bigint").isNull()),
        ("area", _unfit(d["area"]["id"], "int")),
        ("salary_from", _unfit(d["salary"]["from"], "decimal(18,2)")),
        ("salary_to", _unfit(d["salary"]["to"], "decimal(18,2)")),
        ("published_at", _unfit(d["published_at"], "timestamp_ntz")),
        ("skill_name", too_long),
    ]
    return parsed.withColumn(
        "reasons",
        _reasons(
            ("malformed", ~whole),
            *[(code, whole & bad) for code, bad in fields],
            ("query_profession_eng_name", F.col("query_profession_eng_name").isNull()),
            ("query_dt", F.col("query_dt").isNull()),
        ),
    ).drop("_whole")


def accepted_vacancies(checked: DataFrame, sem: Semantics = REFERENCE) -> DataFrame:
    """Documents nothing speaks against, as parsed rows; of their skills, those with a name that fits."""
    fine = checked.where(F.size(F.array_except("reasons", F.array(*[F.lit(r) for r in ENTRY_REASONS]))) == 0)
    short = F.filter(F.col("d.key_skills"), lambda s: s["name"].isNull() | (F.length(s["name"]) <= sem.skill_name_len))
    variant = ["v"] if "v" in checked.columns else []
    return fine.select(F.col("d").withField("key_skills", short).alias("d"), *variant, "query_profession_eng_name", "query_dt", "update_ts")


def check_rate_documents(staging: DataFrame) -> DataFrame:
    """Staged rate rows, parsed once, with the ``reasons`` against the document as a whole."""
    if "v" in staging.columns:
        parsed, whole, day = staging, variants.is_object(), variant_field("v", "Date")
    else:
        parsed, whole = staging.withColumn("d", parse_doc("obj", RATES_DOC)), F.coalesce(is_json_object("obj"), F.lit(False))
        day = F.col("d.Date")
    return parsed.withColumn(
        "reasons",
        _reasons(("malformed", ~whole), ("rate_date", whole & _unfit(day, "timestamp_ntz")), ("query_dt", F.col("query_dt").isNull())),
    )


def check_rate_records(records: DataFrame) -> DataFrame:
    """Currency entries (one row each, struct ``v``) with the ``reasons`` against them."""
    v = F.col("v")
    required = [("ID", "exchange_rates_id"), ("NumCode", "num_code"), ("CharCode", "char_code"), ("Name", "name")]
    return records.withColumn(
        "reasons",
        _reasons(
            *[(name, v[field].isNull()) for field, name in required],
            *[(f.lower(), v[f].try_cast(kind).isNull()) for f, kind in (("Value", "decimal(10,4)"), ("Previous", "decimal(10,4)"), ("Nominal", "int"))],
        ),
    )


def rejects_of(checked: DataFrame, source: str, text: Column | None = None) -> DataFrame:
    """Rows of the table ``rejects``: one for each different text, day, profession and reason, with how often it came."""
    profession = F.col("query_profession_eng_name") if "query_profession_eng_name" in checked.columns else F.lit(None).cast("string")
    rows = checked.where(F.size("reasons") > 0).select(
        F.lit(source).alias("source"), F.explode("reasons").alias("reason"), (F.col("obj") if text is None else text).alias("obj"), profession.alias("query_profession_eng_name"), "query_dt", "update_ts"
    )
    key = ["source", "reason", "obj", "query_profession_eng_name", "query_dt"]
    found = rows.groupBy(*key).agg(F.max("update_ts").alias("update_ts"), F.count(F.lit(1)).alias("n_rows"))
    return found.select(F.xxhash64(*key).alias("reject_id"), *key, "update_ts", "n_rows").select(*REJECT_COLUMNS)


def rejected_rate_files(docs: DataFrame) -> DataFrame:
    """Landed rate files (``obj``, ``doc_day``) that are not one JSON object, as rows of ``rejects``.

    They never serve a day (the latest valid file before them does), so the load
    does not see them; they are accounted for from the files themselves.
    """
    stamp = F.col("_landed_ts") if "_landed_ts" in docs.columns else F.col("doc_day").cast("timestamp_ntz")
    named = docs.select("obj", F.col("doc_day").alias("query_dt"), stamp.alias("update_ts"))
    return rejects_of(named.withColumn("reasons", _reasons(("malformed", ~F.coalesce(is_json_object("obj"), F.lit(False))))), "rates")


def must_fit(checked: DataFrame) -> DataFrame:
    """``checked`` without its ``reasons``; the job fails on the first document that has one.

    The guard stands in the document's columns, one of which every reader takes. As
    a filter it would be pushed below the parsing, which then runs once for each
    reason.
    """
    said = F.concat(F.lit("rejected document ("), F.array_join("reasons", ", "), F.lit(")"))
    guarded = lambda c: F.when(F.size("reasons") > 0, F.raise_error(said)).otherwise(F.col(c))
    return checked.withColumns({c: guarded(c) for c in ("d", "v") if c in checked.columns}).drop("reasons")


def keep_rejects(tables, rows: DataFrame) -> None:
    """Add rejects that the table does not hold yet, so a load that is run again adds none twice."""
    new = rows.join(tables.get("rejects").select("reject_id"), "reject_id", "left_anti")
    tables.put("rejects", new, "append")
