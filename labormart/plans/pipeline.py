"""The load: staged documents → detail tables → marts, in full or incremental mode.

``load(tables, sem, day=None)`` is the stored procedure pair of the source:
``day=None`` is the full load (all staging, weekly metrics, staging
truncated), a day is the incremental load (that day's staging, daily
metrics, that day's staging deleted). Steps run in the source's order and
the marts are written last; everything is published together. ``run_pipeline`` adds the day spine and the mode
choice.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labormart.functions.dates import day_spine, to_day
from labormart.operators import bridge, marts, merge, parse, quarantine, states, variants
from labormart.operators.joins import semi_join_days
from labormart.schemas import METRIC_KEY, SKILL_KEY, VACANCY_KEY
from labormart.semantics import REFERENCE, Semantics


@dataclass
class LoadReport:
    mode: str
    day: object | None


def _scope(df: DataFrame, col: str, day: Column | _dt.date | None) -> DataFrame:
    if day is None:
        return df
    d = day if isinstance(day, Column) else to_day(day)
    return df.where(F.col(col) == d)


def _replace_days(tables, name: str, rows: DataFrame, days: DataFrame) -> None:
    """Replace the partitions of ``days`` by ``rows``; a day without rows loses its partition.

    ``days`` holds partition values only, so collecting the emptied ones is
    bounded by the number of loaded days.
    """
    rows = tables.scratch(rows, name)
    emptied = days.distinct().join(rows.select("dt").distinct(), "dt", "left_anti").collect()
    tables.put(name, rows, "partitions", landed=True)
    for day in emptied:
        tables.delete_partition(name, day["dt"])


def load(
    tables,
    sem: Semantics = REFERENCE,
    day: Column | _dt.date | None = None,
    batch: tuple[DataFrame, DataFrame] | None = None,
    documents: str = "json",
) -> LoadReport:
    """C1 (``day`` given) / C2 (``day=None``) over a tables back end.

    ``batch`` = (staged vacancy rows, staged rate rows) runs the incremental
    load on rows that never went through the staging tables (a streaming
    micro-batch): they are the whole scope, metrics are at day grain, and
    the staging tables are left alone. ``documents="variant"`` parses the staged
    text once into VARIANT, written as such, and unnests arrays and objects from
    it; the results are the same. All tables change together, at the
    end; a load that fails changes none and can be run again.
    """
    with tables.transaction():
        return _load(tables, sem, day, batch, documents)


def _load(
    tables,
    sem: Semantics,
    day: Column | _dt.date | None,
    batch: tuple[DataFrame, DataFrame] | None,
    documents: str,
) -> LoadReport:
    if documents not in ("json", "variant"):
        raise ValueError("documents must be 'json' or 'variant'")
    if batch is not None:
        stg_v, stg_r = batch
        scope_v, scope_r = stg_v, stg_r
        full = False
    else:
        full = day is None
        stg_v = tables.get("stg_vacancies")
        stg_r = tables.get("stg_exchange_rates")
        scope_v = _scope(stg_v, "query_dt", day)
        scope_r = _scope(stg_r, "query_dt", day)
    if documents == "variant":
        scope_v = tables.scratch(variants.with_variant(scope_v), "variant_vacancies")
        stg_r = tables.scratch(variants.with_variant(stg_r), "variant_rates")
        scope_r = stg_r if full or batch is not None else _scope(stg_r, "query_dt", day)
    vac_days = None if batch is None else stg_v.select(F.col("query_dt").alias("dt"))
    # the scope's documents are parsed once, and the readers below use the struct;
    # of other staged days only the skill names are read (Q13)
    if sem.quarantine:
        # the text goes on only where it is rejected
        checked = quarantine.check_vacancies(scope_v, sem).withColumn("obj", F.when(F.size("reasons") > 0, F.col("obj")))
        checked = tables.scratch(checked, "parsed_vacancies")
        parsed_scope = quarantine.accepted_vacancies(checked, sem)
        stg_r, scope_r, bad_rates = _sound_rates(tables, stg_r, scope_r)
        quarantine.keep_rejects(tables, quarantine.rejects_of(checked, "vacancies").unionByName(bad_rates))
    else:
        checked = quarantine.must_fit(quarantine.check_vacancies(scope_v, sem))
        parsed_scope = tables.scratch(checked.drop("obj"), "parsed_vacancies")
    cities = tables.get("d_city")
    professions = tables.get("d_query_profession")

    # Typed vacancies, upserted by (vacancy_id, dt, profession)
    kept = parse.flatten_with_skills(parsed_scope, professions, cities, sem)
    kept = tables.scratch(kept, "kept_vacancies")
    new_vac = kept.drop("key_skills")
    before = None if batch is None else _before_batch(tables, new_vac)
    vac_rows = merge.upsert_partitions(
        tables.get("d_vacancies"), new_vac, VACANCY_KEY, ["dt"], on_duplicate=None
    )
    tables.put("d_vacancies", vac_rows, "partitions")

    # SNK3/J4: skill names of all staged documents that are not known yet (Q13)
    entries = parse.skill_entries(parsed_scope, sem)
    if day is not None and batch is None:
        others = quarantine.check_vacancies(stg_v.where(~(F.col("query_dt") == (day if isinstance(day, Column) else to_day(day)))), sem)
        others = quarantine.accepted_vacancies(others, sem) if sem.quarantine else quarantine.must_fit(others)
        entries = entries.unionByName(parse.skill_entries(others, sem))
    names = parse.skill_names(entries)
    new_names = merge.insert_new(tables.get("d_skill"), names, ["name"])
    tables.put("d_skill", new_names.select(F.xxhash64("name").alias("id"), "name"), "append")

    # Links of the scope's entries to stored vacancy rows. Every staged
    # name was inserted into d_skill just above, so the inner join on the skill
    # name (J5) keeps exactly the non-NULL names; link_skills applies that filter.
    # Keyed links come from the kept version of a vacancy, not from superseded ones.
    entries = parse.kept_skill_entries(kept, sem) if sem.keyed_bridge else parse.skill_entries(parsed_scope, sem)
    links = bridge.link_skills(entries, tables.get("d_vacancies"), keyed=sem.keyed_bridge, small_entries=not full)
    if sem.replace_facts:
        # Q5 corrected: the links of every vacancy row this load re-staged are
        # replaced, also if it has no skills any more; rows of the same days that
        # the load did not touch (an earlier micro-batch of the day) are kept
        stored = tables.get("fct_skill_vacancy")
        _replace_days(tables, "fct_skill_vacancy", merge.replace_keyed(stored, links, VACANCY_KEY, ["dt"], new_vac), new_vac.select("dt"))
    else:
        tables.put("fct_skill_vacancy", links, "append")

    # Currency dimension from all staged rate documents (Q13)
    sound = (lambda rows: quarantine.check_rate_records(rows).where(F.size("reasons") == 0).drop("reasons")) if sem.quarantine else (lambda rows: rows)
    currencies = parse.currency_dimension_rows(sound(parse.rate_records(stg_r)), sem)
    dim = merge.upsert(tables.get("d_exchange_rates"), currencies, ["char_code"], on_duplicate=None)
    tables.put("d_exchange_rates", dim, "overwrite")

    # Rate facts of the scope for known currencies
    facts = parse.rate_fact_rows(sound(parse.rate_records(scope_r))).join(
        tables.get("d_exchange_rates").select("char_code"), "char_code", "left_semi"
    )
    tables.put("fct_exchange_rates", facts, "partitions" if sem.replace_facts else "append")

    # Metrics mart (day grain incremental, week grain full)
    vac = _scope(tables.get("d_vacancies"), "dt", day)
    if vac_days is not None:
        vac = semi_join_days(vac, vac_days, ["dt"])
    rates = _scope(tables.get("fct_exchange_rates"), "dt", day)
    if vac_days is not None:
        rates = semi_join_days(rates, vac_days, ["dt"])
    if before is None:
        found = states.summed(states.contributions(vac, rates, cities, sem))
    else:
        found = _states_after_batch(before, new_vac, vac, rates, cities, sem)
    found = tables.scratch(found, "metric_states")
    tables.put("dm_metric_states", found, "overwrite" if full else "partitions")
    metrics = tables.scratch(states.metrics_from_states(found, sem, "week" if full else "day"), "metrics")
    mkey = METRIC_KEY + (["grain"] if sem.grain_column else [])
    tables.put(
        "dm_metrics",
        merge.upsert_partitions(tables.get("dm_metrics"), metrics, mkey, ["dt"], on_duplicate=None),
        "partitions",
    )

    # C4/U4: skills mart at day grain
    links_scope = _scope(tables.get("fct_skill_vacancy"), "dt", day)
    if vac_days is not None:
        links_scope = semi_join_days(links_scope, vac_days, ["dt"])
    ranking = marts.skills_mart(links_scope, vac, cities, sem)
    if sem.replace_rank_slice:
        # Q6 corrected: the ranking is recomputed from the day's complete link
        # set, so it replaces the day (vanished skills, slices and days disappear)
        _replace_days(tables, "dm_skills", ranking, new_vac.select("dt"))
    else:
        ranking = tables.scratch(ranking, "ranking")
        new_skills = merge.upsert_partitions(tables.get("dm_skills"), ranking, SKILL_KEY, ["dt"], on_duplicate=None)
        tables.put("dm_skills", new_skills, "partitions")

    # SNK5/SNK6: consume staging
    if batch is not None:
        return LoadReport("batch", None)
    for name in ("stg_vacancies", "stg_exchange_rates"):
        if full:
            tables.truncate(name)
        else:
            tables.delete_partition(name, day)
    return LoadReport("full" if full else "incremental", day)


@dataclass
class _Before:
    """What a micro-batch finds: its vacancies' stored versions, and its days' rates, states and vacancy days."""

    versions: DataFrame
    rates: DataFrame
    states: DataFrame
    days: DataFrame


def _before_batch(tables, new_vac: DataFrame) -> _Before:
    stored = semi_join_days(tables.get("d_vacancies"), new_vac, ["dt"])
    return _Before(
        tables.scratch(stored.join(new_vac.select(*VACANCY_KEY), VACANCY_KEY, "left_semi"), "versions_before"),
        tables.scratch(semi_join_days(tables.get("fct_exchange_rates"), new_vac, ["dt"]), "rates_before"),
        tables.scratch(semi_join_days(tables.get("dm_metric_states"), new_vac, ["dt"]), "states_before"),
        tables.scratch(stored.select("dt").distinct(), "days_before"),
    )


def _states_after_batch(before: _Before, new_vac: DataFrame, vac: DataFrame, rates: DataFrame, cities: DataFrame, sem: Semantics) -> DataFrame:
    """The states of the batch's days: stored ones plus what the batch's vacancies add less what they replace.

    Days whose quotes changed, or whose vacancies were stored without a state,
    are summed anew from their rows.
    """
    unknown = before.days.join(before.states.select("dt").distinct(), "dt", "left_anti")
    anew = states.changed_rate_days(before.rates, rates).unionByName(unknown).distinct()
    steady = lambda rows: rows.join(anew, "dt", "left_anti")
    change = states.changes(
        states.contributions(steady(before.versions), before.rates, cities, sem), states.contributions(steady(new_vac), rates, cities, sem)
    )
    whole = states.summed(states.contributions(vac.join(anew, "dt", "left_semi"), rates, cities, sem))
    return states.merged(steady(before.states), change).unionByName(whole)


def _sound_rates(tables, stg_r: DataFrame, scope_r: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Staged rate rows and the scope's, without documents that do not fit; and the rejects of the scope."""
    fine = lambda rows: quarantine.check_rate_documents(rows).where(F.size("reasons") == 0).drop("d", "reasons")
    documents = quarantine.rejects_of(quarantine.check_rate_documents(scope_r), "rates")
    records = quarantine.check_rate_records(parse.rate_records(fine(scope_r)).withColumnRenamed("dt", "query_dt"))
    return fine(stg_r), fine(scope_r), documents.unionByName(quarantine.rejects_of(records, "rates", F.to_json("v")))


def stage(tables, vacancy_docs: DataFrame | None = None, rate_docs: DataFrame | None = None) -> None:
    """SNK1: append staged rows (already in staging layout)."""
    if vacancy_docs is not None:
        tables.put("stg_vacancies", vacancy_docs, "append", landed=True)
    if rate_docs is not None:
        tables.put("stg_exchange_rates", rate_docs, "append")


def plan_days(dt: _dt.date, as_of: _dt.date) -> tuple[str, list[_dt.date] | tuple[_dt.date, _dt.date]]:
    """D1 + D3: mode and inclusive day range (``dt`` … yesterday).

    ``dt == yesterday`` → incremental for that day; otherwise full over the
    range, which is empty when ``dt`` is after yesterday (Q15: the full load
    then only consumes what is already staged).
    """
    yesterday = as_of - _dt.timedelta(days=1)
    if dt == yesterday:
        return "incremental", (yesterday, yesterday)
    return "full", (dt, yesterday)


def run_pipeline(
    spark: SparkSession,
    tables,
    dt: _dt.date | None = None,
    as_of: _dt.date | None = None,
    sem: Semantics = REFERENCE,
    vacancy_source=None,
    rate_source=None,
    reject_source=None,
) -> LoadReport:
    """Stage the documents of the days ``dt`` … yesterday, then run the load.

    ``as_of`` fixes "today" once for the whole run (Q9). ``vacancy_source``
    and ``rate_source`` are callables ``(spine DataFrame) -> staged rows``
    that select the landed documents for the requested days; ``reject_source``
    names landed files that serve no day, for the table ``rejects``. Staging and
    load are published together.
    """
    as_of = as_of or _dt.date.today()
    dt = dt or (as_of - _dt.timedelta(days=1))
    mode, (start, end) = plan_days(dt, as_of)
    spine = day_spine(spark, start, end, "query_dt")
    with tables.transaction():
        if vacancy_source is not None:
            stage(tables, vacancy_docs=vacancy_source(spine))
        if rate_source is not None:
            stage(tables, rate_docs=rate_source(spine))
        if reject_source is not None and sem.quarantine:
            quarantine.keep_rejects(tables, reject_source(spine))
        return load(tables, sem, None if mode == "full" else end)
