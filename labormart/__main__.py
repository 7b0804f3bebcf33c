"""Command line: ``python -m labormart run|audit …`` (also usable as a spark-submit entry point).

run    stage the landed documents of the days ``--dt`` … yesterday and load them
       (incremental when ``--dt`` is yesterday, full otherwise), like the daily job.
audit  check every declared constraint of the warehouse tables.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import sys


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="labormart")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("run", "audit"):
        s = sub.add_parser(name)
        s.add_argument("--warehouse", required=True, help="root folder of the Parquet tables")
        s.add_argument("--preset", default="reference", choices=["reference", "corrected"])
        s.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
        if name == "run":
            s.add_argument("--landing", required=True, help="root folder of the landed documents")
            s.add_argument("--dt", default=None, help="first day to load (YYYY-MM-DD); default yesterday")
            s.add_argument("--as-of", default=None, help="the run's 'today' (YYYY-MM-DD); default today")
            s.add_argument("--cities", default=None, help="city file (id|name|eng_name) to (re)load first")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    from labormart.plans.tables import ParquetTables
    from labormart.semantics import preset
    from labormart.session import build_session

    sem = preset(args.preset)
    spark = build_session(args.master)
    tables = ParquetTables(spark, args.warehouse, sem)
    if args.command == "audit":
        from labormart.operators.quality import audit

        for r in audit(tables).where("n_findings > 0").collect():
            print(json.dumps(r.asDict()))
        return 0

    from labormart.plans.pipeline import run_pipeline
    from labormart.sources.dims import read_cities, seed_professions
    from labormart.sources.landed import landed_rejects, landed_sources

    if args.cities:
        tables.put("d_city", read_cities(spark, args.cities))
    if tables.get("d_query_profession").isEmpty():
        tables.put("d_query_profession", seed_professions(spark))
    as_of = _dt.date.fromisoformat(args.as_of) if args.as_of else _dt.date.today()
    dt = _dt.date.fromisoformat(args.dt) if args.dt else as_of - _dt.timedelta(days=1)
    vs, rs = landed_sources(spark, args.landing, sem)
    report = run_pipeline(spark, tables, dt=dt, as_of=as_of, sem=sem, vacancy_source=vs, rate_source=rs, reject_source=landed_rejects(spark, args.landing))
    print(json.dumps({"mode": report.mode, "dt": dt.isoformat(), "as_of": as_of.isoformat()}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
