"""Documents and staging rows that the tests share."""

import datetime as dt
import json


def staged(spark, rows):
    """Staging rows from (document dict or raw text, profession, query_dt, update_ts)."""
    from labormart.schemas import STG_VACANCIES

    data = []
    for doc, prof, day, ts in rows:
        obj = doc if isinstance(doc, str) else json.dumps(doc, ensure_ascii=False)
        data.append((obj, prof, day, ts))
    return spark.createDataFrame(data, STG_VACANCIES)


def rate_doc(date_text, quotes):
    """A rate document: quotes = {code: (value, nominal)}."""
    valute = {
        code: {
            "ID": f"R{i:05d}",
            "NumCode": f"{i:03d}",
            "CharCode": code,
            "Name": f"Currency {code}",
            "Value": value,
            "Previous": value,
            "Nominal": nominal,
        }
        for i, (code, (value, nominal)) in enumerate(sorted(quotes.items()), start=1)
    }
    return json.dumps({"Date": date_text, "Valute": valute})


def vacancy(vid, area=1, name="Data engineer", currency="RUR", lo=None, hi=None, exp="noExperience",
            sched="remote", published="2024-06-01T10:00:00+0300", skills=None):
    doc = {
        "id": vid,
        "name": name,
        "area": {"id": str(area)},
        "salary": None if currency is None and lo is None and hi is None else {"currency": currency, "from": lo, "to": hi},
        "experience": {"id": exp},
        "schedule": {"id": sched},
        "published_at": published,
    }
    if skills is not None:
        doc["key_skills"] = [{"name": s} for s in skills]
    return doc


D = dt.date
TS = dt.datetime
