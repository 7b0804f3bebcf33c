"""Table and document schemas.

JSON documents are declared with STRING leaves only and cast afterwards, so a
number and a quoted number read alike (the source reads every leaf as text).
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()


def _struct(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, S) for n in names])


# ---- landed documents -------------------------------------------------------

VACANCY_DOC = T.StructType(
    [
        T.StructField("id", S),
        T.StructField("name", S),
        T.StructField("area", _struct("id")),
        T.StructField("salary", _struct("currency", "from", "to")),
        T.StructField("experience", _struct("id")),
        T.StructField("schedule", _struct("id")),
        T.StructField("published_at", S),
        T.StructField("key_skills", T.ArrayType(_struct("name"))),
    ]
)

LIST_PAGE_DOC = T.StructType([T.StructField("items", T.ArrayType(_struct("id", "url")))])

RATE_RECORD = _struct("ID", "NumCode", "CharCode", "Name", "Value", "Previous", "Nominal")

RATES_DOC = T.StructType(
    [
        T.StructField("Date", S),
        T.StructField("Valute", T.MapType(S, RATE_RECORD)),
    ]
)

# ---- documents that do not fit ----

REJECTS = T.StructType(
    [
        T.StructField("reject_id", T.LongType(), False),
        T.StructField("source", S, False),
        T.StructField("reason", S, False),
        T.StructField("obj", S),
        T.StructField("query_profession_eng_name", S),
        T.StructField("query_dt", T.DateType()),
        T.StructField("update_ts", T.TimestampNTZType()),
        T.StructField("n_rows", T.LongType()),
    ]
)

# ---- staging ----------------------------------------------------------------

STG_VACANCIES = T.StructType(
    [
        T.StructField("obj", S, False),
        T.StructField("query_profession_eng_name", S, False),
        T.StructField("query_dt", T.DateType(), False),
        T.StructField("update_ts", T.TimestampNTZType(), False),
    ]
)

STG_EXCHANGE_RATES = T.StructType(
    [
        T.StructField("obj", S, False),
        T.StructField("query_dt", T.DateType(), False),
        T.StructField("update_ts", T.TimestampNTZType(), True),
    ]
)

# ---- dimensions -------------------------------------------------------------

D_CITY = T.StructType(
    [
        T.StructField("id", T.IntegerType(), False),
        T.StructField("name", S, False),
        T.StructField("eng_name", S, False),
    ]
)

D_QUERY_PROFESSION = T.StructType(
    [
        T.StructField("id", T.IntegerType(), False),
        T.StructField("name", S, False),
        T.StructField("eng_name", S, False),
    ]
)

D_SKILL = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("name", S)])

D_EXCHANGE_RATES = T.StructType(
    [
        T.StructField("exchange_rates_id", S, False),
        T.StructField("num_code", S, False),
        T.StructField("char_code", S, False),
        T.StructField("name", S, False),
    ]
)

# ---- detail -----------------------------------------------------------------


def _decimal(type_text: str) -> T.DecimalType:
    """``decimal(p,s)`` text → DecimalType (no session needed)."""
    p, s = type_text.strip().lower().removeprefix("decimal(").removesuffix(")").split(",")
    return T.DecimalType(int(p), int(s))


def d_vacancies(money_type: str = "decimal(18,2)") -> T.StructType:
    money = _decimal(money_type)
    return T.StructType(
        [
            T.StructField("vacancy_id", T.LongType(), False),
            T.StructField("city_id", T.IntegerType(), False),
            T.StructField("query_profession_eng_name", S, False),
            T.StructField("profession", S),
            T.StructField("salary_currency", S),
            T.StructField("salary_from", money),
            T.StructField("salary_to", money),
            T.StructField("experience", S),
            T.StructField("schedule", S),
            T.StructField("published_at", T.TimestampNTZType()),
            T.StructField("update_ts", T.TimestampNTZType()),
            T.StructField("dt", T.DateType(), False),
        ]
    )


D_VACANCIES = d_vacancies()
VACANCY_KEY = ["vacancy_id", "dt", "query_profession_eng_name"]

FCT_SKILL_VACANCY = T.StructType(
    [
        T.StructField("vacancy_id", T.LongType(), False),
        T.StructField("query_profession_eng_name", S, False),
        T.StructField("skill_name", S, False),
        T.StructField("n_links", T.LongType(), False),
        T.StructField("dt", T.DateType(), False),
    ]
)

FCT_EXCHANGE_RATES = T.StructType(
    [
        T.StructField("char_code", S, False),
        T.StructField("value", T.DecimalType(10, 4), False),
        T.StructField("previous", T.DecimalType(10, 4), False),
        T.StructField("nominal", T.IntegerType(), False),
        T.StructField("published_at", T.TimestampNTZType(), False),
        T.StructField("dt", T.DateType(), False),
    ]
)

# ---- marts ------------------------------------------------------------------

EXPERIENCE_BANDS = [
    # fixed values: (column prefix, experience id) as stored by the source
    ("no_experience", "noExperience"),
    ("between_1_and_3", "between1And3"),
    ("between_3_and_6", "between3And6"),
    ("more_than_6", "moreThan6"),
]

SCHEDULES = [
    # fixed values: (column prefix, schedule id) as stored by the source
    ("flexible", "flexible"),
    ("remote", "remote"),
    ("full_day", "fullDay"),
    ("shift", "shift"),
    ("fly_in_fly_out", "flyInFlyOut"),
]

METRIC_KEY = ["city_name", "query_profession_eng_name", "dt"]
METRIC_COUNT_COLS = ["cnt"] + [f"{p}_cnt" for p, _ in EXPERIENCE_BANDS]
METRIC_AVG_COLS = [f"{p}_avg_salary" for p, _ in EXPERIENCE_BANDS]
METRIC_SCHEDULE_COLS = [f"{p}_schedule_cnt" for p, _ in SCHEDULES]
METRIC_MEASURES = METRIC_COUNT_COLS + METRIC_AVG_COLS + METRIC_SCHEDULE_COLS

SKILL_KEY = ["city_name", "query_profession_eng_name", "skill_name", "dt"]


def dm_metrics(precision: int = 10, grain_column: bool = False) -> T.StructType:
    fields = [
        T.StructField("city_name", S, False),
        T.StructField("query_profession_eng_name", S, False),
        T.StructField("dt", T.DateType(), False),
    ]
    fields += [T.StructField(c, T.IntegerType(), False) for c in METRIC_COUNT_COLS]
    fields += [T.StructField(c, T.DecimalType(precision, 2), True) for c in METRIC_AVG_COLS]
    fields += [T.StructField(c, T.IntegerType(), False) for c in METRIC_SCHEDULE_COLS]
    if grain_column:
        fields.append(T.StructField("grain", S, False))
    return T.StructType(fields)


DM_SKILLS = T.StructType(
    [
        T.StructField("city_name", S, False),
        T.StructField("query_profession_eng_name", S, False),
        T.StructField("skill_name", S, False),
        T.StructField("dt", T.DateType(), False),
        T.StructField("top", T.IntegerType(), False),
        T.StructField("cnt", T.IntegerType(), False),
    ]
)

#: Additive partial states of dm_metrics, one row per (city, profession, day).
DM_METRIC_STATES = T.StructType(
    [
        T.StructField("city_name", S),
        T.StructField("query_profession_eng_name", S),
        T.StructField("dt", T.DateType()),
        *[T.StructField(c, T.LongType()) for c in METRIC_COUNT_COLS],
        *[T.StructField(c, T.LongType()) for c in METRIC_SCHEDULE_COLS],
        *[T.StructField(f"{p}_{kind}", T.LongType()) for kind in ("cents", "paid") for p, _ in EXPERIENCE_BANDS],
    ]
)

#: What was checked while the last load wrote.
LOAD_AUDIT = T.StructType([*[T.StructField(c, S) for c in ("table_name", "check", "target")], *[T.StructField(c, T.LongType()) for c in ("n_findings", "n_rows")]])
