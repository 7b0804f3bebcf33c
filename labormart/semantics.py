"""Behaviour presets.

REFERENCE reproduces the source system's results, including its quirks.
CORRECTED fixes each quirk. Every field names the quirk it controls
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Semantics:
    # Q1: characters kept of the schedule id (the source cuts to 10).
    schedule_len: int = 10
    # Q2: divide the rate by its nominal (per-100 quotes).
    use_nominal: bool = False
    # Q3/Q14: join skill links on the full vacancy key and drop repeats.
    keyed_bridge: bool = False
    # Q4: keep day and week rows apart with a ``grain`` column in the key.
    grain_column: bool = False
    # Q5: replace the dt partitions of the fact tables instead of appending.
    replace_facts: bool = False
    # Q6: replace the day's whole ranking instead of upserting it.
    replace_rank_slice: bool = False
    # Q7: two different incoming rows with one key: "error" or "latest".
    on_duplicate: str = "error"
    # Q8: drop skill entries without a name.
    drop_null_skills: bool = False
    # Q10: an experience band without salaries averages to NULL, not 0.
    empty_avg_as_null: bool = False
    # Q11: dashboard salary mean weighted by the band's vacancy count.
    weighted_dashboard_avg: bool = False
    # Q12: currency codes treated as the home currency besides ``home_currency``.
    home_aliases: tuple[str, ...] = ()
    home_currency: str = "RUR"
    # Q16/Q-RNG: precision of per-vacancy salaries and mart averages.
    salary_precision: int = 10
    # Q18: collation for the skill-name tie-break (None = binary order).
    name_collation: str | None = None
    # Truncation lengths of the flattened vacancy (varchar(n) casts).
    name_len: int = 100
    currency_len: int = 10
    experience_len: int = 20
    skill_name_len: int = 150
    # X1b/Q-RNG/Q-LEN: keep documents that do not fit in ``rejects`` instead of failing.
    quarantine: bool = False

    def with_(self, **changes) -> "Semantics":
        return replace(self, **changes)

    @property
    def home_codes(self) -> tuple[str, ...]:
        return (self.home_currency, *self.home_aliases)

    @property
    def money_type(self) -> str:
        return f"decimal({self.salary_precision},2)"


REFERENCE = Semantics()

CORRECTED = Semantics(
    schedule_len=20,
    use_nominal=True,
    keyed_bridge=True,
    grain_column=True,
    replace_facts=True,
    replace_rank_slice=True,
    on_duplicate="latest",
    drop_null_skills=True,
    empty_avg_as_null=True,
    weighted_dashboard_avg=True,
    home_aliases=("RUB",),
    salary_precision=18,
    quarantine=True,
)

PRESETS = {"reference": REFERENCE, "corrected": CORRECTED}


def preset(name: str | Semantics) -> Semantics:
    if isinstance(name, Semantics):
        return name
    try:
        return PRESETS[name.lower()]
    except KeyError as exc:
        raise ValueError(f"unknown semantics preset {name!r}; use one of {sorted(PRESETS)}") from exc


__all__ = ["Semantics", "REFERENCE", "CORRECTED", "PRESETS", "preset"]
