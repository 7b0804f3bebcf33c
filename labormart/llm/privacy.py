"""Format-preserving pseudonyms for personal data; DataFrame functions only.

Numbers and dates that pass their own checks are moved by a keyed permutation
within their format: a card number becomes another one with a right check
digit, a date another date written the same way. The permutation is a Feistel
network over two halves with modular addition, so it is one to one, and equal
values stay linked across documents. What fails its check stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labormart.llm.common import fresh
from labormart.llm.quality import let

ROUNDS = 8

# The forms that are looked at, in the order in which they are tried.
_LEFT = r"(?<![A-Za-z0-9._%+-])"
EMAIL = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
SECRET = r"(?i:password|passwd|pwd|token|secret|api[_-]?key)[ \t]*[=:][ \t]*[\"']?(?=[A-Za-z+/_.-]*[0-9]|[A-Z0-9+/_.-]*[a-z][a-z0-9+/_.-]*[A-Z]|[A-Za-z0-9+/_.-]{20})[A-Za-z0-9+/_.-]{6,}"
ACCESS_KEY = r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])"
DATE = r"(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4})(?![0-9])(?!\.[0-9])"
IPV4 = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])(?!\.[0-9])"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
PHONE = r"(?:\+?[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
ABROAD = r"\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9])"
CARD = r"[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"
HEX = r"[0-9a-f]{32,}(?![0-9A-Za-z])"
_EDGE = r"(?<![0-9A-Za-z._%+-])"
FOUND = "|".join([_LEFT + EMAIL, r"(?<![A-Za-z])" + SECRET, _EDGE + ACCESS_KEY, *[r"(?<![0-9A-Za-z.])" + p for p in (DATE, IPV4, SSN)], r"(?<![0-9A-Za-z.+(])(?:" + PHONE + "|" + ABROAD + "|" + CARD + ")", _EDGE + HEX])

#: Dates of this span are permuted among themselves: 400 years of 146,097 = 189 x 773 days.
FIRST_DATE = "1800-01-01"
DAY_HALVES = (189, 773)
#: The days after the 12th among them: 400 years of 88,497 = 9 x 9,833 days.
LATE_HALVES = (9, 9833)


def _number(value: Column) -> Column:
    return value.cast("decimal(20,0)").cast("long")


def feistel(left: Column, right: Column, left_size: Column, right_size: Column, key: str, kind: str) -> Column:
    """Struct ``(l, r)``: ``(left, right)`` moved within ``left_size`` x ``right_size`` one to one.

    In turn, each half adds a keyed hash of the other, modulo its own size.
    """

    def added(r: Column, half: Column, other: Column, size: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), r.cast("string"), other.cast("string"), left_size.cast("string")), 256)
        return F.pmod(half + F.pmod(_number(F.conv(F.substring(digest, 1, 15), 16, 10)), size), size)

    def step(state: Column, r: Column) -> Column:
        return F.when(r % 2 == 0, F.struct(added(r, state["l"], state["r"], left_size).alias("l"), state["r"].alias("r"))).otherwise(F.struct(state["l"].alias("l"), added(r, state["r"], state["l"], right_size).alias("r")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")), step)


def _moved_digits(digits: Column, key: str, kind: str) -> Column:
    """A string of 2 to 36 digits as another one of the same length."""

    def halves(d: Column) -> Column:
        cut = F.ceil(F.length(d) / 2).cast("int")
        rest = F.length(d) - cut
        size = lambda n: F.pow(F.lit(10.0), n).cast("long")
        moved = feistel(_number(F.substr(d, F.lit(1), cut)), _number(F.coalesce(F.nullif(F.substr(d, cut + 1, rest), F.lit("")), F.lit("0"))), size(cut), size(rest), key, kind)
        return let(moved, lambda m: F.concat(F.lpad(m["l"].cast("string"), cut, F.lit("0")), F.when(rest > 0, F.lpad(m["r"].cast("string"), rest, F.lit("0"))).otherwise("")))

    return let(digits, halves)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _refilled(value: Column, digits: Column) -> Column:
    """``value`` with its digits, from left to right, replaced by ``digits``."""

    def filled(d: Column) -> Column:
        char = lambda i: F.substr(value, i, F.lit(1))
        count = lambda i: F.length(_digits(F.substr(value, F.lit(1), i)))
        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), lambda i: F.when(char(i).rlike("[0-9]"), F.substr(d, count(i), F.lit(1))).otherwise(char(i))), "")

    return let(digits, filled)


def _moved_text(value: Column, key: str, kind: str, hexadecimal: bool = False) -> Column:
    """A string whose letters and digits are moved within their own kind, place by place."""
    alphabet = "0123456789abcdef"

    def shifted(text: Column, other: Column, r: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), r.cast("string"), other, F.length(text).cast("string")), 256)

        def moved(h: Column) -> Column:
            def one(i: Column) -> Column:
                c, k = F.substr(text, i, F.lit(1)), _number(F.conv(F.substr(h, F.pmod(i * 3, F.lit(60)).cast("int") + 1, F.lit(4)), 16, 10))
                if hexadecimal:
                    return F.substr(F.lit(alphabet), F.pmod(F.instr(F.lit(alphabet), c) - 1 + k, F.lit(16)).cast("int") + 1, F.lit(1))
                turn = lambda low, n: F.char(F.lit(low) + F.pmod(F.ascii(c) - low + k, F.lit(n)))
                return F.when(c.rlike("[0-9]"), turn(48, 10)).when(c.rlike("[a-z]"), turn(97, 26)).when(c.rlike("[A-Z]"), turn(65, 26)).otherwise(c)

            return F.when(F.length(text) == 0, "").otherwise(F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), one), ""))

        return let(digest, moved)

    def step(state: Column, r: Column) -> Column:
        return F.when(r % 2 == 0, F.struct(shifted(state["l"], state["r"], r).alias("l"), state["r"].alias("r"))).otherwise(F.struct(state["l"].alias("l"), shifted(state["r"], state["l"], r).alias("r")))

    cut = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(F.substr(value, F.lit(1), cut).alias("l"), F.substr(value, cut + 1, F.length(value) - cut).alias("r"))
    return let(F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step), lambda m: F.concat(m["l"], m["r"]))


def _card(value: Column, key: str) -> Column:
    """Another number of the same length, first digit and punctuation, with a right check digit."""
    lead = F.substr(_digits(value), F.lit(1), F.lit(1))
    payload = lambda d: F.substr(d, F.lit(2), F.length(d) - 2)
    checked = lambda p: F.concat(p, F.element_at(F.filter(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda c: c.cast("string")), lambda c: F.call_function("luhn_check", F.concat(p, c))), 1))
    return F.when(F.call_function("luhn_check", _digits(value)), _refilled(value, let(F.concat(lead, _moved_digits(payload(_digits(value)), key, "card")), checked)))


def _phone(value: Column, key: str) -> Column:
    """Area code and exchange keep first digits of 2 to 9 where both have them; a country code stays."""

    def moved(d: Column) -> Column:
        code, ten = F.substr(d, F.lit(1), F.length(d) - 10), F.substr(d, F.length(d) - 9, F.lit(10))
        regular = ten.rlike("^[2-9][0-9]{2}[2-9]")
        area, rest = _number(F.substr(ten, F.lit(1), F.lit(3))) - 200, _number(F.substr(ten, F.lit(4), F.lit(7))) - 2_000_000
        plain = let(feistel(area, rest, F.lit(800), F.lit(8_000_000), key, "phone"), lambda m: F.concat((m["l"] + 200).cast("string"), (m["r"] + 2_000_000).cast("string")))
        return F.concat(code, F.when(regular, plain).otherwise(_moved_digits(ten, key, "phone-other")))

    digits = _digits(value)
    long = F.length(digits) >= 10
    return _refilled(value, F.when(long, let(digits, moved)).otherwise(_moved_digits(digits, key, "phone-other")))


def _abroad(value: Column, key: str) -> Column:
    return _refilled(value, let(_digits(value), lambda d: F.concat(F.substr(d, F.lit(1), F.lit(2)), _moved_digits(F.substr(d, F.lit(3), F.length(d) - 2), key, "abroad"))))


def _ipv4(value: Column, key: str) -> Column:
    def moved(o: Column) -> Column:
        pair = lambda i: _number(F.get(o, F.lit(i))) * 256 + _number(F.get(o, F.lit(i + 1)))
        spelled = lambda m: F.concat_ws(".", *[x.cast("bigint").cast("string") for half in ("l", "r") for x in (F.floor(m[half] / 256), F.pmod(m[half], F.lit(256)))])
        fine = F.forall(o, lambda x: _number(x) <= 255)
        return F.when(fine, let(feistel(pair(0), pair(2), F.lit(65_536), F.lit(65_536), key, "ipv4"), spelled))

    return let(F.split(value, r"\."), moved)


def _ssn(value: Column, key: str) -> Column:
    """Areas 001 to 665 and 667 to 899, groups 01 to 99, serials 0001 to 9999."""

    def moved(d: Column) -> Column:
        area, group, serial = _number(F.substr(d, F.lit(1), F.lit(3))), _number(F.substr(d, F.lit(4), F.lit(2))), _number(F.substr(d, F.lit(6), F.lit(4)))
        fine = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
        spelled = lambda m: F.concat(F.lpad((m["l"] + F.when(m["l"] >= 665, 2).otherwise(1)).cast("string"), 3, "0"), F.lpad((F.floor(m["r"] / 9999) + 1).cast("string"), 2, "0"), F.lpad((m["r"] % 9999 + 1).cast("string"), 4, "0"))
        changed = let(feistel(area - F.when(area > 666, 2).otherwise(1), (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), key, "ssn"), spelled)
        return F.when(fine, _refilled(value, changed))

    return let(_digits(value), moved)


def _late_rank(day: Column) -> Column:
    """Place of a day after the 12th of its month among all such days from ``FIRST_DATE`` on."""
    return F.datediff(day, F.to_date(F.lit(FIRST_DATE))) - 12 * (_month(day) + 1)


def _late_day(rank: Column) -> Column:
    """The day at a place of ``_late_rank``; the mean month has 88,497 / 4,800 such days."""
    around = F.floor(rank * 4800 / 88_497)
    fits = F.filter(F.transform(F.sequence(around - 2, around + 2), lambda m: F.struct(m.alias("m"), F.date_add(F.to_date(F.lit(FIRST_DATE)), (rank + 12 * (m + 1)).cast("int")).alias("day"))), lambda x: (_month(x["day"]) == x["m"]) & (F.day(x["day"]) > 12))
    return F.get(fits, F.lit(0))["day"]


def _month(day: Column) -> Column:
    return (F.year(day) - int(FIRST_DATE[:4])) * 12 + F.month(day) - 1


def _date(value: Column, key: str) -> Column:
    """Another day, written in the same form; days outside the 400 years stay.

    A slash date is day-first where that is a date, and month-first otherwise.
    The latter have a day after the 12th and move among such days, so that the
    two never meet. Parts of one digit are written without a leading zero.
    """

    def among(n: Column, halves: tuple[int, int], kind: str, at) -> Column:
        a, b = halves
        return F.when(n.between(0, a * b - 1), let(feistel(F.floor(n / b), n % b, F.lit(a), F.lit(b), key, kind), lambda m: at(m["l"] * b + m["r"])))

    def written(p: Column) -> Column:
        one, two, three = (F.get(p, F.lit(i)) for i in range(3))
        mark = F.substr(value, F.length(one) + 1, F.lit(1))
        day = lambda y, m, d: F.try_to_date(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")
        part = lambda x, like: F.when(F.length(like) == 2, F.lpad(x.cast("string"), 2, "0")).otherwise(x.cast("string"))
        moved = lambda x: let(F.datediff(x, F.to_date(F.lit(FIRST_DATE))), lambda n: among(n, DAY_HALVES, "date", lambda i: F.date_add(F.to_date(F.lit(FIRST_DATE)), i.cast("int"))))
        late = lambda x: let(_late_rank(x), lambda n: among(n, LATE_HALVES, "date-month-first", _late_day))
        year_first = let(moved(day(one, two, three)), lambda x: F.concat(F.year(x).cast("string"), mark, part(F.month(x), two), mark, part(F.day(x), three)))
        day_first = let(moved(day(three, two, one)), lambda x: F.concat(part(F.day(x), one), mark, part(F.month(x), two), mark, F.year(x).cast("string")))
        month_first = let(late(day(three, one, two)), lambda x: F.concat(part(F.month(x), one), mark, part(F.day(x), two), mark, F.year(x).cast("string")))
        return F.when(F.length(one) == 4, year_first).when((mark == "/") & day(three, two, one).isNull(), month_first).otherwise(day_first)

    return let(F.split(value, "[-/.]"), written)


def _email(value: Column, key: str) -> Column:
    return let(F.split(value, "@"), lambda p: F.concat(_moved_text(F.get(p, F.lit(0)), key, "email"), F.lit("@"), F.get(p, F.lit(1))))


def _secret(value: Column, key: str) -> Column:
    lead = F.regexp_extract(value, r"^(?i:password|passwd|pwd|token|secret|api[_-]?key)[ \t]*[=:][ \t]*[\"']?", 0)
    rest = F.substr(value, F.length(lead) + 1, F.length(value))
    return F.concat(lead, F.when(rest.rlike("^[0-9a-f]+$"), _moved_text(rest, key, "hex", hexadecimal=True)).otherwise(_moved_text(rest, key, "secret")))


def pseudonym(value: Column, key: str) -> Column:
    """Struct ``(kind, text)`` of one match of ``FOUND``; null text where its own check fails."""
    whole = lambda p: value.rlike(f"^(?:{p})$")
    named = lambda kind, text: F.struct(F.lit(kind).alias("kind"), text.alias("text"))
    return (
        F.when(whole(EMAIL), named("email", _email(value, key)))
        .when(whole(SECRET), named("secret", _secret(value, key)))
        .when(whole(ACCESS_KEY), named("secret", F.concat(F.lit("AKIA"), _moved_text(F.substr(value, F.lit(5), F.lit(16)), key, "access"))))
        .when(whole(DATE), named("date", _date(value, key)))
        .when(whole(IPV4), named("ipv4", _ipv4(value, key)))
        .when(whole(SSN), named("ssn", _ssn(value, key)))
        .when(whole(PHONE), named("phone", _phone(value, key)))
        .when(whole(ABROAD), named("phone", _abroad(value, key)))
        .when(whole(HEX) & ~value.rlike("^[0-9]+$"), named("secret", _moved_text(value, key, "hex", hexadecimal=True)))
        .when(whole(CARD), named("card", _card(value, key)))
    )


KINDS = ("email", "secret", "date", "ipv4", "ssn", "phone", "card")


def pseudonymised(docs: DataFrame, key: str, text_column: str = "text", counts: bool = False) -> DataFrame:
    """``docs`` with the personal data of its text moved within their formats.

    All else of the text, and all other columns, stay; a null text stays null.
    With ``counts``, a column ``n_<kind>`` for each kind tells how many values
    were replaced; an input column of that name is replaced. Every row is
    treated by itself, so repeated rows come out alike. Whoever has ``key`` can
    undo the pseudonyms, so there is no default, and an empty one is refused. A
    word after ``password:`` and the like is a secret if it holds a digit, a
    capital after a small letter, or at least 20 characters.
    """
    if not key:
        raise ValueError("pseudonyms need a key")
    text = F.col(text_column).cast("string")

    def changed(m: Column) -> Column:
        parts = F.zip_with(F.split(text, FOUND, -1), F.concat(F.transform(m, lambda x: F.coalesce(x["new"]["text"], x["old"])), F.array(F.lit(""))), lambda gap, value: F.concat(gap, value))
        of_kind = lambda kind: F.size(F.filter(m, lambda x: x["new"]["text"].isNotNull() & (x["new"]["kind"] == kind))).cast("long").alias(f"n_{kind}")
        return F.struct(F.array_join(parts, "").alias("text"), *[of_kind(kind) for kind in KINDS])

    found = F.transform(F.regexp_extract_all(text, F.lit(FOUND), F.lit(0)), lambda v: F.struct(v.alias("old"), pseudonym(v, key).alias("new")))
    nothing = F.struct(text.alias("text"), *[F.lit(0).cast("long").alias(f"n_{kind}") for kind in KINDS])
    # every form holds a digit, an at sign, or the mark that follows a secret's name
    new = F.when(text.rlike("[0-9@=:]"), let(found, lambda m: F.when(F.size(m) == 0, nothing).otherwise(changed(m)))).otherwise(nothing)
    inner = fresh("_pseudonymised", docs.columns)
    out = docs.withColumn(inner, new)
    out = out.withColumn(text_column, F.col(f"{inner}.text"))
    if counts:
        out = out.withColumns({f"n_{kind}": F.col(f"{inner}.n_{kind}") for kind in KINDS})
    return out.drop(inner)
