"""Licence scans: Aho-Corasick for tags and notices, shunting-yard for expressions.

One automaton holds every phrase, on a text reduced to its words; a hit of the
identifier tag leads back to the text, where the licence expression that follows
is parsed and evaluated.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterator, Mapping
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases that count as base, with their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Longer notices, the label of each and how much it alone says (0 to 1).
NOTICES = {
    "gnu general public license version 2": ("gpl-2.0", 0.8),
    "gnu general public license version 3": ("gpl-3.0", 0.8),
    "gnu lesser general public license": ("lgpl", 0.8),
    "gnu affero general public license": ("agpl", 0.8),
    "apache license version 2 0": ("apache-2.0", 0.8),
    "mozilla public license": ("mpl", 0.8),
    "eclipse public license": ("epl", 0.8),
    "bsd license": ("bsd", 0.6),
    "redistribution and use in source and binary forms": ("bsd", 0.9),
    "permission is hereby granted free of charge": ("mit", 0.9),
    "permission to use copy modify and or distribute this software": ("isc", 0.9),
    "creative commons attribution": ("cc-by", 0.7),
    "cc by 4 0": ("cc-by-4.0", 0.8),
    "cc by sa": ("cc-by-sa", 0.8),
    "cc by sa 4 0": ("cc-by-sa-4.0", 0.8),
    "cc by nc": ("cc-by-nc", 0.8),
    "cc by nc 4 0": ("cc-by-nc-4.0", 0.8),
    "cc by nd": ("cc-by-nd", 0.8),
    "cc0 1 0 universal": ("cc0-1.0", 0.8),
    "all rights reserved": ("proprietary", 0.4),
}

BASE_STRENGTH = 0.5
TAG = "spdx license identifier"
TAG_STRENGTH = 0.95

# Families of the public list of licence identifiers, as a name, its versions and its variants.
FAMILIES = (
    ("gpl lgpl", "1.0 2.0 2.1 3.0", "-only -or-later"),
    ("agpl", "1.0 3.0", "-only -or-later"),
    ("gfdl", "1.1 1.2 1.3", "-only -or-later -invariants-only -invariants-or-later -no-invariants-only -no-invariants-or-later"),
    ("cc-by cc-by-nc cc-by-nc-nd cc-by-nc-sa cc-by-nd cc-by-sa", "1.0 2.0 2.5 3.0 4.0", ""),
    ("apache", "1.0 1.1 2.0", ""),
    ("bsd", "1-clause 2-clause 3-clause 4-clause", ""),
    ("bsd-2-clause", "patent views", ""),
    ("bsd-3-clause", "attribution clear lbnl modification", ""),
    ("mit", "0 cmu advertising enna feh modern-variant", ""),
    ("mpl", "1.0 1.1 2.0 2.0-no-copyleft-exception", ""),
    ("epl eupl", "1.0 1.1 1.2 2.0", ""),
    ("cecill", "1.0 1.1 2.0 2.1 b c", ""),
    ("cddl", "1.0 1.1", ""),
    ("afl", "1.1 1.2 2.0 2.1 3.0", ""),
    ("osl", "1.0 1.1 2.0 2.1 3.0", ""),
    ("artistic", "1.0 1.0-cl8 1.0-perl 2.0", ""),
    ("ofl", "1.0 1.0-no-rfn 1.0-rfn 1.1 1.1-no-rfn 1.1-rfn", ""),
    ("lppl", "1.0 1.1 1.2 1.3a 1.3c", ""),
    ("zpl", "1.1 2.0 2.1", ""),
    ("php", "3.0 3.01", ""),
    ("python", "2.0 2.0.1", ""),
    ("upl cpl ecl odbl odc-by pddl cc0 ipl apsl lpl spl busl sspl cal cern-ohl", "1.0 1.1 1.2 2.0", ""),
    ("cern-ohl-p cern-ohl-s cern-ohl-w", "2.0", ""),
)
# Identifiers of no family.
SINGLE = frozenset(
    "0bsd adsl antlr-pd beerware blessing blueoak-1.0.0 bsl-1.0 bzip2-1.0.6 cc-pddc cc-pdm-1.0 curl eudatagrid ftl hpnd ibm-pibs icu "
    "ijg imagemagick isc jasper-2.0 json libpng libpng-2.0 libtiff mit miros ms-pl ms-rl mulanpsl-1.0 mulanpsl-2.0 ncsa net-snmp "
    "netcdf ntp ogl-uk-3.0 oldap-2.8 openssl postgresql psf-2.0 qpl-1.0 ruby sgi-b-2.0 sleepycat smlnj tcl ucl-1.0 unicode-3.0 "
    "unicode-dfs-2015 unicode-dfs-2016 unlicense vim vsl-1.0 w3c wtfpl x11 xnet zend-2.0 zlib zlib-acknowledgement".split()
)
# Exceptions that may follow "with".
EXCEPTIONS = frozenset(
    "389-exception autoconf-exception-2.0 autoconf-exception-3.0 bison-exception-2.2 bootloader-exception classpath-exception-2.0 "
    "ecos-exception-2.0 fltk-exception font-exception-2.0 freertos-exception-2.0 gcc-exception-2.0 gcc-exception-3.1 gpl-3.0-linking-exception "
    "gpl-cc-1.0 i2p-gpl-java-exception lgpl-3.0-linking-exception libtool-exception linux-syscall-note llvm-exception mif-exception "
    "ocaml-lgpl-linking-exception openjdk-assembly-exception-1.0 openvpn-openssl-exception qt-gpl-exception-1.0 qt-lgpl-exception-1.1 "
    "swift-exception u-boot-exception-2.0 universal-foss-exception-1.0 wxwindows-exception-3.1".split()
)
# Identifiers, and families, that allow use with notice only.
PERMISSIVE = frozenset(
    "0bsd afl apache beerware blessing blueoak-1.0.0 bsd bsd-2-clause bsd-3-clause bsl-1.0 bzip2-1.0.6 cc-by cc-pddc cc-pdm-1.0 cc0 curl "
    "ecl ftl hpnd icu ijg imagemagick isc json libpng libpng-2.0 libtiff mit miros ms-pl mulanpsl-1.0 mulanpsl-2.0 ncsa net-snmp netcdf "
    "ntp odc-by openssl pddl php postgresql psf-2.0 python smlnj tcl unicode-3.0 unicode-dfs-2015 unicode-dfs-2016 unlicense upl vim w3c "
    "wtfpl x11 xnet zlib zlib-acknowledgement zpl".split()
)
#: A licence that the document itself defines.
_OWN = re.compile(r"(?:documentref-[a-z0-9.-]+:)?licenseref-[a-z0-9.-]+")


def licence_identifiers() -> dict[str, bool]:
    """Every known identifier, in lower case, and whether it is permissive."""
    known = {name: name in PERMISSIVE for name in SINGLE}
    for names, versions, variants in FAMILIES:
        for name in names.split():
            for version in versions.split():
                for variant in ("", *variants.split()):
                    known.setdefault(f"{name}-{version}{variant}", name in PERMISSIVE)
    return known


IDENTIFIERS = licence_identifiers()

_WORDS = bytes((c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32) for c in range(256))
_EXPRESSION = re.compile(r"spdx[^A-Za-z0-9\n]*license[^A-Za-z0-9\n]*identifier[^A-Za-z0-9\n(]*([^\n]*)", re.IGNORECASE)
_PART = re.compile(r"\s*(?:([()])|([A-Za-z0-9][A-Za-z0-9.+:-]*))")
_RANK = {"or": 1, "and": 2, "with": 3}


@dataclass(frozen=True)
class Terms:
    """An evaluated expression: the licences it names and whether permissive terms suffice."""

    licences: frozenset[str]
    permissive: bool


def to_postfix(text: str) -> list[str]:
    """The longest leading licence expression of ``text`` in postfix order.

    Shunting-yard: ``with`` binds before ``and``, ``and`` before ``or``. Reading
    ends where no operand or operator can stand; an expression that is not
    complete there raises ``ValueError``.
    """
    output: list[str] = []
    waiting: list[str] = []
    at, operand = 0, True
    while m := _PART.match(text, at):
        bracket, word = m.groups()
        if operand:
            if bracket == "(":
                waiting.append(bracket)
            elif word and word.lower() not in _RANK:
                output.append(word.rstrip(".:-").lower())
                operand = False
            else:
                raise ValueError(f"licence expected at {at}")
        elif bracket == ")":
            while waiting and waiting[-1] != "(":
                output.append(waiting.pop())
            if not waiting:
                break
            waiting.pop()
        elif word and word.lower() in _RANK:
            rank = _RANK[word.lower()]
            while waiting and waiting[-1] != "(" and _RANK[waiting[-1]] >= rank:
                output.append(waiting.pop())
            waiting.append(word.lower())
            operand = True
        else:
            break
        at = m.end()
    if operand or "(" in waiting:
        raise ValueError("incomplete expression")
    return output + waiting[::-1]


def licence_terms(word: str, known: Mapping[str, bool] = IDENTIFIERS) -> Terms:
    """The terms of one identifier, ``+`` (or a later version) allowed; an unknown one raises ``ValueError``."""
    plain = word.removesuffix("+")
    if plain not in known and not _OWN.fullmatch(word):
        raise ValueError(f"unknown licence {word}")
    return Terms(frozenset([word]), known.get(plain, False))


def evaluate(postfix: list[str], known: Mapping[str, bool] = IDENTIFIERS, exceptions: Collection[str] = EXCEPTIONS) -> Terms:
    """Licences and permissiveness: ``or`` offers a choice, ``and`` asks for both, ``with`` relaxes one.

    Every operand must be a known identifier, and what follows ``with`` a known
    exception to one licence; else the expression raises ``ValueError``.
    """
    stack: list[Terms | str] = []

    def operand() -> Terms:
        if not stack:
            raise ValueError("operand missing")
        x = stack.pop()
        return licence_terms(x, known) if isinstance(x, str) else x

    for word in postfix:
        if word not in _RANK:
            stack.append(word)
        elif word == "with":
            right = stack.pop() if stack else None
            if not isinstance(right, str) or right not in exceptions or not stack or not isinstance(stack[-1], str):
                raise ValueError("exception expected")
            left = operand()
            stack.append(Terms(frozenset(f"{a}-with-{right}" for a in left.licences), left.permissive))
        else:
            right, left = operand(), operand()
            both = left.permissive and right.permissive if word == "and" else left.permissive or right.permissive
            stack.append(Terms(left.licences | right.licences, both))
    found = operand()
    if stack:
        raise ValueError("operator missing")
    return found


def _automaton() -> ahocorasick.Automaton:
    phrases: dict[str, list[tuple[str, str, float]]] = {}
    for phrase, label in BASE.items():
        phrases.setdefault(phrase, []).append(("base", label, BASE_STRENGTH))
    for phrase, (label, strength) in NOTICES.items():
        phrases.setdefault(phrase, []).append(("notice", label, strength))
    phrases.setdefault(TAG, []).append(("tag", "", 0.0))
    out = ahocorasick.Automaton()
    for phrase, meanings in phrases.items():
        out.add_word(f" {phrase} ", (len(phrase) + 2, meanings))
    out.make_automaton()
    return out


_FOUND = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, expressions array<string>, permissive boolean"


def scan_text(text: str, automaton: ahocorasick.Automaton, known: Mapping[str, bool] = IDENTIFIERS) -> tuple:
    """The columns of ``scan_licenses`` for one text, without its id."""
    words = text.encode().translate(_WORDS).split()
    line = f" {b' '.join(words).decode()} "
    places: list[int] = []
    base: set[str] = set()
    strength: dict[str, float] = {}
    tagged = False
    for end, (size, meanings) in automaton.iter(line):
        for kind, label, weight in meanings:
            if kind == "tag":
                tagged = True
                continue
            if kind == "base":
                places.append(end + 1 - size)
                base.add(label)
            strength[label] = max(weight, strength.get(label, 0.0))
    expressions: list[str] = []
    permissive = None
    if tagged:
        for m in _EXPRESSION.finditer(text):
            try:
                postfix = to_postfix(m[1])
                terms = evaluate(postfix, known)
            except ValueError:
                continue
            expressions.append(" ".join(postfix))
            permissive = terms.permissive if permissive is None else permissive and terms.permissive
            for licence in terms.licences:
                strength[licence] = max(TAG_STRENGTH, strength.get(licence, 0.0))
    missing = 1.0
    for label in sorted(strength):
        missing *= 1.0 - strength[label]
    first, last = (line.count(" ", 0, min(places)), line.count(" ", 0, max(places))) if places else (None, None)
    return len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(strength)), 1.0 - missing, expressions, permissive


def scan_licenses(docs: DataFrame, identifiers: Mapping[str, bool] = IDENTIFIERS) -> DataFrame:
    """One row for every row of ``docs``: words, base places, labels, score, expressions.

    ``score`` is one minus the product of what each label leaves open. An
    expression that does not parse, or names a licence that is not among
    ``identifiers`` (lower case, and whether it is permissive) and no
    ``LicenseRef-``, adds nothing. ``permissive`` tells whether
    all expressions can be met by permissive terms; null without expressions.
    A null text is empty: no words, no labels, score 0. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        for batch in batches:
            rows = [scan_text(t.as_py() or "", automaton, identifiers) for t in batch.column(1)]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 9
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.string()), pa.bool_()]
            names = [x.split()[0] for x in _FOUND.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _FOUND)
