"""Licence identifiers and expressions."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from labormart.llm import licenses


def labels(text: str) -> tuple[str, bool | None]:
    found = licenses.scan_text(text, licenses._automaton())
    return found[5], found[8]


@pytest.mark.parametrize(
    "tag, found",
    [
        ("MIT", ("mit", True)),
        ("GPL-2.0+", ("gpl-2.0+", False)),
        # the phrases in an identifier count as well
        ("(CC-BY-SA-4.0 AND MIT-0) -->", ("cc-by,cc-by-sa,cc-by-sa-4.0,mit-0", False)),
        ("GPL-2.0-only WITH Linux-syscall-note OR BSD-3-Clause", ("bsd-3-clause,gpl-2.0-only-with-linux-syscall-note", True)),
        ("LicenseRef-Own AND ISC", ("isc,licenseref-own", False)),
        ("DocumentRef-a:LicenseRef-b", ("documentref-a:licenseref-b", False)),
        # no licence: prose, unknown names, exceptions out of place, exceptions to more than one licence
        ("is required in every file", ("", None)),
        ("mitochondria", ("", None)),
        ("MIT OR Foo-1.0", ("", None)),
        ("MIT WITH Apache-2.0", ("", None)),
        ("Classpath-exception-2.0", ("", None)),
        ("(MIT OR ISC) WITH LLVM-exception", ("", None)),
    ],
)
def test_only_known_identifiers_count(tag, found):
    assert labels(f"// SPDX-License-Identifier: {tag}\ncode") == found


def test_identifiers_are_a_parameter(llm):
    df = llm.createDataFrame([(1, "SPDX-License-Identifier: House-1.0"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: (r.labels, r.permissive) for r in licenses.scan_licenses(df, {"house-1.0": True}).collect()}
    assert rows == {1: ("house-1.0", True), 2: ("", None)}
    assert licenses.scan_licenses(df.where("doc_id < 0")).collect() == []


IDS = st.sampled_from(["mit", "isc", "gpl-3.0-only", "mpl-2.0"])
TREE = st.recursive(IDS, lambda t: st.tuples(st.sampled_from(["and", "or"]), t, t), max_leaves=12)


def written(tree) -> str:
    return tree if isinstance(tree, str) else f"({written(tree[1])} {tree[0]} {written(tree[2])})"


def plain(tree) -> tuple[set, bool]:
    if isinstance(tree, str):
        return {tree}, tree in ("mit", "isc")
    (a, x), (b, y) = plain(tree[1]), plain(tree[2])
    return a | b, x and y if tree[0] == "and" else x or y


@settings(max_examples=150, deadline=None)
@given(TREE)
def test_expressions_equal_a_plain_evaluation(tree):
    found = licenses.evaluate(licenses.to_postfix(written(tree)))
    assert (set(found.licences), found.permissive) == plain(tree)
