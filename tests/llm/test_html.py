"""Layout and visibility of rendered pages: golden pages, a plain renderer, and time on hostile pages."""

import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from labormart.llm import html_text


def shown(page: str) -> str:
    return html_text.render(page)[0]


@pytest.mark.parametrize(
    "page, text",
    [
        # cells stand in their columns, whatever spans lie above or before
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a | b\n  | c"),
        ("<table><tr><td colspan=2>head<td>x<tr><td>1<td>22<td>3</table>", "head |    | x\n1 | 22 | 3"),
        ("<table><tr><td>a<td rowspan=0>b<td>c<tr><td>d<td>e<tr><td>f<td>g</table>", "a | b | c\nd |   | e\nf |   | g"),
        ("<table><tr><td rowspan=x colspan=-3>a<td>b</table>", "a | b"),
        # a page laid out in a table keeps its blocks
        ("<table><tr><td><h1>T</h1><p>one</p><p>two</p><ul><li>a<li>b</ul></table>", "T\n\none\n\ntwo\n\n- a\n- b"),
        ("<table><tr><td>nav<td><p>one<p>two<tr><td>x<td>y</table>", "nav\n\none\n\ntwo\n\nx | y"),
        ("<table><tr><td>k<td><pre>l1\n  l2</pre><tr><td>m<td>n</table>", "k | l1\n  |   l2\nm | n"),
        ("<table><tr><td>a<br>b<td>c</table>", "a | c\nb |"),
        ("<table><tr><td>o<td><table><tr><td>i<td>j</table></table>", "o | i | j"),
        # visibility is what a browser shows
        ("<p aria-hidden=true>seen", "seen"),
        ("<details><summary>More</summary><p>body</details><details open><summary>Less</summary><p>shown</details>", "More\nLess\n\nshown"),
        ("<dialog>no</dialog><dialog open>yes</dialog><p popover>no", "yes"),
        ("<div style='visibility:hidden'>no <b style='visibility: visible'>yes</b> no</div>", "yes"),
        ("<div style='display:none'><b style='visibility:visible'>no</b></div>x", "x"),
        ("<ul><li style='visibility:hidden'>no<li>b</ul>", "- b"),
        ("<p hidden style='display:block'>yes<p style='display:none;display:inline'>too", "yes\n\ntoo"),
        # what the page's end cuts off, as in a browser
        ("a<!-- b", "a"), ("a<b title='x>y", "ay"), ("a <b", "a"), ("1 < 2 <!--> c <!---> d", "1 < 2 c d"), ("a</", "a</"), ("a<!x>b</3>c<?y>d", "abcd"),
        ("<script>no</script x>yes", "yes"), ("<script>no</scriptx>no", ""),
        (f"&#{'9' * 5000};x &#x41;", "\ufffdx A"),
    ],
)
def test_golden_pages(page, text):
    assert shown(page) == text


LEAF = st.sampled_from(["w", "hidden", "gone"])
TREE = st.recursive(LEAF, lambda t: st.tuples(st.sampled_from(["div", "section", "span", "b", "ul", "table", "visible", "unseen", "closed"]), st.lists(t, max_size=4)), max_leaves=20)


def page_of(tree, count, see=True) -> tuple[str, list[str]]:
    """A page of the tree and its visible words, found by plain recursion."""
    if isinstance(tree, str):
        word = f"w{next(count)}"
        page = {"w": f" {word} ", "hidden": f"<i style='visibility:hidden'> {word} </i>", "gone": f"<i hidden> {word} </i>"}[tree]
        return page, [word] if tree == "w" and see else []
    tag, children = tree
    see = {"visible": True, "unseen": False}.get(tag, see)
    made = [page_of(c, count, see) for c in children]
    words = [] if tag == "closed" else [w for _, x in made for w in x]
    inner = [p for p, _ in made]
    if tag == "ul":
        return "<ul>" + "".join(f"<li>{p}" for p in inner) + "</ul>", words
    if tag == "table":
        return "<table>" + "".join(f"<tr><td>{p}" for p in inner) + "</table>", words
    if tag in ("visible", "unseen"):
        return f"<div style='visibility:{'visible' if tag == 'visible' else 'hidden'}'>{''.join(inner)}</div>", words
    if tag == "closed":
        return f"<details><div>{''.join(inner)}</div></details>", words
    return f"<{tag}>{''.join(inner)}</{tag}>", words


@settings(max_examples=200, deadline=None)
@given(st.lists(TREE, max_size=5))
def test_visible_words_equal_a_plain_walk(trees):
    import itertools

    count = itertools.count()
    made = [page_of(t, count) for t in trees]
    assert re.findall(r"w[0-9]+", shown("".join(p for p, _ in made))) == [w for _, x in made for w in x]


HOSTILE = {
    "unclosed quotes": "<a '",
    "quotes and ends": "<a '>",
    "nested blocks": "<div>",
    "nested lists": "<ul><li>x",
    "nested tables": "<table><tr><td>x",
    "nested quotes": "<blockquote>x",
    "stray ends": "<div></p></b>",
    "under a boundary": "<span><div>",
    "open comments": "<!-- - --",
    "open declarations": "<!",
    "open raw ends": "<script></script ",
    "wide spans": "<table><td colspan=1000 rowspan=60000>x<td>y</table>",
    "long spans": "<td rowspan=60000>x<tr><td>y",
    "blank attributes": "<a b    =    c    ",
    "references": "&#9999999999999999;&ampx",
}


@pytest.mark.parametrize("name", HOSTILE)
def test_hostile_pages_take_linear_time(name):
    def seconds(times: int) -> float:
        page = ("<table><tr>" if name == "long spans" else "<p><button>" if name == "under a boundary" else "") + HOSTILE[name] * times
        best = 1e9
        for _ in range(2):
            at = time.process_time()
            text = shown(page)
            best = min(best, time.process_time() - at)
        assert len(text) < 300 * len(page) + 1000
        return best

    # quadratic time would be 64 times as long
    assert seconds(16_000) < 24 * seconds(2_000) + 0.5
