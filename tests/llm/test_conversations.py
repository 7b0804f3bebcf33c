"""Conversation operators on odd inputs and the smallest table, against plain versions."""

import brute
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from labormart.llm import hirschberg, prefix_trie, repair, turns
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, place long, depth int, part string"


@pytest.fixture(scope="module")
def chats(llm):
    """Nulls, empty and long texts, equal turns, repeated rows, shared beginnings, an unusually long one."""
    rows = []
    for c in range(60):
        for t in range(c % 13):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"says {t % 3} about {c % 4}." if c % 3 else "Same."))
    rows += [(61, None, "user", "first"), (61, 0, None, None), (61, 1, "assistant", ""), (61, 1, "assistant", "tie!"), (61, 2, "assistant", "x " * 50_000)]
    rows += [(62, 0, "system", "S."), (62, 1, "user", "Q?"), (62, 1, "user", "Q?"), (62, 3, "tool", "T"), (None, 0, "user", "nobody")]
    rows += [(65, t, "assistant" if t % 2 else "user", f"turn {t}" + "." * (t % 2)) for t in range(40)]
    rows += [(66, t, "assistant" if t % 2 else "user", f"turn {t}" + "." * (t % 2)) for t in range(25)]
    rows += [(67, t, "user", "same") for t in range(30)] + [(9_000_000_001, 0, "user", "far")]
    return llm.createDataFrame([(*r, 1, 2, "p") for r in rows], SCHEMA)


def plain(df):
    return [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]


def trie_rows(df):
    return [(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in prefix_trie.prefix_trie(df).collect()]


@pytest.mark.parametrize("block", [4096, 7])
def test_trie_on_odd_conversations(chats, monkeypatch, block):
    """Also with blocks of seven turns, so that chains and prefixes cross them."""
    monkeypatch.setattr(turns, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "END_IDS", 4)
    # equal turns go by a hash here, in the plain version by text: keep one of them
    fixed = chats.where("text IS NULL OR text <> 'tie!'")
    got = trie_rows(fixed)
    assert len(got) == len(set(got)) and set(got) == brute.prefix_trie(plain(fixed))


def test_trie_on_the_smallest_table(llm):
    df = llm.read.parquet(f"{SF}/conversations.parquet")
    got = trie_rows(df)
    assert len(got) == len(set(got)) and set(got) == brute.prefix_trie(plain(df))


def test_trie_without_rows_or_turns(llm, chats):
    assert prefix_trie.prefix_trie(chats.where("false")).count() == 0
    # a conversation whose turns all fall under a head that does not exist ends at the root
    lonely = next(c for c in range(1, 500) if c % 5 and prefix_trie_head(c) >= 2)
    df = llm.createDataFrame([(lonely, 0, "user", "gone")], "conv_id long, turn long, role string, text string")
    assert set(trie_rows(df)) == brute.prefix_trie(plain(df))


def prefix_trie_head(c):
    import zlib

    return zlib.crc32(str(c).encode()) % 9


def test_equal_turns_keep_all_rows(chats):
    """Turns that tie are all there, in some fixed order."""
    tied = chats.where("conv_id = 61")
    first, second = trie_rows(tied), trie_rows(tied)
    assert sorted(map(str, first)) == sorted(map(str, second)) and max(r[1] for r in first) == 5 - min(5, prefix_trie_head(61))
    assert tied.where(F.col("conv_id") == 61).count() == 5


def repairs(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in repair.repair_damaged(df).collect()}


@pytest.mark.parametrize("block", [4096, 3])
def test_repair_on_odd_conversations(chats, monkeypatch, block):
    """Also with blocks of three turns, whose moves are joined before the rows are solved."""
    monkeypatch.setattr(turns, "BLOCK", block)
    fixed = chats.where("text IS NULL OR text <> 'tie!'")
    want = {c: brute.repair(ts) for c, ts in brute.damaged(plain(fixed)).items()}
    assert repairs(fixed) == want


def test_repair_on_the_smallest_table(llm):
    df = llm.read.parquet(f"{SF}/conversations.parquet")
    assert repairs(df) == {c: brute.repair(ts) for c, ts in brute.damaged(plain(df)).items()}
    assert repair.repair_damaged(df.where("false")).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", "unknown", " "]), st.sampled_from(["a.", "b.", "c", "", "d!", "e", " "])), max_size=9), st.integers(1, 4))
def test_edits_are_the_cheapest_and_the_smallest(turns_, size):
    """Blocks of any size give the same letters as a search over all edits."""
    rows = [(i, r, t) for i, (r, t) in enumerate(turns_)]
    kinds = {"": 0, "truncated": 1, "blank": 2, "duplicate": 3}
    classes = "".join(hirschberg.CLASSES["sua".find(r[:1]) % 4 * 4 + kinds[k]] for (_, r, _), k in zip(rows, brute.faults(rows), strict=True))
    solver = hirschberg.Solver()
    blocks = [classes[i : i + size] for i in range(0, len(classes), size)]
    moves = [solver.block_moves(b) for b in blocks]
    vector, cost = solver.forward(moves, hirschberg.unit(0))
    last = hirschberg.ending(vector)
    states = [0, *(solver.states(moves, 0, last) if moves else [])]
    audit = "".join(solver.letters(b, states[i], states[i + 1]) for i, b in enumerate(blocks)) + hirschberg.CLOSING[last]
    assert (cost + vector[last][0] + 3 * len(hirschberg.CLOSING[last]), audit) == brute.repair(rows)[5:7]
