"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def jaccard(docs, percent=75):
    """{doc_id: (n_shingles, component_id)} by comparing every pair that shares a shingle."""
    sets = {}
    for doc_id, text in docs:
        w = words(lower(text))
        sets[doc_id] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    lists = collections.defaultdict(list)
    for doc_id, s in sets.items():
        for x in s:
            lists[x].append(doc_id)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    shared = collections.Counter()
    for members in lists.values():
        shared.update((a, b) for i, a in enumerate(members) for b in members[:i])
    links = set()
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            links.add((a, b))
            p, q = find(a), find(b)
            parent[max(p, q)] = min(p, q)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def repeats(docs, window=20):
    """{doc_id: (n_words, n_removed, kept_sha256)}."""
    first = {}
    docs = sorted(docs)
    for doc_id, text in docs:
        w = words(text)
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), (doc_id, i))
    out = {}
    for doc_id, text in docs:
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] != (doc_id, i):
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[doc_id] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def base_quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    w = words(text)
    seen = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if words(x)]
    return (
        len(w),
        sum(map(len, w)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        len(w) < 50 or 100 * len(covered) > 50 * len(w),
    )


def base_licences(text, phrases):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    places, labels = [], set()
    for phrase, label in phrases.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def prefix_trie(rows):
    """{(conv_id, depth, …)} of the trie over rebuilt conversations, walked node by node."""
    turns = collections.defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            turns[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = turns.get(c - c % 5, [])[:h] + own[h:]
    members = collections.defaultdict(list)
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    children = collections.defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = set()
    for node, convs in members.items():
        leaves, saved, todo = 0, 0, [node]
        while todo:
            at = todo.pop()
            todo += children[at]
            leaves += not children[at]
            saved += (len(members[at]) - 1) * len(at[-1][1].encode()) if at else 0
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(rebuilt[c]) == len(node)))
        out.add((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def damaged(rows):
    """Rows after damage, by conversation, in order of turn; every conversation has an entry."""
    out = {}
    for conv_id, turn, role, text in rows:
        if conv_id is None:
            continue
        here = out.setdefault(conv_id, [])
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{conv_id}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        here += [(turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return {c: sorted(ts, key=lambda t: (t[0] is not None, t[0] or 0)) for c, ts in out.items()}


def faults(turns):
    seen, out = set(), []
    for _, role, text in turns:
        words_ = text.strip(" \t\n\x0b\f\r")
        out.append("blank" if not words_ else "duplicate" if (role, text) in seen else "truncated" if words_[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def repair(turns):
    """The result row of one conversation, by a search over all edits in order of cost and letters."""
    import heapq

    kinds = faults(turns)
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    queue, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, state, made = heapq.heappop(queue)
        if i == len(turns) and state in ("", "a"):
            break
        if (i, state) in done:
            continue
        done.add((i, state))
        full = {"u": "user", "a": "assistant"}
        ways = [(3, "I", i, r, (f"{full[r]}:",)) for r in "ua"]
        if i < len(turns):
            _, role, text = turns[i]
            ways = [(c, x, i, r, m) for c, x, i, r, m in ways] + [(4, "D", i + 1, None, ())]
            if kinds[i] not in ("blank", "duplicate"):
                extra = 3 * (kinds[i] == "truncated")
                ways += [(extra, "K", i + 1, role[:1] or "-", (f"{role}:{text}",))] + [(3 + extra, "R", i + 1, r, (f"{full[r]}:{text}",)) for r in "ua"]
        for c, x, j, r, m in ways:
            to = state if r is None else after.get((state, r))
            if to is not None:
                heapq.heappush(queue, (cost + c, audit + x, j, to, made + m))
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    roles = [r[:1] for _, r, _ in turns]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:], strict=False))
    return (gaps, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest())
