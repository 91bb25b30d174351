"""Plain-Python versions of the operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall(text or "")


def folded(text):
    return words((text or "").translate(FOLD))


def shingles(text, size):
    w = folded(text)
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1))


def groups(docs, size, percent):
    """{id: (set size, smallest id reachable)} for (id, text) rows."""
    sets = [(i, shingles(t, size)) for i, t in docs if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (a, x) in enumerate(sets):
        for b, y in sets[:n]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: (len(s), find(i)) for i, s in sets}


def repeats(docs, window):
    """{id: (words, removed, digest of the rest)} for (id, text) rows with different ids."""
    seen, out = set(), {}
    for i, text in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0)):
        w = words(text)
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            k = tuple(w[s:s + window])
            if k in seen:
                gone[s:s + window] = [True] * window
            seen.add(k)
        rest = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(rest.encode()).hexdigest())
    return out


def measures(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    times, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if times[x] > 1:
            covered.update(range(i, i + 8))
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def base_scores(docs):
    """{id: (held out, tokens, known, N, base score)}"""
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in docs}
    tokens = {i: [*folded(t), None] for i, t in docs}
    count = Counter(x for i, t in tokens.items() if not held[i] for x in t)
    n, v = sum(count.values()), len(count)
    return {i: (held[i], len(t), sum(count[x] > 0 for x in t), n,
                sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in t)) for i, t in tokens.items()}


def collocations(rows, longest=3, least=10, absorb=50, top=2000):
    """Sorted (lang, rank, phrase, a, l, r, n, score) of (lang, text) rows."""
    counts, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        f = counts.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(FOLD)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update(tuple(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        absorbed = {p[i:i + k] for p, a in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * a >= absorb * f[p[i:i + k]]}
        scored = []
        for p, a in found.items():
            if p not in absorbed:
                score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, rank, p.decode(), -a, left, right, n[lang], -s) for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def damaged(rows):
    """(conversation, turn, role, text, copies) of (conversation, turn, role, text) rows."""
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fate, text)
        yield c, t, "user" if fate == 4 else role, text, {0: 0, 3: 2}.get(fate, 1)


def cheapest(turns):
    """(cost, edits, lines) of the cheapest edits of (role, text, fault) turns, by comparing whole edit strings."""
    after = {"e": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    best = {s: (0, "", None) if s in "ea" else (10**9, "", None) for s in "esua"}

    def inserted(best):
        for s in "uaesua":
            cost, edits, lines = best[after[s]]
            best[s] = min(best[s], (cost + 3, "I" + edits, (names[after[s]] + ":", lines)), key=lambda x: x[:2])
        return best

    best = inserted(best)
    for role, text, fault in reversed(turns):
        now = {}
        for s in "esua":
            ways = [(best[s][0] + 4, "D" + best[s][1], best[s][2])]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                if (s, role[:1]) in {("e", "s"), ("e", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
                    cost, edits, lines = best[role[0]]
                    ways.append((cost + more, "K" + edits, (f"{role}:{text}", lines)))
                cost, edits, lines = best[after[s]]
                ways.append((cost + more + 3, "R" + edits, (f"{names[after[s]]}:{text}", lines)))
            now[s] = min(ways, key=lambda x: x[:2])
        best = inserted(now)
    cost, edits, lines = best["e"]
    said = []
    while lines:
        said.append(lines[0])
        lines = lines[1]
    return cost, edits, said


def repairs(rows):
    """Results of (conversation, turn, role, text, copies) rows, sorted by their text."""
    every = {}
    for c, *row in rows:
        every.setdefault(c, []).append(row)
    out = []
    for c, found in every.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        line = [(t, role, text) for t, role, text, copies in found for _ in range(copies)]
        seen, turns, count = set(), [], Counter()
        for _, role, text in line:
            said = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not said else "duplicate" if (role, text) in seen else None if said[-1] in ".!?" else "truncated"
            seen.add((role, text))
            turns.append((role, text, fault))
            count[fault] += 1
        numbers = [t for t, _, _ in line if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(line, line[1:]))
        cost, edits, said = cheapest(turns)
        out.append((c, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, edits, hashlib.sha256("\n".join(said).encode()).hexdigest()))
    return sorted(out, key=repr)
