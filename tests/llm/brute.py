"""Plain Python versions of the training-data operators, for small inputs only."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
lower = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s)


def pii(text):
    t = text or ""
    out = {k: [] for k in ("email", "ip", "card", "phone")}
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out["email"].append(m.span())
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out["ip"].append(m.span())
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 16 <= len(d) <= 19:
            total = sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(reversed(d)))
            if total % 10 == 0:
                out["card"].append(m.span())
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out["phone"].append(m.span())
    base = ",".join(f"{k}:{a}:{b}" for k, v in out.items() for a, b in v)
    return [len(v) for v in out.values()], sha(base), base


def jaccard_components(rows):
    sets = {}
    for d, t in rows:
        w = WORD.findall(lower(t or ""))
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    where = defaultdict(set)
    for d, s in sets.items():
        for x in s:
            where[x].add(d)
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for d, s in sets.items():
        for e, n in Counter(e for x in s for e in where[x] if e > d).items():
            if 100 * n >= 75 * (len(s) + len(sets[e]) - n):
                a, b = sorted((find(d), find(e)))
                up[b] = a
    return {d: (len(s), find(d)) for d, s in sets.items()}


def quality(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    rep = {j for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep), len(w) < 10 or 100 * len(rep) > 20 * len(w)


def substrings(rows):
    words = {d: WORD.findall(t or "") for d, t in rows}
    first = {}
    for d in sorted(words):
        w = words[d]
        for i in range(len(w) - 12):
            first.setdefault(tuple(w[i : i + 13]), d)
    out = {}
    for d, w in words.items():
        gone = {j for i in range(len(w) - 12) if first[tuple(w[i : i + 13])] < d for j in range(i, i + 13)}
        out[d] = (len(w), len(gone), sha(" ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def contamination(rows, items):
    wins = defaultdict(set)
    for item, t in items:
        w = ALNUM.findall(lower(t or ""))
        for i in range(max(1, len(w) - 9) if w else 0):
            wins[tuple(w[i : i + 10])].add(str(item))
    sizes = {len(x) for x in wins}
    out = []
    for d, t in rows:
        w = ALNUM.findall(lower(t or ""))
        hit, got = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if x := wins.get(tuple(w[i : i + n])):
                    got |= x
                    hit |= set(range(i, i + n))
        out.append((d, len(w), len(hit), len(got), sha(",".join(sorted(got))), bool(hit)))
    return out
