"""Plain Python versions of the text operators."""

import collections
import math


def pairs_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def words(t):
    return (t or "").encode().split()


def brute_components(rows):
    sets = []
    for _, t in rows:
        w = words((t or "").encode().lower().decode())
        sets.append(frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    comp = list(range(len(rows)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if k and 100 * k >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                comp[max(a, b)] = min(a, b)
    low = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)].append(d)
    return [(d, len(sets[i]), (d if not sets[i] else min(low[find(i)], default=None))) for i, (d, _) in enumerate(rows)]


def brute_blocks(rows, n=13):
    first = {}
    for d, t in rows:
        w, d = words(t), math.inf if d is None else d
        for k in range(len(w) - n + 1):
            g = tuple(w[k:k + n])
            first[g] = min(d, first.get(g, math.inf))
    out = []
    for d, t in rows:
        w, gone = words(t), set()
        for k in range(len(w) - n + 1):
            if first[tuple(w[k:k + n])] < (math.inf if d is None else d):
                gone |= set(range(k, k + n))
        out.append((d, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return out


def brute_quality(rows, min_docs):
    texts = {}
    norm = lambda x: b" ".join(x.lower().encode().split()).decode()
    for _, t, s in rows:
        texts.setdefault(s, set()).add(t or "")
    df = {s: collections.Counter(x for t in ts for x in {norm(y) for y in t.split("\n")} if x) for s, ts in texts.items()}
    out = []
    for d, t, s in rows:
        t = t or ""
        w = [x.decode() for x in t.encode().split()]
        g = collections.Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
        rep = {k + j for k in range(len(w) - 4) if g[tuple(w[k:k + 5])] > 1 for j in range(5)}
        solid = [x for x in t.split("\n") if x.encode().split()]
        bad = {x for x, k in df[s].items() if k > max(float(min_docs), 0.1 * len(texts[s]))}
        lost = sum(len(norm(x).encode().split()) for x in solid if norm(x) in bad)
        failed = len(w) < 10 or 100 * len(rep) > 20 * len(w)
        out.append((d, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(solid) - len(set(solid)), len(rep), failed,
                    lost, not failed and 100 * lost <= 50 * len(w),
                    "\n".join(x for x in t.split("\n") if not x.encode().split() or norm(x) not in bad)))
    return out
