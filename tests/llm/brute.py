"""Plain-Python forms of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return SPACE.findall(text or "")


def decontam(docs, items, n=10):
    """docs, items: lists of (id, text)."""
    windows = defaultdict(set)
    for i, t in items:
        w = ALNUM.findall((t or "").translate(UPPER))
        k = min(n, len(w))
        for p in range(len(w) - k + 1 if k else 0):
            windows[tuple(w[p:p + k])].add(i if i is None else str(i))
    lengths = {len(k) for k in windows}
    out = []
    for d, t in docs:
        w = ALNUM.findall((t or "").translate(UPPER))
        hit, found = set(), set()
        for k in lengths:
            for p in range(len(w) - k + 1):
                own = windows.get(tuple(w[p:p + k]))
                if own:
                    hit.update(range(p, p + k))
                    found |= own - {None}  # an item without an id is not listed
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), sha, bool(hit)))
    return out


def substring_dedup(docs, k=13):
    first = {}
    for d, t in docs:
        w = words(t)
        for p in range(len(w) - k + 1):
            key = tuple(w[p:p + k])
            if d is not None:
                first[key] = min(first.get(key, d), d)
    out = []
    for d, t in docs:
        w = words(t)
        cut = set()
        for p in range(len(w) - k + 1):
            if d is not None and first[tuple(w[p:p + k])] < d:
                cut.update(range(p, p + k))
        kept = " ".join(x for i, x in enumerate(w) if i not in cut)
        out.append((d, len(w), len(cut), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def targets(sizes, weights=(3, 1, 2), share=1.5, passes=2):
    """sizes: {source or None: words} -> {source: target}."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total = share * sum(sizes.values())
    full: set = set()
    while True:
        rest = total - sum(passes * sizes[s] for s in full)
        open_ = [s for s in order if s not in full]
        if not open_:
            break
        level = rest / sum(w[s] for s in open_)
        more = {s for s in open_ if w[s] * level >= passes * sizes[s]}
        if not more:
            break
        full |= more
    return {s: float(passes * sizes[s]) if s in full else w[s] * level for s in order}


def base_measures(text):
    w = words(text)
    win = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    rep = set()
    for i in range(len(w) - 7):
        if win[tuple(w[i:i + 8])] > 1:
            rep.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if SPACE.search(x)]
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(rep),
            n < 20 or 100 * len(rep) > 30 * n)


def url_rule(url):
    """(host, path, rule, verdict) with the fixed rules."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = host.translate(UPPER)
    best = None
    for v, h, p in (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
                    ("block", "net", "/es/"), ("block", "net", "/fr/")):
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, v)
    return host, path, *(best or (None, None))


def shingles(text, k=4):
    w = words((text or "").translate(UPPER))
    if not w:
        return frozenset()
    if len(w) < k:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def jaccard_components(docs, k=4, pct=85):
    """[(id, n, component)] by an inverted index over distinct sets."""
    sets = [(d, shingles(t, k)) for d, t in docs]
    by_set = defaultdict(list)
    for d, s in sets:
        if s and d is not None:
            by_set[s].append(d)
    reps = [(min(v), s) for s, v in by_set.items()]
    parent = list(range(len(reps)))  # a class is a node: two texts under one id are two

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    index = defaultdict(list)
    for i, (_, s) in enumerate(reps):
        shared = Counter(j for g in s for j in index[g])
        for j, n in shared.items():
            if 100 * n >= pct * (len(s) + len(reps[j][1]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for g in s:
            index[g].append(i)
    low = {}
    for i, (r, _) in enumerate(reps):
        low[find(i)] = min(low.get(find(i), r), r)
    comp = {s: low[find(i)] for i, (_, s) in enumerate(reps)}
    return [(d, len(s), comp.get(s) if s else d) for d, s in sets]


def url_verdicts(urls, rules, shape, min_children=20, max_share=0.2, merge_z=2.0, weight=5.0, cap=0.25, reject=0.5):
    """Verdict of every url by the template tree, plainly.  ``shape``: a segment
    with its variable part generalised."""
    rows = []
    for u in urls:
        u = u or ""
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", u)
        host, path = (m[1].translate(UPPER), m[2]) if m else ("", "")
        fits = [(len(h + p), v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rows.append((host, [shape(x) for x in path.split("/")], max(fits)[1] if fits else None))
    names = {(h, tuple(s)): list(s) for h, s, _ in rows}
    count = Counter((h, tuple(s)) for h, s, _ in rows)
    while True:
        kids = defaultdict(Counter)
        for (h, raw), s in names.items():
            for i, x in enumerate(s):
                kids[h, tuple(s[:i])][x] += count[h, raw]
        wild = {k for k, c in kids.items() if len(c) >= min_children and max(c.values()) <= max_share * sum(c.values())}
        if not wild:
            break
        names = {(h, raw): ["*" if (h, tuple(s[:i])) in wild else x for i, x in enumerate(s)] for (h, raw), s in names.items()}
    leaf, node = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for h, raw, verdict in rows:
        t = tuple(names[h, tuple(raw)])
        for at, key in [(leaf, (h, t)), *[(node, (h, t[:i])) for i in range(1, len(t))]]:
            at[key][0] += verdict is not None
            at[key][1] += verdict == "block"
    n, b = sum(v[0] for v in leaf.values()), sum(v[1] for v in leaf.values())
    prior = min(b / n, cap) if n else 0.0
    family = defaultdict(list)
    for h, t in leaf:
        for i, x in enumerate(t):
            if x and not re.search(r"[*{]", x):
                family[h, i, t[:i] + ("+",) + t[i + 1:]].append(t)
    bad = set()
    for h, t in leaf:
        own, best = leaf[h, t], []
        for (fh, _, _), members in family.items():
            if fh != h or t not in members:
                continue
            fn, fb = (sum(leaf[h, m][k] for m in members) for k in (0, 1))
            if not fn:
                continue
            share = fb / fn
            far = {m: leaf[h, m][0] > 0 and abs(leaf[h, m][1] / leaf[h, m][0] - share) > merge_z * (share * (1 - share) / leaf[h, m][0]) ** 0.5 + 1e-9 for m in members}
            if not far[t] and (own[0] or not any(far.values())):
                best.append((fn, fb))
        above = prior
        for i in range(1, len(t)):
            above = (node[h, t[:i]][1] + weight * above) / (node[h, t[:i]][0] + weight)
        fn, fb = max(best, default=tuple(own))
        if (fb + weight * above) / (fn + weight) > reject:
            bad.add((h, t))
    return [v or ("block" if (h, tuple(names[h, tuple(s)])) in bad else "allow") for h, s, v in rows]


def quality_verdicts(docs, min_group=100, spread=4.0, rare=0.01, step=1.02):
    """docs: (id, text, lang, source) -> kept per row, by sorted binned values."""
    floor, margin = {"symbols": 0.03, "dup_lines": 0.1}, {"word_len": 1.0}
    rows = []
    for _, t, lang, source in docs:
        n, chars, sym, dup, _, failed = base_measures(t)
        rows.append((lang, source, failed, {"symbols": sym / max(chars, 1), "dup_lines": 100.0 * dup / max(n, 1), "word_len": chars / max(n, 1)}))
    groups = defaultdict(lambda: defaultdict(list))
    for lang, source, failed, m in rows:
        if not failed:
            for key in ((lang, source), (lang,), ()):
                for k, v in m.items():
                    groups[key][k].append(step ** math.ceil(math.log(v) / math.log(step)) if v > 0 else 0.0)

    def fence(key, k):
        v = sorted(groups[key][k])
        above = [x for x in v if x > 0]
        zeros = k in floor and 2 * len(above) < len(v)
        of = above if zeros else v
        if not of:
            return None, None, zeros, len(above) < rare * len(v)
        q1, q3 = (of[max(1, math.ceil(p * len(of))) - 1] for p in (0.25, 0.75))
        room = spread * (q3 - q1) + margin.get(k, 0.0)
        return q1 / step - room, q3 + room, zeros, len(above) < rare * len(v)

    out = []
    for lang, source, failed, m in rows:
        ok = not failed
        for k, v in m.items():
            size = {key: len(groups[key][k]) for key in ((lang, source), (lang,), ())}
            key = next((x for x in ((lang, source), (lang,)) if size[x] >= min_group), ())
            lo, hi, zeros, few = fence(key, k)
            if k in floor:
                parent = fence((lang,) if size[lang,] >= min_group else (), k)[1]
                hi = 0.0 if few else min(x for x in (hi, parent) if x is not None) if zeros else hi
                hi = max(hi, floor[k])
            ok &= hi is None or v <= hi
            ok &= k != "word_len" or lo is None or v >= lo
        out.append(ok)
    return out
