"""Plain Python versions of the corpus operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, width=5):
    w = words((text or "").translate(LOWER))
    if len(w) < width:
        return Counter([tuple(w)] if w else [])
    return Counter(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def base_counts(text):
    w = words(text)
    windows = defaultdict(list)
    for i in range(len(w) - 2):
        windows[tuple(w[i : i + 3])].append(i)
    covered = {j for places in windows.values() if len(places) > 1 for i in places for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    symbols = sum(c in "#*$%&|<>" for x in w for c in x)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def line_dedup(rows):
    """[(doc_id, text)] of unlike, non-null ids → {doc_id: (n_lines, n_dropped, sha256)}."""
    key = lambda line: line.strip(" \t\n\x0b\f\r").translate(LOWER)
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(doc_id)
    out = {}
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        gone = lambda k: len(k) >= 20 and len(holders[k]) >= 3 and doc_id != max(holders[k])
        kept = [x for x in lines if not gone(key(x))]
        out[doc_id] = (len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def components(rows):
    """[(doc_id, text)] → {doc_id: (n_shingles, component)}."""
    sets = {d: set(shingles(t)) for d, t in rows}
    root = {d: d for d in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def leaks(rows, items):
    """Pairs (doc_id, item_id) with a window of the item's size that reaches the similarity."""
    out = set()
    for doc_id, text in rows:
        w = words((text or "").translate(LOWER))
        held = {tuple(w[i : i + k]) for k in range(1, 6) for i in range(len(w) - k + 1)}
        for item_id, passage in items:
            bag, n = shingles(passage), len(words(passage))
            if not held & set(bag):
                continue  # no window can share anything
            for start in range(max(1, len(w) - n + 1) if n and w else 0):
                own = shingles(" ".join(w[start : start + n]))
                shared = sum((bag & own).values())
                if shared and 100 * shared >= 75 * sum((bag | own).values()):
                    out.add((doc_id, item_id))
    return out
