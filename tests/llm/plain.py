"""Plain single-machine versions of the operators' results."""

import hashlib
import re
import zlib
from collections import defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 0


def id_key(doc_id):
    return (doc_id is None, doc_id or 0)


def exact(rows):
    """{(doc_id, sha): (keep_id, group_size, kept)} of (doc_id, text)."""
    groups = defaultdict(list)
    for i, t in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        groups[hashlib.sha256(norm.encode()).hexdigest()].append((-len(t or ""), id_key(i), i))
    out = {}
    for sha, members in groups.items():
        keep = min(members)[2]
        for _, _, i in members:
            out[i, sha] = (keep, len(members), i == keep)
    return out


def shingles(text):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def near(rows):
    """{doc_id: (set size, component)} of (doc_id, text) with distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    parent, holders = {i: i for i in sets}, defaultdict(list)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sorted(sets):
        common = defaultdict(int)
        for s in sets[i]:
            for j in holders[s]:
                common[j] += 1
            holders[s].append(i)
        for j, k in common.items():
            if 100 * k >= 80 * (len(sets[i]) + len(sets[j]) - k):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def targets(sizes, weights=(5, 2, 1), cap=3):
    """{source: target}: shares by weight, excess over the cap reshared until
    none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        rest, of = total - sum(fixed.values()), sum(w[s] for s in free)
        over = [s for s in free if rest * w[s] / of > cap * sizes[s]]
        if not over:
            return fixed | {s: rest * w[s] / of for s in free}
        fixed |= {s: float(cap * sizes[s]) for s in over}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    out, t = [], text or ""
    digits = lambda m: re.sub(r"[^0-9]", "", m.group())
    out += [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t)
            if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m)) <= 15]
    return sorted(out)
