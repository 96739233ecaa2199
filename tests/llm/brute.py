"""Plain Python versions of what the text operators return, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def shingles(text, n):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(low)
    if not w:
        return frozenset()
    if len(w) < n:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def groups(docs, n, percent):
    """docs: (doc_id, text). Rows (doc_id, size, component), same order as docs."""
    sets = [shingles(t, n) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in holders[g] if j > i)
        for j, same in shared.items():
            if 100 * same >= percent * (len(s) + len(sets[j]) - same):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        r = find(i)
        known = least.get(r)
        least[r] = d if known is None else known if d is None else min(d, known)
    return [(d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(docs)]


def repeats(docs, window):
    """Rows (doc_id, n_words, n_removed, kept_sha256) for docs (doc_id, text)."""
    all_words = [words(t) for _, t in docs]
    seen = Counter(
        tuple(w[i : i + window]) for w in all_words for i in range(len(w) - window + 1)
    )
    out = []
    for (d, _), w in zip(docs, all_words):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        digest = hashlib.sha256(kept.encode("utf-8", "surrogatepass")).hexdigest()
        out.append((d, len(w), len(gone), digest))
    return out


def base_rules(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    gone = set()
    for i in range(len(w) - 7):
        if seen[tuple(w[i : i + 8])] > 1:
            gone.update(range(i, i + 8))
    return (
        len(w),
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(gone),
        len(w) < 20 or 100 * len(gone) > 30 * len(w),
    )
