"""Plain versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def decontaminated(documents, items, window=10):
    """documents: (id, text); items: (id, text). Rows of the contract."""
    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    words = lambda t: pattern.findall((t or "").translate(FOLD))
    owners = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            owners[tuple(w[i : i + window])].add(item)
    sizes = sorted({len(w) for w in owners})
    out = []
    for doc, text in documents:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if (key := tuple(w[i : i + size])) in owners:
                    hit.update(range(i, i + size))
                    found |= owners[key]
        names = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(names), sha256(",".join(names)), bool(hit)))
    return out


ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def secrets_base(text):
    """(kind, start, end) in the contract's order."""
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(("assign", "access", "hex")[k], s, e) for s, k, e in sorted(found)]


def window_entropies(text, window):
    """Shannon entropy of every window, each computed anew."""
    out = []
    for i in range(len(text) - window + 1):
        counts = Counter(text[i : i + window]).values()
        out.append(-sum(c / window * math.log2(c / window) for c in counts))
    return out


def repeated_words(documents, window=35):
    """(id, n_words, n_removed, kept_sha256)."""
    split = lambda t: re.findall("[^\x20\x09-\x0d]+", t or "")
    counts = Counter()
    for _, text in documents:
        w = split(text)
        counts.update(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    out = []
    for doc, text in documents:
        w, gone = split(text), set()
        for i in range(len(w) - window + 1):
            if counts[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), sha256(kept)))
    return out


def jaccard_components(documents, share=75, whole=100):
    """(id, n_shingles, component_id)."""
    sets = []
    for _, text in documents:
        w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(FOLD))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    posting = defaultdict(list)
    for i, s in enumerate(sets):
        for gram in s:
            posting[gram].append(i)
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        shared = Counter(j for gram in s for j in posting[gram] if j < i)
        for j, n in shared.items():
            if whole * n >= share * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(documents):
        root = find(i)
        if doc is not None:
            least[root] = min(least.get(root, doc), doc)
    return [(doc, len(sets[i]), least.get(find(i))) for i, (doc, _) in enumerate(documents)]
