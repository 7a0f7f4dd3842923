"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def removed_words(docs: dict[int, str], window: int) -> dict[int, set[int]]:
    first: dict[tuple, int] = {}
    runs = {d: words(t) for d, t in docs.items()}
    for d, w in runs.items():
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, d), d)
    return {
        d: {
            k for i in range(len(w) - window + 1) if first[tuple(w[i : i + window])] < d for k in range(i, i + window)
        }
        for d, w in runs.items()
    }


def shingles(text: str | None, width: int) -> frozenset:
    w = words((text or "").translate(LOWER))
    if len(w) >= width:
        return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))
    return frozenset([tuple(w)] if w else [])


def near_components(docs: dict[int, str], width: int, percent: int) -> dict[int, int]:
    sets = {d: shingles(t, width) for d, t in docs.items()}
    owners: dict[tuple, list[int]] = {}
    for d, s in sets.items():
        for g in s:
            owners.setdefault(g, []).append(d)
    root = {d: d for d in docs}

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for d, s in sets.items():
        shared = Counter(e for g in s for e in owners[g] if e < d)
        for e, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[e]) - both):
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
    return {d: find(d) for d in docs}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def personal(text: str | None) -> list[tuple[str, int, int]]:
    def valid(kind: str, m: str) -> bool:
        digits = re.sub("[^0-9]", "", m)
        return {
            "email": True,
            "ip": kind == "ip" and all(int(p) <= 255 for p in m.split(".")),
            "card": 16 <= len(digits) <= 19 and luhn(digits),
            "phone": 8 <= len(digits) <= 15,
        }[kind]

    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m.group())]
