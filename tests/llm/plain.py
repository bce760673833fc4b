"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
MULTIPLIER = 2862933555777941757


def ascii_lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text: str | None) -> list[str]:
    return SPACE.findall(text or "")


def jump(key: int, shards: int) -> int:
    key %= 1 << 64
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * MULTIPLIER + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def shingles(text: str | None, n: int = 5) -> Counter:
    w = words(ascii_lower(text or ""))
    return Counter(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else Counter()


def weighted_jaccard(a: Counter, b: Counter) -> float:
    both = sum((a & b).values())
    return both / max(1, sum(a.values()) + sum(b.values()) - both)


def classes(docs: list[tuple], similarity: float = 0.8) -> dict:
    """Least id of each document's class, by comparing every pair that shares a run of words."""
    ids = [d for d, _ in docs if d is not None]
    parent = {d: d for d in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(x, y):
        x, y = sorted((find(x), find(y)))
        parent[y] = x

    sets: dict[frozenset, tuple] = {}
    for d, text in docs:
        if d is None:
            continue
        key = tuple(words(ascii_lower(text or "")))
        if key in sets:
            join(sets[key][0], d)
        else:
            sets[key] = (d, shingles(text))
    holders: dict = {}
    for d, s in sets.values():
        for e in s:
            holders.setdefault(e, []).append((d, s))
    seen = set()
    for group in holders.values():
        for k, (a, s) in enumerate(group):
            for b, t in group[:k]:
                if (a, b) not in seen and find(a) != find(b):
                    seen.add((a, b))
                    if weighted_jaccard(s, t) >= similarity:
                        join(a, b)
    return {d: find(d) for d in ids}


def targets(sizes: list[int], weights: list[float], most: int = 3) -> list[float]:
    """Shares by weight, filled up a little at a time."""
    low, high = 0.0, 3.0 * sum(sizes) + 1
    for _ in range(200):
        level = (low + high) / 2
        if sum(min(most * s, level * w) for s, w in zip(sizes, weights)) < sum(sizes):
            low = level
        else:
            high = level
    return [min(most * s, high * w) for s, w in zip(sizes, weights)]


def secret_spans(text: str | None) -> list[tuple[int, int, str]]:
    text = text or ""
    folded = ascii_lower(text)
    found = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""", folded):
        if m.end(2) - m.start(2) >= 12:
            found.append((m.start(), 0, m.end(), "assign"))
    for rank, kind, pattern, least in ((1, "access", r"AKIA[A-Z0-9]+", 18), (2, "hex", r"[0-9a-f]+", 16)):
        found += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text) if m.end() - m.start() >= least]
    return [(s, e, kind) for s, _, e, kind in sorted(found)]


def damaged(rows: list[tuple]) -> dict:
    """Rows (conversation, turn, role, text) of each conversation after damage, in order."""
    out: dict = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        own = out.setdefault(conv, [])
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fault == 1 else re.sub(r"[.!?]", "", text) if fault == 2 else text
        own += [(turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return {c: sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, own in out.items()}


def repaired(rows: list[tuple]) -> tuple:
    """gaps, blank, duplicate, truncated, illegal, cost, audit, digest and the repaired turns, every state's best edits kept as text."""
    turns = {t for t, _, _ in rows if t is not None}
    faults, seen = [], set()
    for _, role, text in rows:
        end = SPACE.findall(text)
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1][-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit, made) in list(best.items()):
                role = "assistant" if state == "u" else "user"
                new = (cost + 5, audit + "I", (*made, (role, "")))
                best[role[0]] = min(best.get(role[0], new), new)
        return best

    best = {"": (0, "", ())}
    for (_, role, text), fault in zip(rows, faults):
        new: dict = {}

        def put(state, value, new=new):
            new[state] = min(new.get(state, value), value)

        for state, (cost, audit, made) in inserted(best).items():
            put(state, (cost + 2, audit + "D", made))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 if fault == "truncated" else 0
            follows = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
            if role[:1] and role[:1] in follows:
                put(role[:1], (cost + extra, audit + "K", (*made, (role, text))))
            other = "assistant" if state == "u" else "user"
            put(other[0], (cost + extra + 1, audit + "R", (*made, (other, text))))
        best = new
    cost, audit, made = min(v for k, v in inserted(best).items() if k in ("", "a"))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, digest, made


def in_order(a: list, b: list) -> int:
    """Longest common subsequence, cell by cell."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for k, y in enumerate(b):
            before, row[k + 1] = row[k + 1], before + 1 if x == y else max(row[k + 1], row[k])
    return row[-1]


def leaked(docs: list[tuple], items: list[tuple], window: int = 64, stride: int = 32, frequent: float = 0.02) -> dict:
    """Pairs of a document and an item with the greatest lcs, by comparing every item with every passage of every document."""
    cut = lambda text: re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())
    texts = [(d, cut(t)) for d, t in docs]
    holders = Counter(w for _, ws in texts for w in set(ws))
    rare = lambda w: holders[w] <= frequent * len(docs)
    weight = lambda w: math.log1p(len(docs) / max(1, holders[w]))
    out: dict = {}
    for item, text in items:
        own, sentences = cut(text), [cut(s) for s in re.split(r"[.!?:]\s+|\n", text.lower()) if cut(s)]
        answer = {w for w in (sentences[-1] if len(sentences) > 1 else own[-max(1, len(own) // 3) :]) if rare(w)}
        few = [w for w in own if rare(w)]
        for doc, ws in texts:
            for begin in range(0, max(1, len(ws) - window + stride), stride):
                near = ws[max(0, begin - stride) : begin + window + stride]
                lcs = in_order(own, near) / len(own)
                found = lcs >= 0.8
                if not found and lcs >= 0.6 and few:
                    ordered = in_order(few, [w for w in near if rare(w)]) / len(few)
                    there = sum(weight(w) for w in answer & set(ws)) / sum(map(weight, answer)) if answer else ordered
                    found = ordered >= 0.6 and there >= 0.5
                if found:
                    out[doc, item] = max(lcs, out.get((doc, item), 0))
    return out
