"""Plain versions of the operators, row by row and pair by pair, to hold their results against."""

from __future__ import annotations

import hashlib
import html
import math
import re
from collections import Counter, defaultdict

import xxhash


def lowered(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def roots(nodes, pairs) -> dict:
    at = {n: n for n in nodes}

    def find(x):
        while at[x] != x:
            x = at[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        at[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def simhash(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints: list[int], radius: int = 2):
    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= radius:
                yield a, b


def contamination(docs, items) -> list[tuple]:
    """(doc_id, n_words, n_hit, items) of each (doc_id, text), against (item_id, text)."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t))
    windows = defaultdict(set)
    for item, text in items:
        words = split(text)
        size = min(10, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows[tuple(words[i : i + size])].add(item)
    out = []
    for doc, text in docs:
        words, hit, found = split(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                key = tuple(words[i : i + size])
                if key in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[key]
        out.append((doc, len(words), len(hit), tuple(sorted(str(i) for i in found if i is not None))))
    return out


def edited(docs) -> list[tuple]:
    """(doc_id, text, edited text, next text) of each (doc_id, text)."""
    rows = sorted(((d, t or "") for d, t in docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for i, (doc, text) in enumerate(rows):
        following, half = rows[(i + 1) % len(rows)][1], len(text) // 2
        out.append((doc, text, text[: len(text) - half] + following[:half], following))
    return out


def shingles(text: str, size: int = 5) -> set:
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set())


def base_spans(text: str | None) -> list[tuple]:
    """(kind, start, end) as the plain patterns say."""
    text = text or ""
    value = r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, m.end()) for m in re.finditer(value, text, re.I | re.A) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(("assign", "access", "hex")[k], s, e) for s, k, e in sorted(found)]


def kneser_ney(sequences: list[list[int]], order: int, classes: int, discount_of):
    """p(run) of an interpolated modified Kneser-Ney model, with counts kept in dictionaries."""
    level = {order: Counter()}
    for codes in sequences:
        padded = [0] * (order - 1) + list(codes)
        level[order].update(tuple(padded[i : i + order]) for i in range(len(codes)))
    for n in range(order - 1, 0, -1):
        level[n] = Counter(run[1:] for run in level[n + 1])
    cuts = {n: discount_of([sum(c == i for c in level[n].values()) for i in (1, 2, 3, 4)]) for n in level}
    below = {n: defaultdict(list) for n in level}
    for n, runs in level.items():
        for run, c in runs.items():
            below[n][run[:-1]].append(c)

    def p(run):
        n = len(run)
        if not n:
            return 1.0 / classes
        seen = below[n].get(run[:-1])
        if not seen:
            return p(run[1:])
        cut = lambda c: cuts[n][min(c, 3) - 1]
        own = level[n].get(run, 0)
        return (max(0.0, own - cut(own)) if own else 0.0) / sum(seen) + sum(map(cut, seen)) / sum(seen) * p(run[1:])

    return p


def surprise(p, codes: list[int], order: int) -> float:
    padded = [0] * (order - 1) + list(codes)
    return -sum(math.log(p(tuple(padded[i : i + order]))) for i in range(len(codes)))


def article(page: str) -> str:
    """The main text of the test tables' pages, whose articles hold headings and paragraphs only."""
    body = re.search(r"<article>(.*)</article>", page or "", re.S)
    if not body:
        return ""
    parts = re.split(r"</?(?:h1|p)>", body[1])
    texts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", p.replace("<br>", " "))).split()) for p in parts)
    return "\n\n".join(t for t in texts if t)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def resembling(docs, k=5, similarity=0.8):
    """Pairs of documents with the same words, or with so much of their k-word shingles in common; every pair is looked at."""
    sets = {}
    for d, text in docs:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(dict.fromkeys(range(9, 14), " ")).split(" ")
        words = [w for w in words if w]
        sets[d] = {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}
    holders = {}
    for d, own in sets.items():
        for shingle in own:
            holders.setdefault(shingle, []).append(d)
    shared = {}
    for group in holders.values():
        for i, a in enumerate(group):
            for b in group[i + 1 :]:
                shared[a, b] = shared.get((a, b), 0) + 1
    return [(a, b) for (a, b), n in shared.items() if n >= similarity * (len(sets[a]) + len(sets[b]) - n)]
