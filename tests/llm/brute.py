"""Plain Python forms of the corpus operators, to hold their results against."""

from __future__ import annotations

import math
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKEN = re.compile(r"[0-9A-Za-z\u0080-\U0010ffff]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    w = words(text)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(grams)
    covered = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def shingles(text: str | None) -> set[tuple[str, ...]]:
    fold = {c: c + 32 for c in range(65, 91)}
    w = [x.translate(fold) for x in words(text)]
    if not w:
        return set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def near_components(texts: dict[int, str | None], percent: int) -> dict[int, int]:
    sets = {k: shingles(v) for k, v in texts.items()}
    holders: dict[tuple, list[int]] = {}
    for k, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(k)
    parent = {k: k for k in texts}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for k, s in sets.items():
        shared = Counter(j for g in s for j in holders[g] if j < k)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = find(k), find(j)
                parent[max(a, b)] = min(a, b)
    return {k: find(k) for k in texts}


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def tiling(a: list[str], b: list[str], shortest: int = 4) -> list[tuple[int, int, int]]:
    """Greedy string tiling by trying every pair of places."""
    free_a, free_b, out = [True] * len(a), [True] * len(b), []
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                    n += 1
                if n > best[2]:
                    best = (i, j, n)
        i, j, n = best
        if n < shortest:
            return out
        out.append(best)
        free_a[i : i + n] = [False] * n
        free_b[j : j + n] = [False] * n


def reachable(a: list[str], b: list[str], shortest: int = 4) -> int:
    """Tokens of ``b`` inside four-token windows that ``a`` has too: no tiling covers more."""
    have = {tuple(a[i : i + shortest]) for i in range(len(a) - shortest + 1)}
    inside = {j + d for j in range(len(b) - shortest + 1) if tuple(b[j : j + shortest]) in have for d in range(shortest)}
    return len(inside)


def leaks(docs: dict[int, str | None], items: dict[int, str | None], coverage: float = 0.6) -> dict[tuple[int, int], int]:
    """{(document, item): covered tokens} of the pairs that reach the coverage."""
    out = {}
    known = {k: tokens(v) for k, v in items.items() if v}
    for doc, text in docs.items():
        a = tokens(text or "")
        for item, b in known.items():
            if b and reachable(a, b) >= coverage * len(b) - 1e-9:
                covered = sum(n for _, _, n in tiling(a, b))
                if covered >= max(1, coverage * len(b) - 1e-9):
                    out[doc, item] = covered
    return out


def without_boilerplate(rows: list[tuple], ratio: float = 0.05, least: int = 2) -> list[str | None]:
    """Texts of (host, text) rows without the lines on too many of the host's pages."""
    pages = Counter(host or "" for host, _ in rows)
    seen = Counter((host or "", x) for host, text in rows for x in {y.strip(" ") for y in (text or "").split("\n")} - {""})
    gone = {k for k, n in seen.items() if n >= least and n > pages[k[0]] * ratio}
    return [
        text if text is None else "\n".join(x for x in text.split("\n") if (host or "", x.strip(" ")) not in gone)
        for host, text in rows
    ]


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(d: str) -> bool:
    twice = [int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(d[::-1])]
    return sum(twice) % 10 == 0


def personal(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    found = [("email", *m.span()) for m in EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    found += [("card", *m.span()) for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and _luhn(digits(m))]
    found += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    place = ("email", "ip", "card", "phone")
    return sorted(found, key=lambda x: (x[1], place.index(x[0])))


SEARCH_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def search_terms(text: str | None) -> list[str]:
    return SEARCH_TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def runs(words: list, shortest: int = 6, exponent: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal run, by its smallest period."""
    seen: set[tuple[int, int]] = set()
    out = []
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(shortest, exponent * q) and (i, length) not in seen:
                seen.add((i, length))
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def blanked(text: str) -> str:
    for _, s, e in personal(text):
        text = text[:s] + " " * (e - s) + text[e:]
    return text


def share(n_both: int, n_term: int, n_entity: int, n: int) -> float:
    """The part of an entity's information that a term gives away, with one standard error and a quarter row taken off."""
    sure = n_both - (n_both * (1 - n_both / n_term)) ** 0.5
    return 1 + math.log2(sure / (n_term + 0.25)) / math.log2(n / n_entity) if sure > 0 else -math.inf
