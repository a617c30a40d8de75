"""Awkward rows that every operator on documents must take, and plain Python versions of the contracts."""

from __future__ import annotations

import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Columns whose names operators might use themselves.
CLASHING = "key string, hash bigint, node bigint, spans string, row string, component int, digest string"
DOCS = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASHING}"


def documents(spark, texts):
    """``(id, text)`` rows with the other columns of documents, some null, and clashing ones."""
    rows = [
        (i, t, None if n % 3 == 2 else "en", None if n % 4 == 3 else f"src{n % 2}", None if t is None else len(t), "k", 1, 2, "s", "r", 3, "d")
        for n, (i, t) in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCS)


LONG = " ".join(f"word{n % 977} and{n % 13}" for n in range(30_000))
AWKWARD = [
    (1, "A plain text of some words that is here for all to see, and then some more."),
    (2, None),
    (3, ""),
    (4, "   \n\t "),
    (5, "A plain text of some words that is here for all to see, and then some more."),
    (5, "A plain text of some words that is here for all to see, and then some more."),
    (None, "A plain text of some words that is here for all to see, and then some more."),
    (6, LONG),
    (7, "!!! ??? \x00 \x1c 日本語 ÉTÉ İ"),
]


def shingle_sets(rows):
    out = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        runs = [tuple(words[j : j + 5]) for j in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)] * bool(words)
        out[i] = frozenset(runs)
    return out


def linked_components(rows):
    """``{id: (set size, least id reached)}`` by comparing every two."""
    sets = shingle_sets(rows)
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if sets[a] and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common) and common:
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in ids}


def hit_words(text, items):
    """Words of ``text``, how many are hit, and the sorted ids of the items found; ``items`` is ``(id, text)``."""
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    words = re.findall(pattern, (text or "").translate(LOWER))
    hit, found = set(), set()
    for i, item in items:
        own = re.findall(pattern, (item or "").translate(LOWER))
        n = min(10, len(own))
        windows = {tuple(own[j : j + n]) for j in range(len(own) - n + 1)} if n else set()
        for j in range(len(words) - n + 1):
            if n and tuple(words[j : j + n]) in windows:
                hit.update(range(j, j + n))
                found.add(str(i))
    return len(words), len(hit), sorted(found)


def base_spans(text):
    """The base matches of the contract, straight from its patterns."""
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in reversed(m[0]) if c.isdigit()]
        total = sum(d if n % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for n, d in enumerate(digits))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((3, *m.span()))
    return out
