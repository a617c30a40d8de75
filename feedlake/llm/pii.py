"""Personal data by weak supervision: labelers vote on spans, EM weighs them, a classifier decides.

Every text yields candidate spans. The base patterns give the certain ones; wider
patterns give more: numbers without a plus, written-out addresses, and the parts of base
matches that failed their check because they took too much, as a phone number with the
address after it or two card numbers in a row. Numbers of other use (versions, dates,
digits of keys, handles) are candidates too, so that the labelers' errors can be
estimated on spans of both kinds.
Four labelers vote on each candidate: the pattern, a validity check, a gazetteer and
the words before it. Spark counts the candidates by kind, votes and shape, of which
there are at most ``PATTERNS``. On those counts expectation-maximisation estimates how
reliable each labeler is, and its posteriors train a logistic classifier of shape and
votes that gives each pattern its probability. Base spans always stay; the classifier
adds the others it finds likely.

Null and empty texts have no spans. Ids may be null or repeated: there is one row per
input row. Other columns are ignored. The digest of no spans is that of the empty
string.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.store import settle
from feedlake.llm.workers import tidy

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
SLICE = 256

LOCAL_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is matched from its first digit or not at all, so long runs take one step each.
IP_BASE = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
CARD_BASE = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE_BASE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
#: Numbers with separators that no base pattern may take.
NUMBER = re.compile(r"(?<![\w.+])\(?[0-9]{2,5}\)?(?:[ .-]{1,2}\(?[0-9]{2,5}\)?){1,4}(?![\w]|\.[0-9])")
WRITTEN = re.compile(
    r"[A-Za-z0-9._%+-]{1,64} ?(?:[\[({]at[\])}]| at ) ?[A-Za-z0-9-]{1,63}(?: ?(?:[\[({]dot[\])}]| dot |\.) ?[A-Za-z0-9-]{1,63}){1,4}",
    re.IGNORECASE,
)
#: A phone number by its groups, and the groups of digits of a failed card.
PHONE_FORM = re.compile(r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{2,4})(?:[ .-][0-9]{2,4}){1,4}+(?![0-9])|\+[0-9]{8,15}(?![0-9])")
GROUP = re.compile(r"[0-9]+")
#: What is mostly no personal data: runs of digits, versions, handles.
RUN, VERSION, HANDLE = re.compile(r"[0-9]{5,}"), re.compile(r"(?<![0-9.])[0-9]{1,4}(?:\.[0-9]{1,4}){1,3}(?![0-9.]?[0-9])"), re.compile(r"(?<![\w.%+-])@\w{2,64}")
DATE = re.compile(r"(?:19|20)[0-9]{2}[-. ][0-9]{1,2}[-. ][0-9]{1,2}|[0-9]{1,2}[-. ][0-9]{1,2}[-. ](?:19|20)[0-9]{2}")
SAYS_DOT = re.compile(r"[\[({]at[\])}]| at \S+ dot ", re.IGNORECASE)

# Words that announce a kind, words that announce something else, top-level domains, issuers.
CUES = (
    re.compile(r"e-?mail|mail|contact|write|reach|courriel|correo|kontakt", re.I),
    re.compile(r"\bip\b|address|host|server|login|from", re.I),
    re.compile(r"card|visa|master|credit|debit|payment|karte|carte|tarjeta", re.I),
    re.compile(r"phone|tel|call|mobile|fax|cell|whatsapp|anruf|appel|llama", re.I),
)
OTHER = re.compile(r"order|invoice|version|token|password|isbn|sku|release|serial|article|page|section|\bno\b|#", re.I)
TOP_LEVEL = frozenset("com org net edu gov mil int info biz io co de fr es uk us eu ch at it nl be pl ru jp cn br".split())
ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6(?:011|5|4[4-9])")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``kind, start, end`` of the base matches that pass their checks, by kind and start."""
    out = []
    if "@" in text:
        at, free = text.find("@"), 0
        while at >= 0:
            start = at
            while start > free and text[start - 1] in LOCAL_CHARACTERS:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                out.append((EMAIL, start, m.end()))
                free = m.end()
            at = text.find("@", max(at + 1, free))
    if not DIGIT.search(text):
        return out
    for m in IP_BASE.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:3] or 0) <= 255 for p in m[0].split(".")):
            out.append((IP, *m.span()))
    for m in CARD_BASE.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
            out.append((CARD, *m.span()))
    if "+" in text:
        for m in PHONE_BASE.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                out.append((PHONE, *m.span()))
    return out


def _digits(text: str) -> list[int]:
    return [int(c) for c in text if "0" <= c <= "9"]


def luhn(digits: list[int]) -> bool:
    doubled = [sum(divmod(2 * d, 10)) for d in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, bool, int]]:
    """Base spans and wider ones, each with whether it is a base span and with its pattern of votes and shape."""
    out = [(k, a, b, True, pattern(text, k, a, b, True)) for k, a, b in base]
    taken = _Taken((a, b) for _, a, b in base)

    def add(kind: int, found: list[tuple[int, int]]) -> None:
        """Candidates of one pattern, from left to right, where nothing is taken yet."""
        new = [(a, b) for a, b in found if taken.free(a, b)]
        out.extend((kind, a, b, False, pattern(text, kind, a, b, False)) for a, b in new)
        taken.add(new)

    if SAYS_DOT.search(text):
        add(EMAIL, [m.span() for m in WRITTEN.finditer(text) if "@" not in m[0]])
    if "@" in text:
        add(EMAIL, [m.span() for m in HANDLE.finditer(text)])
    if DIGIT.search(text):
        if "+" in text:
            add(PHONE, list(_swallowed_phones(text, taken)))
        add(CARD, list(_swallowed_cards(text)))
        numbers = [(m.span(), len(_digits(m[0]))) for m in NUMBER.finditer(text)]
        numbers = [(a, b, n) for (a, b), n in numbers if n >= 8]
        add(IP, [(a, b) for a, b, _ in numbers if IP_BASE.fullmatch(text, a, b)])
        add(PHONE, [(a, b) for a, b, n in numbers if n <= 12])
        add(CARD, [(a, b) for a, b, _ in numbers])
        add(IP, [m.span() for m in VERSION.finditer(text)])
        runs = [m.span() for m in RUN.finditer(text)]
        add(PHONE, [(a, b) for a, b in runs if b - a <= 12])
        add(CARD, [(a, b) for a, b in runs if 13 <= b - a <= 19])
    return out


class _Taken:
    """Stretches of a text that spans have taken."""

    def __init__(self, spans):
        self.starts, self.ends = [], []
        self.add(spans)

    def add(self, spans) -> None:
        merged: list[list[int]] = []
        for a, b in sorted([*zip(self.starts, self.ends), *spans]):
            if merged and a < merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        self.starts, self.ends = [a for a, _ in merged], [b for _, b in merged]

    def free(self, a: int, b: int) -> bool:
        i = bisect_left(self.starts, b) - 1
        return i < 0 or self.ends[i] <= a

    def next(self, at: int) -> int | None:
        """Where the first stretch from ``at`` on starts."""
        i = bisect_left(self.starts, at)
        return self.starts[i] if i < len(self.starts) else None


def _swallowed_phones(text: str, taken: _Taken) -> Iterator[tuple[int, int]]:
    """Phone numbers at the start of base matches that failed; they end before what is taken."""
    for m in PHONE_BASE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            continue
        stop = taken.next(m.start())
        form = PHONE_FORM.match(text, m.start(), m.end() if stop is None else min(m.end(), stop))
        if form and 8 <= len(_digits(form[0])) <= 15:
            yield form.span()


def _swallowed_cards(text: str) -> Iterator[tuple[int, int]]:
    """Runs of whole groups of digits that pass as cards, within base matches that failed."""
    for m in CARD_BASE.finditer(text):
        digits = _digits(m[0]) if m.end() - m.start() >= 16 else []
        if len(digits) < 16 or len(digits) <= 19 and luhn(digits):
            continue
        groups = [g.span() for g in GROUP.finditer(text, *m.span())]
        first = 0
        while first < len(groups):
            last, size = first, 0
            while last < len(groups) and (size := size + groups[last][1] - groups[last][0]) <= 19:
                span = groups[first][0], groups[last][1]
                if size >= 16 and luhn(_digits(text[slice(*span)])):
                    yield span
                    break
                last += 1
            else:
                last = first
            first = last + 1


def votes(text: str, kind: int, start: int, end: int, base: bool) -> tuple[int, int, int, int]:
    """What pattern, validity check, gazetteer and context say: 2 for, 0 against, 1 nothing."""
    span = text[start:end]
    digits = _digits(span)
    glued = _glued(text, start, end) > 0 and not base
    before = text[max(0, start - 40) : start].rpartition("\n")[2]
    context = 2 if CUES[kind].search(before) else 0 if OTHER.search(before[-16:]) else 1
    if kind == EMAIL:
        last = re.split(r"[.\s\])}]+", span)[-1].lower()
        valid = 2 if last.isalpha() and 2 <= len(last) <= 24 and span[0] != "@" else 0
        known = 2 if last in TOP_LEVEL else 1
    elif kind == IP:
        parts = span.split(".")
        valid = 2 if len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts) else 0
        known = 0 if any(len(p) > 1 and p[0] == "0" for p in parts) or parts[0] == "0" else 1
    elif kind == CARD:
        valid = 2 if 13 <= len(digits) <= 19 and luhn(digits) and not glued else 0
        known = 2 if ISSUERS.match("".join(map(str, digits[:4]))) else 0
    else:
        written = len(digits) < len(span) and not glued and not DATE.fullmatch(span)
        valid = 2 if 8 <= len(digits) <= 15 and len(set(digits)) > 2 and written else 0
        known = 2 if span[0] == "+" and digits[0] else 1
    return (2 if base else 1 if valid else 0), valid, known, context


def _glued(text: str, start: int, end: int) -> int:
    """Whether letters or digits touch a span: 1 before it, 2 after it."""
    return (start > 0 and text[start - 1].isalnum()) + 2 * (end < len(text) and text[end].isalnum())


def pattern(text: str, kind: int, start: int, end: int, base: bool) -> int:
    """Kind, votes and shape as one number below ``PATTERNS``."""
    number = kind
    for v in votes(text, kind, start, end, base):
        number = number * 3 + v
    glued = _glued(text, start, end)
    separators = set(text[start:end]) & set(" -.()")
    return (number * 4 + glued) * 4 + min(3, len(separators))


LABELERS = 4
PATTERNS = len(KINDS) * 3**LABELERS * 16


def unpack(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kinds, votes and shapes of pattern numbers."""
    shape, rest = numbers % 16, numbers // 16
    cast = np.stack([rest // 3**i % 3 for i in range(LABELERS - 1, -1, -1)], axis=1)
    return rest // 3**LABELERS, cast, shape


def posteriors(numbers: np.ndarray, counts: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Probability that a candidate of each pattern is personal data, by EM over labelers with unknown reliabilities.

    Each kind has its own prior, and each labeler its own probability of each vote
    given the truth, smoothed by one vote each. The votes' majority starts the rounds.
    """
    kinds, cast, _ = unpack(numbers)
    truth = 1 / (1 + np.exp(-(cast - 1).sum(axis=1)))
    for _ in range(rounds):
        log_odds = np.zeros(len(numbers))
        for kind in set(kinds.tolist()):
            own = kinds == kind
            yes, no = counts[own] * truth[own], counts[own] * (1 - truth[own])
            odds = np.log((yes.sum() + 1) / (no.sum() + 1))
            for j in range(LABELERS):
                # A vote counts for its side a little, so that few candidates can't turn a labeler round.
                p_yes = (np.bincount(cast[own, j], yes, 3) + [0.5, 1, 2]) / (yes.sum() + 3.5)
                p_no = (np.bincount(cast[own, j], no, 3) + [2, 1, 0.5]) / (no.sum() + 3.5)
                odds = odds + np.log(p_yes / p_no)[cast[own, j]]
            log_odds[own] = odds
        truth = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
    return truth


def features(numbers: np.ndarray) -> np.ndarray:
    """Kind, votes and shape as zeros and ones."""
    kinds, cast, shape = unpack(numbers)
    columns = [kinds[:, None] == np.arange(len(KINDS))]
    columns += [cast[:, j : j + 1] == np.arange(3) for j in range(LABELERS)]
    columns += [(shape // 4)[:, None] == np.arange(4), (shape % 4)[:, None] == np.arange(4)]
    return np.concatenate(columns, axis=1).astype(float)


def classifier(numbers: np.ndarray, counts: np.ndarray, truth: np.ndarray, steps: int = 400) -> np.ndarray:
    """Weights of a logistic regression on soft labels, by gradient steps with a small penalty.

    Patterns count by the square root of their number, so that the many plain ones don't drown the rare.
    """
    x, weight = features(numbers), np.sqrt(counts)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        w -= 0.5 * (x.T @ (weight * (p - truth)) / weight.sum() + 1e-3 * w)
    return w


def likely_patterns(tally: dict[int, int], threshold: float) -> list[int]:
    """The patterns that the classifier trained on ``tally`` gives at least ``threshold``."""
    if not tally:
        return []
    numbers, counts = (np.array(x) for x in (list(tally), list(tally.values())))
    w = classifier(numbers, counts.astype(float), posteriors(numbers, counts.astype(float)))
    return sorted(numbers[1 / (1 + np.exp(-features(numbers) @ w)) >= threshold].tolist())


SPAN = pa.struct([("kind", pa.int8()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("pattern", pa.int32())])
SPANS = "array<struct<kind: tinyint, start: int, end: int, base: boolean, pattern: int>>"


def candidate_spans(texts: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and the candidates of ``text``."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema if f.name in keep)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in SPAN]
        for batch in batches:
            column = batch.column("text")
            for i in range(0, len(column), SLICE):
                found = [candidates(t, base_spans(t)) if t else [] for t in column.slice(i, SLICE).to_pylist()]
                rows = pa.array([[dict(zip(names, c)) for c in f] for f in found], pa.list_(SPAN))
                kept = [batch.column(n).slice(i, SLICE) for n in keep]
                yield pa.record_batch([*kept, rows], [*keep, "spans"])

    return texts.mapInArrow(tidy(find), f"{schema}, spans {SPANS}")


def decided(found: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``found``, a settled table, with only the base spans and the likely others, by kind and start."""
    tally = found.select(F.explode("spans.pattern").alias("p")).groupBy("p").agg(F.count("*").alias("n"))
    likely = likely_patterns({r.p: r.n for r in tally.collect()}, threshold)  # at most PATTERNS rows
    keep = lambda s: s["base"] | s["pattern"].isin(likely)
    return found.withColumn("spans", F.array_sort(F.filter("spans", keep)))


def _listed(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    kind = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"].cast("int") + 1)
    one = lambda s: F.concat_ws(":", kind(s), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def _number(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, numbers of base spans by kind, ``base_sha256`` and all ``spans`` per row."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = decided(settle(candidate_spans(texts, "doc_id"), "pii-candidates"))
    base = F.filter("spans", lambda s: s["base"])
    counts = [_number(base, k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def mask_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every found span of the text replaced by its kind in angle brackets; null stays null.

    The text travels once, beside one column of all others under names that can't clash.
    """
    places = {c: f"c{i}" for i, c in enumerate(docs.columns) if c != text_col}
    others = F.struct(F.lit(0).alias("none"), *(F.col(f"`{c}`").alias(p) for c, p in places.items())).alias("row")
    rows = docs.select(others, F.col(f"`{text_col}`").alias("text"))
    found = decided(settle(candidate_spans(rows, "row", "text"), "pii-candidates"))
    out = found.mapInArrow(tidy(mask_batches), rows.schema)
    return out.select(*(F.col(f"row.{places[c]}" if c in places else "text").alias(c) for c in docs.columns))


def mask_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``row, text, spans`` to ``row`` and the masked text, a slice at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, SLICE):
            row, texts, spans = (batch.column(c).slice(i, SLICE) for c in ("row", "text", "spans"))
            texts = pa.array([masked(t, s) for t, s in zip(texts.to_pylist(), spans.to_pylist())], pa.string())
            yield pa.record_batch([row, texts], ["row", "text"])


def masked(text: str | None, spans: list[dict]) -> str | None:
    """``text`` with its spans masked, overlapping ones under the name of the first."""
    if not spans:
        return text
    parts, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= at:
            parts += [text[at : s["start"]], f"<{KINDS[s['kind']].upper()}>"]
        at = max(at, s["end"])
    return "".join([*parts, text[at:]])
