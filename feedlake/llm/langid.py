"""Language identification by Bayesian fusion of text, markup, address and host.

The text's likelihood comes from letter trigrams of its words, trained on a bounded
sample of rows that declare a language. A first pass over all rows scores texts alone;
from its verdicts grouped counts tell how far a declared language and an address
suffix can be trusted, and what each host tends to write, smoothed towards its domain,
the domain's suffix and the whole. The second pass adds up the evidence of all four.

A row is accepted if its text holds letters and one language's posterior reaches the
threshold. Null, empty and letterless texts are rejected with no language; a missing
declaration, suffix or host is no evidence. With no declared row there is no language
to tell and all rows are rejected. Ids may be null or repeated: there is one row per
input row. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.store import settle
from feedlake.llm.tokens import Memory
from feedlake.llm.workers import tidy

#: Rows the trigrams are learned from, languages told apart, and trigrams kept, at most.
TRAINING_ROWS, LANGUAGES, TRIGRAMS = 20_000, 200, 300_000
#: A text's trigrams aren't independent: beyond this many, more of them add no certainty.
WORTH = 80
#: Strength of the shared trigram distribution, of each step of the host hierarchy, of unseen declarations and suffixes.
SHARED, STEP, UNSEEN = 200.0, 20.0, 1.0
BROADCAST_ROWS = 200_000
MEMORY, SLICE = 400_000, 256
WORDS = re.compile(r"[^\W\d_]+").findall
COMMENT, HTML_TAG = r"(?s)<!--.*?(?:-->|$)", r"(?i)<html\b[^>]*>"
MARKUP_LANGUAGE = r"(?i)\slang\s*=\s*[\"']?([a-z]{2,3})\b"
HOST = r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def language_code(declared: Column) -> Column:
    """The primary subtag in lower case, or null."""
    code = F.lower(F.regexp_extract(declared, r"^\s*([A-Za-z]{2,3})(?:[-_].*)?\s*$", 1))
    return F.when(code != "", code)


def trigrams(word: str) -> list[str]:
    padded = f"\x02{word}\x03"
    return [padded[i : i + 3] for i in range(len(padded) - 2)]


def trained(texts: DataFrame) -> tuple[list[str], dict[str, np.ndarray]]:
    """Languages, and per trigram the logarithm of its likelihood in each against that in all.

    ``texts`` has ``text`` and ``declared``.
    """
    declared = texts.where("declared IS NOT NULL AND text <> ''")
    keys = F.xxhash64("text")
    cut = declared.select(keys.alias("h")).distinct().orderBy("h").limit(TRAINING_ROWS).agg(F.max("h")).first()[0]
    if cut is None:
        return [], {}
    sample = declared.where(keys <= cut).select("declared", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: dict[str, Counter] = {}
            for i in range(0, batch.num_rows, SLICE):
                for code, text in zip(*(c.slice(i, SLICE).to_pylist() for c in batch.columns)):
                    words.setdefault(code, Counter()).update(set(WORDS(text.lower())))
            for code, own in words.items():
                grams: Counter = Counter()
                for word, n in own.items():
                    for gram in trigrams(word):
                        grams[gram] += n
                columns = [[code] * len(grams), list(grams), list(grams.values())]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], ["code", "gram", "n"])

    types = (pa.string(), pa.string(), pa.int64())
    counts = sample.mapInArrow(tidy(count), "code string, gram string, n bigint").groupBy("code", "gram").agg(F.sum("n").alias("n"))
    counts = settle(counts, "trigrams")
    codes = counts.groupBy("code").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "code").limit(LANGUAGES).collect()
    codes = sorted(r.code for r in codes)
    kept = counts.groupBy("gram").agg(F.sum("n").alias("all")).orderBy(F.desc("all"), "gram").limit(TRIGRAMS)
    rows = counts.where(F.col("code").isin(codes)).join(kept, "gram").groupBy("gram")
    rows = rows.agg(F.collect_list(F.struct("code", "n")).alias("found")).collect()  # at most TRIGRAMS rows
    table = np.zeros((len(rows), len(codes)))
    for i, r in enumerate(rows):
        for one in r.found:
            table[i, codes.index(one.code)] = one.n
    shared = table.sum(axis=1) / table.sum()
    each = (table + SHARED * shared[:, None]) / (table.sum(axis=0) + SHARED)
    ratios = np.log(each / shared[:, None])
    return codes, {r.gram: v for r, v in zip(rows, ratios)}


def text_evidence(rows: DataFrame, codes: list[str], table: dict[str, np.ndarray], *keep: str) -> DataFrame:
    """The columns ``keep`` and ``evidence``: a logarithmic likelihood per language; null where there are no letters."""
    shared = rows.sparkSession.sparkContext.broadcast(table)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in keep)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, used = np.zeros((1 << 12, len(codes) + 1)), 0

        def place(word: str) -> int:
            nonlocal values, used
            if used == len(values):
                values = np.concatenate([values, np.zeros_like(values)])
            own = values[used]
            own[:] = 0
            for gram in trigrams(word):
                if (found := shared.value.get(gram)) is not None:
                    own[:-1] += found
            own[-1] = len(word)
            used += 1
            return used - 1

        known = Memory(place, MEMORY)
        for batch in batches:
            column = batch.column("text")
            for i in range(0, len(column), SLICE):
                texts = column.slice(i, SLICE).to_pylist()
                places = [list(map(known.__getitem__, WORDS(t.lower()))) for t in texts]
                sums = [values[p].sum(axis=0) for p in places]
                found = [(s[:-1] * min(1.0, WORTH / s[-1])).tolist() if s[-1] else None for s in sums]
                kept = [batch.column(n).slice(i, SLICE) for n in keep]
                yield pa.record_batch([*kept, pa.array(found, pa.list_(pa.float64()))], [*keep, "evidence"])
                used = len(known)  # words beyond the memory are forgotten

    return rows.mapInArrow(tidy(score), f"{schema}, evidence array<double>")


def _counts(rows: DataFrame, *by: str) -> DataFrame:
    """Rows per ``by`` and text language, for rows that have both."""
    present = rows.where(" AND ".join(f"{c} IS NOT NULL" for c in ("text_language", *by)))
    return present.groupBy(*by, "text_language").agg(F.count("*").alias("n"))


def _vector(counts: DataFrame, codes: list[str], by: str) -> DataFrame:
    """``by, counts``: an array of counts in the order of the languages."""
    each = [F.sum(F.when(F.col("text_language") == c, F.col("n")).otherwise(0)).cast("double") for c in codes]
    return counts.groupBy(by).agg(F.array(*each).alias("counts"))


def _marked(df: DataFrame) -> DataFrame:
    df = settle(df, "priors")
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _smoothed(counts: Column, parent: Column, strength: float) -> Column:
    """Shares of counts, drawn towards the parent's shares."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(counts, parent, lambda n, p: (n + strength * p) / (total + strength))


def witness(rows: DataFrame, codes: list[str], column: str, totals: list[float]) -> DataFrame:
    """``column, said``: the logarithm of how likely each language's rows carry the value, smoothed by its overall share."""
    counts = _vector(_counts(rows, column), codes, column)
    overall = F.aggregate("counts", F.lit(0.0), lambda a, x: a + x) / float(sum(totals) or 1)
    by_language = F.array(*(F.lit(float(t)) for t in totals))
    said = F.zip_with("counts", by_language, lambda n, t: F.log((n + UNSEEN * overall) / (t + UNSEEN)))
    return _marked(counts.select(column, said.alias(f"{column}_said")))


def host_priors(rows: DataFrame, codes: list[str]) -> DataFrame:
    """``host, prior``: shares of languages by host, smoothed towards domain, suffix and the whole."""
    counts = settle(_counts(rows, "host"), "host-counts")
    parts = F.split("host", r"\.")
    domain = F.when(F.size(parts) > 1, F.array_join(F.slice(parts, -2, 2), ".")).otherwise(F.col("host"))
    counts = counts.withColumns({"domain": domain, "top": F.element_at(parts, -1)})
    whole = dict(counts.groupBy("text_language").agg(F.sum("n")).collect())
    total = sum(whole.values()) + len(codes)
    share = F.array(*(F.lit((whole.get(c, 0) + 1) / total) for c in codes))
    top = _vector(counts, codes, "top").select("top", _smoothed(F.col("counts"), share, STEP).alias("top_prior"))
    names = counts.select("host", "domain", "top").distinct()
    domains = _vector(counts, codes, "domain").join(names.select("domain", "top").distinct(), "domain").join(top, "top")
    domains = domains.select("domain", _smoothed(F.col("counts"), F.col("top_prior"), STEP).alias("domain_prior"))
    hosts = _vector(counts, codes, "host").join(names.select("host", "domain"), "host").join(domains, "domain")
    prior = _smoothed(F.col("counts"), F.col("domain_prior"), STEP)
    return _marked(hosts.select("host", F.transform(prior, lambda p: F.log(p)).alias("host_said")))


def identify(rows: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``id, language, posterior, accepted, declared, text_language`` for rows ``id, text, declared, suffix, host``."""
    rows = rows.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("declared", language_code(F.col("declared")))
    codes, table = trained(rows)
    keep = ("id", "declared", "suffix", "host")
    scored = text_evidence(rows, codes, table, *keep)
    if not codes:
        nothing = [F.lit(None).cast("string").alias("language"), F.lit(None).cast("double").alias("posterior")]
        return scored.select("id", *nothing, F.lit(False).alias("accepted"), "declared", nothing[0].alias("text_language"))
    names = F.array(*map(F.lit, codes))
    best = lambda values: F.get(names, F.array_position(values, F.array_max(values)).cast("int") - 1)
    scored = settle(scored.withColumn("text_language", best(F.col("evidence"))), "text-evidence")
    by_text = dict(scored.where("text_language IS NOT NULL").groupBy("text_language").count().collect())
    totals = [float(by_text.get(c, 0)) for c in codes]
    fused, all_said = scored, F.col("evidence")
    for column in ("declared", "suffix"):
        fused = fused.join(witness(scored, codes, column, totals), column, "left")
        all_said = F.zip_with(all_said, F.coalesce(f"{column}_said", _zeros(codes)), lambda a, b: a + b)
    fused = fused.join(host_priors(scored, codes), "host", "left")
    share = F.array(*(F.lit(float(np.log((t + 1) / (sum(totals) + len(codes))))) for t in totals))
    all_said = F.zip_with(all_said, F.coalesce("host_said", share), lambda a, b: a + b)
    fused = fused.withColumn("said", all_said)
    posterior = 1 / F.aggregate("said", F.lit(0.0), lambda a, x: a + F.exp(x - F.array_max("said")))
    out = fused.withColumns({"language": best(F.col("said")), "posterior": posterior})
    accepted = F.coalesce(F.col("posterior") >= threshold, F.lit(False))
    return out.select("id", "language", "posterior", accepted.alias("accepted"), "declared", "text_language")


def _zeros(codes: list[str]) -> Column:
    return F.array(*(F.lit(0.0) for _ in codes))


def identify_documents(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``doc_id`` and the verdict per document: its ``lang`` is what it declares, its ``source`` the host."""
    nothing = F.lit(None).cast("string")
    rows = docs.select(
        F.col("doc_id").alias("id"), "text", F.col("lang").alias("declared"), nothing.alias("suffix"), F.col("source").alias("host")
    )
    return identify(rows, threshold).withColumnRenamed("id", "doc_id")


def markup_language(html: Column) -> Column:
    """The language of a page's first html tag outside comments, or an empty string."""
    tag = F.regexp_extract(F.regexp_replace(F.coalesce(html, F.lit("")), COMMENT, ""), HTML_TAG, 0)
    return F.regexp_extract(tag, MARKUP_LANGUAGE, 1)


def identify_pages(pages: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``page_id`` and the verdict per page, by its main text, its markup's language, and its address."""
    from feedlake.llm.html_text import extract

    said = markup_language(F.col("html")).alias("said")
    texts = extract(pages.select(F.struct("page_id", said).alias("page"), "url", "html"), "page")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1))
    host = F.when(host != "", host)
    suffix = F.element_at(F.split(host, r"\."), -1)
    rows = texts.select(
        F.col("page_id.page_id").alias("id"), "text", F.col("page_id.said").alias("declared"), suffix.alias("suffix"), host.alias("host")
    )
    return identify(rows, threshold).withColumnRenamed("id", "page_id")
