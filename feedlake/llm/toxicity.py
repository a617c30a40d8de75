"""Toxicity by class-conditional Kneser-Ney models of the letters of words.

Each class has an interpolated Kneser-Ney model of ``ORDER`` letters over the words of
its labelled documents (a word counts once per document). The lower orders are
continuation counts shared by both classes. The ordinary model backs off to them, and
the toxic model's discounted mass goes to the ordinary one: where toxic text has shown
nothing about an expression, both say the same, so rare and new words carry no
evidence. The logarithm of the ratio is therefore needed for the toxic class's own
letter groups only. That table is broadcast if it is counted to have at most ``PIECES``
rows; a longer one is joined to the distinct words' letter groups by shuffle.

A text is judged by the ratio of the two likelihoods per letter, over the whole text
and over its most suspicious word; a logistic curve fitted on labelled rows that the
counts have not seen turns the two into a score.

Null and empty texts and texts without letters get the score of no evidence. Ids may
be null or repeated: there is one row per input row, and an id labelled both ways
counts as toxic. Without labels the curve keeps its starting form. Columns other than
id and text are ignored.
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

ORDER = 6
DISCOUNT = 0.75
#: Discounts of toxic counts of one, two and more: what one document alone shows is no evidence.
TOXIC_DISCOUNTS = (1.0, 1.5, 2.0)
#: Letter groups and contexts that may be broadcast.
PIECES = 1 << 20
#: Labelled rows that the logistic curve is fitted on, at most; the counts take all others.
CALIBRATION_ROWS = 20_000
#: Labels that may be broadcast (16 bytes each); more are joined by shuffle.
BROADCAST_ROWS = 200_000
#: Word ratios remembered by one Python worker.
MEMORY = 400_000
SLICE = 256
WORDS = re.compile(r"[^\W\d_]+").findall
START, END = "\x02", "\x03"
#: Weights of the most suspicious word and of the whole text, and the intercept, before any fitting.
STARTING = np.array([1.0, 0.5, -4.0])


def held_out(doc_id: Column) -> Column:
    """Whether labels of this document may not be learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def word_counts(labelled: DataFrame) -> DataFrame:
    """``word, toxic, ordinary``: in how many documents of each class a word occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = (Counter(), Counter())
            for i in range(0, batch.num_rows, SLICE):
                texts, labels = (c.slice(i, SLICE).to_pylist() for c in batch.columns)
                for text, toxic in zip(texts, labels):
                    seen[toxic].update(set(WORDS(text.lower())))
            words = list(seen[0].keys() | seen[1].keys())
            columns = [pa.array(words, pa.string()), *(pa.array([c[w] for w in words], pa.int64()) for c in seen)]
            yield pa.record_batch(columns, ["word", "ordinary", "toxic"])

    rows = labelled.select("text", "toxic").mapInArrow(count, "word string, ordinary bigint, toxic bigint")
    return rows.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def letter_groups(words: DataFrame) -> DataFrame:
    """``gram, toxic, ordinary`` for every ``ORDER`` letters of the padded words."""
    padded = F.concat(F.lit(START * (ORDER - 1)), "word", F.lit(END))
    starts = F.sequence(F.lit(1), F.length("word") + 1)
    grams = words.select(padded.alias("padded"), "toxic", "ordinary", F.explode(starts).alias("at"))
    grams = grams.select(F.col("padded").substr(F.col("at"), F.lit(ORDER)).alias("gram"), "toxic", "ordinary")
    return grams.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def _context(gram: str = "gram") -> Column:
    return F.expr(f"left({gram}, length({gram}) - 1)")


def _suffix(gram: str = "gram") -> Column:
    return F.expr(f"substring({gram}, 2)")


def shared_backoff(grams: DataFrame) -> DataFrame:
    """``gram, p`` for all groups of ``ORDER - 1`` letters: Kneser-Ney on continuation counts of both classes."""
    levels, above = [], grams.select("gram")
    for _ in range(ORDER - 1):
        above = above.select(_suffix().alias("gram")).groupBy("gram").agg(F.count("*").alias("k"))
        above = settle(above, "continuations")
        levels.append(above)
    letters = levels[-1].agg(F.sum("k").alias("all"), F.count("*").alias("types"))
    base = (F.greatest(F.col("k") - DISCOUNT, F.lit(0)) + DISCOUNT) / F.col("all")
    p = settle(levels[-1].join(F.broadcast(letters)).select("gram", base.alias("p")), "backoff")
    for level in reversed(levels[:-1]):
        contexts = level.groupBy(_context().alias("context")).agg(F.sum("k").alias("all"), F.count("*").alias("types"))
        joined = level.withColumns({"context": _context(), "suffix": _suffix()}).join(contexts, "context")
        joined = joined.join(p.toDF("suffix", "lower"), "suffix")
        own = (F.col("k") - DISCOUNT + DISCOUNT * F.col("types") * F.col("lower")) / F.col("all")
        p = settle(joined.select("gram", own.alias("p")), "backoff")
    return p


def _toxic_discount() -> Column:
    one, two, more = TOXIC_DISCOUNTS
    few = F.when(F.col("toxic") == 0, 0.0).when(F.col("toxic") == 1, one).when(F.col("toxic") == 2, two)
    return few.otherwise(more)


def ratios(grams: DataFrame) -> DataFrame:
    """``piece, ratio``: logarithms of toxic over ordinary likelihood.

    For a group of letters seen in toxic words, that of its last letter; for a context
    seen there, that of any letter that toxic words haven't shown after it.
    """
    taken = {"toxic": _toxic_discount(), "ordinary": F.when(F.col("ordinary") > 0, DISCOUNT).otherwise(0.0)}
    by_context = grams.groupBy(_context().alias("context")).agg(
        *(F.sum(c).alias(f"{c}_all") for c in taken), *(F.sum(d).alias(f"{c}_taken") for c, d in taken.items())
    )
    by_context = by_context.where("toxic_all > 0")
    left = {c: F.col(f"{c}_taken") / F.col(f"{c}_all") for c in taken}
    seen = grams.where("toxic > 0").withColumns({"context": _context(), "suffix": _suffix()})
    seen = seen.join(by_context, "context").join(shared_backoff(grams).toDF("suffix", "lower"), "suffix")
    ordinary = F.when(
        F.col("ordinary_all") > 0,
        F.greatest(F.col("ordinary") - DISCOUNT, F.lit(0)) / F.col("ordinary_all") + left["ordinary"] * F.col("lower"),
    ).otherwise(F.col("lower"))
    toxic = (F.col("toxic") - taken["toxic"]) / F.col("toxic_all") + left["toxic"] * ordinary
    own = seen.select(F.col("gram").alias("piece"), F.log(toxic / ordinary).alias("ratio"))
    rest = by_context.select(F.col("context").alias("piece"), F.log(left["toxic"]).alias("ratio"))
    return own.unionByName(rest)


def word_ratio(word: str, table: dict[str, float]) -> float:
    """The logarithm of a word's likelihood ratio."""
    padded = START * (ORDER - 1) + word + END
    total = 0.0
    for i in range(len(word) + 1):
        gram = padded[i : i + ORDER]
        ratio = table.get(gram)
        total += table.get(gram[:-1], 0.0) if ratio is None else ratio
    return total


def evidence(texts: DataFrame, table: dict[str, float], *keep: str) -> DataFrame:
    """The columns ``keep`` with ``strongest`` (a word's ratio) and ``overall`` (per letter) of ``text``."""
    shared = texts.sparkSession.sparkContext.broadcast(table)
    kept_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema if f.name in keep)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Memory(lambda word: word_ratio(word, shared.value), MEMORY)
        for batch in batches:
            column = batch.column("text")
            for i in range(0, len(column), SLICE):
                found = []
                for text in column.slice(i, SLICE).to_pylist():
                    words = WORDS(text.lower())
                    values = list(map(known.__getitem__, words))
                    found.append((max(values, default=0.0), sum(values) / max(1, sum(map(len, words)))))
                kept = [batch.column(n).slice(i, SLICE) for n in keep]
                columns = [pa.array(c, pa.float64()) for c in zip(*found)]
                yield pa.record_batch([*kept, *columns], [*keep, "strongest", "overall"])

    return texts.mapInArrow(judge, f"{kept_schema}, strongest double, overall double")


def word_ratios(words: DataFrame, pieces: DataFrame) -> DataFrame:
    """``word, ratio`` as by ``word_ratio``, for distinct words and a table of any size."""
    padded = F.concat(F.lit(START * (ORDER - 1)), "word", F.lit(END))
    starts = F.sequence(F.lit(1), F.length("word") + 1)
    grams = words.select("word", padded.alias("padded"), F.explode(starts).alias("at"))
    grams = grams.select("word", F.col("padded").substr(F.col("at"), F.lit(ORDER)).alias("gram"))
    grams = grams.join(pieces.toDF("gram", "own"), "gram", "left").withColumn("context", _context())
    grams = grams.join(pieces.toDF("context", "rest"), "context", "left")
    return grams.groupBy("word").agg(F.sum(F.coalesce("own", "rest", F.lit(0.0))).alias("ratio"))


def evidence_by_shuffle(texts: DataFrame, pieces: DataFrame, *keep: str) -> DataFrame:
    """The rows of ``evidence`` without a broadcast table.

    Words meet their ratios by shuffle and are summed up by the digest of their text;
    copies of a text multiply its sums and its letters alike.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                digests, bodies = (c.slice(i, SLICE).to_pylist() for c in batch.columns)
                found = [(d, w, n) for d, t in zip(digests, bodies) for w, n in Counter(WORDS(t.lower())).items()]
                columns = [pa.array(c, t) for c, t in zip(zip(*found), (pa.binary(), pa.string(), pa.int64()))]
                if columns:
                    yield pa.record_batch(columns, ["digest", "word", "n"])

    keyed = texts.select(F.unhex(F.md5("text")).alias("digest"), *keep, "text")
    found = settle(keyed.select("digest", "text").mapInArrow(count, "digest binary, word string, n bigint"), "words")
    by_word = settle(word_ratios(found.select("word").distinct(), pieces), "word-ratios")
    letters = F.sum(F.col("n") * F.length("word"))
    sums = found.join(by_word, "word").groupBy("digest")
    sums = sums.agg(F.max("ratio").alias("strongest"), (F.sum(F.col("n") * F.col("ratio")) / letters).alias("overall"))
    both = keyed.drop("text").join(sums, "digest", "left")
    return both.select(*keep, *(F.coalesce(c, F.lit(0.0)).alias(c) for c in ("strongest", "overall")))


def _inputs(strongest: np.ndarray, overall: np.ndarray) -> np.ndarray:
    return np.column_stack([np.clip(strongest, -2, 12), np.clip(overall * 20, -3, 3), np.ones(len(strongest))])


def fitted_curve(strongest: np.ndarray, overall: np.ndarray, toxic: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Weights of the logistic curve by Newton steps, drawn to ``STARTING`` where there are few labels."""
    x, w = _inputs(strongest, overall), STARTING.copy()
    if len(x) == 0 or toxic.min() == toxic.max():
        return w
    penalty = np.diag([0.2, 0.5, 0.02])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (p - toxic) + penalty @ (w - STARTING)
        bend = (x * (p * (1 - p))[:, None]).T @ x + penalty
        w = w - np.clip(np.linalg.solve(bend, slope), -2, 2)
    return np.maximum(w, [0.05, 0, -50])  # more evidence never lowers a score


def score_toxicity(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, held_out, score, predicted, strongest, overall`` per row of ``docs``."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    known = labels.where("toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = settle(known.where(~held_out(F.col("doc_id"))), "labels")
    if known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    for_curve = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4)) == 0
    chosen = known.where(for_curve).orderBy(F.xxhash64("doc_id"), "doc_id").limit(CALIBRATION_ROWS)
    chosen = F.broadcast(settle(chosen, "curve-labels"))  # ids first, so that no texts are sorted
    labelled = texts.join(known, "doc_id").join(chosen.select("doc_id"), "doc_id", "left_anti")
    grams = settle(letter_groups(word_counts(labelled)), "letter-groups")
    pieces = settle(ratios(grams), "ratios")
    judge, table = evidence_by_shuffle, pieces
    if pieces.limit(PIECES + 1).count() <= PIECES:
        judge, table = evidence, {r.piece: r.ratio for r in pieces.collect()}
    sample = texts.join(chosen, "doc_id")
    rows = judge(sample, table, "toxic").collect()
    curve = fitted_curve(*(np.array([r[c] for r in rows], float) for c in ("strongest", "overall", "toxic")))

    judged = judge(texts, table, "doc_id")
    clipped = [F.greatest(F.lit(-2.0), F.least(F.lit(12.0), "strongest"))]
    clipped.append(F.greatest(F.lit(-3.0), F.least(F.lit(3.0), F.col("overall") * 20)))
    line = sum((c * float(w) for c, w in zip(clipped, curve)), F.lit(float(curve[2])))
    score = 1 / (1 + F.exp(-line))
    out = judged.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), "strongest", "overall")
    return out.select(
        "doc_id",
        F.coalesce("held_out", F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "strongest",
        "overall",
    )
