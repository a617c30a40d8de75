"""Jaccard join of word-shingle sets by parity sketches.

A document's shingles are dealt by hash into the segments of a sketch, and each
toggles its own random 64-bit pattern there. Two sketches of a size band differ in at
most as many segments as the sets have elements apart (and single toggled bits in at
most as many bits), so documents linked at a similarity of 0.8 agree on all but ``d`` of their
filled segments, ``d`` being the largest difference a document of that size can have
with a partner in the band. Put in one order, the first ``d + 1`` filled segments of both
then have one in common; they are the join keys. The order is by the number of
members, as a segment of few members is also that of documents with little in common.

Equal sets are one node from the start. Each node is first compared with one other,
that of the first nodes of its keys that it shares most keys with; that settles groups
of near copies in as many comparisons as they have members. Components are formed, and
those that meet on a key are compared by single pairs and joined, some times over. Only
nodes of one key that are then still in different components are compared among each
other, all behind the bounds that their bit sketches give, and on one of their common keys
where the least keys that both carry tell which. Every comparison that passes the
bound is verified on the whole sets; nothing is capped, so no link between different
sets is lost.

Null and empty texts, and texts without words, have an empty set and link with
nothing. Documents without an id are returned without a component and link with
nothing. Rows that share an id are one node of the graph. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm import shingles
from feedlake.llm.components import components
from feedlake.llm.store import settle
from feedlake.llm.workers import tidy

#: Sets link when 100 * intersection >= 80 * union, that is when they differ by at most a ninth of their summed sizes.
NINTH = 9
#: Bits of the single-bit sketch that bounds a difference before a pair is verified and travels with every
#: pair. The pairs that it leaves are tried by a sketch of two or more bits per member, which tells large sets apart.
WIDTH = 256
#: Words of 64 bits of the sketch that bounds the pairs of the last comparison; no set's wide sketch is narrower.
MIDDLE = 16
#: Keys of a set that travel with it in the last comparison, so that two sets with several keys in common make one pair.
CARRIED = 16
#: Times that components which meet on a key are compared by single pairs, before all that is left is compared.
ROUNDS = 1
#: Equal sets forgotten by a partition beyond this many; a later copy then costs shuffle, not correctness.
REMEMBERED = 100_000
#: Rows of at most some 100 bytes that may be broadcast.
BROADCAST_ROWS = 200_000
BITS = [f"b{i}" for i in range(WIDTH // 64)]
ROWS = "doc_id bigint, n_shingles bigint, f1 bigint, f2 bigint, " + ", ".join(f"{b} bigint" for b in BITS) + ", wide array<bigint>"
KEYS = "key bigint, f1 bigint, f2 bigint"
SETS = "f1 bigint, f2 bigint, members binary"


def names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def small(df: DataFrame) -> DataFrame:
    """A settled table, marked for broadcast if it is counted to be small."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _digest(members: np.ndarray) -> tuple[int, int]:
    """Two 64-bit numbers that stand for a set."""
    n = np.uint64(len(members))
    one = np.bitwise_xor.reduce(shingles.mix(members + np.uint64(0x9E3779B97F4A7C15)), initial=n)
    two = np.add.reduce(shingles.mix(members ^ np.uint64(0xD1B54A32D192ED03)), dtype=np.uint64) + n
    return int(one.view(np.int64)), int(two.view(np.int64))


def _band(n: int) -> int:
    return n.bit_length()


def _segments(band: int) -> int:
    """Segments of a band's sketch: filled ones suffice for the largest documents, with room for small ones."""
    largest = (1 << band) - 1
    return 2 * largest // NINTH * 13 // 10 + 8


def sketch_keys(members: np.ndarray) -> np.ndarray:
    """Join keys of a set, for its own size band and for the next one if a partner can lie there."""
    n, out = len(members), []
    patterns = shingles.mix(members * np.uint64(0xA0761D6478BD642F) + np.uint64(1))
    for band in (_band(n), _band(n) + 1):
        smallest, largest = 1 << (band - 1), min((1 << band) - 1, n * 5 // 4)
        apart = (n + largest) // NINTH
        if largest < smallest or apart == 0:
            continue  # no partner, or only an equal set
        m = _segments(band)
        # Sorted hashes, so a segment's members stand together.
        segment = ((members >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        starts = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
        tag = shingles.mix(segment[starts] + np.uint64(band << 40))
        keys = shingles.mix(np.bitwise_xor.reduceat(patterns, starts) + tag)
        if len(keys) > apart:
            # Segments that agree hold equally many members, so both sets of a pair put them in the same order.
            held = np.diff(starts, append=n)
            keys = keys[np.lexsort((keys, -held))[: apart + 1]]
        else:
            # Too few filled segments: two such sets might agree on empty ones alone.
            empty = np.setdiff1d(np.arange(m, dtype=np.uint64), segment[starts])
            keys = np.r_[keys, shingles.mix(empty + np.uint64(band << 40) + np.uint64(1 << 63))]
        out.append(keys)
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def bit_sketch(members: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """``width`` bits as signed 64-bit numbers, each bit the parity of the members dealt to it."""
    dealt = shingles.mix(members ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(width)
    return np.packbits(np.bincount(dealt.astype(np.int64), minlength=width).astype(np.uint8) & 1).view("<i8")


def set_sizes(texts: DataFrame) -> DataFrame:
    """``doc_id, n_shingles``, digest and bit sketch of the set, for each text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, wide = [], []
            for s in shingles.sets(batch.column(1)):
                found.append((len(s), *_digest(s), *bit_sketch(s).tolist()))
                wide.append(bit_sketch(s, max(64 * MIDDLE, 2 << _band(len(s)))))
            if found:
                columns = [pa.array(c, pa.int64()) for c in zip(*found)]
                ends = np.cumsum([0, *map(len, wide)], dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(wide)))
                yield pa.record_batch([batch.column(0).cast(pa.int64()), *columns, lists], names(ROWS))

    return texts.mapInArrow(tidy(rows), ROWS)


def keys_of(texts: DataFrame) -> DataFrame:
    """``key`` and digest for each join key of each different set of a partition."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            keys, digests, counts, total = [], [], [], 0
            for members in shingles.sets(batch.column(1)):
                digest = _digest(members) if len(members) else None
                if digest is None or digest in seen:
                    continue
                if len(seen) < REMEMBERED:
                    seen.add(digest)
                own = sketch_keys(members)
                keys.append(own)
                digests.append(digest)
                counts.append(len(own))
                total += len(own)
                if total > 200_000:
                    yield _key_batch(keys, digests, counts)
                    keys, digests, counts, total = [], [], [], 0
            if total:
                yield _key_batch(keys, digests, counts)

    return texts.mapInArrow(tidy(rows), KEYS)


def _key_batch(keys, digests, counts) -> pa.RecordBatch:
    both = np.repeat(np.array(digests, dtype=np.int64), counts, axis=0)
    columns = [np.concatenate(keys).view(np.int64), both[:, 0], both[:, 1]]
    return pa.record_batch([pa.array(c) for c in columns], names(KEYS))


def shared_keys(keys: DataFrame) -> DataFrame:
    """Rows of keys that several sets hold, with the first of them as ``r1, r2``; one pass over sorted partitions."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: np.ndarray | None = None  # the key's first row, which the last batch ended with or within
        open_first = False  # whether that row is still unmatched
        for batch in batches:
            own = np.column_stack([c.to_numpy() for c in batch.columns])
            if held is not None:
                own = np.vstack([held, own])
            fresh = np.any(own[1:] != own[:-1], axis=1)
            own = own[np.r_[True, fresh]]  # a set repeated within a key
            start = np.r_[True, own[1:, 0] != own[:-1, 0]]
            group = np.cumsum(start) - 1
            first = own[start][group]
            size = np.bincount(group)[group]
            keep = size > 1
            if held is not None and not open_first:
                keep[0] = False  # written with an earlier batch
            if keep.any():
                out = np.column_stack([own, first[:, 1:]])[keep]
                yield pa.record_batch([pa.array(c) for c in out.T.copy()], [*names(KEYS), "r1", "r2"])
            last = int(np.flatnonzero(start)[-1])
            if len(own) - last > 1:
                open_first = False
            elif last or held is None:
                open_first = True
            held = own[last : last + 1]

    return keys.mapInArrow(tidy(rows), KEYS + ", r1 bigint, r2 bigint")


def set_table(texts: DataFrame) -> DataFrame:
    """Digest and members of each text's set."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, total = [], 0
            for members in shingles.sets(batch.column(1)):
                found.append((*_digest(members), members.tobytes()))
                total += len(members)
                if total > 500_000:
                    yield pa.record_batch([pa.array(c) for c in zip(*found)], names(SETS))
                    found, total = [], 0
            if found:
                yield pa.record_batch([pa.array(c) for c in zip(*found)], names(SETS))

    return texts.mapInArrow(tidy(rows), SETS)


def _side(nodes: DataFrame, side: str, *also) -> DataFrame:
    """Digest, node, size and bit sketch of nodes, named for one side of a pair."""
    named = (F.col(c).alias(side + c.removeprefix("f")) for c in ("f1", "f2", "node", "n", *BITS))
    return nodes.select(*also, *named)


def _differing(words=BITS):
    """Bits in which the sketches of a pair differ that stand in the columns ``words``, the narrow ones unless told."""
    apart = F.lit(0)
    for b in words:
        apart = apart + F.bit_count(F.col(f"a{b}").bitwiseXOR(F.col(f"b{b}")))
    return apart


def _possible():
    """Whether sizes and sketches leave room for the similarity."""
    apart = _differing()
    total = F.col("an") + F.col("bn")
    return (NINTH * apart <= total) & (NINTH * F.abs(F.col("an") - F.col("bn")) <= total)


def _folded(sketch: Column, width: Column) -> Column:
    """The sketch of ``width`` words that a wider one implies: words of equal remainder laid over each other."""
    def over(i: Column) -> Column:
        every = F.sequence(i, F.size(sketch) - 1, width)
        return F.aggregate(every, F.lit(0).cast("bigint"), lambda t, j: t.bitwiseXOR(F.get(sketch, j)))

    return F.when(F.size(sketch) > width, F.transform(F.sequence(F.lit(0), width - 1), over)).otherwise(sketch)


def _wide_enough(one: Column, other: Column) -> Column:
    """Whether two sketches, which may differ in width, leave room for the similarity of a pair."""
    width = F.least(F.size(one), F.size(other))
    differing = F.zip_with(_folded(one, width), _folded(other, width), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return NINTH * F.aggregate(differing, F.lit(0), lambda t, n: t + n) <= F.col("an") + F.col("bn")


def narrowed(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs ``PAIR`` whose wide sketches leave room for the similarity.

    Possible partners lie in one size band or in two adjacent ones, so one sketch is at most twice as wide.
    """
    a, b = (nodes.select(*(F.col(c).alias(x + c.removeprefix("f")) for c in ("f1", "f2", "n", "wide"))) for x in "ab")
    both = pairs.select(*PAIR).distinct().join(a, ["a1", "a2"]).join(b, ["b1", "b2"])
    return both.where(_wide_enough(F.col("awide"), F.col("bwide"))).select(*PAIR)


#: Members that one slice of a set's comparisons holds, about; a set with more is sent to several slices.
MEMBERS = 2000
PAIR = ("a1", "a2", "anode", "b1", "b2", "bnode")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Edges ``u, v`` of the pairs ``PAIR`` whose whole sets, made again from the texts, are similar enough.

    The second set of a pair travels to the first one's slice, where the first comes
    before all of them; so a set is sent once per pair, and none is sent twice for being compared often.
    """
    pairs = settle(pairs.select(*PAIR).distinct(), "possible-pairs")
    slices = pairs.groupBy("a1", "a2").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("slices"))
    slice_ = F.pmod(F.xxhash64("b1", "b2"), F.col("slices")).cast("int").alias("slice")
    second = pairs.join(slices, ["a1", "a2"]).select(
        F.col("b1").alias("f1"), F.col("b2").alias("f2"), "a1", "a2", slice_, F.col("bnode").alias("node"), F.lit(1).alias("place")
    )
    every = F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice")
    first = pairs.groupBy("a1", "a2").agg(F.min("anode").alias("node")).join(slices, ["a1", "a2"]).select(
        F.col("a1").alias("f1"), F.col("a2").alias("f2"), "a1", "a2", every, "node", F.lit(0).alias("place")
    )
    places = small(settle(first.unionByName(second), "places"))
    nodes = settle(pairs.select(F.explode(F.array("anode", "bnode")).alias("doc_id")).distinct(), "compared")
    sets = set_table(texts.join(small(nodes), "doc_id", "left_semi"))
    by = ("a1", "a2", "slice")
    dealt = sets.join(places, ["f1", "f2"]).select(*by, "place", "node", "members")
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(parts, *by).sortWithinPartitions(*by, "place")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, held = None, np.zeros(0, np.uint64)
        for batch in batches:
            found = []
            for place, own, members in zip(*(batch.column(c).to_pylist() for c in ("place", "node", "members"))):
                members = np.frombuffer(members, np.uint64)
                if place == 0:
                    node, held = own, members
                    continue
                union = len(np.union1d(held, members))
                if 100 * (len(held) + len(members) - union) >= 80 * union:
                    found.append((node, own))
            if found:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found)], ["u", "v"])

    return settle(dealt.mapInArrow(tidy(rows), "u bigint, v bigint"), "links")


def _apart(shared: DataFrame, nodes: DataFrame, tops: DataFrame) -> DataFrame:
    """The nodes of the keys on which several components meet, with their component.

    Keys that the same nodes hold would give the same pairs, so only one of them stays.
    """
    at = shared.select("key", "f1", "f2").join(nodes.drop("wide"), ["f1", "f2"]).join(tops, "node", "left")
    at = at.withColumn("component", F.coalesce("component", "node"))
    holders = [F.bit_xor(F.xxhash64("f1", F.lit(i), "f2")).alias(f"h{i}") for i in range(2)]
    least, most = F.min("component").alias("low"), F.max("component").alias("high")
    split = at.groupBy("key").agg(least, most, F.count("*").alias("h"), *holders).where("low < high")
    return at.join(split.groupBy("h", "h0", "h1").agg(F.min("key").alias("key")), "key", "left_semi")


def _between_components(apart: DataFrame) -> DataFrame:
    """One possible pair for every two components of which one is the first on a key that both have."""
    whole = F.struct("f1", "f2", "node", "n", *BITS)
    each = apart.groupBy("key", "component").agg(F.min_by(whole, F.struct("f1", "f2")).alias("one"))
    first = each.groupBy("key").agg(F.min(F.struct("component", "one")).alias("first"))
    a = _side(first.select("key", "first.component", "first.one.*"), "a", "key", F.col("component").alias("a_component"))
    b = _side(each.select("key", "component", "one.*"), "b", "key", F.col("component").alias("b_component"))
    pairs = a.join(b, "key").where((F.col("a_component") < F.col("b_component")) & _possible())
    best = F.min_by(F.struct(*PAIR), F.struct(_differing() / (F.col("an") + F.col("bn")), "a1", "b1")).alias("best")
    return pairs.groupBy("a_component", "b_component").agg(best).select("best.*")


def _with_least_keys(apart: DataFrame) -> DataFrame:
    """``apart`` with ``least``: of each node's keys the ``CARRIED`` least ones."""
    place = F.row_number().over(Window.partitionBy("f1", "f2").orderBy("key"))
    early = F.when(F.col("place") <= CARRIED, F.col("key"))
    least = F.sort_array(F.collect_list(early).over(Window.partitionBy("f1", "f2")))
    return apart.withColumn("place", place).withColumn("least", least).drop("place")


def _met_here(key: Column, one: Column, other: Column) -> Column:
    """Whether two nodes are to be compared on this one of their common keys.

    That is the least of the keys that both carry. Nodes that carry none in common are compared on each.
    """
    return F.coalesce(key == F.array_min(F.array_intersect(one, other)), F.lit(True))


def _all_between(apart: DataFrame) -> DataFrame:
    """Possible pairs of nodes that meet on a key and lie in different components.

    The words of the middle sketch are columns, so that the join itself can judge them
    and makes no row for a pair that they rule out.
    """
    words = [f"m{i}" for i in range(MIDDLE)]
    middle = [F.get("middle", F.lit(i)).alias(w) for i, w in enumerate(words)]
    apart = apart.select("*", *middle)
    also = ("component", "least")
    a, b = (_side(apart, x, "key", *(F.col(c).alias(f"{x}_{c}") for c in also), *(F.col(w).alias(x + w) for w in words)) for x in "ab")
    alike = _possible() & (NINTH * _differing(words) <= F.col("an") + F.col("bn"))
    alike &= _met_here(F.col("key"), F.col("a_least"), F.col("b_least"))
    return a.join(b, "key").where((F.col("a_component") < F.col("b_component")) & alike)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row."""
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    named = texts.where("doc_id IS NOT NULL")
    sizes = settle(set_sizes(texts), "set-sizes")
    nodes = sizes.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("f1", "f2")
    alike = [*(F.min(c).alias(c) for c in BITS), F.first("wide").alias("wide")]  # equal sets have equal sketches
    nodes = settle(nodes.agg(F.min("doc_id").alias("node"), F.min("n_shingles").alias("n"), *alike), "set-nodes")

    keys = keys_of(named)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = keys.repartition(parts, "key").sortWithinPartitions("key", "f1", "f2")
    shared = settle(shared_keys(keys), "shared-keys")

    # Each set against one: the first of a key, and of those the one it shares most keys with.
    stars = shared.where("f1 <> r1 OR f2 <> r2").groupBy("r1", "r2", "f1", "f2").agg(F.count("*").alias("common"))
    stars = stars.toDF("a1", "a2", "b1", "b2", "common")
    stars = stars.join(_side(nodes, "a"), ["a1", "a2"]).join(_side(nodes, "b"), ["b1", "b2"]).where(_possible())
    most = F.max_by(F.struct("a1", "a2", "anode"), F.struct("common", "a1", "a2")).alias("most")
    stars = stars.groupBy("b1", "b2", "bnode").agg(most).select("most.*", "b1", "b2", "bnode")
    links = verified(narrowed(stars, nodes), named)
    tops = settle(components(links), "star-components")

    # Of the components that meet on a key, each against the first, by one pair for every two components.
    for _ in range(ROUNDS):
        apart = settle(_apart(shared, nodes, tops), "apart")
        more = verified(narrowed(_between_components(apart), nodes), named)
        if more.isEmpty():
            break
        links = links.unionByName(more)
        tops = settle(components(links), "components")
    # What is still apart on a key, all against all behind a wider sketch.
    apart = _apart(shared, nodes, tops).join(nodes.select("f1", "f2", _folded(F.col("wide"), F.lit(MIDDLE)).alias("middle")), ["f1", "f2"])
    apart = settle(_with_least_keys(apart), "apart")
    more = verified(narrowed(_all_between(apart), nodes), named)
    if not more.isEmpty():
        tops = components(links.unionByName(more))

    rows = sizes.select("doc_id", "n_shingles", "f1", "f2").join(nodes.select("f1", "f2", "node"), ["f1", "f2"], "left")
    rows = rows.join(tops, "node", "left")
    linked = F.when(F.col("n_shingles") > 0, F.coalesce("component", "node")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), linked)
    return rows.select("doc_id", "n_shingles", component.alias("component_id"))
