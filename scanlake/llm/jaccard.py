"""Exact Jaccard join of documents as sets of word n-grams, as a metric-space join.

The sets are points, and 1 - Jaccard similarity is their metric; eps is the largest distance of a link. Equal sets are one point.

Level 1 has a pivot for every n-gram: the set of that n-gram alone. A point is equally near to the pivots of all its n-grams, and as far as
can be from others; ties go to the rarest, so the point's Voronoi region is that of its rarest n-gram. A partner within eps
lacks at most a share eps of its n-grams, so replicating a point to the regions of its first eps * n + 1 n-grams makes each pair of
partners meet in one region. The empty set is a pivot too: sizes of partners differ by a factor of at most 1 / (1 - eps), so each
region is cut into rings of sizes, and a point is in its ring and the next. Regions with one point end here.

A member's place is the number of its n-grams that are rarer than the region's own. Partners have to meet only in the region of the first n-gram
that they share; there, none of the rarer ones is shared, so two places bound the similarity from above. Members whose place is too high for
the lowest place in the region leave it, and a member is high if no other high one can be its partner: pivots are low members, and a region
without low ones ends. So near copies with edits of their own, too many for a link, do not meet one another.

In the levels below, points of the region are pivots. All members' distances to them are computed. A pivot is then done with: all its
links are known. Members within RADIUS of a pivot form its region, the first such pivot's if there are more; those of no pivot form the rest.
By the triangle inequality, a partner of a member of a pivot's region is at most RADIUS + eps from that pivot, so members in
that window are replicated there. The join recurses, with more pivots from level to level, until no region has two members left. Where all low
members are pivots, the region ends with that level; only links matter there and between pivots, so only pairs that places allow are compared.

Links found are used at once: after each level the components of all links so far give points their labels. Points of one label need no
comparison. A region of one label ends; pivots are taken from as many labels as there are; members with the label of their region's
pivot go on only if a member of another label lies within eps of their distance. So a group of near copies costs its size, not its square.
Members of one size and place form a cell, cut in two by whether they have the region's most frequent label; sizes and places say which cells can
hold partners. Where that leaves few pairs for the members, they are compared, and the region ends.
Regions with the same members are one region.

Level 1 is what is known as prefix filtering with a size filter.

Rarity is an order only: counts of hashed n-grams in a table of fixed size. Links make components; no group is expanded to pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scanlake.llm.arrow import map_batches, slices, text_bytes
from scanlake.llm.components import components
from scanlake.llm.hashing import BASE, byte_values, mix, sequence_hashes, span_hashes, spans_of
from scanlake.llm.shared import small_batches, written

#: Counters of the rarity table, and rows that a task cuts it into.
RARITY_BITS = 22
_CHUNK_BITS = 14
#: Bits of the filter that says which points' sets are wanted.
FILTER_BITS = 24
#: Distance from a pivot up to which points are in its region, and how many times more pivots each level has.
RADIUS = 0.3
MORE_PIVOTS = 4
#: A region of so many low members takes all of them as pivots.
FEW = 8
#: A region with at most so many cells is looked at for ending by its cells' pairs, of which there are FEW for each member at most.
CELLS = 256
#: Pairs of pivot and point up to which a level's pairs are broadcast (16 bytes each); more of them are shuffled.
BROADCAST_PAIRS = 500_000
#: Texts, and pairs of sets, that a task takes at once.
TEXT_ROWS = 1000
PAIR_ROWS = 128
#: Added to compared distances, so that rounding can only add comparisons.
_SLACK = 1e-9

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def ngram_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The distinct n-gram hashes of each text, ascending. A text of fewer words has its whole sequence as the one n-gram."""
    data, offsets = text_bytes(column)
    lowered = _LOWER[data]
    starts, ends = spans_of(~_SPACE[lowered], offsets)
    hashes = span_hashes(lowered, starts, ends, byte_values(3))
    grams = sequence_hashes(hashes, words) ^ np.uint64(words)
    cuts = np.searchsorted(starts, offsets)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if b - a >= words:
            yield np.unique(grams[a : b - words + 1])
        elif b > a:
            yield sequence_hashes(hashes[a:b], b - a) ^ np.uint64(b - a)
        else:
            yield hashes[:0]


def set_key(grams: np.ndarray) -> int:
    """A hash of the set, as a signed 64-bit number; 0 for the empty set."""
    if not len(grams):
        return 0
    parts = np.array([np.add.reduce(mix(grams)), np.bitwise_xor.reduce(mix(grams ^ np.uint64(BASE))), len(grams)], np.uint64)
    return int(sequence_hashes(parts, 3)[0].astype(np.int64))


def parity_sketch(grams: np.ndarray) -> bytes:
    """A bit for the parity of the n-grams in each of 2n to 4n hash classes.

    Two sketches, folded to one size, differ in at most as many bits as the sets differ in n-grams.
    """
    size = max(64, 1 << (2 * len(grams) - 1).bit_length()) if len(grams) else 64
    places = (grams & np.uint64(size - 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=size) & 1).astype(np.uint8), bitorder="little").tobytes()


def least_difference(a, b) -> int:
    """A lower bound of the number of n-grams in one set only."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


# Rarity ---------------------------------------------------------------------------------------------------------------------


def _counters(words: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << RARITY_BITS, np.int32)
        for part in slices(batches, "text"):
            grams = np.concatenate([np.zeros(0, np.uint64), *ngram_sets(part.column(0), words)])
            kinds, times = np.unique((grams >> np.uint64(64 - RARITY_BITS)).astype(np.int64), return_counts=True)
            counts[kinds] += times.astype(np.int32)
        parts = _levels(counts).reshape(-1, 1 << _CHUNK_BITS)
        chunks = [c for c, part in enumerate(parts) if part.any()]
        payloads = [parts[c].tobytes() for c in chunks]
        yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int32()), pa.array(payloads, pa.binary())], ["chunk", "payload"])

    return work


def _levels(counts: np.ndarray) -> np.ndarray:
    """Sixths of the logarithm: one byte, and exact enough for an order."""
    return np.minimum(255, np.round(6 * np.log2(1.0 + counts))).astype(np.uint8)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            into = sums.setdefault(chunk, np.zeros(1 << _CHUNK_BITS))
            into += np.exp2(np.frombuffer(payload, np.uint8) / 6.0) - 1
    # Finer steps around the mean, where most n-grams are; what is frequent stands out from it.
    levels = [np.minimum(255, np.round(24 * np.log2(1 + 8 * x / x.mean()))).astype(np.uint8).tobytes() for x in sums.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(levels, pa.binary())], ["chunk", "payload"])


def rarity_levels(texts: DataFrame, words: int) -> np.ndarray:
    """How frequent the n-grams with each hash prefix are, on a logarithmic scale; counted over all texts. Its size is fixed."""
    kind = "chunk int, payload binary"
    chunks = map_batches(map_batches(texts, _counters(words), kind).repartition("chunk"), _summed, kind)
    table = np.zeros((1 << (RARITY_BITS - _CHUNK_BITS), 1 << _CHUNK_BITS), np.uint8)
    for row in chunks.collect():
        table[row["chunk"]] = np.frombuffer(row["payload"], np.uint8)
    return table.reshape(-1)


# Points ---------------------------------------------------------------------------------------------------------------------

_POINTS = "doc_id long, mark long, n long, k long, prefix array<long>, sketch binary"


def _points(words: int, num: int, den: int, rarity):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for part in slices(batches, "text"):
            sizes, keys, prefixes, sketches = [], [], [], []
            for grams in ngram_sets(part.column(1), words):
                n = len(grams)
                sizes.append(n)
                keys.append(set_key(grams))
                if keys[-1] in seen:
                    prefixes.append(grams[:0])  # a copy in the same task
                    sketches.append(None)
                    continue
                sketches.append(parity_sketch(grams))
                seen.add(keys[-1])
                level = rarity.value[(grams >> np.uint64(64 - RARITY_BITS)).astype(np.int64)]
                order = np.argsort(level.astype(np.uint64) << np.uint64(56) | grams >> np.uint64(8), kind="stable")
                least = -(-num * n // den)  # n-grams that a partner shares at least
                prefixes.append(grams[order[: n - least + 1]] if n else grams)
            flat = np.concatenate([np.zeros(0, np.uint64), *prefixes]).view(np.int64)
            ends = np.cumsum([0, *(len(p) for p in prefixes)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), lists, pa.array(sketches, pa.binary())],
                ["doc_id", "mark", "n", "k", "prefix", "sketch"],
            )

    return work


def _sets(words: int, wanted):
    """The sets of the points' first documents, as far as a filter of fixed size knows them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = (1 << FILTER_BITS) - 1
        for part in slices(batches, "text"):
            out = []
            ids = part.column(0).fill_null(0).to_pylist()
            for doc, grams in zip(ids, ngram_sets(part.column(1), words), strict=True):
                key = set_key(grams)
                table = wanted.value
                if len(grams) and table[(key ^ doc) & mask] and table[(key >> FILTER_BITS) & mask]:
                    out.append((key, grams.tobytes()))
            keys, sets = zip(*out, strict=True) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.binary())], ["k", "grams"])

    return work


def _filter(points: DataFrame) -> np.ndarray:
    """A table of 2**FILTER_BITS bits, set at two places for each point (``k, rep``); full, it would only let more through."""
    mask = (1 << FILTER_BITS) - 1
    one = F.col("k").bitwiseXOR(F.coalesce(F.col("rep"), F.lit(0))).bitwiseAND(F.lit(mask))
    two = F.shiftright("k", FILTER_BITS).bitwiseAND(F.lit(mask))
    places = points.select(F.explode(F.array(one, two)).alias("p"))
    words = places.groupBy(F.shiftright("p", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))).alias("bits")
    )
    table = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    found = words.toPandas()
    table[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
    return np.unpackbits(table.view(np.uint8), bitorder="little").astype(bool)


# Regions --------------------------------------------------------------------------------------------------------------------


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        shared, union = [], []
        for a, b in zip(col["grams"], col["pivot_grams"], strict=True):
            a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            shared.append(len(np.intersect1d(a, b, assume_unique=True)))
            union.append(len(a) + len(b) - shared[-1])
        arrays = [col["pk"], col["k"], pa.array(shared, pa.int64()), pa.array(union, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["pk", "k", "shared", "together"])


def _far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which pairs are farther apart than their ``limit`` for sure."""
    for batch in batches:
        col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        far = []
        numbers = (col[name].to_pylist() for name in ("n", "pn", "limit"))
        for a, b, n, m, limit in zip(col["sketch"], col["pivot_sketch"], *numbers, strict=True):
            differ = least_difference(a.as_buffer(), b.as_buffer())
            far.append(2 * differ > limit * (n + m + differ))
        yield pa.RecordBatch.from_arrays([col["pk"], col["k"], pa.array(far, pa.bool_())], ["pk", "k", "far"])


def _pairs_with(pairs: DataFrame, table: DataFrame, columns: tuple[str, ...], small: bool) -> DataFrame:
    """The pairs with columns of both points from ``table``; the pivot's are named pivot_..., its size pn.

    Only the side of few rows moves: ``small`` pairs, of a checked number, are broadcast, and of the pivots' rows only theirs are taken.
    """
    hint = F.broadcast if small else lambda df: df
    named = [F.col(c).alias("pn" if c == "n" else f"pivot_{c}") for c in columns]
    pivots = table.join(hint(pairs.select(F.col("pk").alias("k")).distinct()), "k", "left_semi")
    pivots = pivots.select(F.col("k").alias("pk"), *named)
    return table.select("k", *columns).join(hint(pairs), "k").join(pivots, "pk")


def _distances(pairs: DataFrame, points: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """``pk, k, linked, distance`` of the pairs of pivot and point (with their ``limit``); 1 for those that are farther apart."""
    small = pairs.count() <= BROADCAST_PAIRS
    sketched = _pairs_with(pairs, points, ("sketch", "n"), small)
    judged = written(map_batches(sketched, _far, "pk long, k long, far boolean"), "judged")
    both = _pairs_with(judged.where("NOT far").select("pk", "k"), sets, ("grams",), small)
    # A filter of points may let through two documents of one set.
    measured = map_batches(both, _common, "pk long, k long, shared long, together long").groupBy("pk", "k").agg(
        F.first("shared").alias("shared"), F.first("together").alias("together")
    )
    near = measured.select(
        "pk",
        "k",
        (den * F.col("shared") >= num * F.col("together")).alias("linked"),
        (1 - F.col("shared") / F.col("together")).alias("distance"),
    )
    return near.unionByName(judged.where("far").select("pk", "k", F.lit(False).alias("linked"), F.lit(1.0).alias("distance")))


def _low(num: int, den: int) -> Column:
    """Whether a member (its place ``p``, ``n`` n-grams) can be the partner of another with such a place."""
    return 2 * num * F.col("p") <= (den - num) * (F.col("n") - F.col("p"))


def _placed(cells: DataFrame, num: int, den: int) -> DataFrame:
    """The members whose place is low enough for the lowest one of their region."""
    lowest = cells.groupBy("region").agg(F.min("p").alias("lowest"), F.count("*").alias("m")).where("m > 1").drop("m")
    fits = num * (F.col("p") + F.col("lowest")) <= (den - num) * (F.col("n") - F.col("p"))
    return cells.join(lowest, "region").where(fits).drop("lowest")


def _of_members(cells: DataFrame, low: Column, *more: Column) -> DataFrame:
    """The regions of two members at least, a ``low`` one among them, with their aggregates ``more``.

    Of regions with the same members one stays, that of the rarest n-gram: all its members' places are the lowest.
    """
    sums = cells.groupBy("region").agg(
        F.count("*").alias("m"),
        F.bit_xor(F.xxhash64("k")).alias("x"),
        F.bit_xor(F.xxhash64("k", F.lit(1))).alias("y"),
        F.sum("p").alias("places"),
        F.max(low).alias("low"),
        *more,
    ).where("m > 1 AND low")
    rest = [c for c in sums.columns if c not in ("m", "x", "y", "places", "low")]
    return sums.groupBy("m", "x", "y").agg(F.min_by(F.struct(*rest), F.struct("places", "region")).alias("s")).select("s.*")


def _first_regions(entries: DataFrame, num: int, den: int) -> DataFrame:
    """``region, k, label, p, n`` for the n-grams and rings of sizes that hold two points at least; each point is its own label."""
    shared = written(_placed(entries, num, den).distinct(), "regions")
    ring = F.log(F.col("n")) / math.log(den / num)
    rings = F.sequence(F.floor(ring - _SLACK), F.floor(ring + 1 + _SLACK)) if num < den else F.array(F.col("n"))
    cells = shared.select(F.explode(rings).alias("ring"), "region", "k", "p", "n")
    cells = written(_placed(cells.select(F.xxhash64("region", "ring").alias("region"), "k", "p", "n"), num, den), "cells")
    open_ = _of_members(cells, _low(num, den))
    return written(cells.join(open_, "region").select("region", "k", F.col("k").alias("label"), "p", "n"), "entries")


def _relabelled(labels: DataFrame | None, found: DataFrame) -> DataFrame | None:
    """``k, label`` of all linked points after the links ``found`` (``a, b``); only links between different labels are looked at."""
    if labels is not None:
        for end in ("a", "b"):
            of = labels.select(F.col("k").alias(end), F.col("label").alias("_label"))
            found = found.join(of, end, "left").withColumn(end, F.coalesce("_label", end)).drop("_label")
    found = written(found.where("a <> b").select("a", "b").distinct(), "found")
    if found.isEmpty():
        return labels
    joined = written(components(found), "joined")
    if labels is None:
        return joined.select(F.col("node").alias("k"), "label")
    moved = joined.select(F.col("node").alias("label"), F.col("label").alias("to"))
    old = labels.join(moved, "label", "left").select("k", F.coalesce("to", "label").alias("label"))
    new = joined.select(F.col("node").alias("k"), "label").join(labels, "k", "left_anti")
    return written(old.unionByName(new), "labels")


def _mixed(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The members with their labels, of regions that hold more than one label."""
    if labels is None:
        return rows
    now = rows.drop("label").join(labels, "k", "left").withColumn("label", F.coalesce("label", "k"))
    open_ = now.groupBy("region").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("region")
    return written(now.join(open_, "region"), "mixed")


def _pivots(rows: DataFrame, number: int, low: Column) -> DataFrame:
    """``region, pk, number, last`` and the pivot's ``label, p, n``: low points, the lowest of as many labels as possible.

    ``last`` says that all low points of the region are pivots.
    """
    most = max(number, FEW)
    rows = rows.where(low)
    lows = rows.groupBy("region").agg((F.count("*") <= most).alias("last"))
    same = Window.partitionBy("region", "label").orderBy("p", "k")
    order = Window.partitionBy("region").orderBy("rank", "p", "k")
    ranked = rows.withColumn("rank", F.row_number().over(same)).where(F.col("rank") <= most)
    first = ranked.withColumn("number", F.row_number().over(order)).where(F.col("number") <= most)
    first = first.join(lows, "region").where(F.col("last") | (F.col("number") <= number))
    return written(
        first.select("region", F.col("k").alias("pk"), "number", "last", F.col("label").alias("pivot_label"), F.col("p").alias("pp"), F.col("n").alias("pn")),
        "pivots",
    )


def _pairs(rows: DataFrame, pivots: DataFrame, num: int, den: int, more: DataFrame | None) -> DataFrame:
    """``pk, k, limit``: pivots and members, and the distance up to which they have to be known.

    The members of regions that go on are measured with each pivot. Else only links matter: of one label there is nothing to
    find, two pivots are one pair, and places bound the n-grams in common. Of ``more`` pairs, too, only links matter.
    """
    eps = 1 - num / den
    is_pivot = pivots.select("region", F.col("pk").alias("k"), F.lit(True).alias("pivot"))
    both = rows.join(pivots, "region").where("k <> pk").join(is_pivot, ["region", "k"], "left").withColumn("pivot", F.coalesce("pivot", F.lit(False)))
    common = F.least(F.col("n") - F.col("p"), F.col("pn") - F.col("pp"))
    may_link = (den + num) * common >= num * (F.col("n") + F.col("pn"))
    once = ~F.col("pivot") | (F.col("pk") < F.col("k"))
    links_only = F.col("last") | F.col("pivot")
    asked = both.where(~links_only | (may_link & once & (F.col("label") != F.col("pivot_label"))))
    limit = F.when(links_only, F.lit(eps + 2 * _SLACK)).otherwise(F.lit(RADIUS + eps + 2 * _SLACK))
    asked = asked.select("pk", "k", limit.alias("limit"))
    if more is not None:
        asked = asked.unionByName(more.withColumn("limit", F.lit(eps + 2 * _SLACK)))
    return written(asked.groupBy("pk", "k").agg(F.max("limit").alias("limit")), "pairs")


def _by_cells(rows: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """``pk, k`` of the members that sizes and places let link, for the regions where those are few; and the rows of the other regions."""
    main = rows.groupBy("region", "label").agg(F.count("*").alias("c")).groupBy("region").agg(F.max_by("label", F.struct("c", "label")).alias("main"))
    # The largest size that a partner can have.
    reach = F.expr(f"({den + num} * (n - p) - {num} * n) div {num}")
    members = rows.join(main, "region").withColumn("in_main", F.col("label") == F.col("main")).withColumn("reach", reach)
    cell = ["region", "n", "reach", "in_main"]
    cells = members.groupBy(*cell).agg(F.count("*").alias("c"))
    few = cells.groupBy("region").agg(F.count("*").alias("cells"), F.sum("c").alias("m")).where(F.col("cells") <= CELLS)
    cells = written(cells.join(few, "region"), "kinds")
    other = cells.select("region", *(F.col(c).alias(f"{c}_2") for c in ("n", "reach", "in_main", "c")))
    both = cells.join(other, "region").where("n <= reach_2 AND n_2 <= reach AND NOT (in_main AND in_main_2)")
    least = F.struct("n", "reach", "in_main") <= F.struct("n_2", "reach_2", "in_main_2")
    both = written(both.where(least).drop("cells"), "kinds")
    # Regions without such cells end too.
    made = cells.groupBy("region").agg(F.first("m").alias("m")).join(both.groupBy("region").agg(F.sum(F.col("c") * F.col("c_2")).alias("made")), "region", "left")
    done = written(made.where(F.coalesce("made", F.lit(0)) <= FEW * F.col("m")).select("region"), "done")
    second = members.select("region", F.col("k").alias("pk"), F.col("label").alias("label_2"), *(F.col(c).alias(f"{c}_2") for c in ("n", "reach", "in_main")))
    found = (
        both.join(done, "region")
        .select("region", "n", "reach", "in_main", "n_2", "reach_2", "in_main_2")
        .join(members.select(*cell, "k", "label"), cell)
        .join(second, ["region", "n_2", "reach_2", "in_main_2"])
        .where("label <> label_2")
    )
    ends = (F.greatest("pk", "k").alias("pk"), F.least("pk", "k").alias("k"))
    return found.select(*ends).distinct(), rows.join(done, "region", "left_anti")


def _next_regions(rows: DataFrame, pivots: DataFrame, distances: DataFrame, num: int, den: int, level: int) -> DataFrame:
    """The members of the regions below those of ``pivots``; see the module's text."""
    eps = 1 - num / den
    label = rows.select("region", F.col("k").alias("pk"), F.col("label").alias("pivot_label"))
    of_pivots = pivots.select("region", "pk", "number").join(label, ["region", "pk"])
    measured = (
        rows.join(of_pivots, "region")
        .join(distances, ["pk", "k"])
        .select("region", "k", "label", "p", "n", "number", (F.col("label") == F.col("pivot_label")).alias("linked"), F.col("distance").alias("d"))
    )
    members = measured.groupBy("region", "k", "p", "n").agg(
        F.first("label").alias("label"),
        F.min(F.when(F.col("d") <= RADIUS, F.col("number"))).alias("own"),
        F.collect_list(F.when(F.col("d") <= RADIUS + eps + _SLACK, F.struct("number", "d", "linked"))).alias("near"),
    ).join(pivots.select("region", F.col("pk").alias("k")), ["region", "k"], "left_anti")
    # Its own region, and those of pivots before that which it is in the window of; the rest is region 0.
    inside = F.filter("near", lambda p: F.col("own").isNull() | (p["number"] <= F.col("own")))
    rest = F.array(F.struct(F.lit(0).alias("number"), F.lit(1.0).alias("d"), F.lit(False).alias("linked")))
    places = F.when(F.col("own").isNull(), F.concat(inside, rest)).otherwise(inside)
    cells = members.select("region", "k", "label", "p", "n", F.explode(places).alias("c")).select(
        F.xxhash64("region", F.lit(level), "c.number").alias("region"), "k", "label", "p", "n", "c.number", "c.d", "c.linked"
    )
    cells = written(_placed(cells, num, den), "cells")
    least = F.min(F.when(~F.col("linked"), F.col("d"))).alias("least")
    ends = (F.min("label").alias("a"), F.max("label").alias("b"))
    open_ = _of_members(cells, _low(num, den), least, *ends).where("a <> b AND least IS NOT NULL")
    kept = cells.join(open_.select("region", "least"), "region").where(
        (F.col("number") == 0) | ~F.col("linked") | (F.col("d") >= F.col("least") - eps - _SLACK)
    )
    return written(kept.select("region", "k", "label", "p", "n"), "entries")


def linked_labels(entries: DataFrame, points: DataFrame, texts: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """``k, label`` of the points that have a link: the least key of their component. Each link that is used is exact."""
    spark = points.sparkSession
    rows = _first_regions(entries, num, den)
    wanted = points.join(rows.select("k").distinct(), "k", "left_semi").select("k", "rep")
    bits = spark.sparkContext.broadcast(_filter(wanted))
    with small_batches(spark, TEXT_ROWS):
        sets = written(map_batches(texts, _sets(words, bits), "k long, grams binary"), "sets")
    labels, level, direct = None, 0, None
    while not rows.isEmpty() or direct is not None and not direct.isEmpty():
        pivots = _pivots(rows, MORE_PIVOTS**level, _low(num, den))
        pairs = _pairs(rows, pivots, num, den, direct)
        with small_batches(spark, PAIR_ROWS):
            distances = written(_distances(pairs, points, sets, num, den), "distances")
        labels = _relabelled(labels, distances.where("linked").select(F.col("pk").alias("a"), F.col("k").alias("b")))
        pivots = pivots.where("NOT last")
        rows = _mixed(rows.join(pivots.select("region").distinct(), "region", "left_semi"), labels)
        rows = _next_regions(rows, pivots, distances, num, den, level)
        direct, rows = _by_cells(rows, num, den)
        direct, rows = written(direct, "direct"), written(rows, "entries")
        level += 1
    return spark.createDataFrame([], "k long, label long") if labels is None else labels


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _grouped(docs: DataFrame, words: int, num: int, den: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows of ``docs`` with their ``mark`` (a hash of the text) and set key ``k``; the points; and the ``label`` of linked points."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text().alias("text"))
    with small_batches(spark, TEXT_ROWS):
        rarity = spark.sparkContext.broadcast(rarity_levels(rows.select("text"), words))
        marked = rows.withColumn("mark", F.xxhash64("text"))
        every = written(map_batches(marked, _points(words, num, den, rarity), _POINTS), "sets-of-documents")
    points = written(
        every.where("n > 0").groupBy("k").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch", True).alias("sketch")), "points"
    )
    entries = every.select(F.posexplode("prefix").alias("p", "region"), "k", "n")
    return every, points, linked_labels(entries, points, rows, words, num, den)


def jaccard_components(docs: DataFrame, words: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text``): ``doc_id, n_shingles, component_id``.

    Two documents are linked if ``den`` * |intersection| >= ``num`` * |union| of their sets of ``words`` consecutive words (runs of anything but
    ASCII white space, with A-Z lower-cased). ``component_id`` is the smallest doc_id that links reach, the own one included. Null,
    empty and white texts have an empty set and no links: their component is their own. Rows with a null id take part; they get the component of
    the others, or null. Repeated rows give a row each. Other columns are ignored. An empty table gives no rows.

    Sets and n-grams are told apart by 64 bits of hash.
    """
    every, points, label = _grouped(docs, words, num, den)
    own = points.select("k", "rep")
    least = own.join(label, "k").groupBy("label").agg(F.min("rep").alias("least"))
    own = own.join(label.join(least, "label"), "k", "left").select("k", F.coalesce("least", "rep").alias("rep"))
    own = written(own, "components")
    return every.select("doc_id", "n", "k").join(own, "k", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("rep", "doc_id").alias("component_id")
    )


def first_of_groups(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row of ``docs``, with all columns, of each component: that of the smallest id, and of one text if the id repeats with several.

    Rows are told apart by id and text: an id that repeats with a text of another component stays there. Rows that repeat both
    stay once. Rows without id stay, as they cannot be told apart, and so do texts without words.
    """
    every, _, label = _grouped(docs, words, num, den)
    rows = every.where("n > 0 AND doc_id IS NOT NULL").select("doc_id", "mark", "k").join(label, "k", "left")
    rows = rows.select("doc_id", "mark", F.coalesce("label", "k").alias("group"))
    first = rows.groupBy("group").agg(F.min(F.struct("doc_id", "mark")).alias("first"))
    others = rows.join(first, "group").where(F.struct("doc_id", "mark") != F.col("first"))
    others = others.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).distinct()
    same = (F.col("doc_id").cast("long") == F.col("_id")) & (F.xxhash64(_text()) == F.col("_mark"))
    kept = docs.join(others, same, "left_anti")
    named = kept.where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id", "text"])
    return named.unionByName(kept.where(F.col("doc_id").isNull()))
