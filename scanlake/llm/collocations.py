"""Collocations from a weighted de Bruijn graph of words.

The nodes are phrases of two words, an edge is a phrase of three: it leads from its first two words to its last two. Texts are cut into pieces and
pieces into words, per language.

1. A task builds the graph of its texts: edges with their counts. Shorter counts are not counted but derived: a node's count is
   what flows out of it, the weights of its edges, plus the pieces that end in it; a word's count is what flows out of its nodes plus the pieces
   of which it is the last word. Both corrections come from the ends of pieces alone.
2. The graphs are cut into shards by a hash of the phrase, with the words that a shard needs as a list beside the numbers, and
   shards are summed. A frequent phrase is one number of each task, so no phrase weighs more than another. Counts are of words
   themselves, not of hashes.
3. Phrases at or over the least count remain: a far smaller graph. Candidates, their parts and the longer phrases around them are joined in Spark.

``unary_paths`` compacts what remains of the graph: nodes with one edge in and one edge out become the inside of a longer phrase.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scanlake.llm.arrow import slices, text_bytes
from scanlake.llm.hashing import BASE, byte_values, mix, span_hashes, spans_of
from scanlake.llm.shared import small_batches, written

MIN_COUNT = 10
TOP = 2000
#: Share of a candidate's count, in hundredths, at which a longer candidate takes its place.
COVER = 50
NO_LANG = "und"
#: Characters of text whose phrases one task sums up.
SHARD_CHARS = 16_000_000
#: Beyond so many shards phrases are shuffled as single rows.
MOST_SHARDS = 2000
_BITS = 21  # of a word's number in a task's graph
_BLOCK = 1_200_000  # words of a graph, fewer than there are numbers

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)  # 0: of a word, 1: between words, 2: between pieces
_KIND[[9, 32]] = 1
_KIND[[*b".,;:!?", 10, 11, 12, 13]] = 2


def summed(codes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes in order, each with its total weight."""
    if not len(codes):
        return codes, weights
    order = np.argsort(codes)
    codes = codes[order]
    heads = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return codes[heads], np.add.reduceat(weights[order], heads)


def counted_codes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes in order, each with its number; ``codes`` is sorted in place."""
    codes.sort()
    heads = np.flatnonzero(np.concatenate((np.ones(min(1, len(codes)), bool), codes[1:] != codes[:-1])))
    return codes[heads], np.diff(heads, append=len(codes))


class Graph:
    """The graph of some texts."""

    def __init__(self):
        self.numbers: dict[int, int] = {}
        self.words: list[bytes] = []
        self.langs: list[str] = []
        self.blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, texts: pa.Array, langs: list[str]) -> Iterator[Graph]:
        """Takes texts in; yields itself where it is full, to be emptied."""
        data, offsets = text_bytes(texts)
        data = _LOWER[data]
        kind = _KIND[data]
        starts, ends = spans_of(kind == 0, offsets)
        if not len(starts):
            return
        text = np.searchsorted(offsets, starts, side="right") - 1
        seeds = {lang: int.from_bytes(blake2b(lang.encode(), digest_size=8).digest(), "little") for lang in set(langs)}
        hashes = mix(span_hashes(data, starts, ends, byte_values()) + np.array([seeds[x] for x in langs], np.uint64)[text])
        # A word begins a piece if it is its text's first or a mark stands between it and the word before.
        marks = np.concatenate(([0], np.cumsum(kind == 2)))
        begins = np.concatenate(([True], (marks[starts[1:]] != marks[ends[:-1]]) | (text[1:] != text[:-1])))
        for low in range(0, len(starts), _BLOCK):
            high = min(low + _BLOCK, len(starts))
            if self.size and self.size + high - low > _BLOCK:
                yield self
            # Two words more are seen, so that phrases that begin in the block are whole.
            seen = slice(low, min(high + 2, len(starts)))
            kinds, first, inverse = np.unique(hashes[seen], return_index=True, return_inverse=True)
            raw = data.tobytes() if low == 0 else raw
            codes = np.empty(len(kinds), np.int32)
            for k, (h, at) in enumerate(zip(kinds.tolist(), (first + low).tolist(), strict=True)):
                number = self.numbers.get(h)
                if number is None:
                    number = self.numbers[h] = len(self.words)
                    self.words.append(raw[starts[at] : ends[at]])
                    self.langs.append(langs[text[at]])
                codes[k] = number
            block_begins = begins[seen].copy()
            block_begins[0] = True  # what came before is in another block
            counted = np.arange(seen.start, seen.stop) < high
            self.blocks.append((codes[inverse], block_begins, counted))
            self.size += high - low

    def flows(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Codes and counts of words, nodes and edges: edges are counted, the others follow from them."""
        code, begins, counted = (np.concatenate(c) for c in zip(*self.blocks, strict=True))
        joined = np.concatenate((~begins[1:], [False, False, False]))  # the next word is of the same piece
        n = len(code)
        one, two = counted & joined[:n], counted & joined[:n] & joined[1 : n + 1]
        at = np.flatnonzero(two)
        whole = code[at].astype(np.int64)
        for step in (1, 2):
            whole <<= _BITS
            whole |= code[at + step]
        edges = counted_codes(whole)
        del whole
        at = np.flatnonzero(one & ~two)  # pieces that end behind these two words
        ends = (code[at].astype(np.int64) << _BITS) | code[at + 1]
        nodes = summed(np.concatenate((edges[0] >> _BITS, ends)), np.concatenate((edges[1], np.ones(len(at), np.int64))))
        ends = code[counted & ~one].astype(np.int64)
        words = summed(np.concatenate((nodes[0] >> _BITS, ends)), np.concatenate((nodes[1], np.ones(len(ends), np.int64))))
        return [words, nodes, edges]

    def shards(self, number: int) -> Iterator[tuple]:
        """Per shard: its words, their languages, and for each length the words' numbers (all first ones, all second ones ...) and counts."""
        by_number = np.fromiter(self.numbers.keys(), np.uint64, len(self.numbers))  # numbers are given in this order
        parts = []
        for k, (codes, counts) in enumerate(self.flows(), 1):
            columns = [((codes >> (_BITS * (k - 1 - j))) & ((1 << _BITS) - 1)).astype(np.int32) for j in range(k)]
            total = np.zeros(len(codes), np.uint64)
            for column in columns:
                total = total * np.uint64(BASE) + by_number[column]
            shard = (mix(total) % np.uint64(number)).astype(np.int32)
            del total, codes
            order = np.argsort(shard, kind="stable")
            borders = np.searchsorted(shard[order], np.arange(number + 1))
            parts.append(([c[order] for c in columns], counts[order].astype(np.uint32), borders))
        names = np.array([*self.words, None], object)[:-1]
        langs = np.array([*self.langs, None], object)[:-1]
        for s in range(number):
            cut = [([c[b[s] : b[s + 1]] for c in columns], counts[b[s] : b[s + 1]]) for columns, counts, b in parts]
            if not any(len(counts) for _, counts in cut):
                continue
            used, local = np.unique(np.concatenate([c for columns, _ in cut for c in columns]), return_inverse=True)
            local = local.astype(np.uint16 if len(used) <= 1 << 16 else np.uint32)
            sizes = np.cumsum([k * len(counts) for k, (_, counts) in enumerate(cut, 1)])
            grams = np.split(local, sizes[:-1])
            yield s, names[used], langs[used], grams, [counts for _, counts in cut]


_LENGTHS = (1, 2, 3)
_SHARDS = "shard int, graph binary"
_SMALL = pa.ipc.IpcWriteOptions(compression="zstd")


def packed(words: list[bytes], langs: list[str], grams: list[np.ndarray], counts: list[np.ndarray]) -> bytes:
    """A shard of a graph as compressed Arrow bytes: one row of lists."""
    columns = {"words": pa.array(words, pa.binary()).cast(pa.string()), "langs": pa.array(langs, pa.string()).dictionary_encode()}
    for k, g, c in zip(_LENGTHS, grams, counts, strict=True):
        columns |= {f"g{k}": pa.array(g), f"c{k}": pa.array(c)}
    lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in columns.values()]
    batch = pa.RecordBatch.from_arrays(lists, list(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=_SMALL) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(blob: bytes) -> dict[str, pa.Array]:
    with pa.ipc.open_stream(blob) as reader:
        batch = reader.read_next_batch()
    found = {name: batch.column(i).flatten() for i, name in enumerate(batch.schema.names)}
    return found | {"langs": found["langs"].dictionary_decode()}


def _graphs(out):
    """Runs ``out`` on the graphs of a task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = Graph()
        for batch in slices(batches, "text", 1 << 20):
            for full in graph.add(batch.column(1), batch.column(0).to_pylist()):
                yield from out(full)
                full.__init__()
        if graph.size:
            yield from out(graph)

    return work


def _shards(number: int):
    def out(graph: Graph) -> Iterator[pa.RecordBatch]:
        for shard, words, langs, grams, counts in graph.shards(number):
            row = [pa.array([shard], pa.int32()), pa.array([packed(list(words), list(langs), grams, counts)], pa.binary())]
            yield pa.RecordBatch.from_arrays(row, ["shard", "graph"])

    return _graphs(out)


def _phrases(graph: Graph) -> Iterator[pa.RecordBatch]:
    """Each phrase of a graph as a row of its own."""
    words, langs = pa.array(graph.words, pa.binary()).cast(pa.string()), pa.array(graph.langs, pa.string())
    for k, (codes, counts) in enumerate(graph.flows(), 1):
        for low in range(0, len(codes), 1 << 16):
            part = codes[low : low + (1 << 16)]
            at = np.stack([(part >> (_BITS * (k - 1 - j))) & ((1 << _BITS) - 1) for j in range(k)], axis=1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * k), words.take(pa.array(at.ravel())))
            size = pa.array(np.full(len(part), k, np.int32))
            yield pa.RecordBatch.from_arrays(
                [langs.take(pa.array(at[:, 0])), size, lists, pa.array(counts[low : low + (1 << 16)])], ["lang", "size", "words", "f"]
            )


_COUNTS = "lang string, size int, words array<string>, f long"


def _sums(least: int, wide: int = 63):
    """Counts of a shard's phrases, those of ``least`` or more; rows of size 0 hold all words of a language, as far as the shard has them.

    A phrase is one number of at most ``wide`` bits; where its words need more, all but the last are numbered anew.
    """

    def rows(langs, size, words, counts) -> pa.RecordBatch:
        size = pa.array(np.full(len(counts), size, np.int32))
        return pa.RecordBatch.from_arrays([langs, size, words, pa.array(counts)], ["lang", "size", "words", "f"])

    def shard_counts(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        keys, parts = [], []
        while blobs:
            graph = unpacked(blobs.pop())
            keys.append(pc.binary_join_element_wise(graph["langs"], graph["words"], "\t"))
            parts.append([(graph[f"g{k}"].to_numpy(), graph[f"c{k}"].to_numpy()) for k in _LENGTHS])
        begins = np.concatenate(([0], np.cumsum([len(x) for x in keys])))
        coded = pa.chunked_array(keys).combine_chunks().dictionary_encode()
        del keys
        number = coded.indices.to_numpy()
        # A word has no tab, so the last one ends the language.
        pairs = pc.split_pattern(coded.dictionary, "\t", max_splits=1, reverse=True).flatten()
        langs, words = pairs.take(pa.array(np.arange(0, len(pairs), 2))), pairs.take(pa.array(np.arange(1, len(pairs), 2)))
        bits = max(1, int(len(langs) - 1).bit_length())
        for k in _LENGTHS:
            grams = [p[k - 1][0] for p in parts]
            counts = np.concatenate([p[k - 1][1] for p in parts]).astype(np.int64)
            kinds, code = [], None  # codes of all words but the last, in order, where a number can't hold them
            for j in range(k):
                cuts = [number[g[j * (len(g) // k) : (j + 1) * (len(g) // k)] + b] for g, b in zip(grams, begins, strict=False)]
                column = np.concatenate(cuts).astype(np.int64)
                if code is None:
                    code = column
                    continue
                if k * bits > wide:
                    before, code = np.unique(code, return_inverse=True)
                    kinds.append(before)
                code = code << bits | column
            code, totals = summed(code, counts)
            del counts
            if k == 1 and len(code):
                by_lang = pa.table({"l": langs.take(pa.array(code)), "f": totals}).group_by("l").aggregate([("f", "sum")])
                none = pa.array([None] * len(by_lang), pa.list_(pa.string()))
                yield rows(by_lang["l"].combine_chunks(), 0, none, by_lang["f_sum"].to_numpy())
            often = totals >= least
            code, totals = code[often], totals[often]
            columns = []
            for _ in range(k - 1):
                columns.append(code & ((1 << bits) - 1))
                code = code >> bits
                code = kinds.pop()[code] if kinds else code
            columns.append(code)
            at = np.stack(columns[::-1], axis=1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * k), words.take(pa.array(at.ravel())))
            yield rows(langs.take(pa.array(at[:, 0])), k, lists, totals)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            for shard, graph in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and shard != last:
                    yield from shard_counts(held)
                    held = []
                last = shard
                held.append(graph)
        if held:
            yield from shard_counts(held)

    return work


def phrase_counts(
    docs: DataFrame, min_count: int = MIN_COUNT, shard_chars: int = SHARD_CHARS, most_shards: int = MOST_SHARDS
) -> DataFrame:
    """``lang, size, words, f`` for all phrases of one to three words with ``f >= min_count`` in ``docs`` (``text, lang``), and per
    language rows of size 0 (words null) whose ``f`` add up to the number of all its words. Written to the shared folder.

    A null language is ``und``. A null or empty text has no words. The counts are the same for every ``shard_chars`` and ``most_shards``.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    # As many shards as the texts ask for, so that a task's share stays the same at any size.
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    number = -(-chars // shard_chars) or 1
    if number > most_shards:
        # A graph would be cut into crumbs: its phrases go their own ways.
        every = texts.mapInArrow(_graphs(_phrases), _COUNTS).groupBy("lang", "size", "words").agg(F.sum("f").alias("f"))
        words = every.where("size = 1").groupBy("lang").agg(F.sum("f").alias("f"))
        total = words.select("lang", F.lit(0).alias("size"), F.lit(None).cast("array<string>").alias("words"), "f")
        return written(every.where(F.col("f") >= min_count).unionByName(total), "phrases")
    shards = texts.mapInArrow(_shards(number), _SHARDS).repartitionById(number, "shard").sortWithinPartitions("shard")
    with small_batches(docs.sparkSession, 256):  # of texts, and of graphs of many kilobytes
        return written(shards.mapInArrow(_sums(min_count), _COUNTS), "phrases")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, cover: int = COVER) -> DataFrame:
    """Per language of ``docs`` (``text, lang``) its first ``top`` phrases of two or three words: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased (A-Z). ``a`` is the count of the phrase, ``l`` and ``r`` those of its parts at the cut with the lowest score (then the
    leftmost), ``n`` the number of the language's words, and the score is floor(1000000 * a * a / (l * r)), exact to 38 digits. A phrase of two words is left
    out if one of three that holds it has ``cover`` hundredths of its count. Ranks go by score, then count, then the phrase's bytes. Copies
    count as often as they occur; other columns are ignored; without phrases of ``min_count`` there are no rows.
    """
    counts = phrase_counts(docs, min_count)
    phrases = counts.where("size > 0").select("lang", "size", "words", F.array_join("words", " ").alias("phrase"), "f")
    candidates = phrases.where("size > 1")
    edge = candidates.where("size = 3")
    longer = edge.select("lang", F.explode(F.array(F.slice("words", 1, 2), F.slice("words", 2, 2))).alias("w"), "f")
    longer = longer.groupBy("lang", F.array_join("w", " ").alias("phrase")).agg(F.max("f").alias("longer"))
    kept = candidates.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < cover * F.col("f")))
    cuts = kept.select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")), " ").alias("right"),
    )
    part = phrases.where("size < 3")
    scored = cuts.join(part.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"]).join(
        part.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"]
    )
    whole = "decimal(38, 0)"
    score = F.expr(f"cast(1000000 as {whole}) * a * a div (cast(l as {whole}) * r)")
    least = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = scored.groupBy("lang", "phrase", "a").agg(least).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    total = counts.where("size = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    return first.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def unary_paths(counts: DataFrame) -> DataFrame:
    """The graph of ``phrase_counts`` with its unary paths compacted: ``lang, words, edges, least, most``.

    A node with one edge in and one edge out joins the two; a path runs from an end or a branch to the next, and stands for the phrase of
    all its words. ``least`` and ``most`` are the weights of its weakest and strongest edge. A closed ring of such nodes has no end: its edges
    stay single. Each edge follows pointers that double in reach every round, so rounds grow with the logarithm of the longest path; rounds are written
    to the shared folder.
    """
    edges = counts.where("size = 3").select(
        "lang", F.array_join("words", " ").alias("edge"), "words", "f",
        F.array_join(F.slice("words", 1, 2), " ").alias("head"), F.array_join(F.slice("words", 2, 2), " ").alias("tail"),
    )
    leaving = edges.groupBy("lang", F.col("head").alias("node")).agg(F.count("*").alias("n"), F.min("edge").alias("next"))
    coming = edges.groupBy("lang", F.col("tail").alias("node")).agg(F.count("*").alias("m"))
    unary = leaving.where("n = 1").join(coming.where("m = 1"), ["lang", "node"]).select("lang", F.col("node").alias("tail"), "next")
    reach = edges.join(unary, ["lang", "tail"], "left").select("lang", "edge", F.col("next").alias("to"), F.lit(1).alias("steps"))
    reach = written(reach.select("lang", "edge", F.coalesce("to", "edge").alias("to"), F.when(F.col("to").isNull(), 0).otherwise(1).cast("long").alias("steps")), "reach")
    limit, rounds = max(2, reach.count()), 0
    while True:
        hop = reach.select("lang", F.col("edge").alias("to"), F.col("to").alias("then"), F.col("steps").alias("more"))
        moved = reach.join(hop, ["lang", "to"])
        moved = moved.select("lang", "edge", F.col("then").alias("to"), (F.col("steps") + F.col("more")).alias("steps"), (F.col("more") > 0).alias("moved"))
        moved = written(moved, "reach")
        reach, rounds = moved.drop("moved"), rounds + 1
        # After so many rounds only rings still move; theirs are reset to single edges.
        if not moved.where("moved").limit(1).count() or 1 << rounds - 1 > limit:
            break
    ring = F.col("moved")
    ends = moved.select("lang", "edge", F.when(ring, F.col("edge")).otherwise(F.col("to")).alias("to"), F.when(ring, 0).otherwise(F.col("steps")).alias("steps"))
    rows = ends.join(edges.select("lang", "edge", "words", "f"), ["lang", "edge"])
    paths = rows.groupBy("lang", "to").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("steps")).alias("at"), "words"))).alias("way"),
        F.count("*").alias("edges"), F.min("f").alias("least"), F.max("f").alias("most"),
    )
    tail = F.transform("way", lambda e: e.words[2])
    return paths.select("lang", F.concat(F.slice(F.col("way")[0]["words"], 1, 2), tail).alias("words"), "edges", "least", "most")
