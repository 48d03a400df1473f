"""Benchmark decontamination by templates.

Texts become templates: numbers, units after a number and names (capitalised words inside a sentence) turn into typed placeholders,
other words are lower-cased. Names of several words, and numbers whose thousands are set apart by spaces, are read
both as that many slots and as one. A capitalised word that opens a sentence may be a name or not, so windows that hold one have two templates. Scripts that set no spaces between words
are cut into characters. Windows of consecutive template tokens, and of the plain lower-cased words, are hash-joined between documents and items.
Matches of one document, one item and one distance between their positions form an alignment. It counts if it covers enough tokens
with the benchmark's own words, whatever their case, position or share of slots, or if it covers enough tokens and its slots are consistent: equal benchmark values stand for equal
document values, and different names for different names. So an item is found verbatim and with other numbers, names or units.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlake.llm.arrow import map_batches, slices, text_bytes
from scanlake.llm.hashing import BASE, mix, powers, sequence_hashes, span_hashes, spans_of

#: Tokens of a window, literal tokens that it needs, and tokens that an alignment must cover.
WINDOW = 8
LITERALS = 4
COVER = 13
#: So many characters of a script without spaces count as one word.
CHARACTERS = 3

# Names of units, as they stand after a number.
UNITS = frozenset(
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms tonne tonnes ton tons lb lbs "
    "pound pounds oz ounce ounces ml l liter liters litre litres gallon gallons second seconds sec minute minutes min hour hours h day "
    "days week weeks month months year years dollar dollars cent cents euro euros usd eur percent degree degrees celsius fahrenheit "
    "kelvin meter meters metre metres kilometer kilometers kilometre kilometres centimeter centimeters joule joules watt watts kw "
    "volt volts hz mph kmh".split()
)

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_POINT = np.zeros(256, bool)
_POINT[[44, 46]] = True
_BREAK = np.zeros(256, np.int32)
_BREAK[[ord(c) for c in ".!?:;\n\r|"]] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _lower_letters() -> np.ndarray:
    """The lower-case letter of each code point up to U+FFFF whose UTF-8 is as long; a final sigma counts as sigma."""
    out = np.arange(1 << 16)
    for c in range(128, 1 << 16):
        small = chr(c).lower()
        if len(small) == 1 and ord(small) >= 128 and (ord(small) < 2048) == (c < 2048):
            out[c] = ord(small)
    out[0x3C2] = 0x3C3
    return out


_LOWER_LETTERS = _lower_letters()
_CAPITAL_LETTERS = _LOWER_LETTERS != np.arange(1 << 16)
_CAPITAL_LETTERS[0x3C2] = False
#: Bytes of a letter after its first one.
_MORE = np.zeros(256, np.int64)
_MORE[0xC2:0xE0], _MORE[0xE0:0xF0], _MORE[0xF0:] = 1, 2, 3

_HASH_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
_NUMBER, _UNIT, _NAME = (mix(np.array([k], np.uint64))[0] for k in (11, 12, 13))


# Code points. Scripts without spaces (Thai, Lao, Burmese, Khmer, kana, Han), their punctuation, and their sentence ends.
_SPACELESS = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x9FFF), (0xF900, 0xFAFF))
_MARKS = ((0x3000, 0x3004), (0x3008, 0x303F), (0x30FB, 0x30FB), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65))
_ENDS = (0x3002, 0xFF01, 0xFF1A, 0xFF1B, 0xFF1F, 0xFF61)
_IN_SPACELESS, _IS_MARK, _IS_END = (np.zeros(1 << 16, bool) for _ in range(3))
for _table, _ranges in ((_IN_SPACELESS, _SPACELESS), (_IS_MARK, _MARKS), (_IS_END, [(c, c) for c in _ENDS])):
    for _low, _high in _ranges:
        _table[_low : _high + 1] = True
_IN_SPACELESS[_IS_MARK] = False
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _hash_words(words) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends = spans_of(data != 32, np.array([0]))
    return np.sort(span_hashes(data, starts, ends, _HASH_TABLE))


#: Type of a name slot.
_IS_NAME = 1

#: Templates: 0 has opening words as literals and 1 as names; MERGED and MERGED + 1 are the same with runs as one slot; PLAIN has the words.
PLAIN = 2
MERGED = 3
_PLAIN = np.uint64(0x5851F42D4C957F2D)

_UNIT_HASHES = _hash_words(sorted(UNITS))


def _shifted(x: np.ndarray, by: int) -> np.ndarray:
    """x moved by one place; False where nothing moves in."""
    out = np.zeros_like(x)
    if by > 0:
        out[by:] = x[:-by]
    else:
        out[:by] = x[-by:]
    return out


def lower_case(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 in lower case, and where capitals start."""
    lowered = _LOWER[data]
    capital = (data >= 65) & (data <= 90)
    for width, low, high in ((2, 0xC3, 0xE0), (3, 0xE0, 0xF0)):
        at = np.flatnonzero((data >= low) & (data < high))
        at = at[at + width <= len(data)]
        code = data[at].astype(np.int64) & (0x1F if width == 2 else 0x0F)
        for k in range(1, width):
            code = code << 6 | data[at + k] & 0x3F
        changed = np.flatnonzero(_LOWER_LETTERS[code] != code)
        at, code = at[changed], code[changed]
        capital[at] = _CAPITAL_LETTERS[code]
        small = _LOWER_LETTERS[code]
        for k in range(width - 1, 0, -1):
            lowered[at + k] = 0x80 | small & 0x3F
            small = small >> 6
        lowered[at] = (0xC0 if width == 2 else 0xE0) | small
    return lowered, capital


def _wide_letters(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Starts and widths of the characters of scripts without spaces; starts of their punctuation and of its sentence ends."""
    at = np.flatnonzero((data >= 0xE0) & (data < 0xF0))
    at = at[at + 2 < len(data)]
    code = (data[at].astype(np.int64) & 0x0F) << 12 | (data[at + 1].astype(np.int64) & 0x3F) << 6 | data[at + 2] & 0x3F
    rare = np.flatnonzero(data == 0xF0)
    rare = rare[rare + 3 < len(data)]
    # Han beyond U+FFFF: U+20000 to U+33FFF.
    rare = rare[(data[rare + 1] >= 0xA0) & (data[rare + 1] < 0xB4)]
    single = at[_IN_SPACELESS[code]]
    widths = np.repeat(np.array([3, 4]), [len(single), len(rare)])
    return np.concatenate((single, rare)), widths, at[_IS_MARK[code]], at[_IS_END[code]]


class Templates:
    """The words of some texts and their templates.

    ``word``: hash of each lower-cased word, ``owner``: its text's number, ``sizes``: words of each text, ``single``: characters of
    scripts without spaces, ``in_run``: words of a run of names or of groups of digits. Each template has ``token``, the word or its
    placeholder, ``literal``, ``kind`` and ``value``. ``place`` numbers the tokens of template MERGED + 1 in each text; what lies
    inside one of them has its number.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        digit = _DIGIT[data]
        inside = _LETTER[data] | digit
        inside |= _POINT[data] & _shifted(digit, 1) & _shifted(digit, -1)
        # Punctuation outside ASCII: U+0080-00BF and U+2000-203F.
        two = data == 0xC2
        three = (data == 0xE2) & _shifted(data == 0x80, -1)
        inside &= ~(two | _shifted(two, 1) | three | _shifted(three, 1) | _shifted(three, 2))
        singles, widths, marks, ends_of = _wide_letters(data)
        for k in range(3):
            inside[marks + k] = False
        breaking = _BREAK[data]
        breaking[ends_of] = 1
        starts, ends = spans_of(inside, np.concatenate((offsets, singles, singles + widths)))
        lowered, capital = lower_case(data)
        self.word = span_hashes(lowered, starts, ends, _HASH_TABLE)
        self.owner = np.searchsorted(offsets, starts, side="right") - 1
        n = len(starts)
        alone = np.zeros(len(data) + 1, bool)
        alone[singles] = True
        self.single = alone[starts]
        first = np.ones(n, bool)
        first[1:] = self.owner[1:] != self.owner[:-1]
        breaks = np.concatenate((np.zeros(1, np.int32), np.cumsum(breaking, dtype=np.int32)))
        opening = first.copy()
        if n > 1:
            opening[1:] |= breaks[starts[1:]] > breaks[ends[:-1]]
        self.opening = opening
        # The letter after the first: words in capitals only are no names.
        second = np.minimum(starts + 1 + _MORE[data[starts]], len(data) - 1) if n else starts
        name = capital[starts] & (second < ends) & ~capital[second]
        number = digit[starts]
        after = np.zeros(n, bool)
        after[1:] = number[:-1] & ~first[1:]
        unit = after & ~number
        at = np.flatnonzero(unit)
        unit[at] = np.isin(self.word[at], _UNIT_HASHES)
        name &= ~unit
        self._templates(name, opening, number, unit, *self._runs(data, starts, ends, name, number, opening))
        self.first = np.searchsorted(self.owner, np.arange(len(offsets) - 1))
        self.sizes = np.bincount(self.owner, minlength=len(offsets) - 1)
        self.singles = np.bincount(self.owner[self.single], minlength=len(offsets) - 1)
        self.counts = {t: np.bincount(self.owner[w], minlength=len(offsets) - 1) for t, w in self.starts.items()}
        self.place -= self.place[self.first[self.owner]]

    @staticmethod
    def _runs(data, starts, ends, name, number, opening) -> tuple[np.ndarray, np.ndarray]:
        """Words that go on a name, and groups of three digits that go on a number, after the word before."""
        n = len(starts)
        names, groups = np.zeros(n, bool), np.zeros(n, bool)
        if n < 2:
            return names, groups
        blank = _BLANK[data]
        # Spaces outside ASCII: U+00A0, U+2009 and U+202F.
        hard = (data == 0xC2) & _shifted(data == 0xA0, -1)
        thin = (data == 0xE2) & _shifted(data == 0x80, -1) & _shifted(_shifted((data == 0x89) | (data == 0xAF), -1), -1)
        blank |= hard | _shifted(hard, 1) | thin | _shifted(thin, 1) | _shifted(_shifted(thin, 1), 1)
        solid = np.concatenate((np.zeros(1, np.int64), np.cumsum(~blank)))
        gap = starts[1:] - ends[:-1]
        follows = ~opening[1:] & (solid[starts[1:]] == solid[ends[:-1]]) & (gap > 0)
        names[1:] = name[1:] & name[:-1] & follows
        sizes = ends - starts
        points = np.concatenate((np.zeros(1, np.int64), np.cumsum(_POINT[data])))
        digits = number & (points[ends] == points[starts])
        # Three digits, then the end or a fraction.
        fraction = number & (sizes > 4)
        fraction &= _POINT[data[np.minimum(starts + 3, len(data) - 1)]] & (points[np.minimum(starts + 3, len(data))] == points[starts])
        three = (digits & (sizes == 3)) | fraction
        one = (gap == 1) | (data[np.minimum(ends[:-1], len(data) - 1)] >= 128) & (gap <= 3)
        groups[1:] = three[1:] & digits[:-1] & (sizes[:-1] <= 3) & follows & one
        return names, groups

    def _templates(self, name, opening, number, unit, more_name, more_digits) -> None:
        n = len(name)
        self.starts, self.ends, self.token, self.literal, self.kind, self.value, self.opens = {}, {}, {}, {}, {}, {}, {}
        for template in (0, 1, MERGED, MERGED + 1):
            names = name if template in (1, MERGED + 1) else name & ~opening
            goes_on = np.zeros(n, bool)
            if template >= MERGED and n:
                goes_on = more_name & _shifted(names, 1) | more_digits
            at = np.flatnonzero(~goes_on)
            sizes = np.diff(np.append(at, n))
            value = self.word[at]
            if template >= MERGED and n:
                inner = np.arange(n) - np.repeat(at, sizes)
                value = np.where(sizes == 1, value, mix(np.add.reduceat(self.word * powers(n, BASE)[inner], at)))
            token = self.word[at]
            token[names[at]] = _NAME
            token[unit[at]] = _UNIT
            token[number[at]] = _NUMBER
            self.starts[template], self.ends[template] = at, at + sizes
            self.token[template], self.value[template] = token, value
            self.literal[template] = ~(names | unit | number)[at]
            kinds = [np.uint64(2), np.uint64(3), np.uint64(_IS_NAME)]
            self.kind[template] = np.select([number[at], unit[at], names[at]], kinds, np.uint64(0))
            self.opens[template] = (name & opening)[at]
        self.place = np.cumsum(~goes_on) - 1
        self.in_run = goes_on.copy()
        self.in_run[:-1] |= goes_on[1:]

    def windows(self, length: int, template: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the windows of ``length`` tokens inside one text, with enough literal tokens.

        Only those that differ from the windows of templates before: they hold an opening name, or a run of words.
        """
        hashes = sequence_hashes(self.token[template], length)
        if not len(hashes):
            return np.zeros(0, np.int64), hashes
        literals = np.concatenate(([0], np.cumsum(self.literal[template])))
        n = len(hashes)
        owner = self.owner[self.starts[template]]
        usable = owner[:n] == owner[length - 1 :]
        usable &= literals[length:] - literals[:n] >= min(LITERALS, length)
        if template in (1, MERGED + 1):
            opens = np.concatenate(([0], np.cumsum(self.opens[template])))
            usable &= opens[length:] > opens[:n]
        at = np.flatnonzero(usable)
        if template >= MERGED:
            at = at[self.holds_run(*self.words_of(at, length, template))]
        return at, hashes[at] ^ np.uint64(length)

    def holds_run(self, start: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Whether some of the words belong to a run."""
        runs = np.concatenate(([0], np.cumsum(self.in_run)))
        return runs[last + 1] > runs[start]

    def plain_windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of all windows of ``length`` words inside one text; fewer than LITERALS must be a whole sentence."""
        hashes = sequence_hashes(self.word, length)
        usable = self.owner[: len(hashes)] == self.owner[length - 1 :][: len(hashes)]
        if length < LITERALS:
            usable &= self.opening[: len(hashes)] & np.append(self.opening, True)[length:][: len(hashes)]
        at = np.flatnonzero(usable)
        return at, mix(hashes[at] ^ np.uint64(length) ^ _PLAIN)

    def words_of(self, at: np.ndarray, length: int, template: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last word of the windows of ``length`` tokens or, for PLAIN, words."""
        if template == PLAIN:
            return at, at + length - 1
        return self.starts[template][at], self.ends[template][at + length - 1] - 1

    def slots(self, start: int, length: int, template: int = 0) -> list[int]:
        """The values of a window's placeholders, in order; the last two bits tell the type. PLAIN: those of template 0 there."""
        low, high = start, start + length
        template = 0 if template == PLAIN else template
        at = np.flatnonzero(~self.literal[template][low:high]) + low
        return (self.value[template][at] & ~np.uint64(3) | self.kind[template][at]).astype(np.int64).tolist()


_WINDOWS = (
    "key long, position int, place int, span int, hash long, size int, tokens int, places int, singles int, template int, "
    "in_words boolean, in_places boolean, slots array<long>"
)


def _windows(rows: DataFrame, lengths: tuple[int, ...] | None, wanted=None) -> DataFrame:
    """Windows of the texts (``key, text``). ``lengths`` None: of WINDOW tokens, or of the whole text if it has fewer.

    ``position`` counts words, ``place`` and ``span`` count tokens of template MERGED + 1. A window takes part in alignments by words
    unless it is merged, and in those by places unless it should be merged.
    ``wanted``: a broadcast table of hash prefixes; windows it does not have are left out.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            data, offsets = text_bytes(part.column(1))
            keys = part.column(0).to_numpy(zero_copy_only=False)
            found = Templates(data, offsets)
            names = ("key", "position", "place", "span", "hash", "size", "tokens", "places", "singles", "template", "in_words", "in_places", "slots")
            out = {name: [] for name in names}
            for length, template in product(lengths or range(WINDOW, 0, -1), (0, 1, PLAIN, MERGED, MERGED + 1)):
                if length < LITERALS and template != PLAIN:
                    continue
                at, hashes = found.plain_windows(length) if template == PLAIN else found.windows(length, template)
                start, last = found.words_of(at, length, template)
                if lengths is None and length < WINDOW:
                    sizes = found.sizes if template == PLAIN else found.counts[template]
                    whole = sizes[found.owner[start]] == length
                    at, hashes, start, last = at[whole], hashes[whole], start[whole], last[whole]
                if wanted is not None:
                    table = wanted.value
                    shift = np.uint64(64 - (len(table).bit_length() - 1))
                    known = table[(hashes >> shift).astype(np.int64)]
                    at, hashes, start, last = at[known], hashes[known], start[known], last[known]
                owner = found.owner[start]
                whole_numbers = {
                    "position": start - found.first[owner], "place": found.place[start], "span": found.place[last] - found.place[start] + 1,
                    "size": np.full(len(at), length), "tokens": found.sizes[owner], "places": found.counts[MERGED + 1][owner],
                    "singles": found.singles[owner], "template": np.full(len(at), template),
                }
                for name, numbers in whole_numbers.items():
                    out[name].append(numbers.astype(np.int32))
                out["key"].append(keys[owner])
                out["hash"].append(hashes.view(np.int64))
                out["in_words"].append(np.full(len(at), template < MERGED))
                out["in_places"].append(np.full(len(at), True) if template >= PLAIN else ~found.holds_run(start, last))
                out["slots"] += [found.slots(i, length, template) for i in at]
            arrays = [pa.array(np.concatenate(out[c])) for c in names[:-1]]
            arrays.append(pa.array(out["slots"], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(arrays, list(names))

    return map_batches(rows, work, _WINDOWS)


#: The largest table of hash prefixes that is broadcast: one byte an entry.
TABLE_BITS = 24


def _prefixes(spark, hashes: DataFrame):
    """A broadcast table of the benchmark's hash prefixes; its size is bounded, and a full table only filters less."""
    number = hashes.count()
    bits = min(TABLE_BITS, max(16, (512 * max(1, number) - 1).bit_length()))
    # Distinct prefixes: at most as many as the table has entries.
    prefix = F.shiftrightunsigned(F.col("hash"), 64 - bits)
    table = np.zeros(1 << bits, bool)
    if number:
        table[hashes.select(prefix.alias("p")).distinct().toPandas()["p"].to_numpy(np.int64)] = True
    return spark.sparkContext.broadcast(table)


def _covered(runs):
    """How many tokens the windows (position, size) cover together."""
    return F.aggregate(
        F.sort_array(runs),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda s, r: F.struct(
            (s["n"] + F.greatest(F.lit(0), r["position"] + r["size"] - F.greatest(s["end"], r["position"]))).alias("n"),
            F.greatest(s["end"], r["position"] + r["size"]).alias("end"),
        ),
        lambda s: s["n"],
    )


def _consistent(pairs: str):
    """Whether equal benchmark values stand for equal document values, and different names for different names."""
    names = F.filter(pairs, lambda p: p["slots"].bitwiseAND(F.lit(3)) == _IS_NAME)
    return (F.size(pairs) == F.size(F.array_distinct(F.col(pairs)["slots"]))) & (
        F.size(names) == F.size(F.array_distinct(F.transform(names, lambda p: p["values"])))
    )


def find_contamination(docs: DataFrame, benchmark: DataFrame, cover: int = COVER) -> DataFrame:
    """One row per contaminated document and item: ``doc_id, item_id, n_tokens, item_tokens, position, n_slots``.

    ``n_tokens`` of the item's ``item_tokens`` tokens are covered by the best alignment, which starts near the document's
    token ``position``; tokens are words of verbatim matches and template tokens of others. An alignment counts from ``cover`` tokens on, or
    if it covers the whole of an item that has fewer; characters of scripts without spaces count as a third of a word. Items
    of fewer than 4 words match where they are a whole sentence or line. Rows with a null id or text match nothing and empty
    tables give no rows. Repeated rows of an id count as one document or item: the best alignment of any of them. Other columns are
    ignored. Hot windows are joined by Spark's skew join; alignments hold at most as many windows as the item has.
    """
    spark = docs.sparkSession
    items = (
        benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
        .select(F.col("item_id").cast("long").alias("key"), "text")
        .distinct()
    )
    ours = _windows(items, None)
    lengths = tuple(sorted(r["size"] for r in ours.select("size").distinct().collect())) or (WINDOW,)
    wanted = _prefixes(spark, ours)
    texts = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("key"), "text"
    )
    theirs = _windows(texts, lengths, wanted).select(
        F.col("key").alias("doc_id"), F.col("position").alias("at"), F.col("place").alias("at_place"), "hash", "size",
        F.col("template").alias("seen"), F.col("slots").alias("values"), F.col("in_words").alias("by_words"), F.col("in_places").alias("by_places"),
    )
    ours = ours.withColumnRenamed("key", "item_id")
    plain = (F.col("template") == PLAIN) & (F.col("seen") == PLAIN)
    likeness = (F.col("template") != PLAIN) & (F.col("seen") != PLAIN) & (F.size("slots") == F.size("values"))
    # Equal words have equal values, whatever either context makes of them.
    matched = theirs.join(ours, ["hash", "size"]).where(plain | likeness).withColumn("values", F.when(plain, F.col("slots")).otherwise(F.col("values")))
    # Windows align by words, or by places, where a run is one; those without runs in either way.
    by_words = F.struct(
        F.lit(True).alias("words"), (F.col("at") - F.col("position")).alias("shift"), F.col("tokens").alias("item_tokens"),
        F.struct("position", "size").alias("run"), F.col("at").alias("start"),
    )
    by_place = F.struct(
        F.lit(False).alias("words"), (F.col("at_place") - F.col("place")).alias("shift"), F.col("places").alias("item_tokens"),
        F.struct(F.col("place").alias("position"), F.col("span").alias("size")).alias("run"), F.col("at_place").alias("start"),
    )
    ways = F.array(
        F.when(F.col("in_words") & F.col("by_words"), by_words), F.when(F.col("in_places") & F.col("by_places"), by_place)
    )
    matched = matched.withColumn("way", F.explode(F.array_compact(ways)))
    matched = matched.select("doc_id", "item_id", "template", "seen", "slots", "values", "singles", "way.*")
    pairs = F.arrays_zip("slots", "values")
    inside = F.col("template").isin(0, MERGED) & F.col("seen").isin(0, MERGED)
    aligned = (
        matched.groupBy("doc_id", "item_id", "item_tokens", "singles", "words", "shift")
        .agg(
            _covered(F.collect_set("run")).alias("like"),
            _covered(F.collect_set(F.when(inside, F.col("run")))).alias("like_inside"),
            _covered(F.collect_set(F.when(plain, F.col("run")))).alias("same"),
            F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs"),
            F.array_distinct(F.flatten(F.collect_set(F.when(inside, pairs)))).alias("pairs_inside"),
            F.min("start").alias("start"),
        )
        # Other opening words may spoil what names inside sentences agree on, so both readings count.
        .withColumn("like", F.when(_consistent("pairs"), F.col("like")).otherwise(0))
        .withColumn("like_inside", F.when(_consistent("pairs_inside"), F.col("like_inside")).otherwise(0))
        .withColumn("n_tokens", F.greatest("like", "like_inside", "same"))
        .withColumn("pairs", F.when(F.col("n_tokens") > F.greatest("like_inside", "same"), F.col("pairs")).otherwise(F.col("pairs_inside")))
        # Of characters it takes more: all of them, CHARACTERS times the cover.
        .withColumn("need", cover * (1 + (CHARACTERS - 1) * F.col("singles") / F.col("item_tokens")))
        .where(F.col("n_tokens") >= F.least(F.col("need"), F.col("item_tokens")))
    )
    best = F.max(F.struct("n_tokens", (-F.col("start")).alias("before"), "item_tokens", F.size("pairs").alias("n_slots"))).alias("b")
    return (
        aligned.groupBy("doc_id", "item_id")
        .agg(best)
        .select("doc_id", "item_id", "b.n_tokens", "b.item_tokens", (-F.col("b.before")).alias("position"), "b.n_slots")
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` that are not contaminated; rows without id or text stay. All columns are kept.

    Rows are told apart by a hash of id and text, so a clean text stays where its id repeats with a contaminated one.
    """
    named = F.col("doc_id").isNotNull() & F.col("text").isNotNull()
    rows = docs.withColumn("_row", F.when(named, F.xxhash64("doc_id", "text")))
    found = find_contamination(rows.select(F.col("_row").alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias("_row")).distinct()
    return rows.join(found, "_row", "left_anti").select(*docs.columns)
