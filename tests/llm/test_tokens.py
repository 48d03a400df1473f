"""Token ids by words, the coder's round trip, token files and packing against plain encoding."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scanlake.llm import packing, token_coder
from scanlake.llm.tokens import WordTokenizer, default_path

pytest.importorskip("public_tokenizers")

ODD = [
    "", " ", "\n\n", "a\x1cb \x85 c\xa0d <|endoftext|> X <|ENDOFTEXT|>", "Ünïcode’s don't ΣΑΣ İI K ß ﬁ é é cóte",
    "re.\r\nfoo\tbar  ªº µ 12a3 5kg it's they'll..,", "日本語 テキスト　x", "I’m <|startoftext|>a", "a." * 50, "x" * 5000, "🙂👍🏽 ‍", "Ÿ ÿ \xad",
]


def texts(number, seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("etaoinshréß,.!0") for _ in range(r.randint(1, 9)))
    sizes = [0, 1, 3, 20, 200, 2000, 5000]
    return [*ODD, None, *(" ".join(word() for _ in range(r.choice(sizes))) for _ in range(number))]


def plain(rows):
    library = Tokenizer.from_file(default_path())
    return [np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for t in rows]


@pytest.mark.parametrize("memory", [10, 100_000])
def test_words_give_the_ids_of_the_text(memory):
    rows = [t or "" for t in texts(30, 1)]
    own = WordTokenizer(default_path(), memory)
    assert own.by_word and own.plain
    for first in range(0, len(rows), 7):
        ids, ends = own.encode(rows[first : first + 7])
        for text, a, b in zip(rows[first : first + 7], ends[:-1], ends[1:], strict=True):
            assert ids[a:b].tolist() == plain([text])[0][:-1].tolist(), text[:60]


@pytest.mark.parametrize("memory", [3, 40])
def test_words_met_again_outlive_a_full_memory(memory):
    own, r = WordTokenizer(default_path(), memory), random.Random(7)
    often = ["the", "cat!!", "été,", "is***", "x?!", "don't.", "a#$%&"]
    for step in range(40):
        words = [w for w in often for _ in range(2)] + [f"{r.choice('bcdfg')}{''.join(r.choice('aeiou') for _ in range(6))}{step % 3 * '!'}" for _ in range(8)]
        text = " ".join(words)
        ids, ends = own.encode([text])
        assert ids.tolist() == plain([text])[0][:-1].tolist() and ends.tolist() == [0, len(ids)]
    assert memory == 3 or set(often) <= own.known.keys()


def test_a_word_is_given_to_the_library_once_among_many(monkeypatch):
    own = WordTokenizer(default_path())
    given = []
    monkeypatch.setattr(own, "_encode_plain", lambda words, f=own._encode_plain: given.append(words) or f(words))
    rows = ["Été thé cat cat, cat... The\tCAT!\nthé?", None, "", "cat thé, new"]
    ids, ends = own.encode(pa.array(["x", *rows])[1:])
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == [x[:-1].tolist() for x in plain(rows)]
    assert [sorted(words) for words in given] == [["cat", "new", "the", "thé", "été"]]
    own.encode(["new cat été!"])
    assert len(given) == 1


def test_letters_beyond_ascii_are_lowered_only_where_no_id_changes():
    rows = ["".join(map(chr, range(a, a + 64))) + f" {chr(a)}Z,. J\u030c" for a in range(0, 0x250, 16)] + ["J\u030c", "\xc9\xd7\xf7\xb5.", "<|EndOfText|> A"]
    ids, ends = WordTokenizer(default_path()).encode(rows)
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == [x[:-1].tolist() for x in plain(rows)]


def test_words_met_most_outlive_others_met_again():
    own = WordTokenizer(default_path(), 20)
    names = [f"{a}{b}" for a in "bcdfg" for b in "aeio"]
    for step in range(12):
        text = " ".join(names * 2 + ["often"] * 9 + [f"{'x' * step}new"])
        assert own.encode([text])[0].tolist() == plain([text])[0][:-1].tolist()
    assert len(own.known) > 20 and "often" in own.known
    own._forget_rare()
    assert "often" in own.known and len(own.known) <= 10


def test_long_words_do_not_stay_in_memory():
    own, r = WordTokenizer(default_path(), 20), random.Random(3)
    for _ in range(6):
        text = " ".join("".join(r.choice("qxzjkv") for _ in range(400)) for _ in range(3))
        assert own.encode([text])[0].tolist() == plain([text])[0][:-1].tolist()
        assert len(own.known) <= 3


def test_other_tokenizers_encode_whole_texts():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    own, library = WordTokenizer(path), Tokenizer.from_file(path)
    assert not own.by_word
    ids, ends = own.encode(["a b  c", "", "é\n"])
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == [
        library.encode(t, add_special_tokens=False).ids for t in ("a b  c", "", "é\n")
    ]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 255, 256, 700, 40_000])
@pytest.mark.parametrize("kind", ["random", "skewed", "one", "period", "large"])
def test_blocks_round_trip(n, kind):
    r = np.random.default_rng(n)
    ids = {
        "random": r.integers(0, 49408, n), "skewed": np.minimum(r.geometric(0.01, n), 49407), "one": np.zeros(n, np.int64),
        "period": np.arange(n) % 7, "large": r.integers(0, token_coder.MOST_IDS, n),
    }[kind]
    sizes = np.array([n // 3, 0, n - n // 3])
    doc_ids = np.array([5, token_coder.NO_ID, 9])
    block = token_coder.write_block(doc_ids, sizes, ids)
    got_docs, got_sizes, got = token_coder.read_block(block)
    assert (got_docs == doc_ids).all() and (got_sizes == sizes).all() and (got == ids).all()
    if n == 40_000 and kind in ("one", "period"):
        assert len(block) < n / 4


def test_ids_that_do_not_occur_cost_next_to_nothing():
    few = np.random.default_rng(1).integers(0, 16, 20_000)
    sizes = [len(token_coder.write_block(np.array([1]), np.array([len(x)]), x)) for x in (few, few * 3000 + 7)]
    assert sizes[1] < sizes[0] + 200
    assert (token_coder.read_block(token_coder.write_block(np.array([1]), np.array([20_000]), few * 3000 + 7))[2] == few * 3000 + 7).all()


def test_a_carry_runs_through_full_words():
    out = token_coder._Writer(2, 3)
    out.words[:3], out.used[:] = np.array([[7, 1], [0xFFFFFFFF, 2], [0xFFFFFFFF, 3]]), 3
    out._carry(np.array([0]))
    assert out.words[:3].T.tolist() == [[8, 0, 0], [1, 2, 3]]


@pytest.mark.parametrize("seed", range(4))
def test_coder_of_rare_outcomes(seed):
    r, lanes, steps, mix = np.random.default_rng(seed), 5, 400, token_coder._MIX
    bits = np.uint64(token_coder._ORDER0_BITS)
    numbers = lambda x: np.asarray(x).astype(np.uint64)
    coded, out, carries = [], token_coder._Writer(lanes, steps), []
    out._carry = lambda found, f=out._carry: carries.extend(found) or f(found)
    for _ in range(steps):
        start = r.choice([0, 1, mix - 2, mix - 1], lanes)
        size = np.where(r.random(lanes) < 0.8, 1, mix - start)
        missed = np.flatnonzero(r.random(lanes) < 0.5)
        begin = r.choice([0, (1 << int(bits)) - 1], len(missed))
        out.put(numbers(start), numbers(size), missed, numbers(begin), numbers(np.ones(len(missed))), bits)
        coded.append((start, size, missed, begin))
    assert carries
    read = token_coder._Reader(*out.finish())
    for start, size, missed, begin in coded:
        unit = read.range >> token_coder._MIX_SHIFT
        assert (read.ahead >= unit * numbers(start)).all() and (read.ahead < unit * numbers(start + size)).all()
        read.ahead -= unit * numbers(start)
        read.range = unit * numbers(size)
        unit = read.range[missed] >> bits
        assert (read.ahead[missed] // unit == numbers(begin)).all()
        read.ahead[missed] -= unit * numbers(begin)
        read.range[missed] = unit
        read.refill()


def test_damage_is_noticed():
    block = token_coder.write_block(np.array([1]), np.array([900]), np.arange(900))
    for at in range(0, len(block), 37):
        broken = bytearray(block)
        broken[at] ^= 4
        with pytest.raises(ValueError):
            token_coder.read_block(bytes(broken))
    for cut in (0, 10, 40, len(block) - 1):
        with pytest.raises(ValueError):
            token_coder.read_block(block[:cut])
    with pytest.raises(ValueError):
        token_coder.write_block(np.array([1]), np.array([1]), np.array([token_coder.MOST_IDS]))


def frame(spark, rows):
    r = random.Random(4)
    rows = [(i * 3, t, "n", i) for i, t in enumerate(rows)]
    r.shuffle(rows)
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, pid int").repartition(3)


def test_token_files(spark, monkeypatch):
    monkeypatch.setattr(token_coder, "FILE_BYTES", 60_000)
    rows = texts(40, 2)
    found = sorted(token_coder.token_round_trip(frame(spark, rows)).collect())
    start = 0
    for i, (row, ids) in enumerate(zip(found, plain(rows), strict=True)):
        assert tuple(row[:4]) == (i * 3, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len({(r.block_bytes, r.block_ids) for r in found}) > 1


def test_token_files_of_null_ids_repeats_and_nothing(spark):
    schema = "doc_id long, text string"
    assert token_coder.token_round_trip(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "b"), (4, "c d"), (4, "c d"), (-2, None)]
    found = token_coder.token_round_trip(spark.createDataFrame(rows, schema)).collect()
    sizes = {None: len(plain(["b"])[0]), 4: len(plain(["c d"])[0]), -2: 1}
    assert [(r.doc_id, r.start, r.n_tokens) for r in sorted(found, key=lambda r: r.start)] == [
        (None, 0, sizes[None]), (-2, sizes[None], 1), (4, sizes[None] + 1, sizes[4]), (4, sizes[None] + 1 + sizes[4], sizes[4])
    ]


def test_a_hot_id_fills_many_files(spark, tmp_path):
    rows = [(None, f"word{i % 50} " * 400) for i in range(3000)] + [(7, "same text " * 300)] * 2000
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    token_coder.write_token_files(docs, str(tmp_path / "files"))
    blocks = spark.read.parquet(str(tmp_path / "files"))
    counts = [r.n for r in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()]
    assert len(counts) > 3 and max(counts) < 0.7 * sum(counts)
    found = token_coder.read_token_files(spark, str(tmp_path / "files")).collect()
    assert len(found) == len(rows) and sum(r.doc_id is None for r in found) == 3000
    found.sort(key=lambda r: r.start)
    assert [r.doc_id for r in found] == [None] * 3000 + [7] * 2000
    assert all(a.start + a.n_tokens == b.start for a, b in zip(found, found[1:]))


def check_pieces(found, ids_of, window):
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        docs[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
        assert r.doc_tokens == len(ids_of[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids_of[r.doc_id][r.start : r.start + r.length].tobytes())
    for doc, ids in ids_of.items():
        at = 0
        for start, length in sorted(docs[doc]):
            assert start == at and length > 0
            at += length
        assert at == len(ids)
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        padding += window - at if at & (at - 1) else 0
    assert sorted(sequences) == list(range(len(sequences)))
    return padding


@pytest.mark.parametrize("window", [2048, 64, 8])
def test_packing(spark, window):
    rows = texts(60, 3)
    found = packing.pack(frame(spark, rows), window=window).collect()
    ids_of = {i * 3: ids for i, ids in enumerate(plain(rows))}
    assert check_pieces(found, ids_of, window) == 0


def test_packing_of_nothing_and_of_null_ids(spark):
    schema = "doc_id long, text string"
    assert packing.pack(spark.createDataFrame([], schema)).count() == 0
    found = packing.pack(spark.createDataFrame([(None, "a"), (None, None), (3, ""), (3, "")], schema)).collect()
    assert sorted((str(r.doc_id), r.length) for r in found if r.length == r.doc_tokens)[:1] == [("3", 1)]
    assert sum(r.length for r in found) == len(plain(["a"])[0]) + 3


def brute_fill(counts, capacity):
    sums = {0}
    for length, n in enumerate(counts):
        for _ in range(n):
            sums |= {s + length for s in sums if s + length <= capacity}
    return max(sums)


def test_best_fill_equals_brute_force():
    r = random.Random(1)
    for _ in range(300):
        capacity = r.randint(1, 40)
        counts = np.array([0, *(r.choice([0, 0, 1, 2, 5]) for _ in range(capacity))])
        total, pieces = packing.best_fill(counts, capacity)
        assert total == brute_fill(counts, capacity) == sum(n * c for n, c in pieces.items())
        assert all(c <= counts[n] for n, c in pieces.items())


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    r = random.Random(seed)
    window = 32
    counts = {n: r.choice([0, 1, 3, 50]) for n in range(1, window)} if seed else {20: 1000}
    counts[window] = 4
    plan = packing.make_plan(counts, window)
    used = defaultdict(list)
    for length, n in counts.items():
        if n:
            piece, start, size, sequence, offset = plan.place(np.full(n, length), np.arange(n))
            done = np.bincount(piece, size, n)
            assert (done == length).all()
            for s, z, q, o in zip(start, size, sequence, offset, strict=True):
                assert 0 <= s < length
                used[q].append((o, z))
    assert sorted(used) == list(range(len(used)))
    for parts in used.values():
        at = 0
        for o, z in sorted(parts):
            assert o == at
            at += z
        assert at == window or at & (at - 1) == 0
