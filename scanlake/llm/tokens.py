"""Token ids of texts by the tokenizers library, with each distinct word encoded once per task.

Where a tokenizer drops white space and splits before it merges, the ids of a text are those of its words one after another.
So words are cut at spaces and line ends, each distinct one of a slice of texts is looked up, and only unknown ones are given to
the library, many at once. Any other tokenizer encodes whole texts.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterable
from functools import cache
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from scanlake.llm.arrow import byte_lengths, text_bytes

#: The words that a task remembers, and ids for each in the mean; beyond, it forgets those met least, more than half of them.
MEMORY = 1_000_000
_IDS_A_WORD = 8
#: Bytes of text to encode at once: words are looked up once in them, however often they occur.
ENCODE_BYTES = 4 << 20
#: Words that the library gets at once.
_AT_ONCE = 8192

#: A word of lower-case letters of Latin-1 is one piece of text, and marks after it are another.
_LETTERS = "^[a-z\xdf-\xf6\xf8-\xff]+$"
_MARKS = ".,;:!?#$%&*"


def default_path() -> str:
    """The public vocabulary file that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """Byte-level tokenizers write a byte as itself if it is printable Latin-1, else as the next free letter from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(others)) for b in range(256)}


class WordTokenizer:
    def __init__(self, path: str, memory: int = MEMORY):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.library = Tokenizer.from_file(path)
        self.memory = memory
        with open(path, encoding="utf-8") as f:
            form = json.load(f)
        self.by_word = _splits_at_space(form)
        self.plain = self.by_word and _is_byte_level(form) and _marks_ends(form)
        if self.plain:
            # The library's model alone, for words that are one piece each; the last id of a word shows that it is the last.
            self.pieces = Tokenizer(self.library.model)
            self.pieces.pre_tokenizer = WhitespaceSplit()
            suffix, vocab = form["model"]["end_of_word_suffix"], form["model"]["vocab"]
            self.is_last = np.zeros(max(vocab.values()) + 1, bool)
            self.is_last[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
        self.moved = [(chr(b), c) for b, c in _byte_letters().items() if b > 127 and chr(b) != c]
        self._forget()

    def _forget_rare(self):
        """Words met once go, or up to 3, 7 and so on times until half of the memory is free; the ids of the others move together."""
        met, least = self.met[: len(self.known)], 2
        while (kept := met >= least).any():
            ids, ends = self._ids_of(np.flatnonzero(kept))
            if 2 * len(ends) <= self.memory and 2 * len(ids) <= _IDS_A_WORD * self.memory:
                break
            least *= 2
        else:
            self._forget()
            return
        words = list(compress(self.known, kept.tolist()))
        self._forget()
        self._keep(words, ids, ends)
        self.met[: len(words)] = 1

    def _forget(self):
        self.known: dict[str, int] = {}
        self.met = np.zeros(1 << 14, np.int64)
        self.flat = np.zeros(1 << 16, np.int32)
        #: Where the ids of each known word start in ``flat``, and the last one's end.
        self.borders = np.zeros(1 << 14, np.int64)

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: none) one after another, and where each text's ids start and the last one's end."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if column.null_count:
            column = column.fill_null("")
        if not self.by_word:
            return _joined(e.ids for e in self.library.encode_batch_fast(column.to_pylist(), add_special_tokens=False))
        lists = _words(column)
        found = lists.flatten().dictionary_encode()
        words = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        at = found.indices.to_numpy()
        if len(self.known) > self.memory or self.borders[len(self.known)] > _IDS_A_WORD * self.memory:
            self._forget_rare()
        names = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(names < 0)
        if len(missing):
            new = [words[i] for i in missing.tolist()]
            self._learn(new, found.dictionary.take(pa.array(missing)))
            names[missing] = np.fromiter(map(self.known.__getitem__, new), np.int64, len(new))
        self.met[names] += np.bincount(at, minlength=len(words))
        ids, ends = self._ids_of(names[at])
        return ids, ends[lists.offsets.to_numpy()]

    def _ids_of(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of known words one after another, and where each word's ids start and the last one's end."""
        starts = self.borders[names]
        sizes = self.borders[names + 1] - starts
        ends = np.concatenate(([0], np.cumsum(sizes)))
        source = np.arange(ends[-1]) + np.repeat(starts - ends[:-1], sizes)
        return self.flat[source], ends

    def _learn(self, words: list[str], column: pa.Array):
        """Words that are not known, each once, and the same as a column."""
        if not self.plain:
            self._keep_new(words, self._encode_odd)
            return
        letters = pc.utf8_rtrim(column, characters=_MARKS)
        plain = pc.match_substring_regex(letters, _LETTERS).to_numpy(zero_copy_only=False)
        marks = byte_lengths(column) - byte_lengths(letters)
        marked = np.flatnonzero(plain & (marks > 0))
        with_marks = [words[i] for i in marked.tolist()]
        letters = letters.to_numpy(zero_copy_only=False)
        heads = letters[marked].tolist()
        tails = [word[-n:] for word, n in zip(with_marks, marks[marked].tolist(), strict=True)]
        self._keep_new(letters[plain].tolist(), self._encode_plain)
        self._keep_new([words[i] for i in np.flatnonzero(~plain).tolist()] + tails, self._encode_odd)
        both = np.empty((len(marked), 2), np.int64)
        for k, parts in enumerate((heads, tails)):
            both[:, k] = np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts))
        ids, ends = self._ids_of(both.reshape(-1))
        self._keep(with_marks, ids, ends[::2])

    def _keep_new(self, words: list[str], encode: Callable):
        new = [word for word in dict.fromkeys(words) if word not in self.known]
        for first in range(0, len(new), _AT_ONCE):
            some = new[first : first + _AT_ONCE]
            self._keep(some, *encode(some))

    def _encode_plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        text = " ".join(words).encode().decode("latin-1")
        for byte, letter in self.moved:
            text = text.replace(byte, letter)
        ids = np.array(self.pieces.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
        return ids, np.concatenate(([0], np.flatnonzero(self.is_last[ids]) + 1))

    def _encode_odd(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _joined(e.ids for e in self.library.encode_batch_fast(words, add_special_tokens=False))

    def _keep(self, words: list[str], ids: np.ndarray, ends: np.ndarray):
        """New words with their ids."""
        n = len(self.known)
        used = int(self.borders[n])
        self.known.update(zip(words, range(n, n + len(words)), strict=True))
        if len(ends) != len(words) + 1 or len(self.known) != n + len(words):
            raise AssertionError("each new word has ids of its own")
        self.flat = _with_room(self.flat, used + len(ids))
        self.borders = _with_room(self.borders, n + len(ends))
        self.met = _with_room(self.met, n + len(ends))
        self.flat[used : used + len(ids)] = ids
        self.borders[n : n + len(ends)] = used + ends


def _joined(lists: Iterable[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    lists = list(lists)
    ends = np.cumsum([0, *map(len, lists)])
    return np.fromiter(chain.from_iterable(lists), np.int32, ends[-1]), ends


def _with_room(values: np.ndarray, size: int) -> np.ndarray:
    if size <= len(values):
        return values
    return np.concatenate((values, np.zeros(max(size, 2 * len(values)) - len(values), values.dtype)))


def _words(column: pa.Array) -> pa.ListArray:
    """Texts cut at spaces and line ends, in lower case where that changes no id: Latin-1 texts without the marks of special tokens."""
    data, borders = text_bytes(column)
    full = np.flatnonzero(np.diff(borders))
    as_is = pc.match_substring(column, "<|").to_numpy(zero_copy_only=False)
    if len(full):
        as_is[full] |= np.maximum.reduceat(data, borders[full]) > 0xC3
    low = pc.utf8_lower(column)
    if as_is.any():
        low = pc.if_else(pa.array(as_is), column, low)
    for space in "\n\t\r":
        low = pc.replace_substring(low, space, " ")
    return pc.split_pattern(low, " ")


def _normalizers(form: dict) -> list[dict]:
    own = form.get("normalizer") or {}
    return own.get("normalizers", [own])


def _splits_at_space(form: dict) -> bool:
    """White space becomes a space, which the split drops; case is ignored, and every merge stays inside a word."""
    steps = _normalizers(form)
    kinds = [s.get("type") for s in steps]
    spaces = any(s.get("type") == "Replace" and s["pattern"].get("Regex") == r"\s+" and s["content"] == " " for s in steps)
    before = form.get("pre_tokenizer") or {}
    splits = [p for p in before.get("pretokenizers", [before]) if p.get("type") == "Split"]
    dropped = any(p["behavior"] == "Removed" and p["invert"] and r"\s" not in p["pattern"].get("Regex", r"\s").replace(r"[^\s", "") for p in splits)
    return spaces and dropped and "Lowercase" in kinds and not form.get("post_processor")


def _is_byte_level(form: dict) -> bool:
    before = form.get("pre_tokenizer") or {}
    kinds = [p.get("type") for p in before.get("pretokenizers", [before])]
    return kinds == ["Split", "ByteLevel"] and form["model"].get("type") == "BPE" and not form["model"].get("dropout")


def _marks_ends(form: dict) -> bool:
    """The last id of a piece of letters is one that stands only at ends, whatever the letters are."""
    suffix, vocab = form["model"].get("end_of_word_suffix"), form["model"]["vocab"]
    return bool(suffix) and all(c in vocab and c + suffix in vocab for c in _byte_letters().values())


@cache
def tokenizer(path: str) -> WordTokenizer:
    """One per worker and file."""
    return WordTokenizer(path)


def with_end(ids: np.ndarray, ends: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts with ``end_id`` after each text."""
    number = len(ends) - 1
    out = np.empty(len(ids) + number, np.dtype("<u4"))
    borders = ends + np.arange(number + 1)
    inner = np.ones(len(out), bool)
    inner[borders[1:] - 1] = False
    out[inner] = ids
    out[~inner] = end_id
    return out, borders
