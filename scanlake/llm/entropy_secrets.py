"""Secret scan: assignment, access-key and hex patterns, and windows of high Shannon entropy.

The patterns give the base spans. The method adds spans of kind ``entropy``: candidate strings are runs of the characters of
one class; a window of fixed width slides over each, with its character counts updated by one character in and one out, and
windows whose entropy reaches the class's limit are merged into spans. Strings of an allow list are suppressed.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from scanlake.llm.arrow import map_batches, slices

# The patterns of the three base kinds, and the least length of what counts.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex")
LEAST = {"assign": 12, "access": 18, "hex": 16}


@dataclass(frozen=True)
class Candidates:
    """One character class: its strings, the window's width, and the least entropy of a window in bits a character."""

    name: str
    pattern: re.Pattern
    window: int
    bits: float


CLASSES = (
    Candidates("hex", re.compile(r"(?<![A-Za-z0-9])[0-9A-Fa-f]{24,}(?![A-Za-z0-9])", re.ASCII), 24, 3.0),
    Candidates("base64", re.compile(r"[A-Za-z0-9+/]{32,}={0,2}", re.ASCII), 32, 4.25),
    Candidates("url", re.compile(r"[A-Za-z0-9_-]{32,}", re.ASCII), 32, 4.25),
)

#: Whole candidate strings that are never secrets: identifiers with a fixed form, single-case words, plain digits.
ALLOW = (
    re.compile(r"[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}", re.IGNORECASE | re.ASCII),
    re.compile(r"[0-9]+(?:-[0-9]+)*", re.ASCII),
    re.compile(r"[A-Za-z][a-z]*|[A-Z]+", re.ASCII),
    re.compile(r"[A-Za-z]+(?:[-_/][A-Za-z]+)+", re.ASCII),
)

SCHEMA = (
    "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_entropy long"
)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, by start, then kind as listed; positions in code points."""
    found = []
    for m in ASSIGN.finditer(text) if "=" in text or ":" in text else ():
        if m.end(2) - m.start(2) >= LEAST["assign"]:
            found.append((m.start(), 0, m.end()))
    for m in ACCESS.finditer(text) if "AKIA" in text else ():
        if m.end() - m.start() >= LEAST["access"]:
            found.append((m.start(), 1, m.end()))
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(a, b, KINDS[k]) for a, k, b in sorted(found)]


def entropy_runs(text: str, width: int, bits: float) -> list[tuple[int, int]]:
    """The parts of ``text`` that are covered by windows of ``width`` characters with at least ``bits`` bits each.

    Entropy is log2(width) - sum(c * log2(c)) / width over the counts c of a window; one step changes two counts.
    """
    if len(text) < width:
        return []
    # A window holds one character more for a moment.
    cost = [0.0] + [c * math.log2(c) for c in range(1, width + 2)]
    most = (math.log2(width) - bits) * width + 1e-9
    counts: dict[str, int] = {}
    total, runs = 0.0, []
    for i, char in enumerate(text):
        c = counts.get(char, 0)
        counts[char] = c + 1
        total += cost[c + 1] - cost[c]
        if i >= width:
            old = text[i - width]
            c = counts[old]
            counts[old] = c - 1
            total += cost[c - 1] - cost[c]
        if i >= width - 1 and total <= most:
            start = i - width + 1
            if runs and start <= runs[-1][1]:
                runs[-1][1] = i + 1
            else:
                runs.append([start, i + 1])
    return [tuple(r) for r in runs]


def entropy_spans(text: str, classes=CLASSES, allow=ALLOW) -> list[tuple[int, int, str]]:
    """Spans of high entropy in the candidate strings of all classes; overlapping ones are one span."""
    found = []
    for kind in classes:
        for m in kind.pattern.finditer(text):
            string = m.group()
            if any(a.fullmatch(string) for a in allow):
                continue
            found += [(m.start() + a, m.start() + b) for a, b in entropy_runs(string, kind.window, kind.bits)]
    merged: list[list[int]] = []
    for a, b in sorted(found):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    return [(a, b, "entropy") for a, b in merged]


_LONG_RUN = re.compile(rb"[A-Za-z0-9+/_=-]{24}")


def scan(text: str) -> tuple[list, list]:
    """Base spans, and entropy spans that no base span covers wholly."""
    base = base_spans(text)
    added = []
    if _LONG_RUN.search(text.encode("utf-8", "surrogatepass")):
        added = _uncovered(entropy_spans(text), base)
    return base, added


def _uncovered(spans: list, base: list) -> list:
    """Those of ``spans`` that no base span holds wholly. Both are sorted by start: one walk, with the furthest base end so far."""
    kept, at, reach = [], 0, -1
    for span in spans:
        while at < len(base) and base[at][0] <= span[0]:
            reach = max(reach, base[at][1])
            at += 1
        if span[1] > reach:
            kept.append(span)
    return kept


def _joined(spans) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """Columns of ``docs`` other than the text, and per row ``n_assign, n_access, n_hex, base_sha256, spans, n_entropy``.

    A null or empty text has no spans: counts 0, ``spans`` empty, the digest of an empty string. Every row gives one row,
    repeated ones too. Columns of ``docs`` with the name of a result column are replaced. Positions are code points, ends are
    exclusive; ``spans`` holds base and entropy spans by start, then kind. There is no shuffle.
    """
    fields = [f.split()[0] for f in SCHEMA.split(", ")]
    kept = [c for c in docs.columns if c not in fields and c != text]
    schema = docs.select(*kept).schema.simpleString()[len("struct<") : -1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_row(t or "") for t in batch.column(len(kept)).to_pylist()]
            arrays = [batch.column(i) for i in range(len(kept))]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(fields)
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            arrays += [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, *fields])

    return docs.select(*kept, text).mapInArrow(work, f"{_ddl(docs, kept)}{SCHEMA}" if schema else SCHEMA)


MASK = "[secret]"


def masked(text: str, mask: str = MASK) -> str:
    """The text with every run of base and entropy spans replaced."""
    base, added = scan(text)
    out, done = [], 0
    for a, b, _ in sorted(base + added):
        if a >= done:
            out += [text[done:a], mask]
        done = max(done, b)
    return "".join(out) + text[done:]


def without_secrets(docs: DataFrame, mask: str = MASK) -> DataFrame:
    """All rows and columns of ``docs`` with secrets masked in ``text``; ``n_chars``, if there is one, follows a changed text."""
    schema, names = docs.schema, docs.columns
    place = names.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column(place).to_pylist()
            clean = [masked(t, mask) if t else t for t in texts]
            arrays = list(batch.columns)
            arrays[place] = pa.array(clean, batch.column(place).type)
            if "n_chars" in names:
                at = names.index("n_chars")
                sizes = [len(new) if new != old else n for old, new, n in zip(texts, clean, batch.column(at).to_pylist(), strict=True)]
                arrays[at] = pa.array(sizes, batch.column(at).type)
            yield pa.RecordBatch.from_arrays(arrays, names)

    return map_batches(docs, work, schema)


def _ddl(docs: DataFrame, kept: list[str]) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema.fields if f.name in kept)


def _row(text: str):
    base, added = scan(text)
    counts = [sum(s[2] == k for s in base) for k in KINDS]
    digest = hashlib.sha256(_joined(base).encode()).hexdigest()
    order = {**{k: i for i, k in enumerate(KINDS)}, "entropy": len(KINDS)}
    every = sorted(base + added, key=lambda s: (s[0], order[s[2]], s[1]))
    return *counts, digest, _joined(every), len(added)
