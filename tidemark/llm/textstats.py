"""Per-document text statistics over Arrow batches, vectorised across the documents of a slice.

Words are maximal runs of bytes outside ``\\x20 \\x09-\\x0D`` (ASCII white space
only), so UTF-8 text is cut on bytes without decoding.  A null text counts as
an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

# The symbols that the base quality rule counts.
SYMBOLS = "#*$%&|<>"


class Recent:
    """A bounded memory in two generations: what was met lately stays, the rest is forgotten a generation at a time."""

    def __init__(self, limit: int):
        self.limit, self.young, self.old = max(1, limit // 2), {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.limit:
            self.old, self.young = self.young, {}
        self.young[key] = value


def lean_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, with Arrow buffers allocated so that a worker gives their memory back.

    Workers outlive their tasks: what one task leaves behind would count against the next.
    """
    pool = pa.system_memory_pool()
    pa.set_memory_pool(pool)
    try:
        yield from batches
    finally:
        pool.release_unused()


def slices(texts: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Cut a string array into runs of about ``max_bytes`` (a longer text stands alone): (first row, run)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    run = np.cumsum(sizes)
    start = 0
    while start < len(texts):
        base = run[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(run, base + max_bytes, side="right")))
        yield start, texts.slice(start, end - start)
        start = end


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the n+1 offsets into them."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` between consecutive offsets."""
    run = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return run[offsets[1:]] - run[offsets[:-1]]


def _lut(chars: str) -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[list(chars.encode())] = 1
    return out


_SPACE = _lut(" \t\n\v\f\r")
_SYMBOL = _lut(SYMBOLS)
_UPPER = _lut("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_SHOUT = _lut("!?")
_DIGIT = _lut("0123456789")
_PUNCT = _lut(".,;:\"'()-_=+/\\@[]{}~^`")
_LEAD = np.ones(256, np.uint8)
_LEAD[0x80:0xC0] = 0  # continuation bytes carry no code point of their own


@dataclass
class Words:
    """Words of a slice: ``code[i]`` is the word's place in ``distinct``, ``row[i]`` its document."""

    code: np.ndarray
    row: np.ndarray
    distinct: pa.Array
    per_row: np.ndarray


def words(texts: pa.Array) -> Words:
    parts = pc.ascii_split_whitespace(texts)
    row = pc.list_parent_indices(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = parts.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    row = row[full.to_numpy(zero_copy_only=False)]
    enc = flat.filter(full).dictionary_encode()
    code = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return Words(code, row, enc.dictionary, np.bincount(row, minlength=len(texts)))


def repeated_window_words(w: Words, rows: int, size: int = 3) -> np.ndarray:
    """Per document: word positions inside some ``size``-word window that occurs twice or more in it."""
    n = len(w.code)
    out = np.zeros(rows, np.int64)
    if n < size:
        return out
    key = w.code[: n - size + 1].copy()
    for k in range(1, size):
        nxt = w.code[k: n - size + 1 + k]
        span = len(w.distinct)
        if len(key) and int(key.max()) >= (1 << 62) // max(span, 1):
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
        key = key * span + nxt
    inside = w.row[: n - size + 1] == w.row[size - 1:]
    at = np.flatnonzero(inside)
    order = np.argsort(key[at], kind="stable")  # stable: rows of one document stay together
    k, r = key[at][order], w.row[at][order]
    same = (k[1:] == k[:-1]) & (r[1:] == r[:-1])
    hit = np.zeros(len(k), bool)
    hit[1:] |= same
    hit[:-1] |= same
    covered = np.zeros(n, bool)
    start = at[order[hit]]
    for j in range(size):
        covered[start + j] = True
    return np.bincount(w.row[covered], minlength=rows)


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line of the text."""
    seen: set[str] = set()
    dups = 0
    for line in text.split("\n"):
        if line in seen:
            dups += 1
        elif line.strip(" \t\n\v\f\r"):
            seen.add(line)
    return dups


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """All counts of a slice, one int64 array entry per document."""
    raw, offsets = _flat(texts)
    w = words(texts)
    rows = len(texts)
    count = lambda lut: _per_row(lut[raw], offsets)
    chars = count(_LEAD)
    pairs = np.unique(w.row * max(len(w.distinct), 1) + w.code) // max(len(w.distinct), 1)
    many = pc.greater(pc.count_substring(texts, "\n"), 0).to_numpy(zero_copy_only=False)
    dup = np.zeros(rows, np.int64)
    for i in np.flatnonzero(many):
        dup[i] = duplicate_lines(texts[int(i)].as_py())
    return {
        "n_words": w.per_row.astype(np.int64),
        "word_chars": chars - count(_SPACE),
        "n_symbols": count(_SYMBOL),
        "n_dup_lines": dup,
        "n_repeat_words": repeated_window_words(w, rows),
        "n_distinct": np.bincount(pairs.astype(np.int64), minlength=rows),
        "n_upper": count(_UPPER),
        "n_shout": count(_SHOUT),
        "n_digits": count(_DIGIT),
        "n_punct": count(_PUNCT),
        "n_lines": _per_row((raw == 10).astype(np.uint8), offsets) + 1,
        "n_codepoints": chars,
    }


COUNTS = ("n_words word_chars n_symbols n_dup_lines n_repeat_words n_distinct n_upper n_shout n_digits n_punct "
          "n_lines n_codepoints").split()


def ratios(s: dict[str, np.ndarray]) -> np.ndarray:
    """Length-free rule statistics from the counts: one row per document, one column per ``RATIOS`` entry."""
    words_n = np.maximum(s["n_words"], 1).astype(np.float64)
    chars = np.maximum(s["word_chars"], 1).astype(np.float64)
    return np.column_stack([
        s["word_chars"] / words_n,
        s["n_symbols"] / words_n,
        s["n_dup_lines"] / s["n_lines"],
        s["n_repeat_words"] / words_n,
        # distinct words against the usual sub-linear growth with length
        s["n_distinct"] / words_n ** 0.85,
        s["n_upper"] / chars,
        s["n_shout"] / words_n,
        s["n_digits"] / chars,
        s["n_punct"] / words_n,
    ])


RATIOS = ("word_length symbols dup_lines repeat_words distinct upper shout digits punct").split()
