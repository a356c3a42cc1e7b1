"""Byte-pair encoding through one table of distinct words, and decoding through an id-to-piece table.

1. Every text is cut into words (an optional space and what follows up to the next
   white space, or a run of white space), the coarsest cut at which a byte-level
   tokenizer always starts afresh.  The documents of a slice (a few MB of text)
   share a list of distinct words, commonest first; each position becomes its
   word's number there.
2. The slices' distinct words are dealt by their hash, so each word of the corpus
   meets in one task from all slices and is encoded there once.
3. The ids return to the slices: a join on the slice and, in it, on the word's
   number gives the ids of every position in order, some documents at a time.
4. Decoding joins every id with its piece of bytes (the vocabulary bounds that table,
   so it lies in every task) and concatenates the pieces.

No text is shuffled, only word numbers and distinct words, both compressed.  A word
that a third of all positions hold is one entry per slice.  The documents are scanned
twice (for the words and for the numbers) and must come in the same order, as files
do; slices carry a check sum of their words, and a difference is an error.

Cases: a null or empty text has no ids and decodes to an empty text; special
strings inside a text are their special id, as in the library; repeated rows are
encoded each; a long run without white space is one word, a very long text a slice of
its own; an empty table gives no rows; extra columns of the input are not read.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textstats as ts
from .tables import partitions

SLICE_BYTES = 16 << 20  # bytes of text in a slice, about
SLICE_IDS = 400_000  # ids decoded, or words given their ids, at once
CALL_WORDS = 5_000  # words in one encoder call


def _lean(run):
    """A function of batches whose worker gives back, when it is through, what it took; lean_batches does so before the last work."""

    @functools.wraps(run)
    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(ts.lean_batches(batches))
        pa.system_memory_pool().release_unused()

    return lean


def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def _specials(path: str) -> list[str]:
    return [t.content for _, t in sorted(_tokenizer(path).get_added_tokens_decoder().items())]


# Fixed value: the white space of the tokenizer's word rule (Unicode White_Space), in UTF-8.
WHITE = [c.encode() for c in "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
                             "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"]
_ASCII_WHITE = np.zeros(256, bool)
_ASCII_WHITE[[w[0] for w in WHITE if len(w) == 1]] = True


def _white(raw: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """Whether the character that starts at each place of ``lead`` is white space."""
    out = _ASCII_WHITE[raw[lead]]
    if len(lead) < len(raw):
        many = np.flatnonzero(np.isin(raw[lead], [w[0] for w in WHITE if len(w) > 1]))
        code = np.zeros(len(many), np.int64)
        padded = np.concatenate((raw, np.zeros(2, np.uint8))).astype(np.int64)
        at = lead[many]
        two = raw[at] < 0xE0
        code = (padded[at] << 16) + (padded[at + 1] << 8) + np.where(two, 0, padded[at + 2])
        out[many] = np.isin(code, [int.from_bytes(w.ljust(3, b"\0"), "big") for w in WHITE if len(w) > 1])
    return out


def words(texts: pa.Array, specials: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The words of a run of texts, in order, and their number in each text; special strings stand alone."""
    raw, offsets = ts._flat(texts)
    if not len(raw):
        return pa.array([], pa.large_string()), np.zeros(len(texts), np.int64)
    begins = np.zeros(len(raw) + 1, bool)  # where a text or a part of it begins
    begins[offsets] = True
    for mark in specials:
        if pc.any(pc.match_substring(texts, mark)).as_py():
            whole, at = raw.tobytes(), -1
            while (at := whole.find(mark.encode(), at + 1)) >= 0:
                if np.searchsorted(offsets, at, "right") == np.searchsorted(offsets, at + len(mark.encode()) - 1, "right"):
                    begins[[at, at + len(mark.encode())]] = True
                    at += len(mark.encode()) - 1
    lead = np.flatnonzero((raw & 0xC0) != 0x80)
    white, edge = _white(raw, lead), begins[lead]
    after = np.zeros(len(lead), bool)  # the character before, in the same part, is white space
    after[1:] = white[:-1] & ~edge[1:]
    spaced = np.zeros(len(lead), bool)
    spaced[1:] = after[1:] & (raw[lead[:-1]] == 0x20)
    leads = np.zeros(len(lead), bool)  # the character behind, in the same part, is none
    leads[:-1] = ~white[1:] & ~edge[1:]
    # A run of white space is a word; its last character starts the next one (a space) or stands alone.
    start = edge | np.where(white, ~after | leads, after & ~spaced)
    at = lead[start]
    ends = np.append(at, len(raw)).astype(np.int64)
    out = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(raw)))
    return out, np.diff(np.searchsorted(at, offsets))


def _packed(x: np.ndarray) -> bytes:
    """Numbers as compressed byte planes: small ones take little."""
    x = np.ascontiguousarray(x, np.uint32)
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 4).T), codec="zstd", asbytes=True)


def _planes(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, decompressed_size=4 * n, codec="zstd"), np.uint8).reshape(4, n)


def _from_planes(planes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(planes.T).view(np.int32).reshape(-1)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    return _from_planes(_planes(data, n))


def _packed_strings(x: pa.Array) -> tuple[bytes, bytes]:
    """(lengths, bytes) of strings, compressed."""
    x = x.cast(pa.large_binary())
    raw, offsets = ts._flat(x)
    return _packed(np.diff(offsets)), pa.compress(raw.tobytes(), codec="zstd", asbytes=True)


def _unpacked_strings(lengths: bytes, data: bytes, n: int) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum(_unpacked(lengths, n))))
    raw = pa.decompress(data, decompressed_size=int(ends[-1]), codec="zstd")
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer(ends), raw)


class _Slice:
    """Documents gathered until they are a slice.  Of each run of texts the word numbers and distinct words stay, no text."""

    def __init__(self):
        self.ids, self.sizes, self.codes, self.distinct, self.bytes = [], [], [], [], 0

    def add(self, ids: pa.Array, texts: pa.Array, found: pa.Array, sizes: np.ndarray) -> None:
        enc = found.dictionary_encode()
        self.ids.append(ids.take(pa.array(np.arange(len(ids)))))  # a copy: a slice of the column would hold its whole batch
        self.sizes.append(sizes.astype(np.int32))
        self.codes.append(enc.indices.to_numpy(zero_copy_only=False))
        self.distinct.append(enc.dictionary)
        self.bytes += pc.sum(pc.binary_length(texts)).as_py() or 0

    def ranked(self) -> tuple[list[np.ndarray], pa.Array]:
        """For each run, the number of each of its distinct words; the slice's distinct words by number, commonest first."""
        enc = pa.concat_arrays(self.distinct).dictionary_encode()
        cuts = np.cumsum([len(x) for x in self.distinct])[:-1]
        runs, count = np.split(enc.indices.to_numpy(zero_copy_only=False), cuts), np.zeros(len(enc.dictionary), np.int64)
        for run, code in zip(runs, self.codes):
            count[run] += np.bincount(code, minlength=len(run))
        order = np.argsort(-count, kind="stable")
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order))
        return [place[run] for run in runs], enc.dictionary.take(pa.array(order))

    def numbers(self, slice_id: int) -> pa.RecordBatch:
        """The slice as one row: word numbers, document sizes and ids."""
        runs, distinct = self.ranked()
        code = np.concatenate([run[code] for run, code in zip(runs, self.codes)])
        sizes, flat = np.concatenate(self.sizes), pa.concat_arrays(self.ids)
        row = [slice_id, _check(distinct), len(code), _packed(code), len(sizes), _packed(sizes), len(distinct)]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip(row, kinds)]
            + [pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)],
            names=["slice", "check", "n_words", "codes", "n_docs", "sizes", "n_distinct", "ids"])

    def dealt(self, slice_id: int, parts: int) -> pa.RecordBatch:
        """The slice's distinct words by their hash, in their order; ``steps`` are the differences of their numbers."""
        _, distinct = self.ranked()
        n, raw = len(distinct), distinct.cast(pa.large_binary())
        part = np.fromiter((zlib.crc32(w) for k in range(0, n, CALL_WORDS) for w in raw.slice(k, CALL_WORDS).to_pylist()),
                           np.int64, n) % parts
        order = np.argsort(part, kind="stable")
        used, begin = np.unique(part[order], return_index=True)
        spans = list(zip(begin, np.append(begin[1:], n)))
        packed = [_packed_strings(distinct.take(pa.array(order[a:b]))) for a, b in spans]
        return pa.RecordBatch.from_arrays([
            pa.array(used.astype(np.int32)), pa.array(np.full(len(used), slice_id)), pa.array(np.full(len(used), _check(distinct))),
            pa.array([int(b - a) for a, b in spans], pa.int64()),
            pa.array([_packed(np.diff(order[a:b], prepend=0)) for a, b in spans], pa.binary()),
            *(pa.array([x[k] for x in packed], pa.binary()) for k in (0, 1))],
            names=["part", "slice", "check", "n", "steps", "word_lengths", "words"])


def _check(distinct: pa.Array) -> int:
    return zlib.crc32(ts._flat(distinct)[0].tobytes())


def _slices(batches: Iterator[pa.RecordBatch], specials: list[str]) -> Iterator[tuple[int, _Slice]]:
    """The slices of a task's documents, numbered over all tasks."""
    number, now = TaskContext.get().partitionId() << 32, _Slice()
    for batch in batches:
        for first, texts in ts.slices(batch.column(1)):
            now.add(batch.column(0).slice(first, len(texts)), texts, *words(texts, specials))
            if now.bytes >= SLICE_BYTES:
                yield number, now
                number, now = number + 1, _Slice()
        batch = texts = None  # they would stay while the next batch is read
    if now.ids:
        yield number, now


def _numbers(docs: DataFrame, path: str, id_type: str) -> DataFrame:
    """One row per slice: its word numbers, document sizes and ids."""
    specials = _specials(path)

    @_lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, now in _slices(batches, specials):
            yield now.numbers(number)

    return docs.mapInArrow(run, "slice long, check long, n_words long, codes binary, n_docs long, sizes binary, "
                                f"n_distinct long, ids array<{id_type}>")


def _deal(docs: DataFrame, path: str, parts: int) -> DataFrame:
    """(part, slice, check, n, steps, word_lengths, words): the distinct words of every slice by their hash."""
    specials = _specials(path)

    @_lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, now in _slices(batches, specials):
            yield now.dealt(number, parts)

    return docs.mapInArrow(run, "part int, slice long, check long, n long, steps binary, word_lengths binary, words binary")


def _encode_words(dealt: DataFrame, path: str) -> DataFrame:
    """(slice, check, n, steps, n_ids, lengths, word_ids): the ids of the dealt words, each distinct word encoded once."""

    @_lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        tok = _tokenizer(path)
        probe = [e.ids for e in tok.encode_batch(["ab 1,", " ", " cd", "ab 1,  cd"], add_special_tokens=False)]
        if probe[0] + probe[1] + probe[2] != probe[3]:
            raise ValueError(f"{path}: this tokenizer does not start afresh at a word's leading space")
        flat = pa.concat_arrays([_unpacked_strings(size, data, n) for b in rows for n, size, data in zip(
            *(b.column(c).to_pylist() for c in ("n", "word_lengths", "words")))]).dictionary_encode()
        distinct, code = flat.dictionary, flat.indices
        table = pa.concat_arrays([
            pa.array([e.ids for e in tok.encode_batch(distinct.slice(k, CALL_WORDS).to_pylist(), add_special_tokens=False)],
                     pa.list_(pa.int32())) for k in range(0, len(distinct), CALL_WORDS)])
        at = 0
        for b in rows:
            out = []
            for n in b.column("n").to_pylist():
                got = table.take(code.slice(at, n))
                at += n
                lengths, values = pc.list_value_length(got).to_numpy(zero_copy_only=False), got.flatten().to_numpy(zero_copy_only=False)
                out.append((len(values), _packed(lengths), _packed(values)))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("slice", "check", "n", "steps")), pa.array([x[0] for x in out], pa.int64()),
                 *(pa.array([x[k] for x in out], pa.binary()) for k in (1, 2))],
                names=["slice", "check", "n", "steps", "n_ids", "lengths", "word_ids"])

    return dealt.select("slice", "check", "n", "steps", "word_lengths", "words").mapInArrow(
        run, "slice long, check long, n long, steps binary, n_ids long, lengths binary, word_ids binary")


def _slice_ids(own: pa.Table, table: pa.Table) -> Iterator[tuple[int, pa.ListArray]]:
    """(first document, ids of each document) of runs of a slice's documents, from word numbers and the ids of distinct words."""
    row = {c: own.column(c)[0].as_py() for c in ("slice", "n_words", "codes", "n_docs", "sizes", "n_distinct")}
    if sum(table.column("n").to_pylist()) != row["n_distinct"]:
        raise ValueError(f"slice {row['slice']}: the two scans of the documents differ")
    sizes, code = _unpacked(row["sizes"], row["n_docs"]), _planes(row.pop("codes"), row["n_words"])
    place, lengths, values = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for n, steps, n_ids, size, ids in zip(*(table.column(c).to_pylist() for c in ("n", "steps", "n_ids", "lengths", "word_ids"))):
        place.append(np.cumsum(_unpacked(steps, n)))
        lengths.append(_unpacked(size, n))
        values.append(_unpacked(ids, n_ids))
    order, length = np.argsort(np.concatenate(place)), np.concatenate(lengths)
    offsets = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values))).take(pa.array(order))
    length, at = length[order], 0
    del own, table, place, lengths, values, order, offsets
    pa.system_memory_pool().release_unused()
    for a, b in _runs(sizes, SLICE_IDS):
        ends = np.concatenate(([0], np.cumsum(sizes[a:b])))
        part = _from_planes(code[:, at: at + ends[-1]])
        at += ends[-1]
        before = np.concatenate(([0], np.cumsum(length[part])))
        yield a, pa.ListArray.from_arrays(pa.array(before[ends].astype(np.int32)), lists.take(pa.array(part)).flatten())


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and the ``ids`` of every text, as the tokenizer library gives them without added special tokens."""
    id_type, parts = dict(docs.dtypes)[id_col], partitions(docs.sparkSession)
    rows = docs.select(id_col, F.col(text_col).cast("string"))
    table = _encode_words(_deal(rows, path, parts).repartition(parts, "part"), path)

    @_lean
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pa.Table.from_batches(batches)
        mine = pc.is_valid(both.column("codes"))
        own, found = both.filter(mine), both.filter(pc.invert(mine))
        if not own.num_rows:
            raise ValueError("words without their slice: the two scans of the documents differ")
        ids = own.column("ids").combine_chunks().flatten()
        runs = _slice_ids(own, found)
        del both, mine, own, found  # the runs let go of them before the first one
        for first, lists in runs:
            yield pa.RecordBatch.from_arrays([ids.slice(first, len(lists)), lists], names=[id_col, "ids"])

    # One stream of rows for each slice, and ids handed on some documents at a time: a cogroup's result would be whole.
    both = _numbers(rows, path, id_type).unionByName(table, allowMissingColumns=True)
    return both.groupBy("slice", "check").applyInArrow(join, f"{id_col} {id_type}, ids array<int>")


def _runs(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    run = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        base = run[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(run, base + most, side="right")))
        yield start, end
        start = end


def _byte_of() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable bytes are themselves, others follow 255."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def pieces(path: str) -> pa.Array:
    """The bytes of each id of the vocabulary."""
    vocab, byte_of = _tokenizer(path).get_vocab(with_added_tokens=True), _byte_of()
    known, to_byte = set(byte_of), str.maketrans({c: chr(b) for c, b in byte_of.items()})
    out = [b""] * (max(vocab.values(), default=-1) + 1)
    for letters, i in vocab.items():
        out[i] = letters.translate(to_byte).encode("latin-1") if known.issuperset(letters) else letters.encode()
    return pa.array(out, pa.binary())


def _text(raw: pa.Array) -> pa.Array:
    try:
        return raw.cast(pa.string())
    except pa.ArrowInvalid:  # ids that cut a character apart
        return pa.array([x.decode("utf-8", "replace") for x in raw.to_pylist()], pa.string())


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids",
           text_col: str = "decoded") -> DataFrame:
    """The input with ``text_col``: the pieces of its ids, joined (special pieces included)."""
    table = pieces(path)

    @_lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            for a, b in _runs(sizes, SLICE_IDS):
                part = lists.slice(a, b - a)
                offsets = np.concatenate(([0], np.cumsum(sizes[a:b]))).astype(np.int32)
                got = pa.ListArray.from_arrays(pa.array(offsets), table.take(part.flatten()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), part, _text(pc.binary_join(got, b""))],
                    names=[id_col, ids_col, text_col])
            batch = lists = part = got = None  # they would stay while the next batch is read

    return encoded.select(id_col, ids_col).mapInArrow(
        run, f"{id_col} {dict(encoded.dtypes)[id_col]}, {ids_col} array<int>, {text_col} string")
