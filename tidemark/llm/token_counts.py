"""Token counts by batch encoding in Arrow functions that return lengths only.

Texts are cut into slices of about equal bytes, each slice into pieces at safe
boundaries (spaces and line feeds), and the pieces that a worker has not met
lately are encoded together.  Only the piece lengths leave the tokenizer; a
document's count is the sum over its pieces.  Nothing is shuffled.

Safe boundaries hold for tokenizers that drop white space between words, which
is checked when the tokenizer is loaded.  Cases: a null or empty text has 0
tokens; a long run without spaces is one piece; repeated rows are counted each.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textstats as ts

CALL_BYTES = 256 << 10  # bytes of pieces in one encoder call
MEMO_PIECES = 400_000  # piece lengths a worker remembers
MEMO_CHARS = 64  # longer pieces are not remembered


class PieceLengths:
    """Token counts of space-free pieces, with a bounded memory of recent ones."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        probe = [e.ids for e in self.tok.encode_batch(["ab 1,", "cd", "ab 1,\n  cd "], add_special_tokens=False)]
        if probe[0] + probe[1] != probe[2]:
            raise ValueError(f"{path}: this tokenizer keeps white space; texts cannot be cut at spaces")
        self.memo = ts.Recent(MEMO_PIECES)

    def __call__(self, pieces: list[str]) -> np.ndarray:
        memo = self.memo
        out = np.zeros(len(pieces), np.int64)
        todo, size = [], 0
        for i, p in enumerate(pieces):
            n = memo.get(p)
            if n is not None:
                out[i] = n
                continue
            todo.append(i)
            size += len(p)
            if size >= CALL_BYTES:
                self._encode(pieces, todo, out)
                todo, size = [], 0
        self._encode(pieces, todo, out)
        return out

    def _encode(self, pieces: list[str], todo: list[int], out: np.ndarray) -> None:
        for i, e in zip(todo, self.tok.encode_batch([pieces[i] for i in todo], add_special_tokens=False)):
            out[i] = n = len(e)
            if len(pieces[i]) <= MEMO_CHARS:
                self.memo.put(pieces[i], n)


def slice_counts(texts: pa.Array, lengths: PieceLengths) -> np.ndarray:
    """Tokens of each text of a slice."""
    parts = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
    row = pc.list_parent_indices(parts).to_numpy(zero_copy_only=False)
    enc = parts.flatten().dictionary_encode()
    per_piece = lengths(enc.dictionary.to_pylist())
    code = enc.indices.to_numpy(zero_copy_only=False)
    return np.bincount(row, weights=per_piece[code], minlength=len(texts)).astype(np.int64)


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = PieceLengths(tokenizer_path)  # for this task only: a worker that lives on keeps no table
        for batch in ts.lean_batches(batches):
            for start, texts in ts.slices(batch.column(1)):
                n = slice_counts(texts, lengths)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), pc.binary_length(texts).cast(pa.int64()), pa.array(n),
                     pa.array(n > limit)], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(
        run, f"{id_col} {dict(docs.dtypes)[id_col]}, n_bytes long, n_tokens long, over_limit boolean")
