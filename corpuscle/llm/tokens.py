"""Problem 8: the whole corpus as token ids of a public byte-level BPE, by monoid tree reduction.

The ids of a text form a monoid: two encoded halves are joined by encoding a window around the seam again. The
window grows until both its ends lie on *seams of the pre-tokenizer* (places where a piece ends whatever stands
left and right of them), so that no token outside it can change; if it reaches both ends, the span is encoded
as a whole. Short texts are the leaves of the tree, so that they cost one call.

Defined results: a null or empty text gives an empty list; strings that look like special tokens are ordinary
text; blanks are kept. A text is one row; its tree bounds the work of the tokenizer's single calls, and rows are
encoded where they are read, without a shuffle.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame

TOKENIZERS = os.environ.get("CORPUSCLE_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k"

#: Fixed value: the public pre-tokenizer pattern of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: A seam: a piece of PATTERN ends between the two characters in any context, as no alternative matches across a
#: change from a letter to a non-letter, from a digit to a non-digit, or from a mark to a blank. Only characters whose
#: class is the same in every version of Unicode are used; missing a seam only makes a window grow.
SEAM = re.compile(
    r"(?<=[A-Za-zÀ-ÖØ-öА-яا-غ一-龥])(?=[ \n0-9,.;:!?()%/،。，])"
    r"|(?<=[0-9])(?=[ \nA-Za-z,.;:!?()%/。，])"
    r"|(?<=[,.;:!?()%/،。，])(?=[ \n])"
)
#: Leaves of the tree, in characters; the first window takes so many characters on either side of a seam.
LEAF, WINDOW = 16_384, 48


@lru_cache(maxsize=4)
def encoding(folder: str = TOKENIZERS, name: str = VOCABULARY):
    """The tokenizer, made once in each Python worker."""
    import tiktoken

    lines = Path(folder, f"{name}.tiktoken").read_bytes().splitlines()
    ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line)}
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def token_bytes(folder: str = TOKENIZERS, name: str = VOCABULARY) -> tuple[bytes, ...]:
    made = encoding(folder, name)
    return tuple(made.decode_single_token_bytes(i) for i in range(made.n_vocab))


class Tree:
    """Encodes texts by halves and decodes lists of ids."""

    def __init__(self, folder: str = TOKENIZERS, name: str = VOCABULARY, leaf: int = LEAF, window: int = WINDOW):
        self.plain = encoding(folder, name).encode_ordinary
        self.raw = token_bytes(folder, name)
        self.leaf, self.window = max(leaf, 2), max(window, 1)

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        return self.plain(text) if len(text) <= self.leaf else self._span(text)

    def _span(self, text: str) -> list[int]:
        if len(text) <= self.leaf:
            return self.plain(text)
        middle = len(text) // 2
        return self._join(text, middle, self._span(text[:middle]), self._span(text[middle:]))

    def _join(self, text: str, middle: int, left: list[int], right: list[int]) -> list[int]:
        """The ids of ``text`` from those of its parts before and after ``middle``."""
        width = self.window
        while True:
            low, high = max(0, middle - width), min(len(text), middle + width)
            # a seam is proven by the two characters around it, which must lie in the same half
            start = self._first_seam(text, low, middle)
            stop = self._last_seam(text, middle, high)
            if start is None and low == 0:
                start = 0
            if stop is None and high == len(text):
                stop = len(text)
            if start is not None and stop is not None:
                break
            width *= 2
        keep_left = self._without_tail(left, len(text[start:middle].encode()))
        keep_right = self._without_head(right, len(text[middle:stop].encode()))
        return keep_left + self.plain(text[start:stop]) + keep_right

    @staticmethod
    def _first_seam(text: str, low: int, high: int) -> int | None:
        found = SEAM.search(text[low:high])
        return None if found is None else low + found.start()

    @staticmethod
    def _last_seam(text: str, low: int, high: int) -> int | None:
        last = None
        for last in SEAM.finditer(text[low:high]):
            pass
        return None if last is None else low + last.start()

    def _without_tail(self, ids: list[int], size: int) -> list[int]:
        at = len(ids)
        while size > 0:
            at -= 1
            size -= len(self.raw[ids[at]])
        assert size == 0, "a seam cut through a token"
        return ids[:at]

    def _without_head(self, ids: list[int], size: int) -> list[int]:
        at = 0
        while size > 0:
            size -= len(self.raw[ids[at]])
            at += 1
        assert size == 0, "a seam cut through a token"
        return ids[at:]

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``: bytes are joined up the tree, so a character whose bytes lie in both halves is whole again."""
        return self._bytes(ids).decode("utf-8", errors="replace")

    def _bytes(self, ids: list[int]) -> bytes:
        if len(ids) <= self.leaf:
            return b"".join(self.raw[i] for i in ids)
        middle = len(ids) // 2
        return self._bytes(ids[:middle]) + self._bytes(ids[middle:])


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def token_ids(documents: DataFrame, key: str = "doc_id", text: str = "text", folder: str = TOKENIZERS, name: str = VOCABULARY, leaf: int = LEAF) -> DataFrame:
    """``key`` and ``ids`` of every row; null and empty texts have empty lists, repeated rows are kept."""
    source = documents.select(key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree(folder, name, leaf)
        kind = pa.list_(pa.int32())
        for part in _slices(batches):
            ids = pa.array([tree.encode(x) for x in part.column(1).to_pylist()], kind)
            yield pa.RecordBatch.from_arrays([part.column(0), ids], [key, "ids"])

    return source.mapInArrow(run, f"{_quoted(key)} {source.schema[key].dataType.simpleString()}, ids array<int>")


def token_counts(documents: DataFrame, key: str = "doc_id", text: str = "text", folder: str = TOKENIZERS, name: str = VOCABULARY) -> DataFrame:
    """``key`` and ``n_tokens`` of every row, by the same tree; 0 for null and empty texts."""
    source = documents.select(key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree(folder, name)
        for part in _slices(batches):
            sizes = pa.array([len(tree.encode(x)) for x in part.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), sizes], [key, "n_tokens"])

    return source.mapInArrow(run, f"{_quoted(key)} {source.schema[key].dataType.simpleString()}, n_tokens bigint")


def round_trip(documents: DataFrame, key: str = "doc_id", text: str = "text", folder: str = TOKENIZERS, name: str = VOCABULARY, leaf: int = LEAF) -> DataFrame:
    """``key``, ``n_ids`` and ``same``: whether decoding the ids gives the text back (a null text counts as empty)."""
    source = documents.select(key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree(folder, name, leaf)
        for part in _slices(batches):
            texts = [x or "" for x in part.column(1).to_pylist()]
            ids = [tree.encode(x) for x in texts]
            same = [tree.decode(i) == x for i, x in zip(ids, texts, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(i) for i in ids], pa.int64()), pa.array(same, pa.bool_())], [key, "n_ids", "same"])

    return source.mapInArrow(run, f"{_quoted(key)} {source.schema[key].dataType.simpleString()}, n_ids bigint, same boolean")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
