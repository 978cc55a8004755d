"""Token counts that follow edits, by a segment tree of pre-token runs per document.

A text is cut into leaves: runs of whole pre-tokens. Where letters, digits and other characters meet, or
white space follows any of them, one pre-token always ends and the next begins, whatever stands around
it (an apostrophe before a letter aside), so a leaf has the same tokens alone as in its text. A run of one
kind without white space (a single word, a number, unspaced ideographs) is one pre-token of the
vocabulary itself and stays in one leaf, however long; an edit inside it encodes it whole. A segment tree over the leaves sums characters and tokens. An
edit finds its leaves by descending the sums, takes the leaves that hold the characters beside it as
context, cuts and encodes these anew, and updates the sums above them; all other leaves stay.

Between jobs a tree is kept as its leaves' lengths and counts, beside the text. The vocabulary is a
public file of the installed tiktoken library, whose path is a parameter; strings of special tokens
are ordinary text.

Edits are (start, end, replacement) in characters of the text as the edits before have left it;
places beyond the text mean its end, an end before the start means the start, and a null replacement
is empty. A null text has null counts and stays null; an empty text has no leaf. Null edits are none.
Repeated rows are counted each. Other columns stay; those named like the added ones are replaced.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANKS_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the public vocabulary cuts text into pre-tokens: a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Leaves are cut at the first chance after so many characters; a leaf of over LARGE_LEAF times as many,
#: grown by edits, is cut anew.
LEAF_CHARS = 256
LARGE_LEAF = 8

#: A pre-token holds letters, digits or other characters, each behind at most one space, or white space; so it
#: ends where the kind changes, but never after white space, nor between an apostrophe and a letter.
_CUT = regex.compile(
    r"\p{L}(?=\P{L})|\p{N}(?=\P{N})"
    r"|[^\p{White_Space}\p{L}\p{N}](?=[\p{White_Space}\p{N}])|[^\p{White_Space}\p{L}\p{N}'](?=\p{L})"
)


@functools.cache
def encoding(path: str = RANKS_PATH) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def cut(text: str) -> list[str]:
    """The leaves of a text."""
    leaves, start = [], 0
    while start < len(text):
        found = _CUT.search(text, start + LEAF_CHARS - 1)
        end = found.end() if found else len(text)
        leaves.append(text[start:end])
        start = end
    return leaves


class TokenTree:
    """Sums of characters and tokens over the leaves of one text. Node k has the children 2k and 2k + 1."""

    def __init__(self, leaves: Sequence[str], tokens: Sequence[int], encoder: tiktoken.Encoding):
        self.encoder = encoder
        self.chars_encoded = 0
        self._plant(list(leaves), list(tokens))

    @classmethod
    def of(cls, text: str, encoder: tiktoken.Encoding) -> TokenTree:
        leaves = cut(text)
        return cls(leaves, [len(encoder.encode_ordinary(leaf)) for leaf in leaves], encoder)

    @classmethod
    def kept(cls, text: str, leaf_chars: Sequence[int], leaf_tokens: Sequence[int], encoder: tiktoken.Encoding) -> TokenTree:
        ends = np.cumsum(leaf_chars).tolist()
        return cls([text[end - n : end] for n, end in zip(leaf_chars, ends)], leaf_tokens, encoder)

    def _plant(self, leaves: list[str], tokens: list[int]) -> None:
        self.size = 1 << max(0, len(leaves) - 1).bit_length()
        spare = self.size - len(leaves)
        self.leaves = leaves + [""] * spare
        self.chars, self.tokens = (self._sums([*row, *[0] * spare]) for row in ([len(x) for x in leaves], tokens))

    def _sums(self, row: list[int]) -> list[int]:
        levels = [np.array(row, dtype=np.int64)]
        while len(levels[-1]) > 1:
            levels.append(levels[-1].reshape(-1, 2).sum(axis=1))
        return [0, *(int(x) for level in reversed(levels) for x in level)]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return "".join(self.leaves)

    def filled(self) -> tuple[list[int], list[int]]:
        """Lengths and token counts of the leaves that are not empty."""
        rows = [(c, t) for c, t in zip(self.chars[self.size :], self.tokens[self.size :]) if c]
        return [c for c, _ in rows], [t for _, t in rows]

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, and the place of its first one."""
        node, first = 1, 0
        while node < self.size:
            node *= 2
            if place - first >= self.chars[node]:
                first += self.chars[node]
                node += 1
        return node - self.size, first

    def _set(self, leaf: int, text: str) -> None:
        tokens = len(self.encoder.encode_ordinary(text))
        self.chars_encoded += len(text)
        self.leaves[leaf] = text
        node = leaf + self.size
        chars_more, tokens_more = len(text) - self.chars[node], tokens - self.tokens[node]
        while node:
            self.chars[node] += chars_more
            self.tokens[node] += tokens_more
            node //= 2

    def edit(self, start: int, end: int, replacement: str) -> None:
        n = self.n_chars
        start = min(max(0, start), n)
        end = min(max(start, end), n)
        if not n:
            first = last = offset = 0
        else:
            first, offset = self._leaf_at(max(0, start - 1))
            last, _ = self._leaf_at(min(end, n - 1))
        old = "".join(self.leaves[first : last + 1])
        new = cut(old[: start - offset] + replacement + old[end - offset :])
        slots = last - first + 1
        # What does not fit into the leaves' places makes the last of them larger.
        new = new[: slots - 1] + ["".join(new[slots - 1 :])] + [""] * (slots - 1 - len(new))
        for leaf, text in zip(range(first, last + 1), new):
            if text != self.leaves[leaf]:
                self._set(leaf, text)
        if len(new[slots - 1]) > LARGE_LEAF * LEAF_CHARS and len(parts := cut(new[slots - 1])) > 1:
            place = first + slots - 1
            counts = [len(self.encoder.encode_ordinary(p)) for p in parts]
            tokens = self.tokens[self.size :]
            self._plant(self.leaves[:place] + parts + self.leaves[place + 1 :], tokens[:place] + counts + tokens[place + 1 :])


COUNT_FIELDS = [
    T.StructField("n_tokens", T.LongType()),
    T.StructField("leaf_chars", T.ArrayType(T.IntegerType())),
    T.StructField("leaf_tokens", T.ArrayType(T.IntegerType())),
]
EDIT_FIELDS = [*COUNT_FIELDS, T.StructField("chars_encoded", T.LongType())]
_ARROW = {"n_tokens": pa.int64(), "leaf_chars": pa.list_(pa.int32()), "leaf_tokens": pa.list_(pa.int32()), "chars_encoded": pa.int64()}


def _without(docs: DataFrame, fields: list[T.StructField]) -> DataFrame:
    names = {f.name for f in fields}
    return docs.drop(*(c for c in docs.columns if c.lower() in names))


def _columns(trees: list[TokenTree | None], names: list[str]) -> list[pa.Array]:
    filled = [t.filled() if t else (None, None) for t in trees]
    values = {
        "n_tokens": [t.n_tokens if t else None for t in trees],
        "leaf_chars": [chars for chars, _ in filled],
        "leaf_tokens": [tokens for _, tokens in filled],
        "chars_encoded": [t.chars_encoded if t else None for t in trees],
    }
    return [pa.array(values[n], _ARROW[n]) for n in names]


def count_tokens(docs: DataFrame, text_column: str = "text", path: str = RANKS_PATH) -> DataFrame:
    """``docs`` with n_tokens and the tree's leaves, leaf_chars and leaf_tokens."""
    kept = _without(docs, COUNT_FIELDS)
    text_at, names = kept.columns.index(text_column), [f.name for f in COUNT_FIELDS]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(path)
        for batch in batches:
            trees = [TokenTree.of(t.as_py(), encoder) if t.is_valid else None for t in batch.column(text_at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *_columns(trees, names)], names=[*batch.schema.names, *names])

    return kept.mapInArrow(count, T.StructType([*kept.schema.fields, *COUNT_FIELDS]))


def apply_edits(
    counted: DataFrame, edits_column: str = "edits", text_column: str = "text", path: str = RANKS_PATH
) -> DataFrame:
    """Rows of ``count_tokens`` with their edits applied: the new text, n_tokens, leaf_chars and leaf_tokens,
    and chars_encoded, the number of characters that had to be encoded again. The edits are an array of structs
    (start, end, replacement)."""
    rest = _without(counted, EDIT_FIELDS).drop(edits_column)
    names = [f.name for f in EDIT_FIELDS]
    kept = rest.columns
    given = counted.select(*kept, "leaf_chars", "leaf_tokens", edits_column)
    text_at, width = kept.index(text_column), len(kept)

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(path)
        for batch in batches:
            trees: list[TokenTree | None] = []
            for text, chars, tokens, edits in zip(batch.column(text_at), *batch.columns[width:]):
                tree = TokenTree.kept(text.as_py(), chars.as_py(), tokens.as_py(), encoder) if text.is_valid else None
                for own in (edits.as_py() or []) if tree else []:
                    if own and own["start"] is not None and own["end"] is not None:
                        tree.edit(own["start"], own["end"], own["replacement"] or "")
                trees.append(tree)
            columns = batch.columns[:width]
            columns[text_at] = pa.array([t.text() if t else None for t in trees], pa.string())
            yield pa.RecordBatch.from_arrays([*columns, *_columns(trees, names)], names=[*kept, *names])

    return given.mapInArrow(edit, T.StructType([*rest.schema.fields, *EDIT_FIELDS]))


def sample_edits(text_column: str, id_column: str):
    """Three edits per document: words replaced a third into the text, a note put in at two thirds, and the
    first characters deleted."""
    n = F.length(text_column)
    kind = "struct<start:int,end:int,replacement:string>"
    third, two_thirds = F.floor(n / 3).cast("int"), F.floor(2 * n / 3).cast("int")
    note = F.concat(F.lit(" [note "), F.col(id_column).cast("string"), F.lit("] "))
    return F.array(
        F.struct(third.alias("start"), (third + 8).alias("end"), F.lit(" revised wording").alias("replacement")).cast(kind),
        F.struct(two_thirds.alias("start"), two_thirds.alias("end"), note.alias("replacement")).cast(kind),
        F.struct(F.lit(0).alias("start"), F.lit(5).alias("end"), F.lit("").alias("replacement")).cast(kind),
    )


def counted_and_edited(docs: DataFrame) -> DataFrame:
    """Per document: tokens before and after the sample edits, and how much of the text was encoded again."""
    counted = count_tokens(docs.select("doc_id", "text")).withColumn("edits", sample_edits("text", "doc_id"))
    before = counted.withColumn("n_tokens_before", F.col("n_tokens"))
    return apply_edits(before).select(
        "doc_id",
        F.col("n_tokens_before").alias("n_tokens"),
        F.col("n_tokens").alias("n_tokens_edited"),
        F.size("leaf_chars").alias("n_leaves"),
        F.length("text").alias("n_chars_edited"),
        "chars_encoded",
    )
