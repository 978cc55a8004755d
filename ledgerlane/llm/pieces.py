"""Merge-type piece encoding with seeded merge-dropout, and its inverse.

The vocabulary is a public file of the installed sentencepiece library, whose path is a parameter.
Encoding keeps an agenda of candidate merges of neighbouring symbols, best score first and leftmost
among equals. A candidate is skipped for good when a keyed hash of its place falls below the dropout
rate; the key is the seed, the row's key and the place of the chunk in its text, so every occurrence
of a chunk draws its own merges, and the same ones when the row is encoded again. What is remembered
is the pieces of a chunk where certain candidates are skipped, with the other candidates that come up on
the way to them: an occurrence that skips the former and none of the latter has those pieces, and any
other occurrence is merged by itself. With dropout 0 the pieces are those of the library itself.

Every character has an encoding (bytes stand for characters outside the vocabulary, and for a
literal U+2581), so decoding gives back the exact text. A null text has null pieces, an empty text
none. Repeated rows get equal pieces.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlane.llm.memory import give_back

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 7
#: Chunks up to this length are merged side by side in arrays, longer ones each with a heap.
SIDE_BY_SIDE_CHARS = 32
#: So many of them, which fit a CPU's cache.
ROWS_AT_ONCE = 4096
#: So many characters are looked at together, which bounds the memory of a task.
BLOCK_CHARS = 1 << 21
REMEMBERED_CHUNKS = 400_000
REMEMBERED_PATHS = 600_000
#: A path is worked out when so many occurrences in a block take it.
PATH_TIMES = 4
#: Occurrences whose candidates are looked at together.
OCCURRENCES_AT_ONCE = 1 << 15
#: Remembered paths skip up to so many candidates.
PATH_SKIPS = 4

_MASK = (1 << 64) - 1
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
#: No piece of the vocabulary has a letter followed by one of these marks, so a chunk can end there.
_LETTERS, _MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", r".,!?;:|*$%&#"
# Nothing is read twice: after the longest run without a mark, either the chunk ends or the rest up to a space belongs to it.
_REST = rf"(?:(?<=[{_LETTERS}])(?=[{_MARKS}])|[^ \n]*+)"
_CHUNK = re.compile(rf" ++[^ \n{_MARKS}]*+{_REST}|[^ \n{_MARKS}]++{_REST}|\n|[^ \n]++")
_OVER_AN_END = re.compile(rf"[^ ] |\n|[{_LETTERS}][{_MARKS}]")


class Pieces:
    """The pieces of a model file as arrays. Spaces stand for the library's U+2581."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.texts: list[bytes] = [b""] * self.size
        self.byte_ids = np.zeros(256, dtype=np.int32)
        self.unknown = model.unk_id()
        ids: dict[str, int] = {}
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.texts[i] = bytes([int(piece[3:5], 16)])
                self.byte_ids[self.texts[i][0]] = i
            elif not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i)):
                plain = piece.replace("▁", " ")
                ids[plain] = i
                self.texts[i] = plain.encode()
        self.ids = ids
        # Negative symbols are characters outside the vocabulary; they never merge.
        self.char_ids = np.full(0x110000, -1, dtype=np.int32)
        for piece, i in ids.items():
            if len(piece) == 1:
                self.char_ids[ord(piece)] = i
        scores = sorted({model.get_score(i) for i in ids.values()}, reverse=True)
        place = {score: k for k, score in enumerate(scores)}
        merges = {
            ids[piece[:k]] * self.size + ids[piece[k:]]: (i, place[model.get_score(i)])
            for piece, i in ids.items()
            for k in range(1, len(piece))
            if piece[:k] in ids and piece[k:] in ids
        }
        self.merges = merges
        self.pairs = np.array(sorted(merges), dtype=np.int64)
        self.results = np.array([merges[p][0] for p in self.pairs.tolist()], dtype=np.int32)
        self.ranks = np.array([merges[p][1] for p in self.pairs.tolist()], dtype=np.int32)
        if any(_OVER_AN_END.search(piece) for piece in ids if len(piece) > 1):
            raise ValueError("a piece of this model reaches over a chunk's end")


@functools.cache
def load(path: str = MODEL_PATH) -> Pieces:
    return Pieces(path)


def skip_limit(dropout: float) -> int:
    """Candidates whose hash is below this are skipped."""
    return min(int(dropout * 2**64), _MASK)


def _place_hash(key: int, left: int, middle: int, right: int) -> int:
    x = (key + left * _MIX[0] + middle * _MIX[1] + right * _MIX[2]) & _MASK
    x = ((x ^ (x >> 30)) * _MIX[1]) & _MASK
    x = ((x ^ (x >> 27)) * _MIX[2]) & _MASK
    return x ^ (x >> 31)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[1])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[2])
    return x ^ (x >> np.uint64(31))


def _place_terms(left: np.ndarray, middle: np.ndarray, right: np.ndarray) -> np.ndarray:
    """What a candidate's place adds to the key before it is mixed."""
    mix = [np.uint64(m) for m in _MIX]
    return left.astype(np.uint64) * mix[0] + middle.astype(np.uint64) * mix[1] + right.astype(np.uint64) * mix[2]


def encode_chunk(chunk: str, key: int, dropout: float, pieces: Pieces) -> list[int]:
    """The symbols of one chunk, by a heap of candidate merges. Negative: a character's code point - 2^31."""
    symbols = [int(pieces.char_ids[ord(c)]) for c in chunk]
    n, limit = len(symbols), skip_limit(dropout)
    after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    agenda: list[tuple[int, int, int, int, int]] = []

    def propose(i: int) -> None:
        j = after[i]
        if j < n and symbols[i] >= 0 and symbols[j] >= 0:
            found = pieces.merges.get(symbols[i] * pieces.size + symbols[j])
            if found and (not limit or _place_hash(key, i, j, end[j]) >= limit):
                heapq.heappush(agenda, (found[1], i, j, end[j], found[0]))

    for i in range(n - 1):
        propose(i)
    gone = [False] * n
    while agenda:
        _, i, j, stop, merged = heapq.heappop(agenda)
        if gone[i] or after[i] != j or gone[j] or end[j] != stop:
            continue
        symbols[i], end[i], gone[j] = merged, stop, True
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        if before[i] >= 0:
            propose(before[i])
        propose(i)
    return [s if s >= 0 else ord(chunk[i]) - (1 << 31) for i, s in enumerate(symbols) if not gone[i]]


class Trace:
    """Notes the candidates of chunks, by number and place, and leaves out those that are to be skipped."""

    def __init__(self, skipped: np.ndarray):
        #: Terms of the places to be skipped, a row for each chunk, filled up with 0.
        self.skipped = skipped
        self.owners = [np.zeros(0, dtype=np.int64)]
        self.terms = [np.zeros(0, dtype=np.uint64)]

    def meet(self, found: np.ndarray, numbers: np.ndarray, terms: np.ndarray) -> None:
        at = np.flatnonzero(found)
        found[at] = (terms[at, None] != self.skipped[numbers[at]]).all(axis=1)
        at = np.flatnonzero(found)
        self.owners.append(numbers[at])
        self.terms.append(terms[at])

    def candidates(self) -> Ragged:
        """The terms of each chunk's candidates, in the order in which they came up."""
        owners, terms = np.concatenate(self.owners), np.concatenate(self.terms)
        return Ragged(np.bincount(owners, minlength=len(self.skipped)), terms[np.argsort(owners, kind="stable")])


def _candidates(
    left: np.ndarray, right: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray,
    keys: np.ndarray, dropout: float, pieces: Pieces, numbers: np.ndarray, trace: Trace | None,
) -> tuple[np.ndarray, np.ndarray]:
    """Rank and result of merging neighbours; a rank of the vocabulary's size where there is none."""
    wanted = left.astype(np.int64) * pieces.size + right
    wanted[(left < 0) | (right < 0)] = -1
    at = np.searchsorted(pieces.pairs, wanted)
    at[at == len(pieces.pairs)] = 0
    found = pieces.pairs[at] == wanted
    if dropout:
        found &= _mixed(keys + _place_terms(start, middle, end)) >= np.uint64(skip_limit(dropout))
    if trace is not None:
        trace.meet(found, numbers, _place_terms(start, middle, end))
    return np.where(found, pieces.ranks[at], np.int32(pieces.size)), np.where(found, pieces.results[at], np.int32(0))


def _merge_side_by_side(
    codes: np.ndarray, keys: np.ndarray, dropout: float, pieces: Pieces, numbers: np.ndarray, trace: Trace | None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and symbols of chunks of one length, as they get ready: each round every chunk still
    going makes its best merge."""
    rows, width = codes.shape
    symbols = pieces.char_ids[codes]
    symbols = np.where(symbols < 0, codes - (1 << 31), symbols).astype(np.int32)
    starts = np.broadcast_to(np.arange(width + 1, dtype=np.int16), (rows, width + 1)).copy()
    places = np.arange(rows)
    ranks, results = _candidates(
        symbols[:, :-1].ravel(), symbols[:, 1:].ravel(), starts[:, :-2].ravel(), starts[:, 1:-1].ravel(),
        starts[:, 2:].ravel(), np.repeat(keys, width - 1), dropout, pieces, np.repeat(numbers, width - 1), trace,
    )
    ranks, results = ranks.reshape(rows, width - 1), results.reshape(rows, width - 1)
    while width > 1 and len(places):
        best = ranks.argmin(axis=1)
        going = ranks[np.arange(len(places)), best] < pieces.size
        if not going.all():
            yield places[~going], symbols[~going]
            symbols, starts, ranks, results = symbols[going], starts[going], ranks[going], results[going]
            places, keys, best = places[going], keys[going], best[going]
        row = np.arange(len(places))
        symbols[row, best] = results[row, best]
        # Close the gap behind the merged symbol.
        behind = np.arange(width) > best[:, None]
        symbols = np.where(behind[:, : width - 1], symbols[:, 1:], symbols[:, :-1])
        starts = np.where(behind, starts[:, 1:], starts[:, :-1])
        width -= 1
        if width == 1:
            break
        behind = np.arange(width - 1) >= best[:, None]
        ranks, results = np.where(behind, ranks[:, 1:], ranks[:, :-1]), np.where(behind, results[:, 1:], results[:, :-1])
        for at in (best - 1, best):
            near = np.flatnonzero((at >= 0) & (at < width - 1))
            k = at[near]
            ranks[near, k], results[near, k] = _candidates(
                symbols[near, k], symbols[near, k + 1], starts[near, k], starts[near, k + 1], starts[near, k + 2],
                keys[near], dropout, pieces, numbers[places[near]], trace,
            )
    if len(places):
        yield places, symbols


def _with_bytes(symbols: Sequence[int], pieces: Pieces) -> list[int]:
    ids: list[int] = []
    for s in symbols:
        ids.extend([s] if s >= 0 else pieces.byte_ids[list(chr(s + (1 << 31)).encode("utf-8", "surrogatepass"))].tolist())
    return ids


class Ragged:
    """Rows of numbers, one after the other in a flat array."""

    def __init__(self, lengths: np.ndarray, flat: np.ndarray):
        self.lengths, self.flat = lengths, flat
        self.starts = np.cumsum(lengths) - lengths

    def slots(self, rows: np.ndarray) -> np.ndarray:
        """Where the numbers of these rows are in the flat array."""
        lengths = self.lengths[rows]
        ends = np.cumsum(lengths)
        return np.repeat(self.starts[rows] - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)

    def take(self, rows: np.ndarray) -> np.ndarray:
        """The numbers of these rows, joined."""
        return self.flat[self.slots(rows)]

    def extended(self, other: Ragged) -> Ragged:
        return Ragged(np.concatenate([self.lengths, other.lengths]), np.concatenate([self.flat, other.flat]))


def encode_chunks(
    chunks: Sequence[str], keys: Sequence[int], dropout: float, pieces: Pieces, trace: Trace | None = None
) -> Ragged:
    """The piece ids of every chunk. ``trace`` is for chunks merged side by side."""
    sizes = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
    hashes = np.array(keys, dtype=np.uint64)
    lengths = np.zeros(len(chunks), dtype=np.int64)
    ready: list[tuple[np.ndarray, np.ndarray]] = []
    single: list[tuple[int, list[int]]] = []
    groups = [(size, np.flatnonzero(sizes == size)) for size in np.unique(sizes).tolist()]
    for size, places in ((size, group[k : k + ROWS_AT_ONCE]) for size, group in groups for k in range(0, len(group), ROWS_AT_ONCE)):
        if size > SIDE_BY_SIDE_CHARS:
            for i in places.tolist():
                single.append((i, _with_bytes(encode_chunk(chunks[i], keys[i], dropout, pieces), pieces)))
            continue
        joined = "".join([chunks[i] for i in places.tolist()]).encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(joined, dtype="<u4").astype(np.int64).reshape(len(places), size)
        for own, symbols in _merge_side_by_side(codes, hashes[places], dropout, pieces, places, trace):
            plain = (symbols >= 0).all(axis=1)
            for i in np.flatnonzero(~plain).tolist():
                single.append((int(places[own[i]]), _with_bytes(symbols[i].tolist(), pieces)))
            ready.append((places[own[plain]], symbols[plain].astype(np.int32)))
            lengths[places[own[plain]]] = symbols.shape[1]
    for i, ids in single:
        lengths[i] = len(ids)
    out = Ragged(lengths, np.empty(lengths.sum(), dtype=np.int32))
    for places, symbols in ready:
        out.flat[out.starts[places][:, None] + np.arange(symbols.shape[1])] = symbols
    for i, ids in single:
        out.flat[out.starts[i] : out.starts[i] + len(ids)] = ids
    return out


def _split(text: str) -> list[str]:
    return _CHUNK.findall(" " + text) if text else []


class Encoder:
    """Encodes texts together. Every occurrence of a chunk draws its own skips; the paths that several
    occurrences take are worked out once while they are remembered."""

    def __init__(self, pieces: Pieces, dropout: float = DROPOUT, seed: int = SEED):
        self.pieces, self.dropout, self.seed = pieces, dropout, seed
        self._forget()

    def _forget(self) -> None:
        #: Number of each chunk, given when it is first asked for.
        self.known: defaultdict[str, int] = defaultdict(count().__next__)
        #: The path of each known chunk that skips nothing; -1 where it is not worked out.
        self.roots = np.zeros(0, dtype=np.int64)
        # By path: pieces, candidates skipped, other candidates that come up, and the path that skips one of these as well.
        self.ids = Ragged(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32))
        self.skipped = np.zeros((0, PATH_SKIPS), dtype=np.uint64)
        self.terms = Ragged(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64))
        self.next = np.zeros(0, dtype=np.int64)

    def _keys(self, cuts: list[list[str]], keys: Sequence[object]) -> np.ndarray:
        """The hash key of each chunk of these texts, one after the other."""
        own = np.array([xxhash.xxh64_intdigest(repr(key), self.seed) for key in keys], dtype=np.uint64)
        sizes = np.fromiter(map(len, cuts), dtype=np.int64, count=len(cuts))
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return _mixed(np.repeat(own, sizes) + (place + 1).astype(np.uint64) * np.uint64(_MIX[0]))

    def _work_out(self, chunks: list[str], skipped: np.ndarray) -> np.ndarray:
        """New paths of these chunks, each skipping its own candidates."""
        first, trace = len(self.ids.lengths), Trace(skipped)
        self.ids = self.ids.extended(encode_chunks(chunks, [0] * len(chunks), 0, self.pieces, trace))
        self.skipped = np.concatenate([self.skipped, skipped])
        self.terms = self.terms.extended(trace.candidates())
        self.next = np.append(self.next, np.full(len(self.terms.flat) - len(self.next), -1))
        return np.arange(first, first + len(chunks))

    def _first_skips(self, paths: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of these occurrences skip a candidate of their path, and where the first such is in ``terms``.
        A path has many candidates, so a bounded number of occurrences is looked at together."""
        parts = [
            (k + owners, slots)
            for k in range(0, max(1, len(paths)), OCCURRENCES_AT_ONCE)
            for owners, slots in [self._skips_of(paths[k : k + OCCURRENCES_AT_ONCE], keys[k : k + OCCURRENCES_AT_ONCE])]
        ]
        owners, slots = zip(*parts)
        return np.concatenate(owners), np.concatenate(slots)

    def _skips_of(self, paths: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slots = self.terms.slots(paths)
        lengths = self.terms.lengths[paths]
        below = np.flatnonzero(_mixed(np.repeat(keys, lengths) + self.terms.flat[slots]) < np.uint64(skip_limit(self.dropout)))
        owners = np.repeat(np.arange(len(paths)), lengths)[below]
        first = np.append(True, owners[1:] != owners[:-1])[: len(owners)]
        return owners[first], slots[below[first]]

    def _paths(self, flat: list[str], numbers: np.ndarray, drawn: np.ndarray) -> np.ndarray:
        """The path of each occurrence, -1 where it is not worth remembering."""
        found = np.full(len(flat), -1, dtype=np.int64)
        paths = self.roots[numbers]
        going = np.flatnonzero(paths >= 0)
        for depth in range(PATH_SKIPS + 1):
            paths = paths[paths >= 0] if depth else paths[going]
            skip, slots = self._first_skips(paths, drawn[going])
            clean = np.ones(len(going), dtype=bool)
            clean[skip] = False
            found[going[clean]] = paths[clean]
            if depth == PATH_SKIPS or not len(skip):
                break
            going, paths = going[skip], paths[skip]
            missing = np.flatnonzero(self.next[slots] < 0)
            new, at, times = np.unique(slots[missing], return_index=True, return_counts=True)
            new, at = new[times >= PATH_TIMES], missing[at[times >= PATH_TIMES]]
            skipped = self.skipped[paths[at]]
            skipped[:, depth] = self.terms.flat[new]
            self.next[new] = self._work_out([flat[i] for i in going[at].tolist()], skipped)
            paths = self.next[slots]
            going = going[paths >= 0]
        return found

    def encode(self, texts: Sequence[str], keys: Sequence[object]) -> list[np.ndarray]:
        if len(self.known) > REMEMBERED_CHUNKS or len(self.ids.lengths) > REMEMBERED_PATHS:
            self._forget()
        cuts = [_split(text) for text in texts]
        before = len(self.known)
        flat = list(chain.from_iterable(cuts))
        numbers = np.fromiter(map(self.known.__getitem__, flat), dtype=np.int64, count=len(flat))
        self.roots = np.append(self.roots, np.full(len(self.known) - before, -1, dtype=np.int64))
        # Chunks that come again; those longer than SIDE_BY_SIDE_CHARS are always merged by themselves.
        first, at, times = np.unique(numbers, return_index=True, return_counts=True)
        wanted = at[((times > 1) | (first < before)) & (self.roots[first] < 0)].tolist()
        wanted = [i for i in wanted if len(flat[i]) <= SIDE_BY_SIDE_CHARS]
        self.roots[numbers[wanted]] = self._work_out([flat[i] for i in wanted], np.zeros((len(wanted), PATH_SKIPS), dtype=np.uint64))
        drawn = self._keys(cuts, keys)
        paths = self._paths(flat, numbers, drawn)
        single = np.flatnonzero(paths < 0)
        paths[single] = np.arange(len(self.ids.lengths), len(self.ids.lengths) + len(single))
        ids = self.ids.extended(
            encode_chunks([flat[i] for i in single.tolist()], drawn[single].tolist(), self.dropout, self.pieces)
        )
        ends = np.cumsum([len(cut) for cut in cuts], dtype=np.int64)
        return [ids.take(paths[end - len(cut) : end]) for cut, end in zip(cuts, ends.tolist())]


def decode(ids: Iterable[int], pieces: Pieces) -> str:
    """The exact text that was encoded: the first piece starts with the space put before it."""
    return b"".join(map(pieces.texts.__getitem__, ids))[1:].decode("utf-8", "surrogatepass")


PIECE_FIELDS = [
    T.StructField("piece_ids", T.ArrayType(T.IntegerType())),
    T.StructField("n_pieces", T.IntegerType()),
    T.StructField("lossless", T.BooleanType()),
]


def _blocks(lengths: list[int | None]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about BLOCK_CHARS characters; a null text has no length."""
    start, total = 0, 0
    for i, length in enumerate(lengths):
        total += length or 0
        if total >= BLOCK_CHARS:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(lengths):
        yield start, len(lengths)


def encode_documents(
    docs: DataFrame,
    text_column: str = "text",
    key_column: str = "doc_id",
    dropout: float = DROPOUT,
    seed: int = SEED,
    model_path: str = MODEL_PATH,
) -> DataFrame:
    """``docs`` with piece_ids, n_pieces and lossless (whether decoding gave the text back; null for null).

    Columns of ``docs`` that have these names are replaced.
    """
    fields = {f.name for f in PIECE_FIELDS}
    kept = docs.drop(*(c for c in docs.columns if c.lower() in fields))
    schema = T.StructType([*kept.schema.fields, *PIECE_FIELDS])
    text_at, key_at = kept.columns.index(text_column), kept.columns.index(key_column)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model_path)
        encoder = Encoder(pieces, dropout, seed)
        for batch in batches:
            keys = batch.column(key_at).to_pylist()
            for start, stop in _blocks(pc.utf8_length(batch.column(text_at)).to_pylist()):
                own = batch.column(text_at).slice(start, stop - start).to_pylist()
                ids = encoder.encode([t or "" for t in own], keys[start:stop])
                missing = np.array([t is None for t in own])
                lengths = np.array([len(i) for i in ids], dtype=np.int32)
                offsets = pa.array(np.append(0, np.cumsum(lengths)), pa.int32(), mask=np.append(missing, False))
                same = [decode(i.tolist(), pieces) == (t or "") for t, i in zip(own, ids)]
                added = [
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids), pa.int32())),
                    pa.array(lengths, pa.int32(), mask=missing),
                    pa.array(same, pa.bool_(), mask=missing),
                ]
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([*part.columns, *added], names=[*batch.schema.names, *fields_in_order])
                del own, ids, missing, lengths, offsets, same, added, part
                give_back()
            del batch, keys
        del encoder
        give_back()

    fields_in_order = [f.name for f in PIECE_FIELDS]
    return kept.mapInArrow(encode, schema)


def decode_documents(encoded: DataFrame, ids_column: str = "piece_ids", model_path: str = MODEL_PATH) -> DataFrame:
    """``encoded`` with the decoded ``text`` (null for null ids)."""

    @F.pandas_udf("string")
    def decoded(ids):
        pieces = load(model_path)
        return ids.map(lambda row: None if row is None else decode(row, pieces))

    return encoded.withColumn("text", decoded(F.col(ids_column)))
