"""Array helpers for texts in Arrow batches: whole batches are handled by numpy, in slices of bounded size.

Task code only. It looks at the UTF-8 bytes of many texts at once, so the cost per word is a few array operations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2_000_000  # texts are handled in slices of about so many bytes; a longer text is a slice of its own
SHINGLE = 5

_RANDOM = np.random.Generator(np.random.PCG64(20_240_101))
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_SHINGLE_BASE = np.uint64(0xD6E8FEB86659FD93)

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
WORD = np.zeros(256, bool)  # letters, digits and all that is not ASCII
WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts on end, and offsets (one more than there are texts); a NULL is an empty text."""
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(texts.type)
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have about ``limit`` bytes together; a longer text is a run of its own."""
    _, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of marked bytes; no run goes on beyond the end of its text."""
    if not len(member):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = member.copy()
    first[1:] &= ~member[:-1]
    inner = offsets[1:-1]
    inner = inner[inner < len(member)]
    first[inner] = member[inner]
    last = member.copy()
    last[:-1] &= ~member[1:]
    inner = inner[inner > 0]
    last[inner - 1] = member[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes, by prefix sums of a polynomial over the whole slice."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    powers = np.full(len(data) + 1, _BASE, np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers[:-1], out=sums[1:])
    # dividing by the power of the start makes the value independent of the place
    inverse = np.full(len(data) + 1, _BASE_INVERSE, np.uint64)
    inverse[0] = 1
    np.multiply.accumulate(inverse, out=inverse)
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def words_of(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the place of each text's first word (one more than there are texts)."""
    starts, ends = runs(member[data], offsets)
    return starts, ends, np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words of each text, and offsets of the texts in them.

    A text with fewer words has one shingle of all its words; a text without words has none.
    """
    counts = np.diff(first)
    out_counts = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    offsets = np.concatenate([[0], np.cumsum(out_counts)])
    if not len(words):
        return np.zeros(0, np.uint64), offsets
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    total = np.zeros(len(words), np.uint64)
    for j in range(size):
        total = total * _SHINGLE_BASE + padded[j:j + len(words)]
    begins = np.repeat(first[:-1] - offsets[:-1], out_counts) + np.arange(offsets[-1])
    out = mix(total[begins])
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        whole = np.uint64(0)
        with np.errstate(over="ignore"):
            for h in words[first[i]:first[i + 1]]:
                whole = whole * _SHINGLE_BASE + h
        out[offsets[i]] = mix(np.array([whole ^ np.uint64(counts[i])]))[0]
    return out, offsets


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places start, start + 1, ... of all runs, on end."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary values cut out of one run of bytes."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])


class PieceStore:
    """Ids of text pieces, each learned once and remembered up to a number of pieces."""

    def __init__(self, learn: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], most: int = 500_000) -> None:
        """``learn`` gives the ids of pieces on end, and their numbers."""
        self.learn, self.most = learn, most
        self._forget()

    def _forget(self) -> None:
        self.pieces, self.ids = pa.array([], pa.string()), np.zeros(0, np.uint32)
        self.at, self.length = np.zeros(0, np.int32), np.zeros(0, np.int32)

    def _add(self, pieces: pa.Array) -> None:
        ids, counts = self.learn(pieces)
        self.at = np.concatenate([self.at, (np.cumsum(counts) - counts + len(self.ids)).astype(np.int32)])
        self.length, self.ids = np.concatenate([self.length, counts.astype(np.int32)]), np.concatenate([self.ids, ids.astype(np.uint32)])
        self.pieces = pa.concat_arrays([self.pieces, pieces])

    def ids_of(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces on end, and offsets (one more than there are pieces)."""
        if len(self.pieces) > self.most:
            self._forget()
        known = pc.index_in(pieces, value_set=self.pieces) if len(self.pieces) else pa.nulls(len(pieces), pa.int32())
        if known.null_count:
            missing, base = known.is_null(), len(self.pieces)
            self._add(pc.unique(pieces.filter(missing)))
            known = known.fill_null(-1).to_numpy().copy()
            known[known < 0] = base + pc.index_in(pieces.filter(missing), value_set=self.pieces.slice(base)).to_numpy()
        else:
            known = known.to_numpy()
        length = self.length[known]
        ends = np.concatenate([[0], np.cumsum(length, dtype=np.int64)])
        return self.ids[np.arange(ends[-1]) + np.repeat(self.at[known] - ends[:-1], length)], ends


def kept_by_worker(kind: str, raw: bytes, make: Callable[[bytes], object]) -> object:
    """What ``make`` makes of ``raw``, made once by a Python worker, which keeps it from task to task."""
    import sys
    import types
    import zlib
    kept = sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker")).__dict__
    name = f"{kind}:{zlib.crc32(raw)}:{len(raw)}"
    if name not in kept:
        kept[name] = make(raw)
    return kept[name]
