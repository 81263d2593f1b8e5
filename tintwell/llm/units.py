"""Words and units of an Arrow array of texts, found in its bytes as a whole and numbered, so that equal ones are worked once.

No Python object is made for an occurrence: where pieces begin is read off the data buffer, and Arrow's dictionary
encoding says which are equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Longer words and units are worked when they come and not remembered, so that what is remembered is bounded in bytes.
REMEMBERED = 64


def parts(texts: pa.Array, size: int = 1 << 20) -> Iterator[tuple[int, pa.Array]]:
    """(first place, slice) of runs of texts of about ``size`` bytes together; a longer text is a run of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, side="right")))
        yield at, texts.slice(at, to - at)
        at = to


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one behind the other, and where each begins, with the end; a null counts as empty."""
    whole = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    data = np.frombuffer(whole.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _numbered(data: np.ndarray, starts: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Distinct pieces of data, cut at starts, in order of first occurrence, and the number of each piece."""
    if not len(starts):
        return [], np.zeros(0, np.int32)
    offsets = np.append(starts, len(data)).astype(np.int64)
    pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
    return pieces.dictionary.to_pylist(), pieces.indices.to_numpy()


def words(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct words, number of each word, first word of each text with the end); words are parted by ASCII white space."""
    data, edges = _flat(texts)
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inner = edges[:-1][(edges[:-1] < len(data))]
    first[inner] = solid[inner]
    at = np.flatnonzero(first)
    place = np.cumsum(solid, dtype=np.int64) - 1  # of each byte among those of words
    known, numbers = _numbered(data[solid], place[at])
    return known, numbers, np.searchsorted(at, edges)


def spaced_units(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct units, number of each unit, first unit of each text with the end).

    A unit is a line break, or a run of spaces with what follows up to the next space or line break. One space is put in
    front of every text that is not empty.
    """
    data, edges = _flat(texts)
    sizes = np.diff(edges)
    full = sizes > 0
    begin = edges[:-1] + np.cumsum(full) - full
    grown = np.full(len(data) + int(full.sum()), 32, np.uint8)
    own = np.ones(len(grown), bool)
    own[begin[full]] = False
    grown[own] = data
    space, line = grown == 32, grown == 10
    first = line.copy()
    first[1:] |= line[:-1] | (space[1:] & ~space[:-1])
    first[begin[full]] = True
    at = np.flatnonzero(first)
    known, numbers = _numbered(grown, at)
    return known, numbers, np.searchsorted(at, np.append(begin, len(grown)))


def spread(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """values[starts[k] : starts[k] + sizes[k]] for all k, one behind the other."""
    ends = np.cumsum(sizes)
    return values[np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]
