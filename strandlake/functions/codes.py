"""Two-bit codes of windows, in numpy over Arrow columns: for Spark's tasks, linear in bases whatever the length of records.

A, C, G, T are 0 to 3; a window of k <= 31 bases is a number of 2 k bits, so codes sort as their strings do."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MOST = 31
#: Windows looked at at once (a code has 8 bytes).
CHUNK = 1 << 19
_CODE = np.full(256, 4, np.uint8)
_CODE[np.frombuffer(b"ACGT", np.uint8)] = np.arange(4)


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column in one row, and where each value begins and the last one ends; nulls are empty."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if whole.null_count:
        whole = pc.fill_null(whole, b"" if pa.types.is_binary(whole.type) else "")
    ends = np.frombuffer(whole.buffers()[1], np.int64 if whole.type in (pa.large_string(), pa.large_binary()) else np.int32)[whole.offset : whole.offset + len(whole) + 1].astype(np.int64)
    data = whole.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), ends


def values(data: np.ndarray) -> np.ndarray:
    """0 to 3 of bases, 4 of others than ACGT."""
    return _CODE[data]


def is_unknown(data: np.ndarray) -> np.ndarray:
    return _CODE[data] > 3


def rolled(bases: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The codes of all windows of k bases (0 to 3) and of their reverse complements: windows double by joining two halves."""
    n = max(0, len(bases) - k + 1)
    first = bases.astype(np.int64)
    other = 3 - first
    code, turned, size = first, other, 1
    for bit in bin(k)[3:]:
        m = len(code) - size
        code, turned = code[:m] << 2 * size | code[size:], turned[size:] << 2 * size | turned[:m]
        size *= 2
        if bit == "1":
            m = len(code) - 1
            code, turned = code[:m] << 2 | first[size : size + m], other[size : size + m] << 2 * size | turned[:m]
            size += 1
    return code[:n], turned[:n]


class Windows(NamedTuple):
    """Of each window: its row, its 0-based place there, its code and that of its reverse complement, whether all its bases are
    known, and (if asked for) its minimizer."""

    row: np.ndarray
    at: np.ndarray
    code: np.ndarray
    turned: np.ndarray
    known: np.ndarray
    least: np.ndarray | None

    def canonical(self) -> np.ndarray:
        return np.minimum(self.code, self.turned)


def windows(data: np.ndarray, ends: np.ndarray, k: int, minimizer: int = 0, chunk: int = CHUNK) -> Iterator[Windows]:
    """All windows of k within rows, as `flat` gives them, some at a time. A minimizer is the least of a window's own windows
    of so many bases, each on the strand with the lower code, in a mixed order: a function of the k-mer, alike on both strands."""
    rows = np.arange(len(ends) - 1)
    for low in range(int(ends[0]), int(ends[-1]), chunk):
        high = min(low + chunk, int(ends[-1]))
        owner = np.repeat(rows, np.diff(np.clip(ends, low, high)))
        at = np.arange(low, high)
        inside = np.flatnonzero(at + k <= ends[owner + 1])
        if not len(inside):
            continue
        part = _CODE[data[low : min(high + k - 1, int(ends[-1]))]]
        unknown = np.concatenate(([0], np.cumsum(part > 3)))
        code, turned = rolled(part & 3, k)
        least = lowest(mixed(np.minimum(*rolled(part & 3, minimizer))), k - minimizer + 1)[inside] if minimizer else None
        yield Windows(owner[inside], (at - ends[owner])[inside], code[inside], turned[inside], unknown[inside + k] == unknown[inside], least)


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[: len(values) - size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def mixed(codes: np.ndarray) -> np.ndarray:
    """A number for each code, in an order that has nothing to do with its bases; one to one, not negative."""
    h = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h ^ (h >> np.uint64(32))) >> np.uint64(1)).astype(np.int64)


def pack(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Pieces of data (bases as letters) at starts, by parts: the parts there are, and for each its pieces in one value, two
    bits a base. A value is the number of pieces (4 bytes), their sizes (2 bytes each, so under 65,536) and the bases of
    each in whole bytes."""
    order = np.argsort(parts, kind="stable")
    starts, sizes, parts = starts[order], sizes[order], parts[order]
    padded = -(-sizes // 4) * 4
    first = np.concatenate(([0], np.cumsum(padded)))
    place = np.arange(int(first[-1])) - np.repeat(first[:-1], padded)
    bases = _CODE[data[np.repeat(starts, padded) + np.minimum(place, np.repeat(sizes - 1, padded))]].reshape(-1, 4)
    quads = bases[:, 0] << 6 | bases[:, 1] << 4 | bases[:, 2] << 2 | bases[:, 3]
    found, low = np.unique(parts, return_index=True)
    short, ends = sizes.astype(np.uint16), (first // 4).tolist()
    bounds = [*low.tolist(), len(parts)]
    return found, [b"".join((np.uint32(j - i).tobytes(), short[i:j].tobytes(), quads[ends[i] : ends[j]].tobytes())) for i, j in zip(bounds, bounds[1:], strict=False)]


def unpack(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of packed values as bases (letters) in one row, and where each begins and the last one ends."""
    held, quads = [np.zeros(0, np.uint16)], [np.zeros(0, np.uint8)]
    for value in column:
        whole = np.frombuffer(value.as_buffer(), np.uint8)
        n = int(whole[:4].view(np.uint32)[0])
        held.append(whole[4 : 4 + 2 * n].view(np.uint16))
        quads.append(whole[4 + 2 * n :])
    sizes, four = np.concatenate(held).astype(np.int64), np.concatenate(quads)
    letters = np.frombuffer(b"ACGT", np.uint8)[np.stack([four >> 6, four >> 4 & 3, four >> 2 & 3, four & 3], axis=1).ravel()]
    padded = -(-sizes // 4) * 4
    inside = np.arange(len(letters)) - np.repeat(np.cumsum(padded) - padded, padded) < np.repeat(sizes, padded)
    return letters[inside], np.concatenate(([0], np.cumsum(sizes)))


def decoded(codes: np.ndarray, k: int) -> pa.Array:
    """The strings of codes."""
    shifts = np.arange(2 * (k - 1), -1, -2, dtype=np.int64)
    letters = np.frombuffer(b"ACGT", np.uint8)[(codes[:, None] >> shifts) & 3]
    ends = np.arange(len(codes) + 1, dtype=np.int32) * k
    return pa.StringArray.from_buffers(len(codes), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(letters)))
