"""Hashes and numbers packed into binary fields, and the tables that carry them between portions of text and ranges of hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from meterline.llm.textbytes import U


def dealt(hashes: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Range of each hash by its value, and 32 bits of its place in the range; both rise with the hash."""
    n, low = U(ranges), U(0xFFFFFFFF)
    part = ((hashes >> U(32)) * n + (((hashes & low) * n) >> U(32))) >> U(32)
    return part.astype(np.int64), ((hashes * n) >> U(32)).astype(np.uint32)


def packed_planes(columns: list[np.ndarray]) -> bytes:
    """Columns of integers, compressed byte place by byte place."""
    return pa.compress(b"".join(c.astype(c.dtype.newbyteorder("<")).view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in columns), codec="zstd", asbytes=True)


def unpacked_planes(packed: bytes, n: int, types: list[str]) -> list[np.ndarray]:
    sizes = [int(t[-1]) for t in types]
    if not n:
        return [np.zeros(0, "<" + t) for t in types]
    raw = np.frombuffer(pa.decompress(packed, n * sum(sizes), codec="zstd", asbytes=True), np.uint8)
    ends = np.cumsum(sizes) * n
    return [np.ascontiguousarray(raw[e - k * n:e].reshape(k, n).T).view("<" + t).ravel() for t, k, e in zip(types, sizes, ends.tolist())]


def steps(rising: np.ndarray) -> np.ndarray:
    return np.diff(rising, prepend=rising.dtype.type(0))


def packed_rising(rising: np.ndarray) -> bytes:
    """Rising 32-bit numbers, by their differences."""
    return packed_planes([steps(rising)])


def unpacked_rising(packed: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpacked_planes(packed, n, ["u4"])[0], dtype=np.uint32)


def cuts(part: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(part)) + 1
    return list(zip([0, *edges.tolist()], [*edges.tolist(), len(part)])) if len(part) else []


def as_table(schema: str, **columns) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.strip().split() for f in schema.split(",")]
    return pa.table([pa.array(columns[name], kinds[kind]) for name, kind in fields], names=[name for name, _ in fields])


def unpacked_bits(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8), count=n).astype(bool)
