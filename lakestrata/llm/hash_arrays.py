"""Arrays of 64-bit numbers as bytes in rows, and sorted ones mapped from a file."""

from __future__ import annotations

import ctypes
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa


def pack(values: np.ndarray, *, ascending: bool = False) -> bytes:
    """Byte planes, which leaves the empty high bytes together, compressed; of sorted values the steps."""
    steps = values.astype(np.uint64)
    if ascending and len(steps):
        steps[1:] = np.diff(steps)
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)
    return len(steps).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpack(data: bytes, *, ascending: bool = False) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], 8 * n, "zstd", asbytes=True), np.uint8)
    values = np.ascontiguousarray(planes.reshape(8, n).T).view(np.uint64).reshape(n)
    return np.cumsum(values, dtype=np.uint64) if ascending else values


def cuts(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where the ranges of `shards` equal parts of all 64-bit numbers begin in the sorted `keys`, and the end."""
    bounds = np.array([(i << 64) // shards for i in range(shards)], np.uint64)
    return np.append(np.searchsorted(keys, bounds), len(keys))


class MappedArrays:
    """Columns of equal length, the first one sorted, appended piece by piece to unnamed files and read by mapping.

    A worker's heap holds one piece; the pages that look-ups touch are the system's to keep or drop.
    """

    def __init__(self, columns: int):
        self.files = [tempfile.TemporaryFile() for _ in range(columns)]  # noqa: SIM115 - closed by close()
        self.maps: list[np.ndarray] | None = None

    def append(self, *arrays: np.ndarray) -> None:
        for file, array in zip(self.files, arrays, strict=True):
            file.write(array.astype(np.uint64).tobytes())

    def look_up(self, asked: np.ndarray) -> list[np.ndarray]:
        """The other columns for each sorted key asked for; 0 where it is absent."""
        if self.maps is None:
            for file in self.files:
                file.flush()
            held = self.files[0].tell() > 0
            self.maps = [np.memmap(f, np.uint64, "r") if held else np.zeros(0, np.uint64) for f in self.files]
        keys, *columns = self.maps
        if not len(keys):
            return [np.zeros(len(asked), np.uint64) for _ in columns]
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        found = keys[at] == asked
        return [np.where(found, c[at], np.uint64(0)) for c in columns]

    def close(self) -> None:
        self.maps = None
        for file in self.files:
            file.close()


def give_back() -> None:
    """Hand freed memory back to the system; an idle worker would keep what its largest arrays took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def row_stream(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one; few and large ones, as these are, cost nothing to turn into objects."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]
