"""Words and hashes of whole Arrow text columns as numpy arrays; tasks call these on slices of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

SLICE_BYTES = 512 << 10
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(20240229).integers(0, 1 << 64, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices whose texts have about `limit` bytes; a longer text is a slice of its own, never cut."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total, start = np.cumsum(size), 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, before + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the bounds of each; a null is an empty text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    content = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return content[bounds[0] : bounds[-1]], bounds - bounds[0]


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words `[^\\x20\\x09-\\x0D]+`, and where each text's words begin among them."""
    inside = ~SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begin = bounds[:-1][bounds[:-1] < len(data)]
    first[begin] = inside[begin]
    end = bounds[1:][bounds[1:] > 0] - 1
    last[end] = inside[end]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, bounds)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(name: str, factor: int, n: int) -> np.ndarray:
    known = _powers.get(name)
    if known is None or len(known) < n:
        full = np.full(max(n, min(n + n // 4, SLICE_BYTES + 1)), factor, np.uint64)  # no more than the slices need: workers keep it
        full[0] = 1
        known = np.cumprod(full)
        if n <= 8 << 20:
            _powers[name] = known
    return known


def hasher(data: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """What hashes byte ranges (starts, ends) of data, from one running sum of a polynomial in random byte values."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * _power("up", _BASE, len(data) + 1)[: len(data)], out=total[1:])
    down = _power("down", _INVERSE, len(data) + 1)

    def run(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))

    return run


def hash64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges."""
    return hasher(data)(starts, ends)


def of_windows(codes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of `width` neighbouring codes; len(codes) - width + 1 of them."""
    n = max(0, len(codes) - width + 1)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = mix(out * np.uint64(0x2545F4914F6CDD1D) + codes[k : k + n])
    return out


def arrow_schema(ddl: str) -> pa.Schema:
    """On the driver: the Arrow form of a schema."""
    return pa.schema([(f.name, f.type) for f in to_arrow_schema(StructType.fromDDL(ddl))])


def mapped(df, columns: list, run: Callable, schema: str, column: str = "text", limit: int = SLICE_BYTES):
    """Apply run(slice) -> dict of arrays to bounded slices of the rows; rows and order are kept per task."""
    kinds = arrow_schema(schema)

    def task(batches):
        for part in slices(batches, column, limit):
            out = run(part)
            yield pa.RecordBatch.from_arrays([_fit(out[f.name], f.type) for f in kinds], schema=kinds)

    return df.select(*columns).mapInArrow(task, schema)


def _fit(values, kind):
    if isinstance(values, (pa.Array, pa.ChunkedArray)):
        return values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values.cast(kind)
    return pa.array(values, kind)
