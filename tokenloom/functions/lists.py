"""Arrow list arrays inside tasks: numbers out, worked on with numpy, and back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def lengths(lists: pa.ListArray) -> np.ndarray:
    """Length of each list; 0 where it is missing."""
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)


def binary_lengths(texts: pa.Array) -> np.ndarray:
    """Bytes of each text; 0 where it is missing."""
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)


def numbers(lists: pa.ListArray) -> np.ndarray:
    """All entries of all lists, one after the other."""
    return lists.flatten().to_numpy(zero_copy_only=False).astype(float)


def regroup(flat: pa.Array | np.ndarray, sizes: np.ndarray, missing: pa.BooleanArray | None) -> pa.ListArray:
    """Cut `flat` into lists of the given sizes; `missing` ones, if any, stay missing."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype("int32")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat), mask=missing)


def pieces(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive items, as start and stop, of `most` in size together; a larger one is alone."""
    ends, start = np.cumsum(sizes), 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield start, stop
        start = stop
