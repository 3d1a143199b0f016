"""Vectors of a table as integers, for operators whose results must be exact."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def bound(dimensions: int) -> int:
    """Components are held within this bound of zero: the sum of `dimensions` squares of differences of
    two of them still fits a 64-bit number."""
    return 1 << (62 - max(dimensions - 1, 0).bit_length()) // 2 - 1


def integers(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows hold a vector without null or non-finite components, every row's length (0 for null), and
    floor(scale * x) of all components, row after row; components beyond `bound` of their row's length count as the bound."""
    given = column.is_valid().to_numpy(zero_copy_only=False)
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = np.asarray(pc.fill_null(column.flatten().cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False))
    finite = np.isfinite(values)
    wrong = np.concatenate([[0], np.cumsum(~finite)])
    ends = np.cumsum(lengths)
    usable = given & (wrong[ends] == wrong[ends - lengths])
    most = np.repeat(np.array([bound(n) for n in lengths.tolist()], np.float64), lengths)
    scaled = np.where(finite, values, 0.0)
    with np.errstate(over="ignore"):
        scaled = np.floor(scaled * scale)
    return usable, lengths, np.clip(scaled, -most, most).astype(np.int64)


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    """The integers of a column whose lists all have one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dimensions)


def lists(values: np.ndarray, type_: pa.DataType) -> pa.Array:
    """The rows of a matrix as lists."""
    rows, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, rows * width + 1, width or 1)[:rows + 1] if width else
                                             np.zeros(rows + 1, np.int64), pa.int32()),
                                    pa.array(values.reshape(-1), type_))
