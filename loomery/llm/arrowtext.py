"""Views of Arrow string columns as numpy byte arrays, shared by the byte-level operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def bytes_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without copying; a null has length 0."""
    if pa.types.is_large_string(col.type):
        kind = np.int64
    else:
        kind = np.int32
    offs = np.frombuffer(col.buffers()[1], kind)[col.offset : col.offset + len(col) + 1].astype(np.int64) if len(col) else np.zeros(1, np.int64)
    buf = col.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None and len(buf) else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def best_segments(scores: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Highest sum of a contiguous run of scores within each record (0 for an empty one), in linear time.

    A running minimum of prefix sums that restarts at each record: each record's prefix sums are
    lowered by a constant large enough that its first value is below everything before it.
    """
    n = len(offs) - 1
    out = np.zeros(n)
    if not len(scores):
        return out
    lens = np.diff(offs)
    rec = np.repeat(np.arange(n), lens)
    cum = np.cumsum(scores, dtype=np.float64)
    step = float(np.abs(scores).sum()) * 2 + 1.0
    low = cum - scores - rec * step  # prefix sums before each position
    best = (cum - rec * step) - np.minimum.accumulate(low)
    full = lens > 0
    out[full] = np.maximum.reduceat(best, offs[:-1][full])
    return np.maximum(out, 0)


def segment_bounds(scores: np.ndarray) -> tuple[int, int]:
    """[start, end) of the best contiguous run of one record's scores."""
    cum = np.concatenate([[0.0], np.cumsum(scores, dtype=np.float64)])
    low = np.minimum.accumulate(cum)
    end = int(np.argmax(cum - low))
    start = int(np.argmin(cum[: end + 1]))
    return start, end
