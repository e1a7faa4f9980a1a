"""Code points of text columns and tables over them."""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa

from .shared import utf8

#: Code points with table entries of their own; those beyond are rare scripts and symbols.
TABLE = 0x30000


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of a string column end to end, and each row's bounds in them; null counts as empty."""
    data, bounds = utf8(column)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    before = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return points, before[bounds]


@cache
def lowered() -> np.ndarray:
    """For each code point, that of its small letter, or 0 where it is no letter."""
    out = np.zeros(TABLE + 1, np.uint32)
    for c in range(TABLE):
        if unicodedata.category(chr(c))[0] == "L":
            small = chr(c).lower()
            out[c] = ord(small[0])
    out[TABLE] = TABLE
    return out


def letters(points: np.ndarray) -> np.ndarray:
    """Small letters, with 0 for everything else; letters beyond the table share one value."""
    found = lowered()[np.minimum(points, TABLE)]
    far = np.flatnonzero(points >= TABLE)
    if len(far):
        found[far] = [TABLE if unicodedata.category(chr(c))[0] == "L" else 0 for c in points[far]]
    return found
