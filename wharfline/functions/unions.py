"""Components of links inside one task."""

from __future__ import annotations

import numpy as np


def link(parent: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Join the components of ``left[i]`` and ``right[i]``; every position points at the first of its component."""
    while True:
        a, b = parent[left], parent[right]
        apart = a != b
        if not apart.any():
            return parent
        left, right = left[apart], right[apart]
        np.minimum.at(parent, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while not np.array_equal(nearer := parent[parent], parent):
            parent = nearer
