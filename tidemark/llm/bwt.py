"""Repeated substrings of a collection of texts from its Burrows-Wheeler transform.

The longest-common-prefix values of neighbouring suffixes are derived by increasing value:
a border of value l between two suffix ranges, extended backwards by one letter, gives the borders
of value l + 1.  All ranges are extended by every letter, level by level, and the expansion stops
at the length asked for, or at a level that brings no new border.  What is left between two
borders are suffixes that agree in at least that many letters.
"""

from __future__ import annotations

import numpy as np

PACKED = 7


def _suffix_order(letters: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by at least ``depth`` letters; equal ones in any order."""
    n = len(letters)
    padded = np.zeros(n + PACKED, np.uint64)
    padded[:n] = letters
    key = np.zeros(n, np.uint64)
    for k in range(PACKED):
        key = (key << np.uint64(9)) | padded[k : k + n]
    known = PACKED
    while True:
        order = np.argsort(key)
        if known >= depth:
            return order
        ordered = key[order]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.concatenate([[True], ordered[1:] != ordered[:-1]])).astype(np.uint64)
        later = np.zeros(n, np.uint64)
        later[: n - known] = rank[known:] if known < n else 0
        key = (rank << np.uint64(32)) | later
        known *= 2


def shared_prefix_groups(letters: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix order, group of each place in it): a group's suffixes share ``length`` letters.

    ``letters`` are integers from 1 to 511, with 0 after each text.  Groups of suffixes that reach
    over a 0 within ``length`` letters mean nothing.
    """
    n = len(letters)
    order = _suffix_order(letters, length)
    before = letters[order - 1].astype(np.uint16)
    # psi: places of the transform, by letter and then by place; the k-th is the place of the
    # suffix one letter shorter than the k-th in order.
    psi = np.argsort(before, kind="stable")
    first = before[psi]
    border = np.concatenate([[True], first[1:] != first[:-1]])
    here = np.flatnonzero(~border)
    ahead, behind = psi[here].astype(np.int32), psi[here - 1].astype(np.int32)
    for _ in range(1, length):
        level = np.cumsum(border, dtype=np.int32)
        new = level[ahead] != level[behind]
        if not new.any():
            break
        border[here[new]] = True
        stay = ~new
        here, ahead, behind = here[stay], ahead[stay], behind[stay]
    return order, np.cumsum(border, dtype=np.int32) - 1
