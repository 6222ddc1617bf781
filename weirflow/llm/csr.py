"""Sparse 0/1 matrices in compressed rows, and their products by Gustavson's method."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Csr:
    """Row i has ones in the columns ``columns[starts[i]:starts[i + 1]]``."""

    starts: np.ndarray
    columns: np.ndarray
    width: int

    @property
    def height(self) -> int:
        return len(self.starts) - 1

    def rows(self) -> np.ndarray:
        """The row of every one."""
        return np.repeat(np.arange(self.height), np.diff(self.starts))

    def transposed(self) -> Csr:
        order = np.argsort(self.columns, kind="stable")
        counts = np.bincount(self.columns, minlength=self.width)
        return Csr(np.concatenate([[0], np.cumsum(counts)]), self.rows()[order], self.height)


def reach(left: Csr, right: Csr) -> np.ndarray:
    """For each row of ``left`` the number of terms of its row product with
    ``right`` (Gustavson's symbolic pass)."""
    terms = np.diff(right.starts)[left.columns]
    sums = np.concatenate([[0], np.cumsum(terms)])
    return np.diff(sums[left.starts])


def product(left: Csr, right: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and value of what is not zero in ``left`` times ``right``, by
    rows: each one of a row of ``left`` adds a whole row of ``right``, and equal
    columns are summed."""
    sizes = np.diff(right.starts)[left.columns]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    source = np.repeat(right.starts[left.columns] - (ends - sizes), sizes) + np.arange(total)
    keys = np.repeat(left.rows(), sizes) * right.width + right.columns[source]
    if np.any(keys[1:] < keys[:-1]):
        keys.sort()
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    values = np.diff(first, append=len(keys))
    return keys[first] // right.width, keys[first] % right.width, values
