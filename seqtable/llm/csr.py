"""Sparse 0/1 matrices in compressed rows, and their products by Gustavson's row method."""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

#: Non-zeros of the left matrix whose products are worked out at once.
FLOPS = 1 << 20


class Csr(NamedTuple):
    """Row r has ones in the columns `columns[starts[r]:starts[r + 1]]`."""

    starts: np.ndarray
    columns: np.ndarray
    width: int

    @classmethod
    def of_runs(cls, lengths: np.ndarray, width: int) -> "Csr":
        """Row r has ones in the `lengths[r]` columns after those of the row before."""
        starts = np.zeros(len(lengths) + 1, np.int64)
        np.cumsum(lengths, out=starts[1:])
        return cls(starts, np.arange(starts[-1]), width)

    @classmethod
    def of_single(cls, columns: np.ndarray, width: int) -> "Csr":
        """Row r has a one in column `columns[r]`."""
        return cls(np.arange(len(columns) + 1), columns, width)

    @property
    def rows(self) -> int:
        return len(self.starts) - 1

    def transposed(self) -> "Csr":
        """By counting: columns become rows, row numbers stay in ascending order in each."""
        starts = np.zeros(self.width + 1, np.int64)
        np.cumsum(np.bincount(self.columns, minlength=self.width), out=starts[1:])
        owner = np.repeat(np.arange(self.rows), np.diff(self.starts))
        return Csr(starts, owner[np.argsort(self.columns, kind="stable")], self.rows)


def products(a: Csr, b: Csr, flops: int = FLOPS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Non-zeros (row, column, value) of a·b in order, for a block of rows of `a` at a time.

    Each row of the product is the sum of the rows of b that the row of `a` names.
    A block holds some `flops` terms, but for a row that has more of its own.
    """
    terms = np.zeros(len(a.columns) + 1, np.int64)
    np.cumsum((b.starts[1:] - b.starts[:-1])[a.columns], out=terms[1:])
    terms = terms[a.starts]  # terms before each row
    first = 0
    while first < a.rows:
        last = max(first + 1, int(np.searchsorted(terms, terms[first] + flops, side="right")) - 1)
        named = a.columns[a.starts[first] : a.starts[last]]
        sizes = b.starts[named + 1] - b.starts[named]
        ends = np.cumsum(sizes)
        inside = np.arange(int(sizes.sum())) - np.repeat(ends - sizes, sizes)
        columns = b.columns[np.repeat(b.starts[named], sizes) + inside]
        rows = np.repeat(np.repeat(np.arange(first, last), np.diff(a.starts[first : last + 1])), sizes)
        keys = rows * b.width + columns
        if len(keys) and (keys[1:] < keys[:-1]).any():
            keys.sort()
        new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        values = np.diff(new, append=len(keys))
        yield keys[new] // max(b.width, 1), keys[new] % max(b.width, 1), values
        first = last


def product_sizes(a: Csr, b: Csr) -> np.ndarray:
    """Upper bounds of the non-zeros in each row of a·b; exact where rows of `a` name rows of b without common columns."""
    terms = np.zeros(len(a.columns) + 1, np.int64)
    np.cumsum((b.starts[1:] - b.starts[:-1])[a.columns], out=terms[1:])
    return terms[a.starts[1:]] - terms[a.starts[:-1]]
