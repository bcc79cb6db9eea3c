"""Inverted lists of a batch of sparse vectors, with bounds, for exact best-k dot products.

For every term a list holds the rows that have it and their weights. Rows are cut into blocks, and
a list knows its greatest weight in each block. A query reads the lists of its own terms only, and of
these only the blocks whose bounds reach the score that is needed.
"""

from __future__ import annotations

import numpy as np

BLOCK = 64  # rows that share a bound
FIRST = 16  # blocks with the highest bounds, which are read first


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, so many each."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class Lists:
    def __init__(self, rows: np.ndarray, terms: np.ndarray, weights: np.ndarray, n_rows: int, n_terms: int) -> None:
        order = np.lexsort((rows, terms))
        self.rows, terms, self.weights = rows[order], terms[order], weights[order]
        self.n_rows, block = n_rows, self.rows // BLOCK
        edge = np.flatnonzero((np.diff(terms, prepend=-1) != 0) | (np.diff(block, prepend=-1) != 0))
        self.first, self.sizes, self.block = edge, np.diff(np.append(edge, len(terms))), block[edge]
        self.bound = np.maximum.reduceat(self.weights, edge) if len(edge) else np.empty(0)
        self.at = np.searchsorted(terms[edge], np.arange(n_terms + 1))  # where a term's blocks begin

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, bar: float, slack: float) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of all rows that may be among the k best and reach the bar, give or take the slack.

        terms and weights: the query's, not negative; rows without any of its terms are left out.
        """
        sizes = self.at[terms + 1] - self.at[terms]
        cells, weight = spans(self.at[terms], sizes), np.repeat(weights, sizes)
        bounds = np.bincount(self.block[cells], self.bound[cells] * weight, -(-self.n_rows // BLOCK))
        highest = np.argsort(-bounds, kind="stable")
        rows, scores = [np.empty(0, "int64")], [np.empty(0)]
        for some in (highest[:FIRST], highest[FIRST:]):
            wanted = np.zeros(len(bounds), bool)
            wanted[some] = (bounds[some] > 0) & (bounds[some] >= bar - slack)
            near = wanted[self.block[cells]]
            if not near.any():
                continue
            n = self.sizes[cells[near]]
            entries = spans(self.first[cells[near]], n)
            sums = np.bincount(self.rows[entries], self.weights[entries] * np.repeat(weight[near], n), self.n_rows)
            found = np.flatnonzero((sums > 0) & (sums >= bar - slack))
            rows.append(found)
            scores.append(sums[found])
            if (so_far := np.concatenate(scores)).size >= k:
                bar = max(bar, float(np.partition(so_far, so_far.size - k)[so_far.size - k]))
        rows, scores = np.concatenate(rows), np.concatenate(scores)
        kept = scores >= bar - slack
        return rows[kept], scores[kept]
