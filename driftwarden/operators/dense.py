"""Small numpy helpers for bounded blocks of packed sparse vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd

# Cells of a dense piece held at a time; a wide vocabulary is worked through in pieces.
PIECE_CELLS = 4_000_000


def matrix(terms: pd.Series, vals: pd.Series, index: pd.Index) -> np.ndarray:
    """Rows x terms matrix; terms outside ``index`` are left out."""
    out = np.zeros((len(terms), len(index)))
    row, col, val = _cells(terms, vals, index)
    out[row, col] = val
    return out


def _cells(terms: pd.Series, vals: pd.Series, index: pd.Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = [len(t) for t in terms]
    if not sum(sizes):
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    col = index.get_indexer(np.concatenate(list(terms)))
    known = col >= 0
    return np.repeat(np.arange(len(sizes)), sizes)[known], col[known], np.concatenate(list(vals))[known]


def _shared_cells(a: pd.DataFrame, b: pd.DataFrame) -> tuple[tuple, tuple, int]:
    """(row, column, value) of either frame's cells in terms that both hold, and the number of those terms."""
    parts = []
    for frame in (a,) if a is b else (a, b):
        sizes = [len(t) for t in frame["terms"]]
        cells = np.concatenate([*frame["terms"], np.empty(0, object)]), np.concatenate([*frame["vals"], np.empty(0)])
        parts.append((np.repeat(np.arange(len(sizes)), sizes), *cells))
    code = pd.factorize(np.concatenate([p[1] for p in parts]))[0]
    first = code[:len(parts[0][1])]
    if a is b:
        cells = parts[0][0], first, parts[0][2]
        return cells, cells, int(first.max(initial=-1)) + 1
    second = code[len(first):]
    shared = np.zeros(int(first.max(initial=-1)) + 1, bool)
    shared[second[(second >= 0) & (second < len(shared))]] = True
    place = np.cumsum(shared) - 1
    found = []
    for (row, _, val), of in zip(parts, (first, second)):
        here = (of >= 0) & (of < len(shared))  # -1 stands for a null term
        here[here] = shared[of[here]]
        found.append((row[here], place[of[here]], val[here]))
    return found[0], found[1], int(shared.sum())


def row_pieces(rows: pd.DataFrame, width: int) -> Iterator[pd.DataFrame]:
    """Slices of the rows whose dense form stays small."""
    step = max(1, PIECE_CELLS // max(width, 1))
    for start in range(0, len(rows), step):
        yield rows.iloc[start:start + step]


def dot_products(a: pd.DataFrame, b: pd.DataFrame) -> np.ndarray:
    """All dot products, summed over pieces of the shared vocabulary."""
    out = np.zeros((len(a), len(b)))
    left, right, width = _shared_cells(a, b)
    step = max(1, PIECE_CELLS // max(len(a), len(b)))
    for start in range(0, width, step):
        pieces = []
        for (row, col, val), size in ((left, len(a)), (right, len(b))):
            here = (col >= start) & (col < start + step)
            piece = np.zeros((size, min(step, width - start)))
            piece[row[here], col[here] - start] = val[here]
            pieces.append(piece)
        out += pieces[0] @ pieces[1].T
    return out


def squared_distances(a: pd.DataFrame, b: pd.DataFrame) -> np.ndarray:
    """Squared Euclidean distances between the packed rows of two frames."""
    norm = [np.array([float(np.dot(v, v)) for v in x["vals"]]) for x in (a, b)]
    return np.maximum(norm[0][:, None] + norm[1][None, :] - 2.0 * dot_products(a, b), 0.0)
