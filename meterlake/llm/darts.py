"""DartMinHash signatures of weighted sets."""

from __future__ import annotations

import math

import numpy as np

from meterlake.llm.spans import mixed

#: Darts beyond those expected to leave one coordinate empty; more are thrown where needed.
SPARE = 3.0

_RANK = np.uint64(0xD6E8FEB86659FD93)
_PLACE = np.uint64(0xA0761D6478BD642F)
_DEPTH = np.uint64(0xE7037ED1A0B428DB)


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def signature(
    elements: np.ndarray, size: int, weights: np.ndarray | None = None
) -> np.ndarray:
    """The earliest dart of each of ``size`` coordinates, as 64-bit values.

    Every element has a stream of darts, the same in all sets: each falls at a rank, a
    depth between whole weights, and a coordinate, all drawn by hashing. A dart counts if
    it falls within its element's weight. Two sets agree in a coordinate with the
    probability of their weighted Jaccard similarity. Only darts below a rank that a few
    more than ``size`` log ``size`` of them reach are thrown, whatever the set's size; an
    element of a large set rarely has any. ``weights`` are one each unless given.
    """
    if weights is None:
        cells, depth = elements, None
    else:
        whole = np.ceil(weights).astype(np.int64)
        cell = np.arange(whole.sum()) - np.repeat(np.cumsum(whole) - whole, whole)
        cells = mixed(np.repeat(elements, whole) + cell.astype(np.uint64) * _DEPTH)
        depth = np.repeat(weights, whole) - cell
    total = len(elements) if weights is None else float(weights.sum())
    if not total > 0:
        return np.zeros(size, np.uint64)
    limit = size * (math.log(size) + SPARE) / total
    while True:
        result = _earliest(cells, depth, size, limit)
        if result is not None:
            return result
        limit *= 2


def _earliest(
    cells: np.ndarray, depth: np.ndarray | None, size: int, limit: float
) -> np.ndarray | None:
    """The earliest dart below ``limit`` of each coordinate; None if one has none."""
    values, ranks = _throw(cells, depth, limit)
    places = (mixed(values ^ _PLACE) % np.uint64(size)).astype(np.int64)
    order = np.lexsort((values, ranks))[::-1]
    result = np.zeros(size, np.uint64)
    result[places[order]] = values[order]
    filled = np.zeros(size, bool)
    filled[places] = True
    return result if filled.all() else None


def _throw(
    cells: np.ndarray, depth: np.ndarray | None, limit: float
) -> tuple[np.ndarray, np.ndarray]:
    """Darts of all cells below a rank; the gaps between the ranks of a cell are exponential."""
    columns = max(1, math.ceil(limit + 3 * math.sqrt(limit))) if limit > 0.5 else 1
    found: list[tuple[np.ndarray, np.ndarray]] = []
    start = np.zeros(len(cells))
    step = 0
    while len(cells):
        steps = np.arange(step + 1, step + columns + 1, dtype=np.uint64) * _RANK
        values = mixed(cells[:, None] + steps[None, :])
        ranks = start[:, None] - np.cumsum(np.log(_uniform(values)), axis=1)
        inside = ranks < limit
        if depth is not None:
            counted = inside & (_uniform(mixed(values ^ _DEPTH)) < depth[:, None])
        else:
            counted = inside
        found.append((values[counted], ranks[counted]))
        more = inside[:, -1]
        cells, start = cells[more], ranks[more, -1]
        depth = None if depth is None else depth[more]
        step += columns
        columns = max(1, columns // 4)
    values, ranks = (np.concatenate(parts) for parts in zip(*found))
    return values, ranks
