"""Helpers that run inside tasks for rank and score fusion."""

from __future__ import annotations

import numpy as np


def rows_before(values: np.ndarray, ids: np.ndarray, at_values: np.ndarray, at_ids: np.ndarray) -> np.ndarray:
    """For every place ``(value, id)`` the number of rows that sort strictly before it."""
    is_row = np.r_[np.zeros(len(at_values), int), np.ones(len(values), int)]
    order = np.lexsort((is_row, np.r_[at_ids, ids], np.r_[at_values, values]))
    before = np.cumsum(is_row[order])
    place = np.empty(len(order), int)
    place[order] = before
    return place[: len(at_values)]


def min_max(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Scale to 0..1 per column; a list with a single value scales to 1."""
    width = high - low
    return np.where(width > 0, (values - low) / np.where(width > 0, width, 1), 1.0)
