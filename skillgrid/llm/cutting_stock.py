"""Patterns for the cutting-stock problem by column generation.

The linear program asks for the fewest rolls of one capacity that hold given numbers of pieces of each
length. Its columns (patterns) are generated: a knapsack dynamic program over the capacity prices them
with the duals of the restricted program. The work depends on the number of lengths, not of pieces.
"""

from __future__ import annotations

import numpy as np


def price(lengths: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern that fits: unbounded knapsack by doubling the copies of each length."""
    best = np.zeros(capacity + 1)
    steps: list[tuple[int, int, np.ndarray]] = []
    for k in np.flatnonzero(values > 1e-12):
        copies = 1
        while copies * lengths[k] <= capacity:
            size = int(copies * lengths[k])
            candidate = best[:-size] + copies * values[k]
            better = candidate > best[size:] + 1e-12
            if better.any():
                best[size:] = np.where(better, candidate, best[size:])
                steps.append((int(k), copies, better))
            copies *= 2
    pattern, room = np.zeros(len(lengths), np.int64), capacity
    for k, copies, better in reversed(steps):
        size = int(copies * lengths[k])
        if room >= size and better[room - size]:
            pattern[k] += copies
            room -= size
    return float(best[capacity]), pattern


def greedy_start(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """A first basis: the longest length left, the roll filled up by the knapsack, until one length is used up.

    Each pattern uses up one length and later ones do without it, so the patterns are a triangular basis.
    """
    left, columns, uses = demand.astype(float).copy(), [], []
    open_ = np.ones(len(lengths), bool)  # lengths that no pattern has used up
    while (alive := np.flatnonzero(open_)).size:
        if (spent := alive[left[alive] <= 1e-9]).size:  # used up together with another one
            for k in spent:
                columns.append(np.eye(1, len(lengths), k, dtype=np.int64)[0] * (capacity // lengths[k]))
                uses.append(0.0)
            open_[spent] = False
            continue
        first = alive[-1]
        values = np.zeros(len(lengths))
        values[alive] = (lengths[alive] / capacity) ** 1.02  # of equal fills the one with longer pieces
        _, pattern = price(lengths, values, int(capacity - lengths[first]))
        pattern[first] += 1
        members = np.flatnonzero(pattern)
        k = members[np.argmin(left[members] / pattern[members])]
        n = left[k] / pattern[k]
        left -= n * pattern
        open_[k] = False
        columns.append(pattern)
        uses.append(n)
    return np.array(columns, float).T, np.array(uses)


def inverse_of(basis: np.ndarray) -> np.ndarray:
    """Inverse of ``greedy_start``'s basis, whose column t alone, of t and later ones, holds the length it uses up."""
    m = len(basis)
    inverse, done = np.zeros((m, m)), np.zeros(m, bool)
    later = np.cumsum((basis != 0)[:, ::-1], axis=1)[:, ::-1]  # columns from t on with a length
    for t in range(m):
        k = int(np.flatnonzero((basis[:, t] != 0) & (later[:, t] == 1) & ~done)[0])
        done[k] = True
        earlier = np.flatnonzero(basis[k, :t])
        inverse[t] = -(basis[k, earlier, None] * inverse[earlier]).sum(axis=0)
        inverse[t, k] += 1
        inverse[t] /= basis[k, t]
    return inverse


def column_generation(lengths: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 1e-5, rounds: int = 400):
    """Patterns (rows) of a basis and how often each is used, as real numbers.

    Starts from ``greedy_start`` and stops when Farley's lower bound, or the material bound, proves the
    value within ``gap`` of the optimum, or after ``rounds`` new columns. Demands must be positive.
    """
    basis, uses = greedy_start(lengths, demand, capacity)
    inverse = inverse_of(basis)
    bound = float((demand * lengths).sum()) / capacity
    for turn in range(rounds):
        if uses.sum() * (1 - gap) <= bound:
            break
        duals = inverse.sum(axis=0)
        value, pattern = price(lengths, duals, capacity)
        bound = max(bound, float((demand * duals).sum()) / max(value, 1.0))
        if value <= 1 + 1e-9:
            break
        members = np.flatnonzero(pattern)
        direction = (inverse[:, members] * pattern[members]).sum(axis=1)
        positive = direction > 1e-10
        ratios = np.where(positive, uses / np.where(positive, direction, 1), np.inf)
        out = int(np.argmin(ratios))
        step = max(ratios[out], 0.0)
        uses -= step * direction
        uses[out] = step
        row = inverse[out] / direction[out]
        inverse -= np.outer(direction, row)
        inverse[out] = row
        basis[:, out] = pattern
    return basis.T.astype(np.int64), np.maximum(uses, 0)


def first_fit(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Patterns for a few pieces, longest first into the fullest roll with room."""
    rolls: list[np.ndarray] = []
    room = np.zeros(0, np.int64)
    for k in np.argsort(-lengths, kind="stable"):
        for _ in range(int(demand[k])):
            fits = np.flatnonzero(room >= lengths[k])
            if len(fits):
                at = fits[np.argmin(room[fits])]
            else:
                at = len(rolls)
                rolls.append(np.zeros(len(lengths), np.int64))
                room = np.append(room, capacity)
            rolls[at][k] += 1
            room[at] -= lengths[k]
    return rolls


def plan(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Whole-number (pattern, uses) that hold each piece exactly once.

    The real solution is rounded down; what it leaves, at most a basis of patterns, is packed by first fit.
    """
    if not demand.sum():
        return []
    patterns, uses = column_generation(lengths, demand.astype(float), capacity)
    counts = np.floor(uses + 1e-9).astype(np.int64)
    left = demand - counts @ patterns
    for j in np.argsort(-counts):  # an inexact basis may overfill a length
        while counts[j] and (left[patterns[j] > 0] < 0).any():
            counts[j] -= 1
            left = left + patterns[j]
    out = [(patterns[j], int(counts[j])) for j in np.flatnonzero(counts)]
    rolls: dict[bytes, list] = {}
    for roll in first_fit(lengths, left, capacity):
        rolls.setdefault(roll.tobytes(), [roll, 0])[1] += 1
    return out + [(roll, n) for roll, n in rolls.values()]
