"""Context-tree weighting over bytes in NumPy: the arithmetic of one set of contexts, used inside Spark tasks.

A byte is eight binary decisions. A decision is known by the bits of the byte before it (``1`` and those bits, 1 to 255); each
has a tree of contexts, the bytes before, nearest first. A gram is one number: ``depth`` context bytes, nearest in the
highest byte, and the byte itself in the lowest. The node of a gram and a decision at depth d is the number made of the d
nearest context bytes and the decision.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import lgamma, log, pi

import numpy as np

_SMALL = 1024
_HALVES = np.array([lgamma(n + 0.5) for n in range(_SMALL)])
_WHOLES = np.array([lgamma(n + 1.0) for n in range(_SMALL)])
LN2, LN10 = log(2), log(10)


def _log_gamma(n: np.ndarray, shift: float, table: np.ndarray) -> np.ndarray:
    x = np.maximum(n, 8) + shift
    far = (x - 0.5) * np.log(x) - x + 0.5 * log(2 * pi) + 1 / (12 * x) - 1 / (360 * x**3)
    return np.where(n < _SMALL, table[np.minimum(n, _SMALL - 1).astype(np.int64)], far)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of any sequence with these counts."""
    return _log_gamma(zeros, 0.5, _HALVES) + _log_gamma(ones, 0.5, _HALVES) - _log_gamma(zeros + ones, 1.0, _WHOLES) - log(pi)


def weighted(zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log weighted probability of nodes, and the weight of each one's own estimate against its children's.

    ``below``: sum of the children's log weighted probabilities, NaN for a leaf.
    """
    own = log_kt(zeros, ones)
    leaf = np.isnan(below)
    both = np.logaddexp(own, np.where(leaf, own, below)) - LN2
    return np.where(leaf, own, both), np.where(leaf, 1.0, np.exp(own - LN2 - both))


@dataclass
class Level:
    """The nodes of one depth, sorted by number."""

    nodes: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    log_p: np.ndarray
    weight: np.ndarray


def decisions(grams: np.ndarray, drop: int) -> tuple[np.ndarray, np.ndarray]:
    """Node and bit of the eight decisions of each gram, with its ``drop`` farthest context bytes left out; eight rows."""
    context = (grams >> np.uint64(8 * (drop + 1))) << np.uint64(8)
    byte = (grams & np.uint64(0xFF)).astype(np.int64)
    bits = np.arange(8)[:, None]
    prior = (1 << bits) | (byte >> (8 - bits))
    return context | prior.astype(np.uint64), (byte >> (7 - bits)) & 1


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, sorted, and the sums of the values of each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[first], *(np.add.reduceat(v[order], first) if len(first) else v[:0] for v in values)


def levels(grams: np.ndarray, counts: np.ndarray, depth: int, top: int) -> list[Level]:
    """The weighted trees of all decisions at depths ``depth`` down to ``top``, from distinct seen grams and their counts."""
    out: list[Level] = []
    for drop in range(depth - top + 1):
        step = np.uint64(8 * drop)
        part = (grams >> np.uint64(8)) >> step << np.uint64(8) | grams & np.uint64(0xFF)
        part, n = summed(part, counts)
        node, bit = decisions(part, 0)
        n8 = np.broadcast_to(n, node.shape).ravel()
        nodes, zeros, ones = summed(node.ravel(), np.where(bit.ravel() == 0, n8, 0), np.where(bit.ravel() == 1, n8, 0))
        below = np.full(len(nodes), np.nan)
        if out:
            # A child's number without its farthest byte is its parent's: drop the byte above the decision.
            child = out[-1]
            parents, total = summed((child.nodes >> np.uint64(16) << np.uint64(8)) | child.nodes & np.uint64(0xFF), child.log_p)
            below[np.searchsorted(nodes, parents)] = total
        log_p, weight = weighted(zeros, ones, below)
        out.append(Level(nodes, zeros, ones, log_p, weight))
    return out


def log_probability(grams: np.ndarray, tree: list[Level], above: np.ndarray, rest: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Natural log of the probability of each gram's byte in its context.

    ``tree`` as from ``levels``; eight rows each: ``above`` and ``rest``, what shallower nodes give to a one-bit and the
    weight that they leave to the top level of ``tree``, and ``held``, the estimate of the deepest of them that was seen. The
    deepest node that was seen takes all the weight left, as no deeper one can tell more.
    """
    one, left, held = above.copy(), rest.copy(), held.copy()
    for drop in range(len(tree) - 1, -1, -1):
        level = tree[drop]
        if not len(level.nodes):
            break
        node, _ = decisions(grams, drop)
        at = np.minimum(np.searchsorted(level.nodes, node), len(level.nodes) - 1)
        seen = level.nodes[at] == node
        held = np.where(seen, (level.ones[at] + 0.5) / (level.zeros[at] + level.ones[at] + 1), held)
        own = np.where(seen, level.weight[at], 0.0)
        one += left * own * held
        left *= 1 - own
    one += left * held
    bit = decisions(grams, 0)[1]
    return np.log(np.where(bit == 1, one, 1 - one)).sum(axis=0)
