"""Context-tree weighting over bytes, in arrays.

A byte is eight binary decisions; node (context, partial byte) counts the zeros and
ones that followed. Every node estimates by Krichevsky-Trofimov, and weights its own
estimate of all it saw against the product of its children's (contexts one byte
longer) by halves. From the trained tree, a bit's probability mixes the estimates
along its context with the weights' posterior; where the tree ends (a longer context
was never seen), the last node's own estimate stands.

A *gram* packs ``depth`` context bytes, nearest first, and the byte that follows, so
sorted grams lie in the order of the tree. A tree can be cut below depth 2: all
grams with the same two nearest bytes make a subtree of their own, and what lies
above (at most 257 contexts) is a small table, the ``top``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from numpy.typing import NDArray

_LOG_HALF = float(np.log(0.5))


def _log_gamma(x: NDArray) -> NDArray:
    """Log of the gamma function for x >= 0.5, by shifting and Stirling's series."""
    shift = np.log(x) + np.log(x + 1) + np.log(x + 2) + np.log(x + 3) + np.log(x + 4) + np.log(x + 5)
    y = x + 6
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def log_kt(zeros: NDArray, ones: NDArray) -> NDArray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - np.log(np.pi)


@dataclass
class Level:
    """Nodes of one depth, for each of the eight bits: sorted keys and what they hold.

    A key is (number of the context among ``contexts``) << bit | leading bits of the byte.
    """

    contexts: NDArray
    keys: list[NDArray]
    one_share: list[NDArray]
    own_weight: list[NDArray]


def _nodes(context: NDArray, byte: NDArray, count: NDArray, bit: int) -> tuple[NDArray, NDArray, NDArray, NDArray]:
    """Keys of one bit's nodes over sorted (context, byte), zeros, ones, and each pair's node."""
    key = (context << bit) | (byte >> (8 - bit))
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    starts = np.flatnonzero(new)
    total = np.add.reduceat(count, starts)
    ones = np.add.reduceat(count * ((byte >> (7 - bit)) & 1), starts)
    return key[starts], total - ones, ones, np.cumsum(new) - 1


def _weighed(zeros: NDArray, ones: NDArray, below: NDArray | None) -> tuple[NDArray, NDArray]:
    """Log weighted probability of nodes, and the posterior weight of their own estimate."""
    own = log_kt(zeros, ones)
    if below is None:
        return own, np.ones(len(own))
    return _LOG_HALF + np.logaddexp(own, below), 1 / (1 + np.exp(np.clip(below - own, -700, 700)))


def build(grams: NDArray, counts: NDArray, depth: int, above: int = 2) -> tuple[list[Level], tuple[NDArray, NDArray, NDArray, NDArray]]:
    """Levels ``above`` to ``depth`` of the tree of sorted distinct grams.

    Also what level ``above`` hands up: context bytes, partial byte with a leading one,
    zeros, ones and log weighted probability, as (context << 8 | partial, zeros, ones, logs).
    """
    counts = counts.astype(np.float64)
    levels: list[Level] = []
    deeper: list[tuple[NDArray, NDArray]] | None = None  # per bit: a pair of each node, its log
    pair_of_deeper: NDArray | None = None
    handed: list[tuple[NDArray, NDArray, NDArray, NDArray]] = []
    byte_of = (grams & np.uint64(255)).astype(np.int64)
    for d in range(depth, above - 1, -1):
        shown = grams >> np.uint64(8 * (depth - d + 1))
        contexts, number = np.unique(shown, return_inverse=True)
        pair = number.astype(np.int64) << 8 | byte_of
        pairs, where = np.unique(pair, return_inverse=True)
        count = np.bincount(where, weights=counts, minlength=len(pairs))
        context, byte = pairs >> 8, pairs & 255
        level = Level(contexts, [], [], [])
        ahead: list[tuple[NDArray, NDArray]] = []
        for bit in range(8):
            key, zeros, ones, node = _nodes(context, byte, count, bit)
            below = None
            if deeper is not None:
                of_gram, logs = deeper[bit]
                below = np.bincount(node[where[of_gram]], weights=logs, minlength=len(key))
            log, own_weight = _weighed(zeros, ones, below)
            level.keys.append(key)
            level.one_share.append((ones + 0.5) / (zeros + ones + 1))
            level.own_weight.append(own_weight)
            node_of_gram = node[where]
            of_node = np.empty(len(key), dtype=np.int64)
            of_node[node_of_gram] = np.arange(len(grams))
            ahead.append((of_node, log))
            if d == above:
                partial = np.int64(1 << bit) | (key & ((1 << bit) - 1))
                handed.append((contexts[key >> bit].astype(np.int64) << 8 | partial, zeros, ones, log))
        levels.append(level)
        deeper, pair_of_deeper = ahead, where
    levels.reverse()
    return levels, tuple(np.concatenate([x[i] for x in handed]) for i in range(4))


@dataclass
class Top:
    """The nodes of no context and of one byte: share of ones and own weight, by (byte or 256, partial)."""

    one_share: NDArray
    own_weight: NDArray
    seen: NDArray


def top(keys: NDArray, zeros: NDArray, ones: NDArray, logs: NDArray) -> Top:
    """From nodes of one-byte contexts (byte << 8 | partial), with the logs of those below them added up."""
    made = Top(np.full((257, 256), 0.5), np.zeros((257, 256)), np.zeros((257, 256), dtype=bool))
    log, weight = _weighed(zeros, ones, logs)
    at = (keys >> 8, keys & 255)
    made.one_share[at], made.own_weight[at], made.seen[at] = (ones + 0.5) / (zeros + ones + 1), weight, True
    partial = keys & 255
    z, o, below = (np.bincount(partial, weights=x, minlength=256) for x in (zeros, ones, log))
    _, weight = _weighed(z, o, below)
    made.one_share[256], made.own_weight[256], made.seen[256] = (o + 0.5) / (z + o + 1), weight, z + o > 0
    return made


def log10_probability(asked: NDArray, depth: int, levels: list[Level], above: Top) -> NDArray:
    """Log10 of the probability of each gram's byte after its context, for distinct grams."""
    byte = (asked & np.uint64(255)).astype(np.int64)
    numbers = []
    for d, level in enumerate(levels, start=2):
        shown = asked >> np.uint64(8 * (depth - d + 1))
        at = np.minimum(np.searchsorted(level.contexts, shown), max(len(level.contexts) - 1, 0))
        known = level.contexts[at] == shown if len(level.contexts) else np.zeros(len(asked), bool)
        numbers.append((at, known))
    nearest = (asked >> np.uint64(8 * depth)).astype(np.int64)
    total = np.zeros(len(asked))
    for bit in range(8):
        partial = (1 << bit) | (byte >> (8 - bit))
        one = np.full(len(asked), 0.5)
        begun = np.zeros(len(asked), dtype=bool)
        for level, (at, known) in zip(reversed(levels), reversed(numbers), strict=True):
            key = (at << bit) | (byte >> (8 - bit))
            keys = level.keys[bit]
            if not len(keys):
                continue
            node = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = known & (keys[node] == key)
            share, weight = level.one_share[bit][node], level.own_weight[bit][node]
            one = np.where(hit, np.where(begun, weight * share + (1 - weight) * one, share), one)
            begun |= hit
        for row in (nearest, 256):
            hit, share, weight = above.seen[row, partial], above.one_share[row, partial], above.own_weight[row, partial]
            one = np.where(hit, np.where(begun, weight * share + (1 - weight) * one, share), one)
            begun |= hit
        total += np.log10(np.where((byte >> (7 - bit)) & 1, one, 1 - one))
    return total
