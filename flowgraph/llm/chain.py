"""Linear-chain conditional random fields over many sequences at once.

Sequences lie after each other in flat arrays, ``ends`` giving their borders.  The recursions advance all sequences that are
long enough by one position at a time, so a step is a few numpy calls whatever the number of sequences, and a sequence of
any length is handled whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Chain:
    """Weights by (feature, label), log weights of transitions (from, to), and of the first label."""

    weights: np.ndarray
    transitions: np.ndarray
    start: np.ndarray


def emissions(weights: np.ndarray, flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of the weights of the features flat[ends[i]:ends[i + 1]] of each unit i."""
    out = np.zeros((len(ends) - 1, weights.shape[1]))
    full = np.flatnonzero(np.diff(ends))
    if len(full):
        out[full] = np.add.reduceat(weights[flat], ends[full], axis=0)
    return out


def marginals(emit: np.ndarray, ends: np.ndarray, model: Chain, pairs: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """(label probabilities of each position, log partition summed); adds expected transitions to ``pairs`` if given."""
    sizes = np.diff(ends)
    order = np.argsort(-sizes, kind="stable")
    order = order[: int(np.count_nonzero(sizes))]
    begin, size = ends[:-1][order], sizes[order]
    top = emit.max(axis=1, keepdims=True) if len(emit) else emit[:, :1]
    local = np.exp(emit - top)
    total = float(top.sum())
    move = np.exp(model.transitions)
    alpha = np.empty_like(local)
    if not len(order):
        return local, 0.0
    active = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right")
    state = np.exp(model.start) * local[begin]
    for t in range(size[0]):
        at = begin[: active[t]] + t
        if t:
            state = state[: active[t]] @ move
            state *= local[at]
        norm = state.sum(axis=1, keepdims=True)
        state = state / norm
        total += float(np.log(norm).sum())
        alpha[at] = state
    prob = np.empty_like(local)
    later = np.ones((0, local.shape[1]))
    for t in range(size[0] - 1, -1, -1):
        at = begin[: active[t]] + t
        n = len(later)
        if n:
            ahead = local[at[:n] + 1] * later
            here = ahead @ move.T
            if pairs is not None:
                z = (alpha[at[:n]] * here).sum(axis=1, keepdims=True)
                pairs += move * (alpha[at[:n]].T @ (ahead / z))
            here /= here.sum(axis=1, keepdims=True)
        else:
            here = later
        if n < len(at):
            here = np.concatenate([here, np.ones((len(at) - n, local.shape[1]))])
        joint = alpha[at] * here
        prob[at] = joint / joint.sum(axis=1, keepdims=True)
        later = here
    return prob, total


def fit(
    flat: np.ndarray, flat_ends: np.ndarray, units: np.ndarray, ends: np.ndarray, labels: np.ndarray,
    features: int, kinds: int, steps: int = 80, rate: float = 0.15, penalty: float = 1e-5,
) -> Chain:
    """Maximum conditional likelihood with an L2 penalty by Adam: position i has the features of ``units[i]``."""
    shapes = [(features, kinds), (kinds, kinds), (kinds,)]
    params = [np.zeros(s) for s in shapes]
    first, second = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
    n = max(1, len(units))
    begin = ends[:-1][np.diff(ends) > 0]
    inner = np.ones(len(units), bool)
    inner[begin] = False
    seen = np.zeros((kinds, kinds))
    np.add.at(seen, (labels[np.flatnonzero(inner) - 1], labels[inner]), 1)
    truth = np.zeros((len(units), kinds))
    truth[np.arange(len(units)), labels] = 1
    repeats = np.diff(flat_ends)
    for step in range(1, steps + 1):
        model = Chain(*params)
        pairs = np.zeros((kinds, kinds))
        prob, _ = marginals(emissions(params[0], flat, flat_ends)[units], ends, model, pairs)
        apart = prob - truth
        grad = np.empty(shapes[0])
        for k in range(kinds):
            by_unit = np.bincount(units, apart[:, k], len(repeats))
            grad[:, k] = np.bincount(flat, np.repeat(by_unit, repeats), features)
        grads = [grad / n + penalty * params[0], (pairs - seen) / n + penalty * params[1], apart[begin].sum(axis=0) / n + penalty * params[2]]
        for i, g in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.99 * second[i] + 0.01 * g * g
            params[i] = params[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8)
    return Chain(*params)
