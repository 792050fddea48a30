"""Linear-chain conditional random fields in numpy: forward-backward over many chains at once, and training."""

from __future__ import annotations

import numpy as np

#: Positions of a block; long chains are run block by block, all blocks at a time.
BLOCK = 64


def _scaled(x: np.ndarray, axis: int = -1) -> np.ndarray:
    return x / x.sum(axis=axis, keepdims=True)


def _messages(scores: np.ndarray, lengths: np.ndarray, transition: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(alpha, beta, psi, step): what comes to each position from the left, itself included, and from the right.

    Chains are cut into blocks. The product of a block's factors carries messages over it, so the number of steps is the
    block size plus the blocks of the longest chain, not its length.
    """
    n, labels = scores.shape
    lengths = np.asarray(lengths, np.int64)
    block = int(min(block, lengths.max()))
    step = np.exp(transition - transition.max())
    psi = np.exp(scores - scores.max(axis=1, keepdims=True))
    blocks = -(-lengths // block)
    first = np.cumsum(blocks) - blocks
    rank = np.arange(blocks.sum()) - np.repeat(first, blocks)
    begin = np.repeat(np.cumsum(lengths) - lengths, blocks) + rank * block
    size = np.minimum(np.repeat(lengths, blocks) - rank * block, block)
    count = len(begin)
    into = np.full((count, labels), 1 / labels)
    back = np.full((count, labels), 1 / labels)
    if blocks.max() > 1:
        carry = np.broadcast_to(np.eye(labels), (count, labels, labels)).copy()
        for j in range(block):
            on = np.flatnonzero(size > j)
            part = (carry[on].reshape(-1, labels) @ step).reshape(-1, labels, labels) * psi[begin[on] + j][:, None, :]
            carry[on] = part / part.sum(axis=(1, 2), keepdims=True)
        for r in range(1, int(blocks.max())):
            at = first[blocks > r] + r
            into[at] = _scaled(np.einsum("nk,nkl->nl", into[at - 1], carry[at - 1]))
        for r in range(int(blocks.max()) - 1, 0, -1):
            at = first[blocks > r] + r
            back[at - 1] = _scaled(np.einsum("nkl,nl->nk", carry[at], back[at]))
    alpha, beta = np.empty((n, labels)), np.empty((n, labels))
    for j in range(block):
        on = np.flatnonzero(size > j)
        at = begin[on] + j
        alpha[at] = into[on] = _scaled((into[on] @ step) * psi[at])
    for j in range(block - 1, -1, -1):
        on = np.flatnonzero(size > j)
        at = begin[on] + j
        beta[at] = back[on]
        back[on] = _scaled((psi[at] * back[on]) @ step.T)
    return alpha, beta, psi, step


def marginals(scores: np.ndarray, lengths: np.ndarray, transition: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Probability of every label at every position, exactly as forward-backward gives it.

    scores: (positions, labels) log emissions of all chains, one after another; lengths: positions of each chain, at
    least 1. Every position, the first too, is entered by a transition; before the first, labels are equally likely.
    """
    if not len(scores):
        return np.empty((0, scores.shape[1]))
    alpha, beta, _, _ = _messages(scores, lengths, transition, block)
    return _scaled(alpha * beta)


class Dense:
    """Emission features as a matrix (positions x features)."""

    def __init__(self, x: np.ndarray):
        self.x, self.width = x, x.shape[1]

    def scores(self, weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return self.x[rows] @ weights

    def gradient(self, rows: np.ndarray, g: np.ndarray) -> np.ndarray:
        return self.x[rows].T @ g


class Sparse:
    """Emission features as numbers of ones (positions x slots); the number `width` stands for no feature.

    more: the further features of those few positions that have more than the slots hold.
    """

    def __init__(self, ones: np.ndarray, width: int, more: dict[int, np.ndarray] | None = None):
        self.ones, self.width, self.more = ones, width, more or {}

    def _long(self, rows: np.ndarray) -> list[tuple[int, np.ndarray]]:
        return [(k, self.more[r]) for k, r in enumerate(rows.tolist()) if r in self.more] if self.more else []

    def scores(self, weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
        out = np.vstack([weights, np.zeros(weights.shape[1])])[self.ones[rows]].sum(axis=1)
        for k, own in self._long(rows):
            out[k] += weights[own].sum(axis=0)
        return out

    def gradient(self, rows: np.ndarray, g: np.ndarray) -> np.ndarray:
        at = self.ones[rows].ravel()
        out = np.stack([np.bincount(at, np.repeat(g[:, k], self.ones.shape[1]), self.width + 1)[: self.width] for k in range(g.shape[1])], axis=1)
        for k, own in self._long(rows):
            np.add.at(out, own, g[k])
        return out


def _gradient(scores: np.ndarray, gold: np.ndarray, lengths: np.ndarray, transition: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the negative log-likelihood by scores and transitions, for chains of any length."""
    labels = scores.shape[1]
    alpha, beta, psi, step = _messages(scores, lengths, transition, block)
    first = np.cumsum(lengths) - lengths
    left = np.vstack([alpha[:1], alpha[:-1]])
    left[first] = 1 / labels  # before the first position every label is as likely
    right = psi * beta
    both = left[:, :, None] * step * right[:, None, :]
    pair = (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    later = np.ones(len(gold), bool)
    later[first] = False
    at = np.flatnonzero(later)
    np.subtract.at(pair, (gold[at - 1], gold[at]), 1)
    for k in range(labels):
        pair[:, k] -= (gold[first] == k).sum() * _scaled(step[:, k])
    node = _scaled(alpha * beta)
    node[np.arange(len(gold)), gold] -= 1
    return node, pair


def fit(features: Dense | Sparse, rows: np.ndarray, gold: np.ndarray, lengths: np.ndarray, labels: int, epochs: int = 4, batch: int = 64, rate: float = 0.2, l2: float = 1e-5, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(emission weights, transitions) by AdaGrad on the chains' negative log-likelihood. Deterministic for a seed."""
    rng = np.random.default_rng(seed)
    weights, transition = np.zeros((features.width, labels)), np.zeros((labels, labels))
    sum_w, sum_t = np.full_like(weights, 1e-6), np.full_like(transition, 1e-6)
    begin = np.cumsum(lengths) - lengths
    for _ in range(epochs):
        order = rng.permutation(len(lengths))
        for k in range(0, len(order), batch):
            pick = order[k : k + batch]
            size = lengths[pick]
            at = np.repeat(begin[pick] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            g_score, g_t = _gradient(features.scores(weights, rows[at]), gold[at], size, transition)
            g_w = features.gradient(rows[at], g_score) / len(pick) + l2 * weights
            g_t = g_t / len(pick) + l2 * transition
            sum_w += g_w * g_w
            sum_t += g_t * g_t
            weights -= rate * g_w / np.sqrt(sum_w)
            transition -= rate * g_t / np.sqrt(sum_t)
    return weights, transition
