"""Linear chains: the best sequence of labels, and training a conditional random field, over many chains at once."""

from __future__ import annotations

import numpy as np


def _steps(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chains in order of length, longest first, where they begin, and how many are longer than t for each t."""
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    longest = int(lengths.max(initial=0))
    return order, first[:-1][order], np.searchsorted(-lengths[order], -np.arange(longest), "left")


def viterbi(scores: np.ndarray, first: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """The best label of each element.

    ``scores`` has a row per element and a column per label, ``first`` where each chain begins (and one more at the
    end), ``transition`` what going from a label (row) to the next one (column) adds. Ties go to the first label.
    Steps run over the length of the longest chain, each over all chains that are as long.
    """
    labels = np.zeros(len(scores), np.uint8)
    order, start, active = _steps(first)
    if not len(active):
        return labels
    start = start[: active[0]]
    back = np.zeros(scores.shape, np.uint8)
    best = scores[start].copy()
    for t in range(1, len(active)):
        rows = start[: active[t]] + t
        reached = best[: active[t], :, None] + transition[None]
        back[rows] = reached.argmax(axis=1)
        best[: active[t]] = reached.max(axis=1) + scores[rows]
    state = best.argmax(axis=1)
    for t in range(len(active) - 1, 0, -1):
        rows = start[: active[t]] + t
        labels[rows] = state[: active[t]]
        state[: active[t]] = back[rows, state[: active[t]]]
    labels[start] = state
    return labels


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(values - top).sum(axis=axis))


def expected(scores: np.ndarray, first: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward pass: probability of each label of each element, and expected number of transitions."""
    order, start, active = _steps(first)
    forward, backward = scores.copy(), np.zeros_like(scores)
    for t in range(1, len(active)):
        rows = start[: active[t]] + t
        forward[rows] += _log_sum(forward[rows - 1][:, :, None] + transition[None], 1)
    for t in range(len(active) - 1, 0, -1):
        rows = start[: active[t]] + t
        backward[rows - 1] = _log_sum(transition[None] + (scores[rows] + backward[rows])[:, None, :], 2)
    joint = forward + backward
    share = np.exp(joint - _log_sum(joint, 1)[:, None])
    inner = np.ones(len(scores), bool)
    inner[first[:-1][np.diff(first) > 0]] = False
    rows = np.flatnonzero(inner)
    pairs = forward[rows - 1][:, :, None] + transition[None] + (scores[rows] + backward[rows])[:, None, :]
    flat = pairs.reshape(len(rows), transition.size)
    pairs = np.exp(flat - _log_sum(flat, 1)[:, None]) if len(rows) else flat
    return share, pairs.sum(axis=0).reshape(transition.shape)


def train_field(
    features: np.ndarray,
    first: np.ndarray,
    share: np.ndarray,
    pairs: np.ndarray,
    start: tuple[np.ndarray, np.ndarray] | None = None,
    rounds: int = 150,
    penalty: float = 1.0,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features x labels) and transitions of a linear-chain conditional random field, by likelihood.

    ``share`` has the probability of each label of each element and ``pairs`` the expected number of transitions, as
    ``expected`` gives them; known labels are probabilities of 0 and 1. Adam steps from ``start`` (or zeros) on the
    gradient of the mean log-likelihood per element, with ``penalty`` on squared weights as a whole.
    """
    n_labels = share.shape[1]
    shapes = [(features.shape[1], n_labels), (n_labels, n_labels)]
    weights = list(start) if start else [np.zeros(shape) for shape in shapes]
    moment, square = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
    for n in range(1, rounds + 1):
        own, steps = expected(features @ weights[0], first, weights[1])
        gradients = [features.T @ (share - own), pairs - steps]
        for k, gradient in enumerate(gradients):
            gradient = (gradient - penalty * weights[k]) / max(1, len(share))
            moment[k] = 0.9 * moment[k] + 0.1 * gradient
            square[k] = 0.999 * square[k] + 0.001 * gradient**2
            step = (moment[k] / (1 - 0.9**n)) / (np.sqrt(square[k] / (1 - 0.999**n)) + 1e-9)
            weights[k] = weights[k] + 0.1 * step
    return weights[0], weights[1]


def train_latent_field(
    features: np.ndarray, first: np.ndarray, given: np.ndarray, n_labels: int, agreement: float
) -> tuple[np.ndarray, np.ndarray]:
    """A field for labels that nobody has seen, from one label per chain.

    ``given`` has, for each element, the label of its chain: a noisy copy of the element's own, right with probability
    ``agreement``. A model of single elements tells how often each kind of element lies in chains of each label, all
    labels counting alike. Taking the noise out of that gives the probabilities of the elements' own labels, and from
    those, with the given label as further evidence, the field is trained. So elements that look like those of another
    kind of chain take its label, and the transitions are those between elements, not those of whole chains.
    """
    wrong = (1 - agreement) / (n_labels - 1)
    weights, _ = train_field(
        features, np.arange(len(given) + 1), np.eye(n_labels)[given], np.zeros((n_labels, n_labels))
    )
    scores = features @ weights - np.log(np.maximum(1, np.bincount(given, minlength=n_labels)) / len(given))
    share = np.exp(scores - _log_sum(scores, 1)[:, None])
    own = np.clip((share - wrong) / (agreement - wrong), 0.01, 0.99)
    copies = np.where(np.arange(n_labels) == given[:, None], agreement, wrong)
    share, pairs = expected(np.log(own * copies), first, np.zeros((n_labels, n_labels)))
    return train_field(features, first, share, pairs)
