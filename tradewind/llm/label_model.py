"""Weak supervision on counts: reliabilities of labelers by expectation-maximisation, and a logistic classifier.

Both take distinct patterns with their counts, of which there are as many as votes and features have combinations, whatever
the data's size; so both run where the counts are.
"""

from __future__ import annotations

import numpy as np


def reliabilities(votes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, float, np.ndarray]:
    """How often each labeler is right when it votes, the share of positives, and each pattern's probability of being one.

    ``votes`` is patterns x labelers with +1, -1 and 0 for no vote. Labelers are taken to err independently, and to be right
    more often than not. Half a vote of each kind is added, so that nothing becomes certain.
    """
    right, share = np.full(votes.shape[1], 0.8), 0.5
    posterior = np.full(len(votes), 0.5)
    for _ in range(rounds):
        odds = np.log(right / (1 - right))
        posterior = 1 / (1 + np.exp(-(np.log(share / (1 - share)) + votes @ odds)))
        weight = counts[:, None] * (votes != 0)
        agree = np.where(votes > 0, posterior[:, None], 1 - posterior[:, None])
        right = np.clip(((weight * agree).sum(0) + 0.5) / (weight.sum(0) + 1), 0.55, 0.99)
        share = float(np.clip(((counts * posterior).sum() + 0.5) / (counts.sum() + 1), 0.01, 0.99))
    return right, share, posterior


#: How often a labeler says no, nothing and yes of a negative and of a positive, before any data is seen. A check of digits or
#: of ranges is known to be stricter than the others.
USUAL = np.array([[0.5, 0.4, 0.1], [0.1, 0.3, 0.6]])
STRICT = np.array([[0.8, 0.1, 0.1], [0.02, 0.08, 0.9]])
#: What this knowledge weighs: so many candidates, and a share of those that there are.
BELIEF, BELIEF_SHARE = 20.0, 0.02
#: Bounds of the share of positives. Candidates that look alike can't show that there are no others.
SHARES = (0.02, 0.9)


def confusions(votes: np.ndarray, counts: np.ndarray, strict: list[bool], rounds: int = 200) -> tuple[np.ndarray, float]:
    """How often each labeler says no, nothing and yes (class x labeler x 3), and the share of positives, by expectation-maximisation.

    Unlike ``reliabilities``, a yes and a no of one labeler may be worth differently much, and silence counts. What is known
    beforehand (``USUAL``, ``STRICT``) keeps a vote that the data lack meaningful.
    """
    known = np.stack([STRICT if s else USUAL for s in strict], 1)
    belief = BELIEF + BELIEF_SHARE * counts.sum()
    says = (votes[:, :, None] == np.array([-1, 0, 1])).astype(float)
    table, share = known, 0.5
    for _ in range(rounds):
        positive = posterior(votes, table, share)
        weight = counts * np.stack([1 - positive, positive])
        table = belief * known + np.einsum("cp,plv->clv", weight, says)
        table = table / table.sum(2, keepdims=True)
        share = float(np.clip((weight[1].sum() + 0.5) / (counts.sum() + 1), *SHARES))
    return table, share


def posterior(votes: np.ndarray, table: np.ndarray, share: float) -> np.ndarray:
    """The probability that each pattern of votes is a positive. A yes never speaks against it, and a no never for it."""
    at, worth = (votes + 1).astype(int), np.log(table[1] / table[0])
    worth = np.stack([np.minimum(worth[:, 0], 0), worth[:, 1], np.maximum(worth[:, 2], 0)], 1)
    odds = worth[np.arange(votes.shape[1]), at].sum(1) + np.log(share / (1 - share))
    return 1 / (1 + np.exp(-odds))


def logistic(features: np.ndarray, target: np.ndarray, counts: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights (the last is the constant) that fit soft targets, by Newton's method."""
    x = np.hstack([features, np.ones((len(features), 1))])
    weights = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * features.shape[1] + [1e-3])
    scale = counts / max(counts.mean(), 1e-9) if len(counts) else counts
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (scale * (target - p)) - penalty @ weights
        bend = (x * (scale * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + penalty
        step = np.linalg.solve(bend, slope)
        weights += np.clip(step, -2, 2)
    return weights
