"""A linear-chain conditional random field in numpy, over batches of sequences.

A token has one feature id in each of K slots (0: none there); its score for a label is
the sum of the slots' weights. Sequences of a batch are padded to the longest.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np


def pad(sequences: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(n, longest, K) ids and the lengths."""
    lengths = np.array([len(s) for s in sequences])
    out = np.zeros((len(sequences), lengths.max(), sequences[0].shape[1]), dtype=np.int64)
    for row, s in zip(out, sequences, strict=True):
        row[: len(s)] = s
    return out, lengths


def batches(sequences: Sequence[np.ndarray], cells: int = 200_000):
    """Index arrays of sequences of like length, at most ``cells`` padded tokens together."""
    order = np.argsort([len(s) for s in sequences], kind="stable")[::-1]
    at = 0
    while at < len(order):
        n = max(1, cells // max(1, len(sequences[order[at]])))
        yield order[at : at + n]
        at += n


@dataclass
class Chain:
    weights: np.ndarray  # (features, labels)
    moves: np.ndarray  # (labels, labels): from, to

    @classmethod
    def fit(cls, sequences, labels, n_features: int, n_labels: int, rounds: int = 60, rate: float = 0.2, decay: float = 1e-3) -> Chain:
        """Maximum likelihood with a small ridge, by Adam over the whole (bounded) training set."""
        chain = cls(np.zeros((n_features, n_labels)), np.zeros((n_labels, n_labels)))
        if not sequences:
            return chain
        groups = []
        for index in batches(sequences):
            ids, lengths = pad([sequences[i] for i in index])
            gold = np.zeros(ids.shape[:2], dtype=np.int64)
            for row, i in zip(gold, index, strict=True):
                row[: len(labels[i])] = labels[i]
            groups.append((ids, lengths, gold))
        total = sum(len(s) for s in sequences)
        groups = [(ids, lengths, gold, *np.nonzero(np.arange(ids.shape[1])[None, :] < lengths[:, None])) for ids, lengths, gold in groups]
        state = [np.zeros_like(p) for p in (chain.weights, chain.moves, chain.weights, chain.moves)]
        for step in range(1, rounds + 1):
            slopes = [decay * chain.weights, decay * chain.moves]
            for ids, lengths, gold, n, t in groups:
                marginal, pairs, mask = chain._expect(ids, lengths)
                error = marginal * mask[..., None]
                error[n, t, gold[n, t]] -= 1
                flat = error[n, t] / total
                for k in range(ids.shape[2]):
                    for label in range(n_labels):
                        slopes[0][:, label] += np.bincount(ids[n, t, k], flat[:, label], n_features)
                slopes[1] += pairs / total
                both = mask[:, 1:]
                np.add.at(slopes[1], (gold[:, :-1][both], gold[:, 1:][both]), -1 / total)
            slopes[0][0] = 0
            for i, (value, slope) in enumerate(zip((chain.weights, chain.moves), slopes, strict=True)):
                state[i] = 0.9 * state[i] + 0.1 * slope
                state[i + 2] = 0.999 * state[i + 2] + 0.001 * slope**2
                value -= rate * (state[i] / (1 - 0.9**step)) / (np.sqrt(state[i + 2] / (1 - 0.999**step)) + 1e-8)
        return chain

    def scores(self, ids: np.ndarray) -> np.ndarray:
        score = self.weights[ids[:, :, 0]]
        for k in range(1, ids.shape[2]):
            score = score + self.weights[ids[:, :, k]]
        return score

    def _passes(self, ids: np.ndarray, lengths: np.ndarray):
        """Scaled forward and backward values, token factors and the mask of real tokens."""
        score = self.scores(ids)
        factor = np.exp(score - score.max(axis=2, keepdims=True))
        move = np.exp(self.moves - self.moves.max())
        mask = np.arange(score.shape[1])[None, :] < lengths[:, None]
        ahead, behind = factor.copy(), np.ones_like(factor)
        ahead[:, 0] /= ahead[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, score.shape[1]):
            ahead[:, t] *= ahead[:, t - 1] @ move
            ahead[:, t] /= ahead[:, t].sum(axis=1, keepdims=True)
        for t in range(score.shape[1] - 2, -1, -1):
            back = (factor[:, t + 1] * behind[:, t + 1]) @ move.T
            behind[:, t] = np.where(mask[:, t + 1, None], back / back.sum(axis=1, keepdims=True), 1)
        return ahead, behind, factor, move, mask

    def _expect(self, ids: np.ndarray, lengths: np.ndarray):
        ahead, behind, factor, move, mask = self._passes(ids, lengths)
        marginal = ahead * behind
        marginal /= marginal.sum(axis=2, keepdims=True)
        both = mask[:, 1:]
        left, right = ahead[:, :-1][both], (factor * behind)[:, 1:][both]
        whole = ((left @ move) * right).sum(axis=1, keepdims=True)
        return marginal, (left / whole).T @ right * move, mask

    def marginals(self, sequences: Sequence[np.ndarray]) -> list[np.ndarray]:
        """Forward-backward: (tokens, labels) probabilities for each sequence."""
        out: list = [None] * len(sequences)
        for index in batches(sequences):
            ids, lengths = pad([sequences[i] for i in index])
            ahead, behind, *_ = self._passes(ids, lengths)
            share = ahead * behind
            share /= share.sum(axis=2, keepdims=True)
            for row, i in enumerate(index):
                out[i] = share[row, : lengths[row]]
        return out

    def viterbi(self, sequences: Sequence[np.ndarray]) -> list[np.ndarray]:
        """The likeliest labels of each sequence; ties go to the lower label."""
        out: list = [None] * len(sequences)
        for index in batches(sequences):
            ids, lengths = pad([sequences[i] for i in index])
            score = self.scores(ids)
            n, longest, labels = score.shape
            best, back = score[:, 0], np.zeros((n, longest, labels), dtype=np.int64)
            ends = np.where((lengths == 1)[:, None], best, 0)
            for t in range(1, longest):
                step = best[:, :, None] + self.moves[None]
                back[:, t] = step.argmax(axis=1)
                best = score[:, t] + step.max(axis=1)
                ends = np.where((lengths == t + 1)[:, None], best, ends)
            path = np.zeros((n, longest), dtype=np.int64)
            path[np.arange(n), lengths - 1] = ends.argmax(axis=1)
            for t in range(longest - 1, 0, -1):
                inside = t < lengths
                path[inside, t - 1] = back[inside, t, path[inside, t]]
            for row, i in enumerate(index):
                out[i] = path[row, : lengths[row]]
        return out
