"""Baum-Welch and the scaled forward recursion on batches of sequences (numpy).

Sequences of a batch are sorted by falling length and laid out time-major, so
the sequences that are still running at a time step are a prefix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Symbols of a layout, with padding (bounds a task's memory).
LAYOUT = 400_000


@dataclass
class Hmm:
    start: np.ndarray  # (states,)
    move: np.ndarray  # (states, states), from row to column
    emit: np.ndarray  # (symbols, states)


def layouts(seqs: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Numbers of the sequences, lengths, and symbols (time, sequence); together all of them."""
    order = np.argsort([-len(s) for s in seqs], kind="stable")
    at = 0
    while at < len(order):
        top = max(1, len(seqs[order[at]]))
        own = order[at:at + max(1, LAYOUT // top)]
        obs = np.zeros((top, len(own)), dtype=np.int64)
        for j, i in enumerate(own):
            obs[:len(seqs[i]), j] = seqs[i]
        yield own, np.array([len(seqs[i]) for i in own]), obs
        at += len(own)


def _running(lens: np.ndarray, steps: int) -> np.ndarray:
    """How many sequences run at each step."""
    return len(lens) - np.searchsorted(lens[::-1], np.arange(steps), side="right")


def log10_likelihoods(m: Hmm, seqs: list[np.ndarray]) -> np.ndarray:
    """log10 of each sequence's exact probability; 0 for an empty one."""
    out = np.zeros(len(seqs))
    for own, lens, obs in layouts(seqs):
        n = _running(lens, len(obs))
        total = np.zeros(len(own))
        a = None
        for t in range(len(obs)):
            k = int(n[t])
            if not k:
                break
            a = (m.start if a is None else a[:k] @ m.move) * m.emit[obs[t, :k]]
            s = a.sum(axis=1)
            a /= s[:, None]
            total[:k] += np.log10(s)
        out[own] = total
    return out


def expected_counts(m: Hmm, seqs: list[np.ndarray]) -> Hmm:
    """Sums of the posteriors: the E-step of Baum-Welch."""
    states, symbols = len(m.start), len(m.emit)
    start, move, emit = np.zeros(states), np.zeros((states, states)), np.zeros((symbols, states))
    for _, lens, obs in layouts([s for s in seqs if len(s)]):
        n, steps = _running(lens, len(obs)), len(obs)
        alpha, scale = np.empty((*obs.shape, states)), np.empty(obs.shape)
        for t in range(steps):
            k = int(n[t])
            a = (m.start if t == 0 else alpha[t - 1, :k] @ m.move) * m.emit[obs[t, :k]]
            scale[t, :k] = s = a.sum(axis=1)
            alpha[t, :k] = a / s[:, None]
        beta = np.ones((obs.shape[1], states))
        for t in range(steps - 1, -1, -1):
            k = int(n[t])
            if t + 1 < steps and (c := int(n[t + 1])):
                ahead = m.emit[obs[t + 1, :c]] * beta[:c] / scale[t + 1, :c, None]
                move += alpha[t, :c].T @ ahead
                beta[:c] = ahead @ m.move.T
                alpha[t, :k] *= beta[:k]  # now the posterior; alpha[t] isn't read again
            # a sequence's last step has beta = 1
        start += alpha[0].sum(axis=0)
        live = np.arange(obs.shape[1]) < n[:, None]
        sym, post = obs[live], alpha[live]
        for s in range(states):
            emit[:, s] += np.bincount(sym, weights=post[:, s], minlength=symbols)
    return Hmm(start, move * m.move, emit)
