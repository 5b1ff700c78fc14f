"""A factorisation machine over sparse rows, scored in linear time and fitted with AdaGrad in numpy."""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class MachineConfig:
    size: int
    factors: int = 8
    epochs: int = 6
    #: Small samples are passed more often, up to this number of batches.
    min_batches: int = 400
    batch: int = 128
    rate: float = 0.08
    decay: float = 1e-5
    seed: int = 11


@dataclass
class Rows:
    """Sparse rows: entries `starts[i]` up to `starts[i + 1]` belong to row i; no row is empty."""

    starts: np.ndarray
    index: np.ndarray
    value: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1

    @classmethod
    def of(cls, rows: list[tuple[np.ndarray, np.ndarray]]) -> Rows:
        sizes = np.array([len(r[0]) for r in rows], np.int64)
        return cls(
            np.concatenate([[0], np.cumsum(sizes)]), np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
        )

    def take(self, rows: np.ndarray) -> Rows:
        sizes = self.starts[rows + 1] - self.starts[rows]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(starts[-1]) + np.repeat(self.starts[rows] - starts[:-1], sizes)
        return Rows(starts, self.index[at], self.value[at])


class Machine:
    """score = bias + sum w_i x_i + sum over i < j of <v_i, v_j> x_i x_j.

    Per factor, twice the pairwise sum is (sum v_i x_i)^2 - sum (v_i x_i)^2, so no pair is ever formed.
    """

    def __init__(self, bias: float, linear: np.ndarray, factors: np.ndarray):
        self.bias, self.linear, self.factors = bias, linear, factors

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, bias=self.bias, linear=self.linear, factors=self.factors)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Machine:
        with np.load(io.BytesIO(data)) as stored:
            return cls(float(stored["bias"]), stored["linear"], stored["factors"])

    def sums(self, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the logistic function, and the sums of v_i x_i per row."""
        weighted = self.factors[rows.index] * rows.value[:, None]
        first = np.add.reduceat(weighted, rows.starts[:-1], axis=0)
        squares = np.add.reduceat((weighted * weighted).sum(1), rows.starts[:-1])
        linear = np.add.reduceat(self.linear[rows.index] * rows.value, rows.starts[:-1])
        return self.bias + linear + 0.5 * ((first * first).sum(1) - squares), first

    def probabilities(self, rows: Rows) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.sums(rows)[0], -30, 30)))


def fit(rows: Rows, labels: np.ndarray, cfg: MachineConfig) -> Machine:
    rng = np.random.default_rng(cfg.seed)
    share = min(max(labels.mean(), 0.01), 0.99) if len(labels) else 0.5
    machine = Machine(
        float(np.log(share / (1 - share))), np.zeros(cfg.size, np.float32),
        rng.normal(0, 0.02, (cfg.size, cfg.factors)).astype(np.float32),
    )
    seen_linear, seen_factors, seen_bias = np.full(cfg.size, 1e-3, np.float32), np.full_like(machine.factors, 1e-3), 1e-3
    per_epoch = max(1, -(-len(rows) // cfg.batch))
    for _ in range(max(cfg.epochs, -(-cfg.min_batches // per_epoch))):
        order = rng.permutation(len(rows))
        for low in range(0, len(order), cfg.batch):
            own = rows.take(order[low : low + cfg.batch])
            scores, sums = machine.sums(own)
            error = (1 / (1 + np.exp(-np.clip(scores, -30, 30))) - labels[order[low : low + cfg.batch]]) / len(own)
            per_entry = np.repeat(error, np.diff(own.starts)) * own.value
            ids, places = np.unique(own.index, return_inverse=True)
            g_linear = np.bincount(places, per_entry, len(ids)) + cfg.decay * machine.linear[ids]
            spread = np.repeat(sums, np.diff(own.starts), axis=0) - machine.factors[own.index] * own.value[:, None]
            spread *= per_entry[:, None]
            g_factors = np.stack([np.bincount(places, spread[:, k], len(ids)) for k in range(cfg.factors)], 1)
            g_factors += cfg.decay * machine.factors[ids]
            seen_bias += error.sum() ** 2
            machine.bias -= cfg.rate * error.sum() / seen_bias**0.5
            seen_linear[ids] += g_linear**2
            machine.linear[ids] -= cfg.rate * g_linear / np.sqrt(seen_linear[ids])
            seen_factors[ids] += g_factors**2
            machine.factors[ids] -= cfg.rate * g_factors / np.sqrt(seen_factors[ids])
    return machine
