"""Canonical length-limited Huffman codes over ids, packed and unpacked with numpy."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np


def code_lengths(counts: np.ndarray, max_bits: int) -> np.ndarray:
    """Optimal code lengths of at most `max_bits` for ids with a count; 0 for the others (package-merge).

    Items of a level are the ids and the pairs of the level below, sorted by weight. Going back from
    the top, the items taken at a level are its cheapest ones, so only their numbers have to be known.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} ids need codes of more than {max_bits} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used].astype(np.int64)
    pairs, kinds = np.zeros(0, np.int64), []
    for _ in range(max_bits):
        weights = np.concatenate([leaves, pairs])
        order = np.argsort(weights, kind="stable")
        kinds.append(order < len(leaves))
        weights = weights[order]
        pairs = weights[: len(weights) // 2 * 2].reshape(-1, 2).sum(axis=1)
    taken = 2 * len(used) - 2
    for is_leaf in reversed(kinds):
        n = int(is_leaf[:taken].sum())
        lengths[used[:n]] += 1
        taken = 2 * (taken - n)
    return lengths


@dataclass(frozen=True)
class Codebook:
    """Code lengths by id; the codes follow from them: by length, then by id."""

    lengths: np.ndarray
    max_bits: int

    @cached_property
    def _ordered(self) -> np.ndarray:
        used = np.flatnonzero(self.lengths)
        return used[np.argsort(self.lengths[used], kind="stable")]

    @cached_property
    def codes(self) -> np.ndarray:
        codes = np.zeros(len(self.lengths), np.uint64)
        # A code fills 2 ** (max_bits - length) cells of the decoding table; its cells start where the last one's end.
        cells = np.left_shift(1, self.max_bits - self.lengths[self._ordered].astype(np.int64))
        starts = np.cumsum(cells) - cells
        codes[self._ordered] = starts >> (self.max_bits - self.lengths[self._ordered].astype(np.int64))
        return codes

    @cached_property
    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Id and code length for each value of the next `max_bits` bits."""
        cells = np.left_shift(1, self.max_bits - self.lengths[self._ordered].astype(np.int64))
        ids, lens = np.zeros(1 << self.max_bits, np.uint32), np.zeros(1 << self.max_bits, np.int64)
        filled = int(cells.sum())
        ids[:filled] = np.repeat(self._ordered.astype(np.uint32), cells)
        lens[:filled] = np.repeat(self.lengths[self._ordered].astype(np.int64), cells)
        return ids, lens

    def pack(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Code runs of ids, each from a byte border.

        `sizes` are the numbers of ids of the runs, none 0. Returns the bytes, the first byte of each run
        with the end added, and the bit offset of each id inside its run.
        """
        lens = self.lengths[ids].astype(np.int64)
        ends = np.cumsum(lens)
        last = np.cumsum(sizes) - 1
        run_bits = np.diff(ends[last], prepend=0)
        borders = np.concatenate([[0], np.cumsum((run_bits + 7) // 8)])
        inside = ends - lens - np.repeat(ends[last] - run_bits, sizes)
        at = inside + np.repeat(borders[:-1] * 8, sizes)
        # A code of up to 32 bits touches two words of 32 bits at most; bits of different ids never overlap, so sums join them.
        shifted = self.codes[ids] << (64 - (at & 31) - lens).astype(np.uint64)
        words = at >> 5
        size = int(borders[-1] + 3) // 4 + 1
        packed = np.bincount(words, (shifted >> np.uint64(32)).astype(np.float64), size)
        packed[1:] += np.bincount(words, (shifted & np.uint64(0xFFFFFFFF)).astype(np.float64), size)[: size - 1]
        return packed.astype(np.uint64).astype(">u4").tobytes()[: borders[-1]], borders, inside

    def unpack(self, payload: bytes, marks: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The ids from `counts[i]` codes at each bit offset `marks[i]`, joined in order.

        All marks are read side by side: in each step every mark that has codes left looks its next
        bits up in the table and moves on.
        """
        raw = np.frombuffer(payload + b"\0" * 8, np.uint8).astype(np.uint32)
        words = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        ids, lens = self.table
        order = np.argsort(-counts, kind="stable")
        at, left = marks[order].astype(np.int64), counts[order]
        into = (np.cumsum(counts) - counts)[order]
        out = np.empty(int(counts.sum()), np.uint32)
        active = np.searchsorted(-left, -np.arange(int(left.max(initial=0))), "left")
        mask, shift = np.uint32((1 << self.max_bits) - 1), 32 - self.max_bits
        for step, n in enumerate(active.tolist()):
            here = at[:n]
            cell = (words[here >> 3] >> (shift - (here & 7)).astype(np.uint32)) & mask
            out[into[:n] + step] = ids[cell]
            at[:n] += lens[cell]
        return out
