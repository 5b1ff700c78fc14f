"""Burrows-Wheeler transform and common prefixes of many strings, built column by column.

Round j inserts one symbol of every string: the suffix of length j of each string takes its place
among the suffixes so far (Bauer, Cox and Rosone, 2013, with prefixes as by Cox et al., 2016). The place
follows from the transform itself: the k-th occurrence of a symbol belongs to the k-th suffix that
begins with it. Between rounds the transform and the prefixes stand in two files that are read
and written front to back; a round's files replace the last one's.

Prefixes are kept up to `depth`. A new suffix and its neighbour that begin with the same symbol share one symbol more
than the suffixes behind that symbol, which is a range minimum over the prefixes of the round before.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow.fs as pafs


class ColumnFiles:
    """The two columns between rounds, as files in a folder that all executors may share."""

    def __init__(self, folder: str):
        self.files, root = pafs.FileSystem.from_uri(folder)
        self.root = f"{root}/{uuid.uuid4().hex}"
        self.files.create_dir(self.root, recursive=True)
        self.round = 0

    def write(self, symbols: np.ndarray, prefixes: np.ndarray) -> None:
        for name, column in (("bwt", symbols), ("lcp", prefixes)):
            with self.files.open_output_stream(f"{self.root}/{name}-{self.round + 1}") as stream:
                stream.write(memoryview(column))
        if self.round:
            for name in ("bwt", "lcp"):
                self.files.delete_file(f"{self.root}/{name}-{self.round}")
        self.round += 1

    def read(self, symbols: np.dtype) -> tuple[np.ndarray, np.ndarray]:
        columns = []
        for name, kind in (("bwt", symbols), ("lcp", np.uint8)):
            with self.files.open_input_stream(f"{self.root}/{name}-{self.round}") as stream:
                columns.append(np.frombuffer(stream.read(), kind))
        return columns[0], columns[1]

    def remove(self) -> None:
        self.files.delete_dir(self.root)


def range_minimum(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Minima of values[first..last], from tables of minima over powers of two."""
    span = np.frexp((last - first + 1).astype(np.float64))[1] - 1
    out = np.empty(len(first), values.dtype)
    table = values
    for level in range(int(span.max(initial=-1)) + 1):
        own = np.flatnonzero(span == level)
        out[own] = np.minimum(table[first[own]], table[last[own] - (1 << level) + 1])
        table = np.minimum(table[: -(1 << level)], table[1 << level :]) if len(table) > 1 << level else table
    return out


class Order:
    """The places of a transform by symbol: what follows the k-th occurrence of a symbol, and the other way round."""

    def __init__(self, symbols: np.ndarray, strings: int, counts: np.ndarray | None = None):
        """`counts`: of each symbol, if they are known."""
        self.order = np.argsort(symbols, kind="stable")
        self.borders = np.concatenate([[0], np.cumsum(np.bincount(symbols) if counts is None else counts)])
        #: Suffixes of one symbol or more stand after the end marks of the strings, in the order of the places of their symbols.
        self.shift = strings - int(self.borders[1])

    def suffix(self, places: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The suffixes that begin with the symbols at these places; `symbols` are the symbols there, none 0."""
        out = np.empty(len(places), np.int64)
        by_symbol = np.argsort(symbols, kind="stable")
        groups = np.cumsum(np.bincount(symbols, minlength=len(self.borders) - 1))
        low = 0
        for symbol in np.flatnonzero(np.diff(groups, prepend=0)).tolist():
            own, low = by_symbol[low : groups[symbol]], int(groups[symbol])
            first = self.borders[symbol]
            out[own] = np.searchsorted(self.order[first : self.borders[symbol + 1]], places[own]) + first
        return out + self.shift

    def place(self, suffixes: np.ndarray) -> np.ndarray:
        """The places of the symbols that these suffixes begin with."""
        return self.order[suffixes - self.shift]


class Collection:
    """Strings end to end in `letters`; string i has the `sizes[i]` bytes before `ends[i]`."""

    def __init__(self, strings: list[bytes]):
        self.letters = np.frombuffer(b"".join(strings), np.uint8)
        self.sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        #: Bytes plus 1 fit into bytes for all valid UTF-8.
        self.kind = np.dtype(np.uint8 if self.letters.max(initial=0) < 255 else np.uint16)
        self.letters = self.letters.astype(self.kind)
        self.ends = np.cumsum(self.sizes)

    def symbols(self, strings: np.ndarray, column: int) -> np.ndarray:
        """The symbol in front of the suffix of length `column`: a byte plus 1, or 0 where the string is used up."""
        inside = self.sizes[strings] > column
        out = np.zeros(len(strings), self.kind)
        out[inside] = self.letters[self.ends[strings[inside]] - 1 - column] + self.kind.type(1)
        return out

    def build(self, depth: int, files: ColumnFiles) -> None:
        n = len(self.sizes)
        active = np.arange(n)
        at = np.arange(n)
        front = self.symbols(active, 0)
        width = int(self.letters.max(initial=0)) + 2
        counts = np.bincount(front, minlength=width)
        files.write(front, np.zeros(n, np.uint8))
        for column in range(1, int(self.sizes.max(initial=0)) + 1):
            bwt, lcp = files.read(self.kind)
            going = front > 0
            active, at, front = active[going], at[going], front[going]
            order = Order(bwt, n, counts)
            at = order.suffix(at, front)
            front = self.symbols(active, column)
            counts = counts + np.bincount(front, minlength=width)
            total = len(bwt) + len(active)
            old = np.ones(total, bool)
            old[at] = False
            new_bwt, new_lcp = np.empty(total, self.kind), np.empty(total, np.uint8)
            new_bwt[old], new_lcp[old] = bwt, lcp
            new_bwt[at] = front
            # Where a new suffix meets its neighbours: behind equal first symbols lies a range of the last round.
            check = np.concatenate([at, at + 1])
            check = check[check < total]
            inner = check[check > n]
            before, behind = order.place(inner - 1), order.place(inner)
            joint = bwt[behind] == bwt[before]
            new_lcp[check] = 0
            shared = range_minimum(lcp, before[joint] + 1, behind[joint])
            new_lcp[inner[joint]] = np.minimum(shared, depth - 1) + 1
            files.write(new_bwt, new_lcp)

    def groups(self, depth: int, files: ColumnFiles) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(strings, offsets, group) of all places with `depth` symbols to go; equal groups are equal strings of that length.

        A walk along the finished transform meets the suffixes of all strings, the shortest first.
        """
        bwt, lcp = files.read(self.kind)
        group = np.cumsum(lcp < depth, dtype=np.int32)
        order = Order(bwt, len(self.sizes)).order
        ended = int(np.count_nonzero(bwt == 0))
        suffix = np.empty(len(bwt), np.int32)
        suffix[order] = np.arange(len(bwt), dtype=np.int32) - ended + len(self.sizes)
        active, at, found = np.arange(len(self.sizes)), np.arange(len(self.sizes)), []
        for column in range(1, int(self.sizes.max(initial=0)) + 1):
            going = self.sizes[active] >= column
            active, at = active[going], suffix[at[going]]
            if column >= depth:
                found.append((active, self.sizes[active] - column, group[at]))
        return found


def earliest_flat(strings: list[bytes], ranks: np.ndarray, depth: int, folder: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, offset, smallest): the substrings of `depth` bytes of all strings, string by string, and the smallest rank of a string that holds each."""
    if not strings:
        return (np.zeros(0, np.int64),) * 3
    files = ColumnFiles(folder)
    try:
        collection = Collection(strings)
        collection.build(depth, files)
        found = collection.groups(depth, files)
    finally:
        files.remove()
    owner = np.concatenate([f[0] for f in found] or [np.zeros(0, np.int64)])
    offset = np.concatenate([f[1] for f in found] or [np.zeros(0, np.int64)])
    group = np.concatenate([f[2] for f in found] or [np.zeros(0, np.int64)])
    order = np.argsort(group, kind="stable")
    starts = np.flatnonzero(np.diff(group[order], prepend=-1))
    least = np.minimum.reduceat(ranks[owner[order]], starts) if len(order) else np.zeros(0, np.int64)
    smallest = np.empty(len(group), np.int64)
    smallest[order] = np.repeat(least, np.diff(np.append(starts, len(order))))
    by_string = np.lexsort((offset, owner))
    return owner[by_string], offset[by_string], smallest[by_string]


def earliest(strings: list[bytes], ranks: np.ndarray, depth: int, folder: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per string: the offsets of its substrings of `depth` bytes, and for each the smallest rank of a string that holds it."""
    owner, offset, smallest = earliest_flat(strings, ranks, depth, folder)
    borders = np.searchsorted(owner, np.arange(len(strings) + 1))
    return [(offset[a:b], smallest[a:b]) for a, b in zip(borders[:-1], borders[1:])]
