"""Runs of words that repeat with a period, found by convolution of blocks.

A run is a longest stretch of words in which words q apart are equal, with q as its smallest period, at least two
periods and 12 words long. A run of period q with 2B <= q < 4B holds an aligned block of B words together with its copy
q words on. So at each dyadic scale B, every aligned block is compared with the windows that follow at the
distances from 2B to 4B: the sum of squared differences between the block and the words at distance d is
(squares of the block) + (squares at the distance) - 2 * (cross products), and exact integer transforms (`convolution`) give it
for all distances at once. Where it is zero the block occurs again; the distance is a seed. The smallest scale, blocks of two words,
takes all distances below 8, since runs have at least 12 words.

Sums are taken modulo a prime, so a seed may rarely be false; each is extended word by word, to the left and to the right,
which also rejects those. Seeds at multiples of a shorter period of a run that holds them are left out: they lead to
that run again. One pass over a scale costs some transforms of 2B points for each B words, so a text of n words takes
O(n log(n) log(n)) steps however it repeats, and long texts need no more memory than a few arrays of their words.

Documents are rows of one pass over the table: nothing is shuffled and no key can be hot.

Defined cases: NULL, empty and blank texts have no runs, and a NULL text has an empty collapsed text. Repeated rows get
a result each. Further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.convolution import MAX_SIZE, PRIME, forward, half_shift, inverse, negated, reduced, scale_of

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


@dataclass(frozen=True)
class PeriodConfig:
    #: The fewest words of a run.
    min_words: int = 12
    #: Bytes of texts that are searched together.
    batch_bytes: int = 2 << 20
    #: Numbers in one array of transforms.
    chunk: int = 1 << 19


def block_seeds(values: np.ndarray, starts: np.ndarray, size: int, first: int, last: int, chunk: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance): where the words of a block, `size` from each start on, seem to occur again at a distance in [first, last).

    `starts` are multiples of `size`, and so is `first`. `values` are the words as integers below the prime.
    """
    points, lags = 2 * size, range(first // size, -(-last // size))
    padded = np.concatenate([values, np.zeros(-len(values) % size + (lags[-1] + 3) * size)])
    squares = np.concatenate([[0.0], np.cumsum(reduced(padded * padded))])
    blocks = padded.reshape(-1, size)
    back, shift, factor = negated(points), half_shift(points), 2 * scale_of(points) % PRIME
    found_starts, found_distances = [], []
    for low in range(0, len(starts), max(1, chunk // points)):
        own = starts[low : low + max(1, chunk // points)]
        units = own // size
        used = np.unique(np.concatenate([units, *[units + lag + k for lag in lags for k in (0, 1)]]))
        whole = np.zeros((len(used), points))
        whole[:, :size] = blocks[used]
        spectra = forward(whole)
        flipped = spectra[np.searchsorted(used, units)][:, back]
        energy = (squares[own + size] - squares[own])[:, None]
        for lag in lags:
            window = spectra[np.searchsorted(used, units + lag)] + shift * spectra[np.searchsorted(used, units + lag + 1)]
            crossed = reduced(inverse(reduced(flipped * window))[:, :size] * factor)
            at = own[:, None] + (lag * size + np.arange(size))[None, :]
            rest = reduced(energy + (squares[at + size] - squares[at]) - crossed)
            row, column = np.nonzero((rest == 0) | (rest == PRIME))
            found_starts.append(own[row])
            found_distances.append(lag * size + column)
    starts, distances = np.concatenate(found_starts), np.concatenate(found_distances)
    inside = (distances >= max(1, first)) & (distances < last)
    return starts[inside], distances[inside]


def extension(words: np.ndarray, at: np.ndarray, distances: np.ndarray, forwards: bool, cells: int = 1 << 20) -> np.ndarray:
    """How many words from `at` on (or before it) equal those at the distance. The ends of `words` occur once."""
    total, last = np.zeros(len(at), np.int64), len(words) - 1
    active, width = np.arange(len(at)), 16
    while len(active):
        width = max(1, min(width, cells))
        open_ = []
        for low in range(0, len(active), max(1, cells // width)):
            some = active[low : low + max(1, cells // width)]
            steps = total[some][:, None] + np.arange(width)[None, :]
            places = at[some][:, None] + steps if forwards else at[some][:, None] - 1 - steps
            there = places + distances[some][:, None]
            same = words[np.clip(places, 0, last)] == words[np.clip(there, 0, last)]
            whole = same.all(axis=1)
            total[some] += np.where(whole, width, same.argmin(axis=1))
            open_.append(some[whole])
        active, width = np.concatenate(open_), width * 4
    return total


class Found:
    """Runs as (start, end) with their smallest period."""

    def __init__(self) -> None:
        self.periods: dict[tuple[int, int], int] = {}

    def add(self, starts: np.ndarray, ends: np.ndarray, periods: np.ndarray) -> None:
        for start, end, period in sorted(zip(starts.tolist(), ends.tolist(), periods.tolist()), key=lambda r: r[2]):
            self.periods.setdefault((start, end), period)  # two periods of one stretch: the smaller divides the larger

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = np.array([(s, e, p) for (s, e), p in sorted(self.periods.items())], np.int64).reshape(-1, 3)
        return rows[:, 0], rows[:, 1], rows[:, 2]

    def covers(self, starts: np.ndarray, ends: np.ndarray, distances: np.ndarray) -> np.ndarray:
        """Whether a known run holds the stretch and has a period that divides the distance."""
        shortest = int((ends - starts).min()) if len(starts) else 0
        s, e, p = (a for a in self.arrays())
        long = e - s >= shortest
        s, e, p = s[long], e[long], p[long]
        if not len(s):
            return np.zeros(len(starts), bool)
        # At most one run with a period of up to half the distance can hold the stretch: the one that ends last.
        reach = np.maximum.accumulate(e)
        owner = np.maximum.accumulate(np.where(e == reach, np.arange(len(e)), 0))
        before = np.searchsorted(s, starts, "right") - 1
        run = owner[np.maximum(before, 0)]
        return (before >= 0) & (e[run] >= ends) & (distances % p[run] == 0)


def extend_seeds(words: np.ndarray, starts: np.ndarray, distances: np.ndarray, size: int, spacing: int, min_words: int, found: Found) -> None:
    """Adds the runs that the seeds lead to."""
    fresh = ~found.covers(starts, starts + size + distances, distances)
    starts, distances = starts[fresh], distances[fresh]
    order = np.lexsort((starts, distances))
    starts, distances = starts[order], distances[order]
    # Neighbouring blocks with one distance belong together: the first leads to the stretch of the others.
    new = np.concatenate([[True], (distances[1:] != distances[:-1]) | (starts[1:] != starts[:-1] + spacing)])[: len(starts)]
    chain = np.cumsum(new) - 1
    while len(starts):
        chains, first = np.unique(chain, return_index=True)
        at, apart = starts[first], distances[first]
        right = extension(words, at, apart, True)
        true = right >= size
        low = at[true] - extension(words, at[true], apart[true], False)
        high = at[true] + right[true] + apart[true]
        enough = high - low >= np.maximum(min_words, 2 * apart[true])
        found.add(low[enough], high[enough], apart[true][enough])
        rest = starts + size > (at + right)[np.searchsorted(chains, chain)]
        rest[first] = False
        starts, distances, chain = starts[rest], distances[rest], chain[rest]


def runs_of(lists: list[np.ndarray], cfg: PeriodConfig = PeriodConfig()) -> list[np.ndarray]:
    """For each list of words, given as codes from 0 on, the rows (start, length, period) of its runs by start, then period."""
    lengths = np.array([len(a) for a in lists], np.int64)
    firsts = np.cumsum(lengths + 1) - lengths  # one mark before each list
    words = np.empty(int((lengths + 1).sum()) + 1, np.int64)
    words[firsts - 1] = -1 - np.arange(len(lists))
    words[-1] = -1 - len(lists)
    for first, codes in zip(firsts.tolist(), lists):
        words[first : first + len(codes)] = codes
    values = (words % PRIME).astype(np.float64)
    found = Found()
    size = 2 if cfg.min_words >= 5 else 1
    least, longest = max(2, cfg.min_words), int(lengths.max(initial=0))
    low, high = 0, 8
    while longest >= max(least, 2 * low):
        block = min(size, MAX_SIZE // 2)
        starts = np.arange(0, len(words), size)
        own = np.searchsorted(firsts, starts, "right") - 1
        fits = (own >= 0) & (lengths[own] >= max(least, 2 * low)) & (starts + max(1, low) + block <= (firsts + lengths)[own])
        if fits.any():
            at, apart = block_seeds(values, starts[fits], block, low, high, cfg.chunk)
            for distance in range(1, high) if low == 0 else [None]:
                some = slice(None) if distance is None else apart == distance
                extend_seeds(words, at[some], apart[some], block, size, cfg.min_words, found)
        size, low, high = (4, 8, 16) if low == 0 else (2 * size, 2 * low, 2 * high)
    start, end, period = found.arrays()
    owner = np.searchsorted(firsts, start, "right") - 1
    rows = np.stack([start - firsts[owner], end - start, period], axis=1) if len(start) else np.zeros((0, 3), np.int64)
    rows = rows[np.lexsort((period, start))]
    return np.split(rows, np.searchsorted(owner[np.lexsort((period, start))], np.arange(1, len(lists)))) if lists else []


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that a run repeats: of each run only the first period stays."""
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    stays = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    return b" ".join([words[i] for i in stays.tolist()])


def searched(texts: pa.Array, cfg: PeriodConfig) -> tuple[pa.Array, pa.Array]:
    """The runs and the collapsed text of each text."""
    words = [(t.as_buffer().to_pybytes() if t.is_valid else b"").split() for t in texts]
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, bounds = split.values, split.offsets.to_numpy()
    codes = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
    real = pc.binary_length(flat).to_numpy() > 0
    lists = [codes[a:b][real[a:b]] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    runs = runs_of(lists, cfg)
    counts = np.array([len(r) for r in runs], np.int64)
    rows = np.concatenate(runs) if runs else np.zeros((0, 3), np.int64)
    kind = [pa.field(n, pa.int64()) for n in ("start", "length", "period")]
    structs = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(rows[:, i])) for i in range(3)], fields=kind)
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, structs), pa.array([collapsed(w, r).decode() for w, r in zip(words, runs)], pa.string())


def periodic_runs(docs: DataFrame, columns: list[str], cfg: PeriodConfig = PeriodConfig()) -> DataFrame:
    """`doc` (the named columns as a struct), `runs` by start, then period, and `collapsed`, the words that stay, joined by spaces."""
    chosen = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), F.col("text").cast("string").alias("text"))
    ddl = chosen.schema["doc"].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64))
            low = 0
            while low < batch.num_rows:
                before = sizes[low - 1] if low else 0
                high = max(low + 1, int(np.searchsorted(sizes, before + cfg.batch_bytes, "right")))
                own = batch.slice(low, high - low)
                runs, rest = searched(own.column(1), cfg)
                yield pa.RecordBatch.from_arrays([own.column(0), runs, rest], names=["doc", "runs", "collapsed"])
                low = high

    return chosen.mapInArrow(search, f"doc {ddl}, runs {RUNS}, collapsed string")
