"""Exact integer convolution: number-theoretic transforms modulo a prime, as matrix products of floats.

A transform of up to 64 points is one product with the matrix of powers of a root of unity; longer ones are cut into
rows and columns (Bailey's four steps). All numbers are integers below the prime, so a sum of 64 products stays under
2^53 and floats carry it exactly.
"""

from __future__ import annotations

from functools import cache

import numpy as np

PRIME = 7340033  # 7 * 2**20 + 1
GENERATOR = 3
#: The longest transform: the prime has roots of unity of this order.
MAX_SIZE = 1 << 20
RADIX = 64


def reduced(x: np.ndarray) -> np.ndarray:
    """Integers of at most 2^52, modulo the prime; zero may come out as 0 or as the prime itself."""
    q = x * (1.0 / PRIME)
    np.floor(q, out=q)
    q *= PRIME
    return np.subtract(x, q, out=q)


def powers(root: int, exponents: np.ndarray, order: int) -> np.ndarray:
    """root ** exponents for a root of the given order."""
    table = np.ones(order, np.int64)
    size, step = 1, root
    while size < order:
        table[size : 2 * size] = table[:size] * step % PRIME
        size, step = 2 * size, step * step % PRIME
    return table[exponents % order].astype(np.float64)


def split(size: int) -> tuple[int, int]:
    """Rows and columns of a transform of more than 64 points."""
    bits = size.bit_length() - 1
    rows = 1 << min(6, (bits + 1) // 2)
    return rows, size // rows


@cache
def matrix(size: int, inverse: bool) -> np.ndarray:
    root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
    root = pow(root, -1, PRIME) if inverse else root
    places = np.arange(size)
    return powers(root, np.multiply.outer(places, places), size)


@cache
def twiddles(size: int, inverse: bool) -> np.ndarray:
    root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
    root = pow(root, -1, PRIME) if inverse else root
    rows, columns = split(size)
    return powers(root, np.multiply.outer(np.arange(rows), np.arange(columns)), size)


def forward(x: np.ndarray) -> np.ndarray:
    """Transforms of the rows of `x`, in the order that `inverse` takes."""
    size = x.shape[1]
    if size <= RADIX:
        return reduced(x @ matrix(size, False))
    rows, columns = split(size)
    y = reduced(np.matmul(matrix(rows, False), x.reshape(-1, rows, columns)))
    y *= twiddles(size, False)
    return forward(reduced(y).reshape(-1, columns)).reshape(-1, size)


def inverse(x: np.ndarray) -> np.ndarray:
    """Undoes `forward`, but for the factor of the size."""
    size = x.shape[1]
    if size <= RADIX:
        return reduced(x @ matrix(size, True))
    rows, columns = split(size)
    y = inverse(x.reshape(-1, columns)).reshape(-1, rows, columns)
    y *= twiddles(size, True)
    return reduced(np.matmul(matrix(rows, True), reduced(y))).reshape(-1, size)


@cache
def frequencies(size: int) -> np.ndarray:
    """The frequency at each place of a transform."""
    if size <= RADIX:
        return np.arange(size)
    rows, columns = split(size)
    return (np.arange(rows)[:, None] + rows * frequencies(columns)[None, :]).ravel()


@cache
def negated(size: int) -> np.ndarray:
    """For each place of a transform the place of the opposite frequency."""
    own = frequencies(size)
    places = np.empty(size, np.int64)
    places[own] = np.arange(size)
    return places[-own % size]


@cache
def half_shift(size: int) -> np.ndarray:
    """The factors of a transform when its row moves on by half its size."""
    return np.where(frequencies(size) % 2, -1.0, 1.0)


def scale_of(size: int) -> int:
    """The factor by which `inverse` comes out too large, undone modulo the prime."""
    return pow(size, -1, PRIME)
