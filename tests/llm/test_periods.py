import random
import time

import numpy as np
import pytest

from eventlake.llm import convolution, periods, queries
from eventlake.llm.periods import PeriodConfig
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"


def found(lists, cfg=PeriodConfig()):
    return [[tuple(map(int, r)) for r in rows] for rows in periods.runs_of([np.array(a, np.int64) for a in lists], cfg)]


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def thue_morse(n):
    return [bin(i).count("1") % 2 for i in range(n)]


def mixed(rng):
    """A list with repeated stretches, some of them broken and nested."""
    out = []
    while len(out) < rng.randrange(400):
        unit = [rng.randrange(rng.choice([2, 5, 500])) for _ in range(rng.randrange(1, 40))]
        out += (unit * rng.randrange(1, 6))[: rng.randrange(1, 150)]
        if rng.random() < 0.3:
            out += out[-rng.randrange(1, 60) :]
    return out


def convolved(x, y):
    size = len(x)
    return [sum(x[i] * y[(i + d) % size] for i in range(size)) % convolution.PRIME for d in range(size)]


@pytest.mark.parametrize("size", [2, 4, 64, 128, 1024])
def test_transforms_convolve(size):
    rng = np.random.default_rng(size)
    x, y = rng.integers(0, convolution.PRIME, (2, size)).astype(float)
    a, b = convolution.forward(x[None]), convolution.forward(y[None])
    got = convolution.inverse(convolution.reduced(a[:, convolution.negated(size)] * b))
    got = convolution.reduced(got * convolution.scale_of(size))[0] % convolution.PRIME
    if size <= 128:
        assert got.tolist() == convolved([int(v) for v in x], [int(v) for v in y])
    moved = convolution.forward(np.roll(y, -size // 2)[None])
    assert np.array_equal(convolution.reduced(convolution.half_shift(size) * b) % convolution.PRIME, moved % convolution.PRIME)


def test_long_transform_comes_back():
    x = np.random.default_rng(1).integers(0, convolution.PRIME, (1, 1 << 14)).astype(float)
    back = convolution.reduced(convolution.inverse(convolution.forward(x)) * convolution.scale_of(1 << 14))
    assert np.array_equal(back % convolution.PRIME, x % convolution.PRIME)


@pytest.mark.parametrize("seed", range(8))
def test_against_brute_force(seed):
    rng = random.Random(seed)
    lists = [mixed(rng) for _ in range(40)] + [[], [1], [3] * 11, [3] * 12, [3] * 13, [1, 2] * 6, list(range(11)) * 2]
    assert found(lists) == [brute.runs_in(a) for a in lists]


def test_words_of_strings():
    lists = [fibonacci(377), thue_morse(300), [0] * 700, [0, 1, 2] * 100 + [0, 1, 2, 3] * 80, list(range(130)) * 3]
    assert found(lists) == [brute.runs_in(a) for a in lists]


def test_shorter_runs_on_demand():
    lists = [[1, 1, 2, 3, 2, 3, 2], fibonacci(90), [1, 2, 3, 4, 1, 2, 3, 4]]
    assert found(lists, PeriodConfig(min_words=2)) == [brute.runs_in(a, 2) for a in lists]


def test_short_transforms_for_long_periods(monkeypatch):
    """Beyond the longest transform a block is searched by its first words."""
    monkeypatch.setattr(periods, "MAX_SIZE", 16)
    rng = random.Random(5)
    lists = [mixed(rng) for _ in range(30)] + [[rng.randrange(1000) for _ in range(150)] * 2, fibonacci(300)]
    assert found(lists) == [brute.runs_in(a) for a in lists]


@pytest.mark.parametrize("make", [lambda n: [7] * n, lambda n: list(range(7)) * (n // 7), lambda n: list(range(n // 2)) * 2, fibonacci])
def test_long_texts_take_no_square(make):
    started = time.time()
    assert found([make(200_000)])[0]
    assert time.time() - started < 60


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    rows = queries.QUERIES["op12_periodic_runs"](spark, SMALL)
    assert rows.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for n, t in rows.dtypes if n not in ("runs_sha256", "collapsed_sha256")} == {"bigint"}
    assert sorted(map(tuple, rows.collect())) == sorted(brute.period_row(r.doc_id, r.text) for r in docs)


def test_hard_documents(hard_docs, hard_rows, clashing):
    rows = periods.periodic_runs(clashing(hard_docs), ["doc_id", "doc"]).collect()
    want = []
    for r in hard_rows:
        words = brute.SPACED.findall(r[1] or "")
        runs = [(0, 42_000, 7)] if len(words) == 42_000 else brute.runs_in(words)
        want.append((r[0], runs, brute.without_repeats(words, runs)))
    assert sorted(((r.doc.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in rows), key=repr) == sorted(want, key=repr)


def test_empty_table(documents):
    assert periods.periodic_runs(documents(), ["doc_id"]).count() == 0
