import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eventlake.llm import substrings
from eventlake.llm.collection import earliest
from eventlake.llm.substrings import SubstringConfig
from tests.llm import brute


@settings(deadline=None, max_examples=80)
@given(st.lists(st.tuples(st.text("ab\x00é", max_size=30), st.integers(0, 5)), min_size=1, max_size=12), st.integers(2, 9))
def test_earliest(tmp_path_factory, listed, depth):
    strings, ranks = [t.encode() for t, _ in listed], np.array([r for _, r in listed])
    first = {}
    for s, r in zip(strings, ranks):
        for o in range(len(s) - depth + 1):
            first[s[o : o + depth]] = min(first.get(s[o : o + depth], 99), r)
    for s, (offsets, least) in zip(strings, earliest(strings, ranks, depth, str(tmp_path_factory.mktemp("columns")))):
        assert offsets.tolist() == list(range(max(0, len(s) - depth + 1)))
        assert least.tolist() == [first[s[o : o + depth]] for o in offsets]


@settings(deadline=None, max_examples=60)
@given(st.text("ab ", max_size=200), st.text("ab ", max_size=200), st.text("abcde fgh", min_size=50, max_size=90))
def test_equal_strings_have_equal_anchors(before, after, shared):
    cfg = SubstringConfig()
    one, two = substrings.anchors((before + shared).encode(), cfg), substrings.anchors((shared + after).encode(), cfg)
    n = len(shared) - 49
    assert (one[len(before) : len(before) + n] == two[:n]).all()
    starts, sizes = substrings.runs_of(one, cfg)
    assert sizes.sum() == len(one) and (not len(sizes) or sizes.max() <= cfg.run)


def report(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def texts():
    rng = random.Random(9)

    def words(n):
        return "".join(rng.choice("abcdefghij éß ") for _ in range(n))

    passages = [words(n) for n in (49, 50, 51, 80, 300)]
    out = [(i, words(200)) for i in range(10)]
    for i in range(10, 70):
        parts = [words(rng.randrange(120)) for _ in range(3)] + rng.choices(passages, k=rng.randrange(4))
        rng.shuffle(parts)
        out.append((i, "".join(parts)))
    return out + [(70, out[3][1]), (71, out[3][1] * 2), (72, "a" * 400), (73, "b" + "a" * 60), (2, out[3][1])]


@pytest.mark.parametrize("split", [1, 20_000])
def test_against_brute_force(documents, split):
    listed = texts()
    cfg = SubstringConfig(split_pieces=split, part_symbols=4_000)
    want = sorted(((i, *r) for (i, _), r in zip(listed, brute.substrings_removed(listed))), key=repr)
    assert report(substrings.removal_report(documents(*listed), cfg)) == want


def test_hard_documents(hard_docs, hard_rows, clashing):
    listed = [r[:2] for r in hard_rows]
    want = sorted(((i, *r) for (i, _), r in zip(listed, brute.substrings_removed(listed))), key=repr)
    assert report(substrings.removal_report(clashing(hard_docs))) == want


def test_empty_table(documents):
    assert substrings.removal_report(documents()).count() == 0


@settings(deadline=None, max_examples=80)
@given(st.lists(st.text("ab", min_size=5, max_size=30), min_size=1, max_size=12))
def test_strings_outside_of_those_that_return_equal_no_other(listed):
    pieces, depth = [t.encode() for t in listed], 5
    data, bounds = substrings.bytes_of(pa.array(pieces, pa.binary()))
    counts = Counter(p[i : i + depth] for p in pieces for i in range(len(p) - depth + 1))
    for p, first, last in zip(pieces, *substrings.returning(data, bounds, depth)):
        again = [i for i in range(len(p) - depth + 1) if counts[p[i : i + depth]] > 1]
        assert (first, last) == ((again[0], again[-1]) if again else (len(p) - depth + 1, -1))


def test_strings_that_do_not_return_are_not_transformed(spark, tmp_path):
    """Two pieces of one anchor with 55 equal bytes, one without any: less than their symbols goes through the columns."""
    rng = random.Random(3)
    letters = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n)).encode()
    same = letters(55)
    pieces = [(letters(10) + same, 1, 1), (same + letters(12), 2, 3), (letters(81), 4, 5)]
    frame = spark.createDataFrame(pieces, "piece binary, low bigint, high bigint").coalesce(1)
    data, bounds = substrings.bytes_of(pa.array([p[0] for p in pieces]))
    first, last = substrings.returning(data, bounds, 50)
    assert [(a, b) for a, b in zip(first, last) if a <= b] == [(10, 15), (0, 5)]
    got = {r.piece: [tuple(x) for x in r.runs] for r in substrings.compare(frame, f"file://{tmp_path}/columns", SubstringConfig()).collect()}
    assert got == {pieces[1][0]: [(0, 5, 1), (6, 17, 2)], pieces[2][0]: [(0, 31, 4)]}


def test_texts_are_not_sorted_in_joins(documents):
    plan = substrings.cleaned(documents((1, "a" * 60), (2, "a" * 60)))._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
