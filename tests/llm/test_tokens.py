import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eventlake.llm import tokens
from eventlake.llm.huffman import Codebook, code_lengths
from eventlake.llm.tokens import TokenConfig, WordTokenizer
from tests.llm import brute


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.vocabulary_path())


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(0, 10**9), min_size=1, max_size=200), st.integers(8, 18))
def test_lengths_are_a_full_code(counts, bits):
    lengths = code_lengths(np.array(counts), bits)
    used = lengths[lengths > 0].astype(int)
    assert (lengths > 0).sum() == np.count_nonzero(counts) and (len(used) == 0 or used.max() <= bits)
    if len(used) > 1:
        assert sum(2.0 ** -n for n in used) == 1.0


def test_lengths_are_optimal():
    import heapq

    counts = np.array([random.Random(1).randrange(1, 1000) for _ in range(120)])
    heap = sorted(counts.tolist())
    cost = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a + b
        heapq.heappush(heap, a + b)
    assert (counts * code_lengths(counts, 18)).sum() == cost
    with pytest.raises(ValueError):
        code_lengths(counts, 6)


def test_codes_come_back():
    rng = np.random.default_rng(3)
    ids = np.minimum(rng.geometric(0.01, 50_000), 3_000)
    book = Codebook(code_lengths(np.bincount(ids, minlength=4_000), 15), 15)
    sizes = np.array([1, 9_999, 20_000, 20_000])
    packed, borders, inside = book.pack(ids, sizes)
    marks = np.concatenate([inside[a : a + n : 100] + 8 * b for a, n, b in zip(np.cumsum(sizes) - sizes, sizes, borders)])
    counts = np.concatenate([[min(100, n - j) for j in range(0, n, 100)] for n in sizes])
    assert (book.unpack(packed, marks, counts) == ids).all()
    order = np.lexsort((np.flatnonzero(book.lengths), book.lengths[book.lengths > 0]))
    codes, lens = book.codes[book.lengths > 0][order].astype(int), book.lengths[book.lengths > 0][order].astype(int)
    for i in range(1, len(codes)):  # canonical: the next code in order
        assert codes[i] == (codes[i - 1] + 1) << (lens[i] - lens[i - 1])


TRICKY = [
    "", " ", "Hello, World!", "don't it's WE'LL x'S", "<|endoftext|> a<|startoftext|>b <|EndOfText|>", "é é ÀÉ ß İ ſ Σας", "日本語 テスト \U0001f600",
    "a b c　d\x1ce\x85f", "1234 a1 1a x2y", "tabs\tand\nlines\r\n\x0b\x0c", "\x00 \x7f \x1f", "word. word, word; (word) 'word' \"w", "#a_b$c%",
]


def ids_of(words, text):
    (own,) = words.encode(pa.array([text]))
    return np.frombuffer(own.as_py(), "<u2").tolist()


def test_words_give_the_ids_of_the_library():
    words, whole = WordTokenizer(TokenConfig(tokens.vocabulary_path(), kept_words=20)), library()
    for text in TRICKY + [" ".join(TRICKY)]:
        got = ids_of(words, text)
        assert got == [*whole.encode(text, add_special_tokens=False).ids, 2], text


@settings(deadline=None, max_examples=150)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" .,'ABCabcé́\n<|>")), max_size=60))
def test_any_text(text):
    got = ids_of(tokens.tokenizer(TokenConfig(tokens.vocabulary_path())), text)
    assert got == [*library_once().encode(text, add_special_tokens=False).ids, 2]


_library = []


def library_once():
    if not _library:
        _library.append(library())
    return _library[0]


@pytest.mark.parametrize("small", [True, False])
def test_round_trip(hard_docs, hard_rows, clashing, small):
    cfg = TokenConfig(tokens.vocabulary_path())
    if small:
        cfg = TokenConfig(tokens.vocabulary_path(), block_ids=64, part_bytes=4_000, mark_every=8, batch_bytes=100, max_bits=12)
    got = sorted(map(tuple, tokens.round_trip(clashing(hard_docs), cfg).collect()), key=lambda r: r[1])
    rows = [r[:2] for r in hard_rows]
    want = brute.token_rows(rows, library_once())
    known = {(i, n, crc) for i, _, n, crc in want}
    assert [r[0] is None for r in got] == sorted((r[0] is None for r in got), reverse=True)
    assert [r[0] for r in got if r[0] is not None] == sorted(i for i, _ in rows if i is not None)
    assert {(i, n, crc) for i, _, n, crc in got} == known and len(got) == len(rows)
    at = 0
    for _, start, n, _ in got:
        assert start == at
        at += n


def test_hot_ids_are_split(documents, tmp_path):
    """A third of all documents without an id, a third with one id."""
    listed = [(None, f"no id number {i}") for i in range(200)] + [(7, "the same text again")] * 100 + [(7, f"text {i} of seven") for i in range(100)]
    listed += [(i, f"own text {i}") for i in range(200)]
    cfg = TokenConfig(tokens.vocabulary_path(), block_ids=64, part_bytes=200, mark_every=8)
    docs = documents(*listed).repartition(6)
    parts = tokens.write_tokens(docs, str(tmp_path), cfg).collect()
    assert len(parts) > 8 and max(p.n_docs for p in parts) < 120
    rows = sorted(map(tuple, tokens.round_trip(docs, cfg).collect()), key=lambda r: r[1])
    assert [r[0] is None for r in rows] == [True] * 200 + [False] * 400
    assert [r[0] for r in rows[200:]] == sorted(i for i, _ in listed if i is not None)
    want = brute.token_rows(listed, library_once())
    assert sorted((str(i), n, crc) for i, _, n, crc in rows) == sorted((str(i), n, crc) for i, _, n, crc in want)
    assert all(b[1] == a[1] + a[2] for a, b in zip(rows, rows[1:]))


def test_files_are_checked(documents, tmp_path):
    import pyarrow.fs as pafs

    cfg = TokenConfig(tokens.vocabulary_path())
    parts = tokens.write_tokens(documents((1, "some words here"), (2, None)), str(tmp_path), cfg).collect()
    assert [(p.part, p.start, p.n_ids, p.n_docs) for p in parts] == [(0, 0, 5, 2)]
    path = tmp_path / "files" / parts[0].path
    data = bytearray(path.read_bytes())
    files = pafs.LocalFileSystem()
    assert sum(len(ids) for _, ids in tokens.read_blocks(files, str(path), cfg.mark_every)) == 5
    data[-1] ^= 1
    path.write_bytes(data)
    with pytest.raises(ValueError):
        list(tokens.read_blocks(files, str(path), cfg.mark_every))


def test_empty_table(documents):
    assert tokens.round_trip(documents()).count() == 0


def test_token_tasks_give_memory_back(monkeypatch):
    """The function that goes to the workers ends by handing back what Arrow only keeps for later."""
    given_back, sent = [], []

    class Pool:
        def release_unused(self):
            given_back.append(True)

    class Frame:
        def select(self, *columns):
            return self

        def mapInArrow(self, function, schema):
            sent.append(function)

    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    monkeypatch.setattr(tokens.F, "col", lambda name: type("Column", (), {"cast": lambda self, kind: self})())
    tokens.token_table(Frame(), TokenConfig(tokens.vocabulary_path()))
    texts = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["one two", None])], names=["doc_id", "text"])
    assert [b.num_rows for b in sent[0](iter([texts, texts]))] == [2, 2] and given_back == [True]
