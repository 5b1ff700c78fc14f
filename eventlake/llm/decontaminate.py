"""Benchmark decontamination with one Aho-Corasick automaton over normalised benchmark windows.

Words are runs of ASCII digits, letters (in lower case) and all characters beyond ASCII. An item
gives windows of ten consecutive words, or its whole text as one window if it has fewer. A document
is normalised once, byte by byte, and scanned once; a match begins and ends at a word border. Hits
are mapped back to character offsets of the original text.

The benchmark is the small side, but its size is checked and never assumed: its windows are dealt to
blocks of a fixed number of bytes, each block is broadcast as one automaton, and a document passes
block after block, carrying its hits. A usual benchmark is one block. Beyond one, the frame is cut
between blocks so that a worker holds one automaton at a time.

Defined cases: a NULL text has no words; an item without words has no windows; equal windows of several
items count for each of them. Item ids are compared as strings; an item with a NULL id is matched and its words are hit,
but it is not listed. Repeated rows are judged alike.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import unpacked
from eventlake.sources.scratch import cut_lineage

#: Byte table: A-Z to lower case, other ASCII than digits and letters to a space.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


@dataclass(frozen=True)
class DecontaminationConfig:
    window: int = 10
    #: Bytes of distinct windows in one automaton.
    block_bytes: int = 4 << 20


def normal_words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(FOLD).split()


def windows(words: list[bytes], size: int) -> set[bytes]:
    if not words:
        return set()
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def window_table(benchmark: DataFrame, size: int) -> DataFrame:
    """(window, items): each distinct window with the sorted ids of its items."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for window in windows(normal_words(text.encode() if text is not None else None), size):
                    ids.append(item)
                    found.append(window)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(found, pa.binary())], names=["item", "window"])

    items = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    return items.mapInArrow(cut, "item string, window binary").groupBy("window").agg(
        F.sort_array(F.collect_set("item")).alias("items")
    )


def blocks_of(benchmark: DataFrame, cfg: DecontaminationConfig) -> Iterator[list[tuple[bytes, list[str]]]]:
    """The windows in lists of at most about `block_bytes`, fetched one after another."""
    table = cut_lineage(window_table(benchmark, cfg.window))
    size = F.length("window") + F.coalesce(F.aggregate("items", F.lit(0), lambda n, i: n + F.length(i) + 8), F.lit(0))
    total = table.agg(F.sum(size)).first()[0] or 0
    count = total // cfg.block_bytes + 1
    for block in range(count):
        rows = table.where(F.pmod(F.xxhash64("window"), F.lit(count)) == block).collect()
        yield [(bytes(r["window"]), r["items"]) for r in rows]


_built: dict[str, ahocorasick.Automaton] = {}


def automaton(block: Broadcast) -> ahocorasick.Automaton:
    """Built once per worker process; a worker keeps the last one only."""
    key = block.value[0]
    if key not in _built:
        machine = ahocorasick.Automaton()
        for window, items in block.value[1]:
            spaced = f" {window.decode('latin-1')} "
            machine.add_word(spaced, (len(spaced), items))
        machine.make_automaton()
        _built.clear()
        _built[key] = machine
    return _built[key]


def scan(machine: ahocorasick.Automaton, text: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, hit runs of words [first, last), items found."""
    folded = b" ".join(normal_words(text))
    spaced = f" {folded.decode('latin-1')} " if folded else ""
    runs: list[list[int]] = []
    items: set[str] = set()
    if len(machine):
        for end, (length, found) in machine.iter(spaced):
            start = end - length + 1
            items.update(found)
            while runs and start <= runs[-1][0]:
                runs.pop()  # a longer match that began earlier ends here
            if runs and start <= runs[-1][1]:
                runs[-1][1] = end
            else:
                runs.append([start, end])
    words, before, at = [], 0, 0
    for start, end in runs:
        before += spaced.count(" ", at, start)
        first = before
        before += spaced.count(" ", start, end)
        words.append((first, before))
        at = end
    return max(0, spaced.count(" ") - 1), words, items


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [tuple(r) for r in out]


def original_spans(text: str, runs: list[tuple[int, int]]) -> list[dict]:
    """Character offsets in the original text of runs of words."""
    if not runs:
        return []
    spans, wanted = [], iter(runs)
    first, last = next(wanted)
    start = 0
    for i, match in enumerate(WORD.finditer(text)):
        if i == first:
            start = match.start()
        if i == last - 1:
            spans.append({"start": start, "end": match.end()})
            first, last = next(wanted, (-1, -1))
    return spans


HITS = pa.struct([
    ("runs", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))), ("items", pa.list_(pa.string())),
])
HITS_DDL = "struct<runs: array<struct<first: int, last: int>>, items: array<string>>"
FOUND = pa.struct([
    ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
])
FOUND_DDL = (
    "struct<n_words: bigint, n_hit: bigint, items: array<string>, spans: array<struct<start: bigint, end: bigint>>>"
)


def found_in(text: bytes, n_words: int, runs: list[tuple[int, int]], items: set[str]) -> dict:
    return {
        "n_words": n_words, "n_hit": sum(last - first for first, last in runs),
        "items": sorted(i for i in items if i is not None), "spans": original_spans(text.decode(), runs) if runs else [],
    }


def scanned(frame: DataFrame, block: Broadcast, doc_ddl: str, last: bool) -> DataFrame:
    """One pass over (doc, text, hits) with one automaton; the last pass gives (doc, found)."""

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            machine, out = automaton(block), []
            texts, hits = batch.column("text"), batch.column("hits")
            for i in range(batch.num_rows):
                text = texts[i].as_buffer().to_pybytes() if texts[i].is_valid else b""
                n_words, runs, items = scan(machine, text)
                if hits[i].is_valid:
                    earlier = hits[i].as_py()
                    runs = merged(runs + [(r["first"], r["last"]) for r in earlier["runs"]])
                    items |= set(earlier["items"])
                if last:
                    out.append(found_in(text, n_words, runs, items))
                else:
                    out.append({"runs": [{"first": a, "last": b} for a, b in runs], "items": list(items)} if runs else None)
            if last:
                yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(out, FOUND)], names=["doc", "found"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column("doc"), texts, pa.array(out, HITS)], names=["doc", "text", "hits"])

    return frame.mapInArrow(
        passed, f"doc {doc_ddl}, found {FOUND_DDL}" if last else f"doc {doc_ddl}, text string, hits {HITS_DDL}"
    )


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, columns: list[str], cfg: DecontaminationConfig = DecontaminationConfig()
) -> DataFrame:
    """`doc`, the named columns as one struct, and `found`: n_words, n_hit, items and the hit spans of the original text."""
    context = docs.sparkSession.sparkContext
    frame = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), F.col("text").cast("string").alias("text"),
        F.lit(None).cast(HITS_DDL).alias("hits"),
    )
    doc_ddl = frame.schema["doc"].dataType.simpleString()
    fetched = blocks_of(benchmark, cfg)
    block = next(fetched)
    while block is not None:
        following = next(fetched, None)
        frame = scanned(frame, context.broadcast((uuid.uuid4().hex, block)), doc_ddl, last=following is None)
        if following is not None:
            frame = cut_lineage(frame)
        block = following
    return frame


def leak_report(docs: DataFrame, benchmark: DataFrame, cfg: DecontaminationConfig = DecontaminationConfig()) -> DataFrame:
    found = F.col("found")
    return find_leaks(docs, benchmark, ["doc_id"], cfg).select(
        "doc.doc_id", found["n_words"].alias("n_words"), found["n_hit"].alias("n_hit"),
        F.size(found["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(found["items"], ","), 256).alias("items_sha256"),
        (found["n_hit"] > 0).alias("contaminated"), found["spans"].alias("spans"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, cfg: DecontaminationConfig = DecontaminationConfig()) -> DataFrame:
    """The documents without any occurrence of a benchmark window, with their own columns."""
    return unpacked(find_leaks(docs, benchmark, docs.columns, cfg).where("found.n_hit = 0"), docs.columns)
