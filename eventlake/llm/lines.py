"""Substring dedup by hashing lines (or paragraphs), then sentences, and keeping the earliest occurrence of each.

A text is cut at a separator into lines, and, on a second level, after `.`, `!` or `?` with white space behind it into sentences, which
may reach over line ends, so that a passage that is wrapped otherwise is found too. A unit is normalised (ASCII letters to lower case,
ASCII white space to single spaces, trimmed) and hashed to 128 bits. Over all documents the occurrence of a unit with the smallest
(doc_id, place) stays; every later one is removed, within a document too. Both levels are judged on the input. What stays is the lines
that are not removed, each without its part of removed sentences (and the white space behind them). Offsets in the original text are kept
for what stays and what goes.

Units without a word are never removed. Sentences of fewer than `sentence_words` words stay (a parameter: short sentences like "He did."
recur by chance in most texts); 0 leaves the second level out.

The earliest occurrence is a plain minimum per digest that Spark combines before the shuffle, and it comes
back to the occurrences of repeated digests in a join that can be split; a line that a third of all
documents share needs no group of its own.

Defined cases: a NULL or empty text has no units and is kept as it is. NULL ids rank last. Rows that share
an id are ranked by a hash of their text; equal rows are one document and are treated alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.sources.scratch import cut_lineage

SENTENCE_END = re.compile(r"[.!?][\x20\x09-\x0D]+")
SENTENCE_END_BYTES = re.compile(SENTENCE_END.pattern.encode())
#: Added to the number of a sentence, which tells it from a line.
SENTENCE = 1 << 30


@dataclass(frozen=True)
class UnitConfig:
    separator: str = "\n"
    min_words: int = 1
    #: The fewest words of a sentence that may be removed; 0 for no sentences at all.
    sentence_words: int = 5


def pieces(text: str | bytes, end: re.Pattern) -> list:
    """The sentences of a text with the white space behind them."""
    cuts = [0, *[m.end() for m in end.finditer(text)], len(text)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:])]


def digests_of(text: bytes, cfg: UnitConfig) -> Iterator[tuple[int, bytes]]:
    """(unit, digest) of all lines and sentences with enough words."""
    for number, unit in enumerate(text.split(cfg.separator.encode())):
        words = unit.lower().split()
        if len(words) >= max(1, cfg.min_words):
            yield number, xxhash.xxh3_128_digest(b" ".join(words))
    if cfg.sentence_words:
        for number, unit in enumerate(pieces(text, SENTENCE_END_BYTES)):
            words = unit.lower().split()
            if len(words) >= cfg.sentence_words:
                yield SENTENCE + number, xxhash.xxh3_128_digest(b"\1" + b" ".join(words))


UNITS = "rank struct<no_id: boolean, doc_id: bigint, content: bigint, unit: int>, high bigint, low bigint"


def unit_digests(docs: DataFrame, cfg: UnitConfig) -> DataFrame:
    """(rank, high, low) of each unit that is long enough."""
    rank = pa.struct([("no_id", pa.bool_()), ("doc_id", pa.int64()), ("content", pa.int64()), ("unit", pa.int32())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, units, digests = [], [], []
            for i, text in enumerate(batch.column(2)):
                if not text.is_valid:
                    continue
                for unit, digest in digests_of(text.as_buffer().to_pybytes(), cfg):
                    rows.append(i)
                    units.append(unit)
                    digests.append(digest)
            ids = batch.column(0).take(pa.array(rows, pa.int64()))
            halves = pa.Array.from_buffers(pa.int64(), 2 * len(digests), [None, pa.py_buffer(b"".join(digests))])
            even = pa.array(range(0, 2 * len(digests), 2), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.StructArray.from_arrays(
                        [ids.is_null(), ids, batch.column(1).take(pa.array(rows, pa.int64())), pa.array(units, pa.int32())],
                        fields=list(rank),
                    ),
                    halves.take(even), halves.slice(1).take(even) if digests else halves,
                ],
                names=["rank", "high", "low"],
            )

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("bigint"), F.xxhash64(text).alias("content"), text.alias("text")).mapInArrow(cut, UNITS)


def later_units(docs: DataFrame, cfg: UnitConfig) -> DataFrame:
    """(doc_id, content, units): the units to remove, by document."""
    units = unit_digests(docs, cfg)
    # Written first, so that the join has no aggregate under it and the occurrences of a digest can be split.
    first = cut_lineage(
        units.groupBy("high", "low").agg(F.min("rank").alias("first"), F.count("*").alias("n")).where("n > 1")
    )
    later = units.join(first, ["high", "low"]).where(F.col("rank") > F.col("first"))
    return later.groupBy("rank.doc_id", "rank.content").agg(F.array_sort(F.collect_set("rank.unit")).alias("units"))


SPAN = "array<struct<start: bigint, end: bigint>>"
CLEANED = f"kept string, n_units bigint, n_removed bigint, removed {SPAN}, stayed {SPAN}"


def rebuilt(text: str, gone: set[int], cfg: UnitConfig) -> tuple[str, int, int, list[dict], list[dict]]:
    """What stays of a text, the numbers of its lines and of the removed units, and the spans removed and kept, by line."""
    kept, removed, stayed, at = [], [], [], 0
    lines = text.split(cfg.separator)
    ends = [m.end() for m in SENTENCE_END.finditer(text)] + [len(text)] if any(u >= SENTENCE for u in gone) else [len(text)]
    sentence, touched = 0, set()
    for number, line in enumerate(lines):
        end = at + len(line)
        if number in gone:
            removed.append({"start": at, "end": end})
        else:
            left, low, first = [], at, True
            while low < end or first:
                first = False
                while ends[sentence] <= low and sentence + 1 < len(ends):
                    sentence += 1
                high = min(end, ends[sentence])
                if SENTENCE + sentence in gone and high > low:
                    touched.add(sentence)
                    removed.append({"start": low, "end": high})
                elif left and stayed[-1]["end"] == low:
                    stayed[-1]["end"] = high
                    left.append(text[low:high])
                else:
                    stayed.append({"start": low, "end": high})
                    left.append(text[low:high])
                low = high
            kept.append("".join(left))
        at = end + len(cfg.separator)
    n_removed = sum(u < SENTENCE for u in gone) + len(touched)
    return cfg.separator.join(kept), len(lines), n_removed, removed, stayed


def cleaned(docs: DataFrame, columns: list[str], cfg: UnitConfig = UnitConfig()) -> DataFrame:
    """`doc` (the named columns), `kept` (the remaining lines, joined, without removed sentences), `n_units` (lines), `n_removed` (lines,
    and sentences with characters on other lines), and the spans removed and kept."""
    later = later_units(docs, cfg)
    text = F.col("text").cast("string")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), F.col("doc_id").cast("bigint").alias("id"),
        F.xxhash64(text).alias("hash"), text.alias("text"),
    )
    joined = rows.join(later, rows.id.eqNullSafe(later.doc_id) & (rows.hash == later.content), "left").select("doc", "text", "units")
    ddl = joined.schema["doc"].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                rebuilt(text, set(gone or ()), cfg) if text else (text, 0, 0, [], [])
                for text, gone in zip(batch.column("text").to_pylist(), batch.column("units").to_pylist())
            ]
            kept, counts, n_removed, removed, stayed = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"), pa.array(kept, pa.string()), pa.array(counts, pa.int64()), pa.array(n_removed, pa.int64()),
                    pa.array(removed, span), pa.array(stayed, span),
                ],
                names=["doc", "kept", "n_units", "n_removed", "removed", "stayed"],
            )

    return joined.mapInArrow(rebuild, f"doc {ddl}, {CLEANED}")


def without_repeats(docs: DataFrame, cfg: UnitConfig = UnitConfig()) -> DataFrame:
    """The documents with the remaining text, with their own columns."""
    found = cleaned(docs, [c for c in docs.columns if c != "text"], cfg)
    return found.select(*[F.col("kept" if c == "text" else f"doc.`{c}`").alias(c) for c in docs.columns])


def removal_report(docs: DataFrame, cfg: UnitConfig = UnitConfig()) -> DataFrame:
    length = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return cleaned(docs, ["doc_id"], cfg).select(
        "doc.doc_id", "n_units", "n_removed", length.alias("chars_removed"),
        F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"),
    )
