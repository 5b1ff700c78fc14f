"""Exact substring dedup over bytes: a byte goes if a string of `depth` bytes over it also starts in an earlier document.

The strings are compared by a transform of the collection with common prefixes (see `collection`), built
column by column. To build it in parts that are independent of each other, documents are cut into
pieces: every string of `depth` bytes has an anchor, the smallest hash of its `anchor` bytes long parts, neighbouring strings
mostly share it, and a piece is a run of such strings. Equal strings have equal anchors, so a
part that has all pieces of its anchors compares all their strings, and no piece is longer than about 80 bytes and so no
part takes more rounds than that.

1. Anchors that occur in one document only cannot lead to a match; the others are found by an aggregate, and a document's own ones
   come back to it in a join.
2. Pieces of these anchors are cut, and equal pieces become one with the smallest and largest rank of their documents.
   Spark combines them before the shuffle, so thousands of copies are one row each task.
3. Parts of about `part_symbols` symbols are built, each in one task. A piece that is alone with its anchor needs none, and strings
   at the ends of a piece (or all of it) whose hash no other string of the part has are left out, as they equal none; pieces that are equal then become one. If an anchor alone has over `split_pieces` pieces,
   its strings are dealt to parts one by one by their own hash, so no anchor has to fit into one task.
4. What a part finds (for each piece, the earliest document of each of its strings) is joined to the
   places of the pieces, and each document is cut by its own spans.

Joins keep the side in memory that has one row a key (anchors, pieces, documents), so neither texts nor anchors are sorted.

Ranks are doc_ids. Defined cases: a NULL or short text loses nothing; a NULL id ranks last; rows with
equal ids do not take from each other, whatever their texts; matches within a document do not count. Rows are known by id and a
64-bit hash of the text. Texts are bytes: a removed run may begin or end inside a character.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.collection import earliest_flat
from eventlake.llm.common import parts_for, remove_folders, written
from eventlake.sources.scratch import new_folder

NO_ID = (1 << 63) - 1


@dataclass(frozen=True)
class SubstringConfig:
    depth: int = 50
    anchor: int = 20
    #: Strings in a piece.
    run: int = 32
    part_symbols: int = 1_000_000
    split_pieces: int = 20_000


#: Odd numbers: the base of the rolling hash, its inverse modulo 2^64, and two factors that mix its bits.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MIX = [np.uint64(m) for m in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
#: Bytes that are hashed together; the powers of the base are kept up to that, longer texts go in segments.
SEGMENT = 1 << 16


def powers(base: int, count: int) -> np.ndarray:
    out, size, step = np.ones(count, np.uint64), 1, base
    while size < count:
        out[size : 2 * size] = out[: min(size, count - size)] * np.uint64(step)
        size, step = 2 * size, step * step % (1 << 64)
    return out


@cache
def tables(count: int) -> tuple[np.ndarray, np.ndarray]:
    return powers(BASE, count), powers(INVERSE, count)


def rolled(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of each part of `size` bytes."""
    up, down = tables(max(2 * SEGMENT, 1 << (len(data) + 1).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * up[: len(data)], out=sums[1:])
    hashes = sums[size:] - sums[:-size]  # the part at place i, times the base to the power of i
    hashes *= down[: len(hashes)]
    return hashes


def anchors(text: bytes | np.ndarray, cfg: SubstringConfig) -> np.ndarray:
    """For each start of a string of `depth` bytes, the smallest hash of the `anchor` bytes long parts inside it."""
    data = np.frombuffer(text, np.uint8) if isinstance(text, bytes) else text
    if len(data) < cfg.depth:
        return np.zeros(0, np.uint64)
    hashes = rolled(data, cfg.anchor)
    hashes ^= hashes >> np.uint64(29)
    hashes *= MIX[0]
    hashes ^= hashes >> np.uint64(32)
    hashes *= MIX[1]
    span, width = cfg.depth - cfg.anchor + 1, 1
    while width < span:
        step = min(width, span - width)
        hashes = np.minimum(hashes[:-step], hashes[step:])
        width += step
    return hashes


def runs_of(found: np.ndarray, cfg: SubstringConfig, new: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and numbers of strings of the pieces: runs of one anchor, of `run` strings at most. `new` marks where a run must begin."""
    if not len(found):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    change = np.concatenate([[True], found[1:] != found[:-1]])
    starts = np.flatnonzero(change if new is None else change | new)
    return cut_runs(starts, np.diff(np.append(starts, len(found))), cfg)


def cut_runs(starts: np.ndarray, sizes: np.ndarray, cfg: SubstringConfig) -> tuple[np.ndarray, np.ndarray]:
    if len(sizes) and sizes.max() > cfg.run:
        number = -(-sizes // cfg.run)
        inside = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
        starts, sizes = np.repeat(starts, number) + cfg.run * inside, np.minimum(cfg.run, np.repeat(sizes, number) - cfg.run * inside)
    return starts, sizes


def segments(bounds: np.ndarray, cfg: SubstringConfig) -> Iterator[list[tuple[int, int, int]]]:
    """(text, first byte, last byte) in groups of about a segment; long texts are cut, with the bytes that strings at a cut need."""
    group, held = [], 0
    for i, (low, high) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        while high - low >= cfg.depth:
            end = min(high, low + SEGMENT + cfg.depth - 1)
            group.append((i, low, end))
            held += end - low
            if held >= SEGMENT:
                yield group
                group, held = [], 0
            low += SEGMENT
    if group:
        yield group


def found_pieces(texts: pa.Array, cfg: SubstringConfig) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, offset in all texts, strings, anchor) of the pieces of the texts of a batch, many texts at a time."""
    data, bounds = bytes_of(texts)
    for group in segments(bounds, cfg):
        owner, low, high = (np.array(column) for column in zip(*group))
        sizes = high - low
        begins = np.cumsum(sizes) - sizes
        joined = data[low[0] : high[-1]] if (low[1:] == high[:-1]).all() else np.concatenate([data[a:b] for a, b in zip(low.tolist(), high.tolist())])
        found = anchors(joined, cfg)
        # Strings that begin in the last bytes of a text would reach into the next.
        strings = sizes - cfg.depth + 1
        places = np.repeat(begins - (np.cumsum(strings) - strings), strings) + np.arange(strings.sum())
        own = found[places]
        new = np.zeros(len(own), bool)
        new[np.cumsum(strings) - strings] = True
        starts, counts = runs_of(own, cfg, new)
        which = np.searchsorted(np.cumsum(strings), starts, "right")
        yield owner[which], low[which] + places[starts] - begins[which], counts, own[starts]


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts or pieces of an array without NULLs, and their borders."""
    large = texts.cast(pa.large_binary())
    bounds = np.frombuffer(large.buffers()[1], np.int64)[large.offset : large.offset + len(large) + 1]
    return np.frombuffer(large.buffers()[2] or b"", np.uint8), bounds


def gathered(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Slices of bytes as an array."""
    ends = np.cumsum(sizes)
    places = np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
    borders = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(borders), pa.py_buffer(np.ascontiguousarray(data[places]))])


def rank() -> Column:
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("rank")


def texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(rank(), F.xxhash64(text).alias("content"), text.alias("text"))


def value(scalar: pa.Scalar) -> bytes:
    return scalar.as_buffer().to_pybytes()


def anchor_rows(rows: DataFrame, cfg: SubstringConfig) -> DataFrame:
    """(rank, content, anchor): the anchors of each document, one that returns more than once perhaps."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for owner, _, _, anchor in grouped(found_pieces(batch.column(2), cfg)):
                new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])])[: len(anchor)]
                at = pa.array(owner[new])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(anchor[new].view(np.int64))], names=["rank", "content", "anchor"]
                )

    return rows.mapInArrow(find, "rank bigint, content bigint, anchor bigint")


def grouped(found: Iterator[tuple[np.ndarray, ...]], rows: int = 200_000) -> Iterator[tuple[np.ndarray, ...]]:
    """The same arrays, joined until they have about so many rows."""
    held, n = [], 0
    for arrays in found:
        held.append(arrays)
        n += len(arrays[0])
        if n >= rows:
            yield tuple(np.concatenate(column) for column in zip(*held))
            held, n = [], 0
    if n:
        yield tuple(np.concatenate(column) for column in zip(*held))


def cut_pieces(flagged: DataFrame, cfg: SubstringConfig) -> DataFrame:
    """(rank, content, anchor, offset, piece): the pieces of the anchors flagged for each document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = bytes_of(batch.column(2))
            lists = batch.column(3)
            wanted = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            known = np.unique(keyed(np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False)), wanted))

            def kept() -> Iterator[tuple[np.ndarray, ...]]:
                for owner, offset, counts, anchor in found_pieces(batch.column(2), cfg):
                    own = keyed(owner, anchor)
                    place = np.minimum(np.searchsorted(known, own), len(known) - 1)
                    keep = known[place] == own
                    yield owner[keep], offset[keep], counts[keep], anchor[keep]

            for owner, offset, counts, anchor in grouped(kept(), 50_000) if len(known) else ():
                at = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(at), batch.column(1).take(at), pa.array(anchor.view(np.int64)), pa.array(offset - bounds[owner]),
                        gathered(data, offset, counts - 1 + cfg.depth),
                    ],
                    names=["rank", "content", "anchor", "offset", "piece"],
                )

    return flagged.mapInArrow(cut, "rank bigint, content bigint, anchor bigint, offset bigint, piece binary")


def keyed(owner: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """A text of a batch and an anchor as one number. Should two pairs have one number, a piece more is compared, which loses nothing."""
    return (owner.astype(np.uint64) + np.uint64(1)) * MIX[1] ^ anchor


RUNS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("least", pa.int64())]))
RUNS_DDL = "array<struct<first: int, last: int, least: bigint>>"


def returning(data: np.ndarray, bounds: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last string of each piece whose hash another string of these pieces has too; the last is before the first if there is none."""
    counts = np.diff(bounds) - depth + 1
    hashes, low = [], 0
    while low < len(counts):
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + SEGMENT, "right")) - 1)
        own = counts[low:high]
        places = np.repeat(bounds[low:high] - bounds[low] - (np.cumsum(own) - own), own) + np.arange(own.sum())
        hashes.append(rolled(data[bounds[low] : bounds[high]], depth)[places])
        low = high
    joined = np.concatenate(hashes)
    order = np.argsort(joined)
    same = np.flatnonzero(joined[order[1:]] == joined[order[:-1]])
    returns = np.zeros(len(joined), bool)
    returns[order[same]] = returns[order[same + 1]] = True
    starts = np.cumsum(counts) - counts
    inside = np.arange(len(joined)) - np.repeat(starts, counts)
    first = np.minimum.reduceat(np.where(returns, inside, np.repeat(counts, counts)), starts)
    return first, np.maximum.reduceat(np.where(returns, inside, -1), starts)


def compare(pieces: DataFrame, folder: str, cfg: SubstringConfig, trim: bool = True) -> DataFrame:
    """Adds `runs` to (piece, low, high): the earliest rank over its strings, in runs before `high`; without pieces that lose nothing.

    All pieces with a string must lie in one partition; each partition is one transform. With `trim`, strings before the first and
    after the last one of a piece whose hash returns in the partition are left out of it: they equal no other.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not sum(b.num_rows for b in held):
            return
        table = pa.Table.from_batches(held).combine_chunks()
        data, bounds = bytes_of(table.column("piece").combine_chunks())
        low, high = table.column("low").to_numpy(), table.column("high").to_numpy()
        counts = np.diff(bounds) - cfg.depth + 1
        starts = np.cumsum(counts) - counts
        first, last = returning(data, bounds, cfg.depth) if trim else (np.zeros_like(counts), counts - 1)
        going = np.flatnonzero(first <= last)
        begins, ends = bounds[going] + first[going], bounds[going] + last[going] + cfg.depth
        # Pieces that are equal now go as one, with the smallest rank.
        number: dict[bytes, int] = {}
        which = np.array([number.setdefault(data[a:b].tobytes(), len(number)) for a, b in zip(begins.tolist(), ends.tolist())], np.int64)
        ranks = np.full(len(number), NO_ID)
        np.minimum.at(ranks, which, low[going])
        owner, _, smallest = earliest_flat(list(number), ranks, cfg.depth, folder)
        least, own = np.repeat(low, counts), ends - begins - cfg.depth + 1
        inside = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        least[np.repeat(starts[going] + first[going], own) + inside] = smallest[np.repeat(np.searchsorted(owner, which), own) + inside]

        new = np.append(True, least[1:] != least[:-1])
        new[starts] = True
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(least)) - 1
        piece = np.searchsorted(starts, begin, "right") - 1
        taken = least[begin] < high[piece]
        begin, end, piece = begin[taken], end[taken], piece[taken]
        rows, sizes = np.unique(piece, return_counts=True)
        fields = [(begin - starts[piece]).astype(np.int32), (end - starts[piece]).astype(np.int32), least[begin]]
        borders = np.append(0, np.cumsum(sizes)).astype(np.int32)
        runs = pa.ListArray.from_arrays(pa.array(borders), pa.StructArray.from_arrays([pa.array(f) for f in fields], fields=list(RUNS.value_type)))
        for at in range(0, len(rows), 20_000):
            some = table.take(pa.array(rows[at : at + 20_000])).append_column("runs", runs.slice(at, 20_000))
            yield from some.combine_chunks().to_batches()

    return pieces.mapInArrow(build, f"{pieces._jdf.schema().toDDL()}, runs {RUNS_DDL}")


def found_runs(distinct: DataFrame, folder: str, cfg: SubstringConfig) -> DataFrame:
    """(anchor, digest, runs) of the distinct pieces (anchor, piece, low, high)."""
    shared = written(
        distinct.groupBy("anchor").agg(F.count("*").alias("n"), F.sum(F.length("piece")).alias("symbols")).where("n > 1"), folder, "shared"
    )
    parts = parts_for(shared.agg(F.sum("symbols")).first()[0] or 0, cfg.part_symbols)
    # Written, as three kinds of pieces are read from it and each would shuffle them all again.
    sized = written(distinct.join(shared.select("anchor", "n").hint("shuffle_hash"), "anchor", "left"), folder, "sized")
    remove_folders(distinct.sparkSession, folder, "pieces", "shared")
    named = ("anchor", F.xxhash64("piece").alias("digest"), "runs")

    # A piece that is alone with its anchor holds all its strings: nothing else can have one of them.
    whole = F.struct(
        F.lit(0).alias("first"), (F.length("piece") - cfg.depth).cast("int").alias("last"), F.col("low").alias("least")
    )
    alone = sized.where("n IS NULL AND low < high").withColumn("runs", F.array(whole)).select(*named)
    usual = sized.where(F.col("n") <= cfg.split_pieces).select("anchor", "piece", "low", "high").repartition(parts, "anchor")
    by_anchor = alone.unionByName(compare(usual, f"{folder}/columns", cfg).select(*named))

    # An anchor with very many pieces: its strings one by one, equal ones as one row.
    at = F.sequence(F.lit(0), F.length("piece") - cfg.depth)
    single = sized.where(F.col("n") > cfg.split_pieces).select(
        "anchor", F.xxhash64("piece").alias("digest"), "low", "high",
        F.explode(F.transform(at, lambda i: F.struct(i.alias("at"), F.substring(F.col("piece"), i + 1, F.lit(cfg.depth)).alias("piece")))).alias("s"),
    ).select("anchor", "digest", "low", "high", "s.at", "s.piece")
    strings = single.groupBy("piece").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    split = compare(strings.repartition(parts, "piece"), f"{folder}/columns", cfg, trim=False).select("piece", F.get("runs", F.lit(0))["least"].alias("least"))
    runs = F.collect_list(F.struct(F.col("at").alias("first"), F.col("at").alias("last"), "least"))
    return by_anchor.unionByName(single.join(split, "piece").groupBy("anchor", "digest").agg(runs.alias("runs")))


def removable(docs: DataFrame, cfg: SubstringConfig) -> DataFrame:
    """(rank, content, spans): the byte ranges to remove, by document."""
    spark = docs.sparkSession
    folder = new_folder(spark, "substrings")
    rows = texts(docs)
    found = anchor_rows(rows, cfg)
    repeated = written(
        found.groupBy("anchor").agg(F.min("rank").alias("low"), F.max("rank").alias("high")).where("low < high").select("anchor"),
        folder, "anchors",
    )
    flags = written(
        found.join(repeated.hint("shuffle_hash"), "anchor", "left_semi").groupBy("rank", "content").agg(F.collect_set("anchor").alias("anchors")),
        folder, "flags",
    )
    places = written(cut_pieces(rows.join(flags.hint("shuffle_hash"), ["rank", "content"]).select("rank", "content", "text", "anchors"), cfg), folder, "places")
    remove_folders(spark, folder, "anchors", "flags")
    distinct = written(
        places.groupBy("anchor", "piece").agg(F.min("rank").alias("low"), F.max("rank").alias("high")), folder, "pieces"
    )
    runs = written(found_runs(distinct, folder, cfg), folder, "runs")
    remove_folders(spark, folder, "sized", "columns")
    own = F.filter("runs", lambda r: r["least"] < F.col("rank"))
    spans = F.transform(
        own, lambda r: F.struct((F.col("offset") + r["first"]).alias("start"), (F.col("offset") + r["last"] + cfg.depth).alias("end"))
    )
    hits = places.select("rank", "content", "anchor", F.xxhash64("piece").alias("digest"), "offset").join(runs.hint("shuffle_hash"), ["anchor", "digest"])
    removed = written(
        hits.select("rank", "content", spans.alias("spans")).where(F.size("spans") > 0)
        .groupBy("rank", "content").agg(F.flatten(F.collect_list("spans")).alias("spans")),
        folder, "spans",
    )
    remove_folders(spark, folder, "places", "runs")
    return removed


def joined_spans(spans: pa.Scalar) -> list[tuple[int, int]]:
    """Maximal runs of the union of spans."""
    if not spans.is_valid:
        return []
    starts = spans.values.field("start").to_numpy(zero_copy_only=False)
    ends = spans.values.field("end").to_numpy(zero_copy_only=False)
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > ends[:-1])
    return list(zip(starts[new].tolist(), ends[np.append(np.flatnonzero(new)[1:] - 1, len(ends) - 1)].tolist()))


SPAN = "array<struct<start: bigint, end: bigint>>"


def cleaned(docs: DataFrame, cfg: SubstringConfig = SubstringConfig()) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept): the removed runs and the remaining bytes of each document."""
    spans = removable(docs, cfg)
    rows = texts(docs).join(spans.hint("shuffle_hash"), ["rank", "content"], "left").select("rank", "text", "spans")
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, gone, runs, kept = [], [], [], []
            for text, spans in zip(batch.column(1), batch.column(2)):
                data, own = value(text), joined_spans(spans)
                at, rest = 0, []
                for start, end in own:
                    rest.append(data[at:start])
                    at = end
                rest.append(data[at:])
                sizes.append(len(data))
                gone.append(sum(e - s for s, e in own))
                runs.append([{"start": s, "end": e} for s, e in own])
                kept.append(b"".join(rest))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, span), pa.array(kept, pa.binary())],
                names=["rank", "n_bytes", "n_removed", "spans", "kept"],
            )

    return rows.mapInArrow(cut, f"rank bigint, n_bytes bigint, n_removed bigint, spans {SPAN}, kept binary").select(
        F.when(F.col("rank") < NO_ID, F.col("rank")).alias("doc_id"), "n_bytes", "n_removed", "spans", "kept"
    )


def removal_report(docs: DataFrame, cfg: SubstringConfig = SubstringConfig()) -> DataFrame:
    return cleaned(docs, cfg).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
