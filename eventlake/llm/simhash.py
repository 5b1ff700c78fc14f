"""Near duplicates by SimHash fingerprints and pigeonhole blocks.

A fingerprint has 64 bits; a bit is set if over half of the hashes of the 3-word shingles have it.
Fingerprints that differ in at most two bits are linked. The 64 bits are cut into 8 blocks: two
differing bits spoil at most two blocks, so a close pair agrees on the other six under one of 28
keys. Rows are joined on these keys and every pair is verified. Copies have one fingerprint and are one row from the start.

A key leaves 16 bits free, so at most 65,536 distinct fingerprints share it, whatever the input.
Keys with few members are joined pair by pair. In a crowded key each member is dealt to the 17
points at distance 0 or 1 in the free bits; two members are close exactly if they share a point, and
linking the members of a point to its smallest one (17 members at most) loses no connection and
makes no square of pairs.

Defined cases: a text without words (or NULL) has fingerprint zero and is linked like any other.
Each row gets a result row, repeated rows too. A NULL id is passed over when the smallest id of a
component is taken; a component without any id has NULL.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import packed, unpacked, written
from eventlake.llm.components import connected_components
from eventlake.sources.scratch import new_folder

BLOCKS, BLOCK_BITS = 8, 8


@dataclass(frozen=True)
class SimhashConfig:
    shingle: int = 3
    seed: int = 42
    #: Members of a key up to which pairs are joined; beyond it they are linked through points.
    pair_limit: int = 32


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """Majority of the shingle hashes; `bytes.lower` and `bytes.split` know ASCII only, as wanted."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[: len(words) - shingle] + 1])
    ends = ends[shingle - 1 :]
    digest, total = xxhash.xxh64_intdigest, len(starts)
    votes = np.zeros(64, np.int64)
    for low in range(0, total, 1 << 15):
        some = slice(low, low + (1 << 15))
        hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts[some].tolist(), ends[some].tolist())], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * votes > total, bitorder="little")
    return int(bits.view("<u8")[0])


def with_fingerprints(docs: DataFrame, columns: list[str], cfg: SimhashConfig) -> DataFrame:
    """The named columns of the documents and `print`, the fingerprint as a signed long."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(columns))
            prints = np.fromiter(
                (fingerprint(t.as_buffer().to_pybytes() if t.is_valid else None, cfg.shingle, cfg.seed) for t in texts),
                np.uint64, batch.num_rows,
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(prints.view(np.int64))], names=[*columns, "print"]
            )

    chosen = docs.select(*columns, F.col("text").cast("string").alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema)
    return chosen.mapInArrow(compute, f"{fields}, print bigint")


def block_masks() -> list[int]:
    """For each choice of two blocks, the mask of the six others, as a signed long."""
    masks = []
    for spoiled in combinations(range(BLOCKS), 2):
        free = sum(((1 << BLOCK_BITS) - 1) << (b * BLOCK_BITS) for b in spoiled)
        masks.append(signed(~free & (1 << 64) - 1))
    return masks


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def close_links(prints: DataFrame, cfg: SimhashConfig) -> DataFrame:
    """Links (a, b) between distinct fingerprints (`print`) that connect all pairs at distance 1 or 2."""
    masks = block_masks()
    keys = prints.select(
        "print",
        F.explode(
            F.array(*[F.struct(F.lit(i).cast("tinyint").alias("choice"), F.col("print").bitwiseAND(F.lit(m)).alias("block"))
                      for i, m in enumerate(masks)])
        ).alias("key"),
    ).select("print", "key.choice", "key.block")
    # At most 65,536 rows share (choice, block).
    sized = keys.withColumn("members", F.count("*").over(Window.partitionBy("choice", "block")))
    shared = written(sized.where("members > 1"), new_folder(prints.sparkSession, "simhash"), "shared")

    few = shared.where(F.col("members") <= cfg.pair_limit).drop("members")
    pairs = (
        few.withColumnRenamed("print", "a").join(few.withColumnRenamed("print", "b"), ["choice", "block"])
        .where((F.col("a") < F.col("b")) & (distance("a", "b") <= 2)).select("a", "b")
    )

    mask = F.get(F.array(*[F.lit(m) for m in masks]), F.col("choice").cast("int"))
    bits = F.array(*[F.lit(signed(1 << i)) for i in range(64)])
    free = F.array_append(F.filter(bits, lambda bit: mask.bitwiseAND(bit) == 0), F.lit(0).cast("bigint"))
    points = shared.where(F.col("members") > cfg.pair_limit).select(
        "choice", "print", F.explode(free).alias("flip")
    ).select("choice", F.col("print").bitwiseXOR(F.col("flip")).alias("point"), F.col("print").alias("b"))
    around = Window.partitionBy("choice", "point")  # 17 rows at most
    stars = points.select(F.min("b").over(around).alias("a"), "b").where((F.col("a") < F.col("b")) & (distance("a", "b") <= 2))
    return pairs.unionAll(stars).distinct()


def near_duplicates(docs: DataFrame, cfg: SimhashConfig = SimhashConfig()) -> DataFrame:
    """(doc_id, print, component_id) per document; the component is named by its smallest doc_id."""
    prints = written(with_fingerprints(docs, ["doc_id"], cfg), new_folder(docs.sparkSession, "simhash"), "prints")
    return with_components(prints, cfg).select("doc_id", "print", "component_id")


def with_components(prints: DataFrame, cfg: SimhashConfig) -> DataFrame:
    """Adds component_id and `root`, the smallest fingerprint of the component."""
    folder = new_folder(prints.sparkSession, "simhash")
    classes = written(prints.groupBy("print").agg(F.min("doc_id").alias("least_id")), folder, "classes")
    roots = connected_components(close_links(classes.select("print"), cfg))
    rooted = classes.join(roots, classes.print == roots.node, "left").select(
        "print", "least_id", F.coalesce("root", "print").alias("root")
    )
    named = written(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")), folder, "named")
    return prints.join(rooted.join(named, "root").select("print", "root", "component_id"), "print")


def keep_one(docs: DataFrame, cfg: SimhashConfig = SimhashConfig()) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, with its own columns.

    Rows that share that id in one component are told apart by a hash of their text, the smallest
    of which stays; a component without ids is treated like one whose rows share an id. Equal rows are one.
    """
    content = F.xxhash64(F.col("text").cast("string"))
    marked = with_fingerprints(docs.withColumn("_content", content), ["doc_id", "_content"], cfg)
    prints = written(marked, new_folder(docs.sparkSession, "simhash"), "prints")
    own = with_components(prints, cfg).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = written(
        own.groupBy("root", "doc_id", "_content").agg(F.count("*").alias("times"))
        .groupBy("root").agg(F.min(F.struct("doc_id", "_content", "times")).alias("chosen")).select("chosen.*"),
        new_folder(docs.sparkSession, "simhash"), "chosen",
    )
    rows = packed(docs).withColumn("content", F.xxhash64(F.col("doc.text").cast("string")))

    def taken(some: DataFrame) -> DataFrame:
        """The rows that are chosen. Only the short side is kept in memory, and no text is sorted."""
        return rows.join(
            some.hint("shuffle_hash"), F.col("doc.doc_id").eqNullSafe(some.doc_id) & (rows.content == some._content), "left_semi"
        )

    # Texts are only grouped where a row is known to return.
    repeated = taken(chosen.where("times > 1")).withColumn("id", F.col("doc.doc_id")).dropDuplicates(["id", "content"])
    return unpacked(taken(chosen.where("times = 1")).select("doc").unionAll(repeated.select("doc")), docs.columns)
