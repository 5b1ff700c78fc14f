"""A Merkle manifest of a table, with proofs that recompute what the manifest does not keep.

Each row is a leaf: the SHA-256 of its fields, each as its UTF-8 length, a colon and its value, or `-` for
NULL. The leaves of a group stand in the order of their ids; every 8 consecutive nodes become their digest,
up to one node, the subroot of the group. The subroots, in the order of the groups, give the root likewise.

Only every second level is stored (`stride`). The 64 descendants of a stored node are one aligned subtree: to
build, and again to prove, a task gets these 64 stored digests, computes the level between, uses it and lets it
go. A proof is drawn from the top down: the steps above a stored node are handed to its subtree by a join, the steps
inside come from the recomputed nodes.

Leaves get their places by a range shuffle on (group, id), so that a group with a third of all rows is
spread over many tasks; nothing but the slim rows of digests is shuffled, and no task holds more than 64 nodes of
a subtree at a time. The driver knows only how many levels there are.

Defined cases: NULL groups are one group, which comes first; NULL ids come first in their group. Rows with one id are
ordered by their leaf digest; equal rows are leaves of their own. An empty table has no root and no rows. A NULL or empty text
is a field like others. Only the named columns are read, so further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlake.sources.scratch import new_folder

#: Left and right siblings of a node on one level, as joined digests.
Step = tuple[str, str]
PATH = "array<struct<left: string, right: string>>"


@dataclass(frozen=True)
class MerkleConfig:
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text")
    group: str = "lang"
    order: str = "doc_id"
    fanout: int = 8
    #: Levels from one stored level to the next.
    stride: int = 2

    @property
    def span(self) -> int:
        return self.fanout**self.stride


@dataclass(frozen=True)
class Manifest:
    """The stored tables: levels of the groups' trees, from the leaves up, and levels of the tree of subroots."""

    groups: list[str]
    top: list[str]
    cfg: MerkleConfig


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def levels_above(nodes: list[str], total: int, cfg: MerkleConfig) -> list[list[str]]:
    """The nodes of an aligned subtree, level by level, up to the next stored level or the level of one node.

    `total` is the number of nodes of the whole tree on the lowest of these levels.
    """
    levels = [nodes]
    while len(levels) <= cfg.stride and total > 1:
        nodes = [digest("".join(nodes[i : i + cfg.fanout])) for i in range(0, len(nodes), cfg.fanout)]
        total = -(-total // cfg.fanout)
        levels.append(nodes)
    return levels


def total_above(total: int, cfg: MerkleConfig) -> int:
    for _ in range(cfg.stride):
        total = -(-total // cfg.fanout)
    return total


def steps_inside(levels: list[list[str]], place: int, cfg: MerkleConfig) -> list[Step]:
    steps = []
    for nodes in levels[:-1]:
        low = place - place % cfg.fanout
        steps.append(("".join(nodes[low:place]), "".join(nodes[place + 1 : low + cfg.fanout])))
        place //= cfg.fanout
    return steps


def fold(node: str, path: list[Step]) -> str:
    """The root that a node and its siblings give."""
    for left, right in path:
        node = digest(left + node + right)
    return node


def proof_digest(path: list[Step]) -> str:
    return digest("".join(left + right for left, right in path))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds `idx`, the place of a row in its `key`, and `total`, the rows of the key. `rows` is read more than once."""
    spark = rows.sparkSession
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    dealt = tied.repartitionByRange("key", *order, "tie").sortWithinPartitions("key", *order, "tie").drop("tie")
    columns = dealt.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            coded = batch.column("key").dictionary_encode()
            codes, names = coded.indices.to_numpy(), coded.dictionary.to_pylist()
            starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            lengths = np.diff(np.append(starts, len(codes)))
            base = np.zeros(len(starts), np.int64)
            base[0] = seen if names[codes[0]] == last else 0
            within = np.arange(len(codes)) - np.repeat(starts - base, lengths)
            last, seen = names[codes[-1]], int(within[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(codes), part), pa.int32()), pa.array(within, pa.int64())],
                names=[*columns, "part", "within"],
            )

    table = new_folder(spark, "manifest-order")
    dealt.mapInArrow(count, f"{schema}, part int, within bigint").write.parquet(table)
    placed = spark.read.parquet(table)
    counts = placed.groupBy("key", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "key", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), F.sum("n").over(Window.partitionBy("key")).alias("total")
    )
    return placed.join(offsets, ["key", "part"]).select(*columns, (F.col("offset") + F.col("within")).alias("idx"), "total")


def subtrees(nodes: DataFrame, cfg: MerkleConfig, *more: str) -> DataFrame:
    """(key, block, total, nodes): the stored digests under each node of the next stored level, in order."""
    return nodes.groupBy("key", F.expr(f"idx div {cfg.span}").alias("block")).agg(
        F.max("total").alias("total"), F.array_sort(F.collect_list(F.struct("idx", "digest", *more))).alias("nodes")
    )


def tree(nodes: DataFrame, table: str, cfg: MerkleConfig) -> list[str]:
    """Store every `stride`-th level over the stored `nodes` (key, idx, total, digest); the last has one node for each key."""
    spark = nodes.sparkSession

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals = batch.column("total").to_pylist()
            lists = batch.column("nodes").to_pylist()
            above = [levels_above([n["digest"] for n in own], total, cfg)[-1][0] for own, total in zip(lists, totals)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("block"), pa.array([total_above(t, cfg) for t in totals], pa.int64()), pa.array(above, pa.string())],
                names=["key", "idx", "total", "digest"],
            )

    stored = []
    while True:
        stored.append(f"{table}/level-{len(stored) * cfg.stride}")
        if len(stored) == 1:
            nodes.write.parquet(stored[0])
        else:
            below = spark.read.parquet(stored[-2]).select("key", "idx", "total", "digest")
            subtrees(below, cfg).mapInArrow(reduce, "key string, idx bigint, total bigint, digest string").write.parquet(stored[-1])
        if (spark.read.parquet(stored[-1]).agg(F.max("total")).first()[0] or 1) <= 1:
            return stored


def write_manifest(docs: DataFrame, claims: dict[str, Column] | None = None, cfg: MerkleConfig = MerkleConfig()) -> Manifest:
    """Hash a table and store its tree. `claims` are further columns to keep with each leaf, each read in the one scan of the table."""
    spark, claims = docs.sparkSession, claims or {}
    group = F.col(f"`{cfg.group}`").cast("string")
    folder = new_folder(spark, "manifest")
    docs.select(
        F.when(group.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), group)).alias("key"), F.col(f"`{cfg.order}`").alias("row_id"),
        leaf_digest(*[F.col(f"`{c}`") for c in cfg.fields]).alias("digest"), *[c.alias(name) for name, c in claims.items()],
    ).write.parquet(f"{folder}/rows")
    leaves = numbered(spark.read.parquet(f"{folder}/rows"), ["row_id", "digest"])
    groups = tree(leaves, f"{folder}/groups", cfg)
    subroots = spark.read.parquet(groups[-1]).select(F.col("key").alias("member"), "digest").withColumn("key", F.lit(""))
    top = tree(numbered(subroots, ["member"]), f"{folder}/top", cfg)
    return Manifest(groups, top, cfg)


def descend(spark: SparkSession, stored: list[str], paths: DataFrame, more: list[str], cfg: MerkleConfig) -> DataFrame:
    """From (key, idx, path, subroot, root) of the uppermost stored level to the subtrees of the lowest, with the path of each from above."""

    def proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
        for key, own, path, subroot, root in opened(batches, cfg):
            places = [n["idx"] for n, _ in own]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([key] * len(own), pa.string()), pa.array(places, pa.int64()),
                    pa.array([[{"left": a, "right": b} for a, b in steps + path] for _, steps in own], kind),
                    pa.array([subroot] * len(own), pa.string()), pa.array([root] * len(own), pa.string()),
                ],
                names=["key", "idx", "path", "subroot", "root"],
            )

    for level in range(len(stored) - 2, -1, -1):
        nodes = spark.read.parquet(stored[level])
        kept = subtrees(nodes, cfg, *(more if level == 0 else []))
        own = kept.join(paths.withColumnRenamed("idx", "block"), ["key", "block"])
        if level == 0:
            return own
        paths = own.mapInArrow(proofs, f"key string, idx bigint, path {PATH}, subroot string, root string")
    # The uppermost level is the lowest: one node for each key.
    nodes = spark.read.parquet(stored[0])
    return subtrees(nodes, cfg, *more).join(paths.withColumnRenamed("idx", "block"), ["key", "block"])


Opened = tuple[str, list[tuple[dict, list[Step]]], list[Step], str, str]


def opened(batches: Iterator[pa.RecordBatch], cfg: MerkleConfig) -> Iterator[Opened]:
    """Per subtree its nodes with the steps inside it, from recomputed levels, and the path above it."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            levels = levels_above([n["digest"] for n in row["nodes"]], row["total"], cfg)
            own = [(n, steps_inside(levels, place, cfg)) for place, n in enumerate(row["nodes"])]
            yield row["key"], own, [(s["left"], s["right"]) for s in row["path"]], row["subroot"], row["root"]


def leaf_subtrees(spark: SparkSession, manifest: Manifest, claims: list[str]) -> DataFrame:
    """(key, block, total, nodes, path, subroot, root) of the subtrees of leaves; `path` leads from their upper node to the root."""
    none = F.array().cast(PATH)
    root = spark.read.parquet(manifest.top[-1]).select("key", "idx", none.alias("path"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    cfg = manifest.cfg
    above = descend(spark, manifest.top, root, ["member"], cfg)

    def to_subroots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
        for _, own, path, _, root in opened(batches, cfg):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([n["member"] for n, _ in own], pa.string()), pa.array([0] * len(own), pa.int64()),
                    pa.array([[{"left": a, "right": b} for a, b in steps + path] for _, steps in own], kind),
                    pa.array([n["digest"] for n, _ in own], pa.string()), pa.array([root] * len(own), pa.string()),
                ],
                names=["key", "idx", "path", "subroot", "root"],
            )

    paths = above.mapInArrow(to_subroots, f"key string, idx bigint, path {PATH}, subroot string, root string")
    return descend(spark, manifest.groups, paths, ["row_id", *claims], cfg)


def row_type(spark: SparkSession, manifest: Manifest) -> str:
    return spark.read.parquet(manifest.groups[0]).schema["row_id"].dataType.simpleString()


def proofs(spark: SparkSession, manifest: Manifest) -> DataFrame:
    """(row_id, leaf, path, subroot, root): the siblings of each leaf, level by level, left and right of the node."""
    cfg = manifest.cfg

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
        for batch in batches:
            ids = batch.column("nodes").flatten().field("row_id")
            own = [(n, steps + path, subroot, root) for _, nodes, path, subroot, root in opened(iter([batch]), cfg) for n, steps in nodes]
            yield pa.RecordBatch.from_arrays(
                [
                    ids, pa.array([n["digest"] for n, *_ in own], pa.string()),
                    pa.array([[{"left": a, "right": b} for a, b in path] for _, path, *_ in own], kind),
                    pa.array([s for *_, s, _ in own], pa.string()), pa.array([r for *_, r in own], pa.string()),
                ],
                names=["row_id", "leaf", "path", "subroot", "root"],
            )

    ddl = f"row_id {row_type(spark, manifest)}, leaf string, path {PATH}, subroot string, root string"
    return leaf_subtrees(spark, manifest, []).mapInArrow(draw, ddl)


def audit(spark: SparkSession, manifest: Manifest, claim: str) -> DataFrame:
    """(row_id, leaf, subroot, root, proof_sha256, folded_root, verified): every leaf proven, where the column `claim` of the
    manifest is not NULL with that digest in place of the leaf. Proofs are drawn, folded and dropped in one task."""
    cfg = manifest.cfg

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for _, own, above, subroot, root in opened(iter([batch]), cfg):
                for n, steps in own:
                    path = steps + above
                    folded = fold(n[claim] or n["digest"], path)
                    for column, value in zip(out, (n["digest"], subroot, root, proof_digest(path), folded, folded == root)):
                        column.append(value)
            ids = batch.column("nodes").flatten().field("row_id")
            yield pa.RecordBatch.from_arrays(
                [ids, *[pa.array(v, pa.string()) for v in out[:5]], pa.array(out[5], pa.bool_())],
                names=["row_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
            )

    ddl = f"row_id {row_type(spark, manifest)}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return leaf_subtrees(spark, manifest, [claim]).mapInArrow(check, ddl)
