"""Mixing sources to target weights by temperature.

The token share p of a source becomes a weight in proportion to p ** a. The exponent a in [0, 1] is
found by bisection: the largest one whose weights reach the target entropy, or the smallest one that keeps
the repetition of every source within its limit, whichever is larger (the limit wins). 30 halvings
are made, six per job: a job sums the weights of all sources at the 63 exponents those six can meet.

The token budget times the weight of a source is the source's own budget. Without a budget the
smallest one is taken that gives every document once, so that mixing drops nothing and small
sources are repeated.

A source's budget is spent on permutations of its documents, one per epoch: documents are dealt to
about sqrt(n) blocks by a hash, the blocks of an epoch are ordered by another, and so are the documents of a
block. Full epochs hold each document once, the last one is filled up to the budget with whole
documents. A place in an epoch is the running total of block sizes plus the running total inside
the block, so a source with a third of all rows is sorted in about sqrt(n) pieces of about sqrt(n) documents.

A token is a word between ASCII white space. Defined cases: a NULL source is a source of its own; a text without
words (or NULL) has no tokens and takes part; a source without tokens gets one epoch. Rows with equal id and text
are placed together. Only DataFrame expressions are used.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import packed, unpacked, words_of
from eventlake.sources.scratch import cut_lineage

HALVINGS, PER_JOB = 30, 6


@dataclass(frozen=True)
class MixConfig:
    #: Share of the largest possible entropy, the log of the number of sources.
    target_entropy: float = 0.9
    #: Epochs that a source may have.
    max_repetition: float = 2.0
    #: Tokens to give out; None: as few as give every document once.
    budget: int | None = None
    seed: int = 17


def hashed(*parts: Column | str | int) -> Column:
    """The md5 of the parts between colons, as hex digits."""
    return F.md5(F.concat_ws(":", *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts]))


def source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def slim(docs: DataFrame) -> DataFrame:
    """(key, source, doc_id, content, copies, n_tokens): one row for all rows of one id and text."""
    text = F.col("text").cast("string")
    return docs.select(
        source_key(F.col("source")).alias("key"), F.col("source").cast("string").alias("source"), "doc_id",
        F.md5(F.coalesce(text, F.lit(""))).alias("content"), F.size(words_of(text)).cast("bigint").alias("n"),
    ).groupBy("key", "source", "doc_id", "content").agg(F.count("*").alias("copies"), F.sum("n").alias("n_tokens"))


def source_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("key").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_docs"))


def at_exponents(totals: DataFrame, exponents: list[float]) -> dict[float, tuple[float, float]]:
    """Per exponent: the sum of p ** a and the entropy of the weights."""
    weight = F.pow("p", "a")
    sums = (
        totals.where("tokens > 0").select("p", F.explode(F.array(*[F.lit(a) for a in exponents])).alias("a"))
        .groupBy("a").agg(F.sum(weight).alias("z"), F.sum(weight * F.log("p")).alias("y"))
    )
    rows = sums.select("a", "z", F.round(F.log("z") - F.col("a") * F.col("y") / F.col("z"), 9).alias("entropy")).collect()
    return {r["a"]: (r["z"], r["entropy"]) for r in rows}


def bisect(totals: DataFrame, holds_low: Callable[[float, float, float], bool], keep_low: bool) -> float:
    """The border in [0, 1] between exponents where `holds_low(a, z, entropy)` and larger ones where it doesn't."""
    low, high = 0.0, 1.0
    for _ in range(HALVINGS // PER_JOB):
        steps = 1 << PER_JOB
        seen = at_exponents(totals, [low + (high - low) * i / steps for i in range(1, steps)])
        for _ in range(PER_JOB):
            middle = (low + high) / 2
            if holds_low(middle, *seen[middle]):
                low = middle
            else:
                high = middle
    return low if keep_low else high


def exponent(totals: DataFrame, cfg: MixConfig) -> float:
    """The exponent for the target entropy, or a larger one if the repetition limit asks for it."""
    facts = totals.where("tokens > 0").agg(F.count("*"), F.min("p"), F.max("p"), F.sum("tokens").alias("all")).first()
    count, least, most, tokens = facts
    if not count:
        return 1.0
    ends = at_exponents(totals, [0.0, 1.0])

    def repetition(a: float, z: float) -> float:
        """Epochs of the smallest source, which has most."""
        given = most ** (1 - a) * z if cfg.budget is None else cfg.budget / tokens
        return round(given * least ** (a - 1) / z, 9)

    target = round(cfg.target_entropy * float(ends[0.0][1]), 9)
    reached = 1.0 if ends[1.0][1] >= target else bisect(totals, lambda a, z, h: h >= target, keep_low=True)
    within = 0.0 if repetition(0.0, ends[0.0][0]) <= cfg.max_repetition else bisect(
        totals, lambda a, z, h: repetition(a, z) > cfg.max_repetition, keep_low=False
    )
    return max(reached, within)


def source_plan(totals: DataFrame, cfg: MixConfig) -> DataFrame:
    """(key, weight, budget, full, rest, blocks): budget in tokens, full epochs, tokens of the last one."""
    everything = totals.agg(F.sum("tokens").alias("all_tokens"))
    shares = cut_lineage(
        totals.withColumn("p", F.coalesce(F.try_divide(F.col("tokens"), everything.select("all_tokens").scalar()), F.lit(0.0)))
    )
    a = exponent(shares, cfg)
    facts = at_exponents(shares, [a]).get(a, (1.0, 0.0))
    peak = shares.agg(F.max("p").alias("p"), F.sum("tokens").alias("n")).first()
    tokens = float(peak["n"] or 0)
    given = float(cfg.budget) if cfg.budget is not None else tokens * facts[0] * (peak["p"] or 1.0) ** (1 - a)
    weight = F.when(F.col("tokens") > 0, F.pow("p", F.lit(a)) / F.lit(facts[0])).otherwise(0.0)
    budget = F.floor(F.lit(given) * F.col("weight") + 0.5).cast("bigint")
    if cfg.budget is None:
        budget = F.greatest(budget, F.col("tokens"))
    planned = shares.withColumn("weight", weight).withColumn("budget", budget)
    full = F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(1)
    return planned.select(
        "key", "weight", "budget", full.cast("bigint").alias("full"),
        F.when(F.col("tokens") > 0, F.col("budget") % F.col("tokens")).otherwise(0).alias("rest"),
        F.ceil(F.sqrt("n_docs")).cast("bigint").alias("blocks"),
    )


def placements(docs: DataFrame, cfg: MixConfig = MixConfig()) -> DataFrame:
    """(source, doc_id, content, copies, epoch, start, n_tokens): where each document stands in its source's epochs.

    `start` counts the tokens before it in that epoch of its source.
    """
    rows = cut_lineage(slim(docs))
    plan = cut_lineage(source_plan(source_totals(rows), cfg))
    block = F.pmod(F.conv(F.substring(hashed(cfg.seed, "block", F.col("doc_id").cast("string"), F.col("content")), 1, 8), 16, 10).cast("bigint"), F.col("blocks"))
    epochs = F.sequence(F.lit(0).cast("bigint"), F.col("full") - F.when(F.col("rest") > 0, 0).otherwise(1))
    dealt = (
        rows.join(plan, "key")
        .where((F.col("full") > 0) | (F.col("rest") > 0))
        .select("key", "source", "doc_id", "content", "copies", "n_tokens", "full", "rest", block.alias("block"), F.explode(epochs).alias("epoch"))
        .withColumn("turn", hashed(cfg.seed, F.col("epoch").cast("string"), F.col("doc_id").cast("string"), F.col("content")))
        # Else Spark would go on with whole sources in one task, since rows of a block are together there too.
        .repartition("key", "epoch", "block")
    )
    inside = Window.partitionBy("key", "epoch", "block").orderBy("turn", "doc_id", "content").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    sizes = dealt.groupBy("key", "epoch", "block").agg(F.sum("n_tokens").alias("size"))
    between = Window.partitionBy("key", "epoch").orderBy(
        hashed(cfg.seed, "order", F.col("epoch").cast("string"), F.col("key"), F.col("block").cast("string")), "block"
    ).rowsBetween(Window.unboundedPreceding, -1)
    blocks = sizes.select("key", "epoch", "block", F.coalesce(F.sum("size").over(between), F.lit(0)).alias("block_start"))
    start = F.col("block_start") + F.col("before")
    return (
        placed.join(blocks, ["key", "epoch", "block"])
        .withColumn("start", start)
        .where((F.col("epoch") < F.col("full")) | (F.col("start") + F.col("n_tokens") <= F.col("rest")))
        .select("source", "doc_id", "content", "copies", "epoch", "start", "n_tokens")
    )


def mixed(docs: DataFrame, cfg: MixConfig = MixConfig()) -> DataFrame:
    """The documents, each as often as its source's epochs hold it, with their own columns."""
    times = placements(docs, cfg).groupBy("doc_id", "content", source_key(F.col("source")).alias("key")).agg(F.count("*").alias("times"))
    rows = packed(docs).withColumn("text_md5", F.md5(F.coalesce(F.col("doc.text").cast("string"), F.lit(""))))
    joined = rows.join(
        times,
        F.col("doc.doc_id").eqNullSafe(times.doc_id) & (rows.text_md5 == times.content)
        & (source_key(F.col("doc.source")) == times.key),
    )
    return unpacked(joined.select("doc", F.explode(F.sequence(F.lit(1).cast("bigint"), "times")).alias("time")), docs.columns)
