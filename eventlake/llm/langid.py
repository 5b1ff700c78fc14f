"""Language identification by compression.

For each language a dictionary of raw text is drawn from labelled documents. A text is compressed by zstandard once
with each dictionary, and the language whose dictionary makes it smallest is its language. Texts are taken
in lower case, with all ASCII but letters as single spaces, and are compressed whole, in pieces of 2 kB, so that
the dictionary and not the text's own past explains every piece. Equal sizes go to the language with more labelled
documents, then to the first by name.

`score` is the margin: the share by which the smallest size is under the second smallest (1 with a single language). A
text whose margin is below `min_margin` has `accepted` false: its language is the best guess and no more.

The sample is bounded: the `max_languages` languages with the most labelled documents, `sample_docs` documents of each
by hash and an excerpt from a place of its own from each, `dictionary_bytes` together. Languages are counted by an aggregate, and
a share of the documents that the counts give passes on to the draw, so a language of a third of all rows is no hot group. All else
covers every document; nothing but the excerpts is shuffled.

Defined cases: NULL and texts without a letter have the language `und`, score 0 and are not accepted, as has every text when
there is nothing to learn from. Repeated rows are scored alike; of rows that share an id and a language one is learned
from. NULL ids are not learned from and not held out. Further columns may have any name and are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
#: ASCII letters in lower case, all other ASCII as a space, other bytes as they are.
FOLDED = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@dataclass(frozen=True)
class LanguageConfig:
    #: Documents with this remainder of crc32(doc_id) are never learned from.
    folds: int = 3
    held_out: int = 1
    max_languages: int = 500
    sample_docs: int = 256
    excerpt_chars: int = 2_000
    dictionary_bytes: int = 32 << 10
    level: int = 5
    piece_bytes: int = 2 << 10
    min_margin: float = 0.02


def folded(text: str) -> bytes:
    return b" ".join((b" %s " % text.lower().encode().translate(FOLDED)).split())


def remainder(doc_id: Column, cfg: LanguageConfig) -> Column:
    return F.crc32(doc_id.cast("string")) % cfg.folds


def samples(docs: DataFrame, cfg: LanguageConfig) -> list[tuple[str, bytes]]:
    """The dictionary of each language, the language with the most labelled documents first."""
    text = F.col("text").cast("string")
    known = docs.select(F.col("doc_id").alias("id"), F.col("lang").cast("string").alias("language"), text.alias("text")).where(
        F.col("language").isNotNull() & (remainder(F.col("id"), cfg) != cfg.held_out)
    )
    counted = (
        known.groupBy("language").agg(F.count("*").alias("n"), F.approx_count_distinct("id").alias("ids"))
        .orderBy(F.desc("n"), "language").limit(cfg.max_languages)
    )
    turn = F.xxhash64("id", "language")
    room = F.greatest(F.length("text") - cfg.excerpt_chars, F.lit(0)) + 1
    excerpt = F.substring("text", (F.pmod(turn, room) + 1).cast("int"), F.lit(cfg.excerpt_chars))
    # About twice the documents wanted pass this, however many a language has; repeats of an id are one.
    few = F.pmod(turn, F.lit(1 << 32)) < F.lit(2.0 * cfg.sample_docs * (1 << 32)) / F.col("ids")
    drawn = known.join(F.broadcast(counted), "language").where(few).groupBy("language", "n", "id").agg(F.min(excerpt).alias("excerpt"))
    first = Window.partitionBy("language").orderBy("turn", "id")
    rows = (
        drawn.withColumn("turn", turn).withColumn("place", F.row_number().over(first)).where(F.col("place") <= cfg.sample_docs)
        .groupBy("language", "n").agg(F.array_sort(F.collect_list(F.struct("place", "excerpt"))).alias("own"))
        .select("language", "n", F.substring(F.array_join(F.col("own.excerpt"), " "), 1, 2 * cfg.dictionary_bytes).alias("text"))
        .collect()  # a bounded text for each of a bounded number of languages
    )
    rows.sort(key=lambda r: (-r.n, r.language))
    return [(r.language, folded(r.text)[: cfg.dictionary_bytes]) for r in rows]


class Model:
    """A compressor for each language."""

    def __init__(self, dictionaries: list[tuple[str, bytes]], cfg: LanguageConfig) -> None:
        self.cfg = cfg
        self.languages = [name for name, _ in dictionaries]
        self.compressors = []
        for _, content in dictionaries:
            size = max(8, len(content))  # zstandard takes no shorter one
            parameters = zstandard.ZstdCompressionParameters.from_level(
                cfg.level, source_size=cfg.piece_bytes, dict_size=size, min_match=3, strategy=zstandard.STRATEGY_BTOPT,
                write_content_size=False, write_checksum=False, write_dict_id=False,
            )
            raw = zstandard.ZstdCompressionDict(content.ljust(size), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(compression_params=parameters)
            self.compressors.append(zstandard.ZstdCompressor(compression_params=parameters, dict_data=raw))

    def sizes(self, text: str) -> list[int]:
        data, step = folded(text), self.cfg.piece_bytes
        pieces = [data[low : low + step] for low in range(0, len(data), step)]
        return [sum(len(c.compress(p)) for p in pieces) for c in self.compressors]

    def judge(self, text: str) -> tuple[str, float]:
        """The language and the margin."""
        sizes = self.sizes(text)
        best = min(range(len(sizes)), key=sizes.__getitem__)
        others = sizes[:best] + sizes[best + 1 :]
        return self.languages[best], 1 - sizes[best] / min(others) if others else 1.0


_models: dict[int, Model] = {}


def loaded(dictionaries: Broadcast, cfg: LanguageConfig) -> Model:
    """Built once per worker process; a worker keeps the last one only."""
    key = hash((tuple(dictionaries.value), cfg))
    if key not in _models:
        _models.clear()
        _models[key] = Model(dictionaries.value, cfg)
    return _models[key]


def identified(docs: DataFrame, columns: list[str], cfg: LanguageConfig = LanguageConfig()) -> DataFrame:
    """`doc` (the named columns as a struct), `language`, `score` and `accepted`."""
    dictionaries = docs.sparkSession.sparkContext.broadcast(samples(docs, cfg))
    text = F.col("text").cast("string")
    chosen = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), F.when(text.rlike(r"\p{L}"), text).alias("text")
    )
    ddl = chosen.schema["doc"].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(dictionaries, cfg)
        for batch in batches:
            judged = [model.judge(t.as_py()) if t.is_valid and model.languages else (UNKNOWN, 0.0) for t in batch.column(1)]
            sure = [language != UNKNOWN and score >= cfg.min_margin for language, score in judged]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([language for language, _ in judged], pa.string()),
                    pa.array([score for _, score in judged], pa.float64()), pa.array(sure, pa.bool_()),
                ],
                names=["doc", "language", "score", "accepted"],
            )

    return chosen.mapInArrow(judge, f"doc {ddl}, language string, score double, accepted boolean")
