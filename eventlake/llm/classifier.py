"""Quality scores from a factorisation machine over hashed words, structure and metadata.

A text becomes a sparse row: its words (ASCII letters in lower case) hashed into buckets, weighted by the log of
their counts and scaled to length one; and one indicator per measure of its structure (length, shares of capitals, digits,
symbols and punctuation, repeated lines and triples of words, and so on) and per metadata column, cut into bins.
Pairs of these interact through the factors.

The machine is fitted once, in one task, to a bounded sample: the `train_rows` labelled ids with the smallest hash,
taken among ids whose crc32 leaves another remainder than `held_out` modulo `folds`. The sample's ids are broadcast (their number is the bound), so
texts are not shuffled; the machine is broadcast too (about 600 kB, whatever the input). Scores are made
document by document from whole texts; labels, language, source and id are no inputs.

Defined cases: a NULL or empty text has only its indicators and is scored. An id with several labels takes their majority (ties: good). A NULL
id is never learned from nor held out. Repeated rows have equal scores. Without labels every score is 0.5.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log1p, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.factorization import Machine, MachineConfig, Rows, fit

WORD_BUCKETS, BINS = 1 << 14, 16
STRUCTURE = (
    "words", "letters_per_word", "capitals", "digits", "symbols", "punctuation", "bytes_beyond_ascii", "lines", "words_per_line",
    "repeated_lines", "repeated_triples", "distinct_words", "longest_word", "marks_per_word",
)
METADATA = ("n_chars",)
SIZE = WORD_BUCKETS + BINS * (len(STRUCTURE) + len(METADATA))

CAPITALS = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
SYMBOLS = b"#*$%&|<>@^~_=+{}[]\\/"
PUNCTUATION = b".,;:!?'\"()-"
BEYOND = bytes(range(128, 256))


@dataclass(frozen=True)
class ClassifierConfig:
    train_rows: int = 20_000
    folds: int = 4
    held_out: int = 2
    threshold: float = 0.7
    machine: MachineConfig = field(default_factory=lambda: MachineConfig(SIZE))


class Buckets(dict):
    """Word to bucket, of bounded size."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 500_000:
            self.clear()
        found = self[word] = zlib.crc32(word) % WORD_BUCKETS
        return found


_buckets = Buckets()


def log_bin(x: float) -> int:
    return min(BINS - 1, int(log2(x + 1)))


def share_bin(part: float, whole: float) -> int:
    """Finer near 0: shares up to 1/2048, 1/1024, ... and so on, then eighths."""
    share = part / whole if whole else 0.0
    return 0 if share <= 0 else min(BINS - 1, max(1, int(12 + log2(share)))) if share < 0.5 else min(BINS - 1, 11 + int((share - 0.5) * 8))


def measures(text: bytes, words: list[bytes], counts: Counter) -> list[int]:
    size, n = len(text), len(words)

    def count(chars: bytes) -> int:
        return size - len(text.translate(None, chars))

    lines = [line for line in text.split(b"\n") if line.strip()]
    triples = len(set(zip(words, words[1:], words[2:])))
    letters = sum(map(len, words))
    symbols, marks = count(SYMBOLS), count(PUNCTUATION)
    return [
        log_bin(n), min(BINS - 1, int(letters / n)) if n else 0, share_bin(count(CAPITALS), letters), share_bin(count(DIGITS), letters),
        share_bin(symbols, letters), share_bin(marks, letters), share_bin(count(BEYOND), letters), log_bin(len(lines)),
        log_bin(n / len(lines)) if lines else 0, share_bin(len(lines) - len(set(lines)), len(lines)),
        share_bin(max(0, n - 2) - triples, max(0, n - 2)), share_bin(len(counts), n), log_bin(max(map(len, words), default=0)),
        log_bin(8 * (symbols + marks) / n) if n else 0,
    ]


def features(text: bytes | None, metadata: tuple[float | None, ...]) -> tuple[np.ndarray, np.ndarray]:
    text = text or b""
    words = text.split()
    counts = Counter(text.lower().split())
    index = np.fromiter(map(_buckets.__getitem__, counts), np.int64, len(counts))
    value = np.log1p(np.fromiter(counts.values(), np.float32, len(counts)))
    value /= max(float(np.sqrt((value * value).sum())), 1e-6)
    bins = measures(text, words, counts) + [0 if m is None else 1 + min(BINS - 2, int(log1p(max(0.0, float(m))))) for m in metadata]
    places = WORD_BUCKETS + BINS * np.arange(len(bins)) + np.array(bins)
    return np.concatenate([places, index]), np.concatenate([np.full(len(bins), 0.4, np.float32), value])


def remainder(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string")) % folds


def sample_ids(labels: DataFrame, cfg: ClassifierConfig) -> DataFrame:
    """(sample_id, label, turn): the labelled ids to learn from."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (remainder(F.col("doc_id"), cfg.folds) != cfg.held_out))
    return (
        known.groupBy(F.col("doc_id").alias("sample_id")).agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
        .withColumn("turn", F.xxhash64("sample_id")).orderBy("turn", "sample_id").limit(cfg.train_rows)
    )


def metadata_of(docs: DataFrame) -> list[Column]:
    return [(F.col(m) if m in docs.columns else F.lit(None)).cast("double").alias(m) for m in METADATA]


def batch_features(batch: pa.RecordBatch, first: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features of the rows of a batch with the text at column `first` and metadata after it."""
    columns = [batch.column(first + 1 + i).to_pylist() for i in range(len(METADATA))]
    for i, text in enumerate(batch.column(first)):
        yield features(text.as_buffer().to_pybytes() if text.is_valid else None, tuple(c[i] for c in columns))


def fitted(docs: DataFrame, labels: DataFrame, cfg: ClassifierConfig) -> bytes | None:
    """The weights of a machine fitted to the sample; None without labelled documents."""
    rows = docs.join(F.broadcast(sample_ids(labels, cfg)), F.col("doc_id") == F.col("sample_id")).select(
        "turn", "label", F.col("text").cast("string").alias("text"), *metadata_of(docs)
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(batch_features(batch, 2))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([i.astype("<i4").tobytes() for i, _ in found], pa.binary()),
                    pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary()),
                ],
                names=["turn", "label", "index", "value"],
            )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(tuple(r.values()) for b in batches for r in b.to_pylist())
        if rows:
            sparse = Rows.of([(np.frombuffer(i, "<i4").astype(np.int64), np.frombuffer(v, "<f4")) for _, _, i, v in rows])
            weights = fit(sparse, np.array([label for _, label, _, _ in rows], np.float64), cfg.machine).dump()
            yield pa.RecordBatch.from_arrays([pa.array([weights], pa.binary())], names=["weights"])

    sample = rows.mapInArrow(cut, "turn bigint, label int, index binary, value binary").limit(cfg.train_rows).coalesce(1)
    found = sample.mapInArrow(learn, "weights binary").collect()  # one row
    return bytes(found[0][0]) if found else None


def scored(docs: DataFrame, labels: DataFrame, columns: list[str], cfg: ClassifierConfig = ClassifierConfig()) -> DataFrame:
    """`doc` (the named columns as a struct) and `score`."""
    weights = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels, cfg))
    chosen = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), F.col("text").cast("string").alias("text"), *metadata_of(docs))
    ddl = chosen.schema["doc"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine.load(weights.value) if weights.value is not None else None
        for batch in batches:
            scores: list[np.ndarray] = []
            group, held = [], 0
            for row in batch_features(batch, 1):
                group.append(row)
                held += len(row[0])
                if held > 200_000:
                    scores.append(machine.probabilities(Rows.of(group)) if machine else np.full(len(group), 0.5))
                    group, held = [], 0
            if group:
                scores.append(machine.probabilities(Rows.of(group)) if machine else np.full(len(group), 0.5))
            found = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["doc", "score"])

    return chosen.mapInArrow(score, f"doc {ddl}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, cfg: ClassifierConfig = ClassifierConfig()) -> DataFrame:
    """(doc_id, held_out, score, predicted)."""
    return scored(docs, labels, ["doc_id"], cfg).select(
        "doc.doc_id", F.coalesce(remainder(F.col("doc.doc_id"), cfg.folds) == cfg.held_out, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= cfg.threshold).cast("int").alias("predicted"),
    )
