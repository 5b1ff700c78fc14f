"""Main text of HTML pages, block by block, with a labeller that reads the whole page.

The labeller is a bidirectional LSTM (see `labeller`) fitted once per run, in one task, to a bounded sample: the
`sample_pages` distinct pages with the smallest hash of URL and text, whatever their length; of a long page whole blocks of up to
`sample_bytes` of text are drawn. A sample without any text is logged as a warning. Pages that
mark their main text teach it; the same pages without their marks (names, `article` and `main`), and pages made from their texts in
random layouts, teach it to do without. It is broadcast (about 300 kB, whatever the input) and labels every block of every page, whole, in Arrow batches. Cutting a page takes time in its length
only, and labelling a long page goes by slices, with a number per block kept between its two readers.

The text of a page is its main blocks, joined in page order by a line feed; a block has its character
references decoded and its white space turned into single spaces.

Defined cases: a NULL or empty page has an empty text; repeated rows are read alike; an unclosed element ends with what encloses
it; an unclosed comment, script or style hides the rest of the page; a quote that is never closed is a character like others; where
quotes hide the end of a tag, tags end at the next `>`. A table without pages gives no rows.
"""

from __future__ import annotations

import json
import logging
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.blocks import blocks_of, packed, unpacked
from eventlake.llm.labeller import Labeller, LabellerConfig, excerpt, train_blocks

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class ExtractionConfig:
    sample_pages: int = 300
    #: Bytes of text that are learned from one page.
    sample_bytes: int = 32_768
    #: Bytes of pages that are read and labelled together.
    batch_bytes: int = 2 << 20
    labeller: LabellerConfig = LabellerConfig()


def fitted(pages: DataFrame, cfg: ExtractionConfig) -> bytes:
    """The weights of a labeller fitted to the sample of pages."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for turn, page in zip(batch.column(0), batch.column(1)):
                if turn.as_py() in seen:
                    continue
                seen.add(turn.as_py())
                own = excerpt(blocks_of(page.as_py()), cfg.sample_bytes, turn.as_py())
                blocks = json.dumps(packed(own))
                yield pa.RecordBatch.from_arrays([pa.array([turn.as_py()], pa.int64()), pa.array([blocks], pa.string())], names=["turn", "blocks"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn = sorted({(r["turn"], r["blocks"]) for batch in batches for r in batch.to_pylist()})
        sample = [unpacked(*json.loads(blocks)) for _, blocks in drawn]
        if any(sample):
            weights = train_blocks(sample, cfg.labeller).dump()
            yield pa.RecordBatch.from_arrays([pa.array([weights], pa.binary())], names=["weights"])

    html = F.col("html").cast("string")
    turned = pages.select(F.xxhash64("url", "html").alias("turn"), html.alias("html")).where(F.length("html") > 0)
    chosen = turned.select("turn").distinct().orderBy("turn").limit(cfg.sample_pages)
    sample = turned.join(F.broadcast(chosen), "turn", "left_semi").mapInArrow(draw, "turn bigint, blocks string").distinct()
    rows = sample.coalesce(1).mapInArrow(fit, "weights binary").collect()  # one row
    if rows:
        return bytes(rows[0][0])
    log.warning("no page of the sample has any text: the labeller has learned nothing")
    return Labeller.fresh(cfg.labeller).dump()


_loaded: dict[int, Labeller] = {}


def loaded(weights: Broadcast) -> Labeller:
    """Read once per worker process; a worker keeps the last one only."""
    data = weights.value
    key = zlib.crc32(data)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Labeller.load(data)
    return _loaded[key]


def main_texts(model: Labeller, pages: list[str | None]) -> list[str]:
    parsed = [blocks_of(p) for p in pages]
    labels = model.label(parsed)
    return ["\n".join(b.text for b, main in zip(page, own) if main) for page, own in zip(parsed, labels)]


def extract(pages: DataFrame, columns: list[str], cfg: ExtractionConfig = ExtractionConfig()) -> DataFrame:
    """`page` (the named columns as a struct) and `text`, the main text of its html."""
    weights = pages.sparkSession.sparkContext.broadcast(fitted(pages, cfg))
    chosen = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("page"), F.col("html").cast("string").alias("html")
    )
    ddl = chosen.schema["page"].dataType.simpleString()

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(weights)
        for batch in batches:
            low = 0
            while low < batch.num_rows:
                own, size = [], 0
                while low + len(own) < batch.num_rows and (not own or size < cfg.batch_bytes):
                    own.append(batch.column(1)[low + len(own)].as_py())
                    size += len(own[-1] or "")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, len(own)), pa.array(main_texts(model, own), pa.string())], names=["page", "text"]
                )
                low += len(own)

    return chosen.mapInArrow(label, f"page {ddl}, text string")
