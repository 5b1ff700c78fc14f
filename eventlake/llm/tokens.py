"""Token ids in Huffman-coded binary files, written in order of doc_id and read back.

1. Each text is tokenized once, whole, and its ids (with the end id) are written as a working table.
   A text is split at ASCII white space, across which the vocabulary never joins, and each worker
   keeps the ids of words it has met, up to a fixed number of them.
2. Ids are counted over all documents, and the counts give canonical codes of at most `max_bits` bits.
3. Documents are coded where they lie, then moved to the part of their range of doc_id and sorted there. The documents of an id
   (or of NULL) that fills whole parts are dealt to all of these.
4. Each part is one file that stands on its own: the code lengths, then blocks. A block has its
   documents, bit-offset checkpoints every `mark_every` ids, and the codes; blocks are independent of each
   other. A file is written under a name of its attempt and then moved, so a repeated task does no harm.
5. Reading goes block by block through a decoding table, all checkpoints of a block side by side.

File: magic, u32 max_bits, u32 vocabulary, u8 code length per id; then per block: u32 entries, u32 marks, u32 crc of
the codes, u32 bytes of the codes; entries (i64 doc_id, u8 flags, u32 ids); u32 bytes of each entry; u32 bit offsets, each from the start of
its entry; the codes, every entry from a byte border. Flag 1: the doc_id is NULL; flag 2: the entry goes on with the document before it.

Defined cases: a NULL or blank text has the end id only. Documents without an id come first; equal ids
stay side by side as documents of their own. An empty table gives an empty result. A long document is cut
into entries of one block at most. Files go to the shared folder through pyarrow's file systems.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import parts_for, released
from eventlake.llm.huffman import Codebook, code_lengths
from eventlake.sources.scratch import new_folder

MAGIC = b"TOKHUF01"
HEAD = struct.Struct("<IIII")
ENTRY = np.dtype([("doc_id", "<i8"), ("flags", "u1"), ("ids", "<u4")])
NO_ID, GOES_ON = 1, 2
LEAST = -(1 << 63)
MIX = np.uint64(0x9E3779B97F4A7C15)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@dataclass(frozen=True)
class TokenConfig:
    vocabulary: str
    end_id: int = 2
    max_bits: int = 18
    mark_every: int = 256
    block_ids: int = 1 << 18
    part_bytes: int = 32 << 20
    #: Words whose ids a worker keeps.
    kept_words: int = 1_000_000
    #: Bytes of texts whose words are looked up together.
    batch_bytes: int = 8 << 20


#: Printable ASCII and the Latin letters that have one form only; the library cuts such words as `PARTS` does once they are in lower case.
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]*")
PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
#: The model names the bytes of a letter by characters: printable ones by themselves, the others, in order, by those from 256 on.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTES = {b: chr(b) for b in PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in PRINTABLE)}
BYTE_CHARACTERS = {c: "".join(BYTES[b] for b in chr(c).encode()) for c in range(128, 256)}


class WordTokenizer:
    """Maps words to their ids as 16-bit integers.

    Words are kept in two halves: when the new half is full the old one is dropped, and a word that is asked for again moves to the
    new half. So common words stay and rare ones go.
    """

    def __init__(self, cfg: TokenConfig):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.cfg = Tokenizer.from_file(cfg.vocabulary), cfg
        self.model = self.tokenizer.model
        #: Ids of words, as bytes, and of their parts, as text.
        self.new: dict[bytes | str, bytes] = {}
        self.old: dict[bytes | str, bytes] = {}
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of more than 16 bits")

    def lookup(self, words: list[bytes]) -> list[bytes]:
        """The ids of distinct words."""
        if len(self.new) > self.cfg.kept_words // 2:
            self.old, self.new = self.new, {}
        known, older = self.new, self.old
        if missing := [w for w in words if w not in known]:
            found = {w: older[w] for w in missing if w in older}
            known.update(found)
            self.learn([w for w in missing if w not in found])
        return [known[w] for w in words]

    def learn(self, words: list[bytes]) -> None:
        """A word of plain characters is cut as the vocabulary cuts it and its parts go to the model; others go through the whole library."""
        known, others = self.new, []
        for word in words:
            text = word.decode()
            if PLAIN.fullmatch(text) and "<|" not in text:
                known[word] = b"".join(map(self.part, PARTS.findall(text.lower())))
            else:
                others.append(text)
        for low in range(0, len(others), 1_000):
            self.learn_texts(others[low : low + 1_000])

    def part(self, part: str) -> bytes:
        found = self.new.get(part) or self.old.get(part)
        if found is None:
            found = array("H", [t.id for t in self.model.tokenize(part.translate(BYTE_CHARACTERS))]).tobytes()
        self.new[part] = found
        return found

    def learn_texts(self, words: list[str]) -> None:
        """One text of all words: the places of its tokens tell the words from each other."""
        starts = np.cumsum([0, *[len(w) + 1 for w in words]])
        found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        ids, offsets = np.array(found.ids, np.uint16), np.array(found.offsets, np.int64).reshape(-1, 2)
        borders = np.searchsorted(offsets[:, 0], starts).tolist()
        data = ids.tobytes()
        for word, low, high in zip(words, borders, borders[1:]):
            self.new[word.encode()] = data[2 * low : 2 * high]

    def encode(self, texts: pa.Array) -> pa.Array:
        """The ids of each text and the end id, as 16-bit integers. Each distinct word is looked up once."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
        coded = split.values.dictionary_encode()
        letters, bounds = coded.dictionary.buffers()[2].to_pybytes(), np.frombuffer(coded.dictionary.buffers()[1], np.int64)[: len(coded.dictionary) + 1].tolist()
        words = [letters[a:b] for a, b in zip(bounds, bounds[1:])]
        own = self.lookup(words) + [array("H", [self.cfg.end_id]).tobytes()]
        sizes = np.fromiter(map(len, own), np.int64, len(own)) // 2
        known, starts = np.frombuffer(b"".join(own), "<u2"), np.cumsum(sizes) - sizes

        ends = split.offsets.to_numpy()[1:]
        places = np.full(len(coded) + len(texts), len(words), np.int64)  # the end id after each text
        inner = np.ones(len(places), bool)
        inner[ends + np.arange(len(texts))] = False
        places[inner] = coded.indices.to_numpy()
        counts = sizes[places]
        after = np.cumsum(counts)
        gathered = known[np.repeat(starts[places] - (after - counts), counts) + np.arange(after[-1] if len(after) else 0)]
        borders = np.concatenate([[0], 2 * after[ends + np.arange(len(texts))]])
        return pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(borders), pa.py_buffer(gathered)])


_tokenizers: dict[TokenConfig, WordTokenizer] = {}


def tokenizer(cfg: TokenConfig) -> WordTokenizer:
    if cfg not in _tokenizers:
        _tokenizers[cfg] = WordTokenizer(cfg)
    return _tokenizers[cfg]


def value(scalar: pa.Scalar) -> bytes:
    return scalar.as_buffer().to_pybytes() if scalar.is_valid else b""


def token_table(docs: DataFrame, cfg: TokenConfig) -> DataFrame:
    """(doc_id, ids): the ids of each document as 16-bit integers."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(cfg)
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64))
            low = 0
            while low < batch.num_rows:
                before = sizes[low - 1] if low else 0
                high = max(low + 1, int(np.searchsorted(sizes, before + cfg.batch_bytes, "right")))
                own = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([own.column(0), words.encode(own.column(1)).cast(pa.binary())], names=["doc_id", "ids"])
                low = high

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        lambda batches: released(encode(batches)), "doc_id bigint, ids binary"
    )


def id_counts(table: DataFrame, vocabulary: int) -> np.ndarray:
    """Occurrences of each id over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                totals += np.bincount(np.frombuffer(value(ids), "<u2"), minlength=vocabulary)
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[used])], names=["id", "n"])

    rows = table.select("ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(vocabulary, np.int64)
    for id_, n in rows.collect():  # one row per id of the vocabulary at most
        counts[id_] = n
    return counts


CODED = "part int, doc_id bigint, crc bigint, row bigint, chunk int, n_ids int, marks binary, codes binary"


def coded_documents(table: DataFrame, book: Codebook, bounds: list[float], cfg: TokenConfig) -> DataFrame:
    """Documents as codes, cut into chunks of a block at most, with their part."""
    shared = table.sparkSession.sparkContext.broadcast((book, np.array(bounds)))

    def grouped(batch: pa.RecordBatch) -> Iterator[list[tuple[int, int, int, np.ndarray]]]:
        """(row, crc, chunk, ids) in groups of about a block."""
        group, held = [], 0
        for i, raw in enumerate(batch.column("ids")):
            data = value(raw)
            ids, crc = np.frombuffer(data, "<u2"), zlib.crc32(data)
            for chunk, low in enumerate(range(0, len(ids), cfg.block_ids)):
                group.append((i, crc, chunk, ids[low : low + cfg.block_ids]))
                held += len(group[-1][3])
                if held >= cfg.block_ids:
                    yield group
                    group, held = [], 0
        if group:
            yield group

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        book, bounds = shared.value
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            doc_ids = batch.column("doc_id")
            known = doc_ids.fill_null(LEAST).to_numpy(zero_copy_only=False)
            least, most = np.searchsorted(bounds, known, "left"), np.searchsorted(bounds, known, "right")
            for group in grouped(batch):
                sizes = np.array([len(g[3]) for g in group])
                packed, borders, inside = book.pack(np.concatenate([g[3] for g in group]), sizes)
                first = np.cumsum(sizes) - sizes
                rows = np.array([g[0] for g in group])
                # An id that fills whole parts is dealt to all of them, document by document.
                turn = (np.array([g[1] for g in group], np.uint64) + (rows + row).astype(np.uint64) * MIX) >> np.uint64(33)
                wide = most[rows] - least[rows]
                parts = np.where(wide > 1, least[rows] + turn.astype(np.int64) % (wide + 1), most[rows]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(parts), doc_ids.take(pa.array(rows)), pa.array([g[1] for g in group], pa.int64()),
                        pa.array(rows + row), pa.array([g[2] for g in group], pa.int32()), pa.array(sizes.astype(np.int32)),
                        pa.array([inside[f : f + n : cfg.mark_every].astype("<u4").tobytes() for f, n in zip(first, sizes)], pa.binary()),
                        pa.array([packed[a:b] for a, b in zip(borders[:-1].tolist(), borders[1:].tolist())], pa.binary()),
                    ],
                    names=[f.split()[0] for f in CODED.split(", ")],
                )
            row += batch.num_rows

    return table.mapInArrow(encode, CODED)


def block_bytes(entries: list[tuple[int | None, int, int, bytes, bytes]]) -> bytes:
    """A block of (doc_id, flags, n_ids, marks, codes)."""
    listed = np.array([(d or 0, flags | (NO_ID if d is None else 0), n) for d, flags, n, _, _ in entries], ENTRY)
    marks, codes = b"".join(e[3] for e in entries), b"".join(e[4] for e in entries)
    head = HEAD.pack(len(entries), len(marks) // 4, zlib.crc32(codes), len(codes))
    sizes = np.array([len(e[4]) for e in entries], "<u4").tobytes()
    return head + listed.tobytes() + sizes + marks + codes


def write_parts(coded: DataFrame, book: Codebook, folder: str, cfg: TokenConfig) -> DataFrame:
    """Writes one file per part from rows in order; gives (part, path, n_ids, n_docs)."""
    lengths = book.lengths.tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        done: list[tuple[int, str, int, int]] = []
        part, out, entries, held, n_ids, n_docs = None, None, [], 0, 0, 0
        name = ""

        def flush() -> None:
            nonlocal entries, held
            if entries:
                out.write(block_bytes(entries))
            entries, held = [], 0

        def close() -> None:
            flush()
            out.close()
            files.move(name, f"{root}/part-{part:06d}.tok")
            done.append((part, f"part-{part:06d}.tok", n_ids, n_docs))

        for batch in batches:
            columns = [batch.column(i) for i in range(batch.num_columns)]
            heads = [columns[i].to_pylist() for i in (0, 1, 4, 5)]
            for i, (own, doc_id, chunk, n) in enumerate(zip(*heads)):
                if own != part:
                    if out is not None:
                        close()
                    part, n_ids, n_docs, name = own, 0, 0, f"{root}/.writing-{uuid.uuid4().hex}"
                    out = files.open_output_stream(name)
                    out.write(MAGIC + struct.pack("<II", cfg.max_bits, len(lengths)) + lengths)
                if held and held + n > cfg.block_ids:
                    flush()
                entries.append((doc_id, GOES_ON if chunk else 0, n, value(columns[6][i]), value(columns[7][i])))
                held, n_ids, n_docs = held + n, n_ids + n, n_docs + (not chunk)
        if out is not None:
            close()
        listed = list(zip(*done)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(listed, (pa.int32(), pa.string(), pa.int64(), pa.int64()))],
            names=["part", "path", "n_ids", "n_docs"],
        )

    return coded.mapInArrow(write, "part int, path string, n_ids bigint, n_docs bigint")


def read_exactly(stream, size: int) -> bytes:
    data = stream.read(size)
    if len(data) != size:
        raise ValueError("a token file ends early")
    return data


def read_blocks(files: pafs.FileSystem, path: str, mark_every: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(entries, ids) of each block of a file."""
    with files.open_input_stream(path) as stream:
        if stream.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"{path} is no token file")
        max_bits, vocabulary = struct.unpack("<II", read_exactly(stream, 8))
        book = Codebook(np.frombuffer(read_exactly(stream, vocabulary), np.uint8), max_bits)
        while head := stream.read(HEAD.size):
            n_entries, n_marks, crc, n_codes = HEAD.unpack(head)
            entries = np.frombuffer(read_exactly(stream, n_entries * ENTRY.itemsize), ENTRY)
            sizes = np.frombuffer(read_exactly(stream, 4 * n_entries), "<u4").astype(np.int64)
            marks = np.frombuffer(read_exactly(stream, 4 * n_marks), "<u4").astype(np.int64)
            codes = read_exactly(stream, n_codes)
            if zlib.crc32(codes) != crc:
                raise ValueError(f"a block of {path} is damaged")
            ids = entries["ids"].astype(np.int64)
            per_entry = -(-ids // mark_every)
            counts = np.full(n_marks, mark_every, np.int64)
            counts[np.cumsum(per_entry) - 1] = ids - (per_entry - 1) * mark_every
            starts = np.repeat((np.cumsum(sizes) - sizes) * 8, per_entry)
            yield entries, book.unpack(codes, marks + starts, counts)


READ = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def read_documents(parts: DataFrame, folder: str, cfg: TokenConfig) -> DataFrame:
    """Per document of the files in (path, start): doc_id, start, n_tokens, ids_crc32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                open_doc: list | None = None
                for entries, ids in read_blocks(files, f"{root}/{path}", cfg.mark_every):
                    done, data, at = [], ids.astype("<u4").tobytes(), 0
                    for doc_id, flags, n in entries.tolist():
                        own, at = data[at : at + 4 * n], at + 4 * n
                        if flags & GOES_ON:
                            open_doc[2] += n
                            open_doc[3] = zlib.crc32(own, open_doc[3])
                        else:
                            if open_doc:
                                done.append(open_doc)
                            open_doc = [None if flags & NO_ID else doc_id, start, n, zlib.crc32(own)]
                        start += n
                    yield result(done)
                yield result([open_doc] if open_doc else [])

    def result(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[], [], [], []]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "n_tokens", "ids_crc32"]
        )

    return parts.select("path", "start").mapInArrow(read, READ)


def write_tokens(docs: DataFrame, folder: str, cfg: TokenConfig) -> DataFrame:
    """Writes the token files of the documents; gives (part, path, start, n_ids, n_docs) per file, in order."""
    spark = docs.sparkSession
    work = new_folder(spark, "token-ids")
    token_table(docs, cfg).write.option("compression", "zstd").parquet(work)
    table = spark.read.parquet(work)

    size = tokenizer(cfg).tokenizer.get_vocab_size()
    counts = id_counts(table, max(size, cfg.end_id + 1))
    book = Codebook(code_lengths(counts, cfg.max_bits), cfg.max_bits)
    n_parts = parts_for(int((counts * book.lengths).sum()) // 8, cfg.part_bytes)
    steps = [i / n_parts for i in range(1, n_parts)]
    # An id that returns as a bound, or NULL, which counts as the least id here, fills more than a part.
    placed = table.select(F.coalesce("doc_id", F.lit(LEAST)).alias("place"))
    bounds = placed.approxQuantile("place", steps, min(0.01, 0.1 / n_parts)) if steps else []
    ordered = (
        coded_documents(table, book, bounds, cfg).repartitionById(n_parts, F.col("part"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "crc", "row", "chunk")
    )
    listed = f"{folder.rstrip('/')}/manifest"
    write_parts(ordered, book, f"{folder.rstrip('/')}/files", cfg).write.parquet(listed)
    start, rows = 0, []
    for part, path, n_ids, n_docs in sorted(tuple(r) for r in spark.read.parquet(listed).collect()):  # one row per file
        rows.append((part, path, start, n_ids, n_docs))
        start += n_ids
    return spark.createDataFrame(rows, "part int, path string, start bigint, n_ids bigint, n_docs bigint")


def round_trip(docs: DataFrame, cfg: TokenConfig | None = None) -> DataFrame:
    """Writes the token files and gives, read back from them, a row per document."""
    cfg = cfg or TokenConfig(vocabulary_path())
    folder = new_folder(docs.sparkSession, "tokens")
    parts = write_tokens(docs, folder, cfg)
    n_parts = max(1, parts.count())
    return read_documents(parts.repartitionById(n_parts, F.col("part") % n_parts), f"{folder}/files", cfg)
