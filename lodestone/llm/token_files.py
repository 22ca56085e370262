"""Token-id files in directly addressable codes: any token is read without decoding others."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.llm.bpe import END_ID, batches, encoder, slices
from lodestone.llm.scratch import Scratch, documents, ship

MAGIC = b"LODEDAC1"
CHUNK_BITS = 8
BLOCK_BITS = 512
FILE_TOKENS = 1 << 22
# So many tokens of a file are put together at once, or a longer document.
READ_TOKENS = 1 << 18
BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 4096
HEAD = struct.Struct("<8sQQQ")  # magic, tokens, documents, levels
MANIFEST = "file_no long, path string, n_docs long, n_tokens long"
RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _padded(array: np.ndarray) -> bytes:
    data = array.tobytes()
    return data + bytes(-len(data) % 8)


def encode(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int]) -> bytes:
    """A file's bytes. After the head: the documents' ids, which of them are null, and their ends in tokens; the entries of
    each level; then each level's chunks, the bitmap of those that go on in the next level, and its rank directory, the ones
    before each block of `BLOCK_BITS` bits. Parts are padded to 8 bytes, numbers little-endian."""
    known = np.array([d or 0 for d in doc_ids], "<i8")
    null = np.array([d is None for d in doc_ids], "u1")
    parts, entries, rest = [], [], ids.astype("<u4")
    while True:
        onward = rest >> CHUNK_BITS
        goes_on = onward > 0
        bitmap = np.packbits(goes_on, bitorder="little")
        bitmap = np.pad(bitmap, (0, -len(bitmap) % (BLOCK_BITS // 8)))
        ones = np.unpackbits(bitmap).reshape(-1, BLOCK_BITS).sum(axis=1, dtype="<u8")
        ranks = np.cumsum(ones, dtype="<u8") - ones
        parts += [_padded((rest & 0xFF).astype("u1")), bitmap.tobytes(), ranks.tobytes()]
        entries.append(len(rest))
        if not goes_on.any():
            break
        rest = onward[goes_on]
    ends = np.cumsum(np.array(lengths, "<u8"), dtype="<u8")
    head = HEAD.pack(MAGIC, len(ids), len(doc_ids), len(entries))
    return b"".join([head, known.tobytes(), _padded(null), ends.tobytes(), np.array(entries, "<u8").tobytes(), *parts])


class TokenFile:
    """Reads a file's bytes, or a memory map of them; nothing is decoded before it is asked for."""

    def __init__(self, data: bytes | memoryview) -> None:
        magic, self.n_tokens, self.n_docs, levels = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = HEAD.size

        def array(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, count, at)
            at += -(-found.nbytes // 8) * 8
            return found

        self._doc_ids, self._null, self._ends = array("<i8", self.n_docs), array("u1", self.n_docs), array("<u8", self.n_docs)
        self._levels = []
        for entries in array("<u8", levels).tolist():
            blocks = -(-entries // BLOCK_BITS)
            self._levels.append((array("u1", entries), array("u1", blocks * BLOCK_BITS // 8), array("<u8", blocks)))

    def _rank(self, level: int, position: int) -> int:
        """The level's entries before `position` that go on."""
        chunks, bitmap, ranks = self._levels[level]
        block = min(position // BLOCK_BITS, len(ranks) - 1)
        bits = np.unpackbits(bitmap[block * BLOCK_BITS // 8 : -(-position // 8)], bitorder="little")
        return int(ranks[block]) + int(bits[: position - block * BLOCK_BITS].sum())

    def token(self, position: int) -> int:
        """One id: a chunk of each level it reaches, and a rank to find the next."""
        value = 0
        for level, (chunks, bitmap, _) in enumerate(self._levels):
            value |= int(chunks[position]) << (CHUNK_BITS * level)
            if not bitmap[position >> 3] >> (position & 7) & 1:
                break
            position = self._rank(level, position)
        return value

    def tokens(self, start: int, end: int) -> np.ndarray:
        """The ids of a range; only its own entries are read at each level."""
        out = np.zeros(end - start, "<u4")
        at = np.arange(end - start)
        for level, (chunks, bitmap, _) in enumerate(self._levels):
            if start == end:
                break
            out[at] |= chunks[start:end].astype("<u4") << (CHUNK_BITS * level)
            bits = np.unpackbits(bitmap[start >> 3 : -(-end // 8)], bitorder="little")[start & 7 :][: end - start]
            at = at[bits.astype(bool)]
            start = self._rank(level, start)
            end = start + len(at)
        return out

    def span(self, index: int) -> tuple[int | None, int, int]:
        """The document's id, and where its tokens begin and end."""
        start, end = int(self._ends[index - 1]) if index else 0, int(self._ends[index])
        return None if self._null[index] else int(self._doc_ids[index]), start, end

    def document(self, index: int) -> tuple[int | None, int, np.ndarray]:
        """The document's id, its first token's position, and its ids."""
        doc_id, start, end = self.span(index)
        return doc_id, start, self.tokens(start, end)

    def documents(self, most: int = READ_TOKENS) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Every document as `document` gives it; the levels are put together for `most` tokens at once, or a longer document."""
        ids, first = np.zeros(0, "<u4"), 0
        for index in range(self.n_docs):
            doc_id, start, end = self.span(index)
            if end > first + len(ids):
                ids, first = self.tokens(start, max(end, min(start + most, self.n_tokens))), start
            yield doc_id, start, ids[start - first : end - first]


@contextmanager
def rows_at_once(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within it, jobs hand Python batches of `rows` rows at most, as a batch of whole texts is held several times over."""
    before = spark.conf.get(BATCH, None)
    spark.conf.set(BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(BATCH) if before is None else spark.conf.set(BATCH, before)


def write_tokens(docs: DataFrame, scratch: Scratch, tokenizer: str, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Write the ids of all rows of `docs`, each with the end id, in ascending order of doc_id (nulls first, then by a hash
    of the text); returns the written files: file_no, path, n_docs, n_tokens, start.

    Documents are dealt by ranges of that order; a task writes the files of its range, one after another, each under a
    name of the attempt's own. Only the attempt that counts returns its names, so what a lost or repeated one wrote is never read.
    Null texts are empty: a document of the end id alone. No rows give no files. Repeated rows are documents of their own.
    """
    folder = f"{scratch.folder}/tokens"

    def written(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        task, encode_texts = TaskContext.get(), encoder(tokenizer)
        end = END_ID.to_bytes(4, "little")
        held: list[tuple[int | None, bytes]] = []
        tokens, files = 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal held, tokens, files
            name = f"{base}/part-{task.partitionId():06d}-{files:05d}-{task.taskAttemptId()}.dac"
            data = encode(np.frombuffer(b"".join(i for _, i in held), "<u4"), [d for d, _ in held], [len(i) // 4 for _, i in held])
            with store.open_output_stream(name) as out:
                out.write(data)
            row = [task.partitionId() << 20 | files, name, len(held), tokens]
            held, tokens, files = [], 0, files + 1
            return pa.record_batch([pa.array([v]) for v in row], ["file_no", "path", "n_docs", "n_tokens"])

        for part in (piece for whole in parts for piece in slices(whole, 1)):
            ids = iter(part.column(0).to_pylist())
            for texts in batches(part.column(1).to_pylist()):
                for encoded in encode_texts.batch(texts):
                    held.append((next(ids), encoded + end))
                    tokens += len(encoded) // 4 + 1
                    if tokens >= file_tokens:
                        yield flush()
        if held:
            yield flush()
        encode_texts.rest()

    order = (F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    ranges = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    with rows_at_once(docs.sparkSession, BATCH_ROWS):
        files = scratch.save(ranges.mapInArrow(written, MANIFEST), "files")
    # One row per file.
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    return scratch.save(files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))), "placed")


def read_tokens(files: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files; start counts all ids before it."""

    def found(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for part in parts:
            for row in part.to_pylist():
                with store.open_input_file(row["path"]) as source:
                    file = TokenFile(source.read())
                rows = [(doc_id, row["start"] + start, len(ids), zlib.crc32(ids.tobytes())) for doc_id, start, ids in file.documents()]
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                yield pa.record_batch(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    # The rows are file names. A task reads some files, one after another.
    tasks = min(files.count(), 4 * files.sparkSession.sparkContext.defaultParallelism)
    spread = files.repartition(max(1, tasks))
    return spread.select("path", "start").mapInArrow(found, RESULT)


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    ship(spark)
    scratch = Scratch(spark, "token-files")
    files = write_tokens(documents(spark, sf_dir), scratch, tokenizer or byte_bpe())
    return read_tokens(files, scratch.folder)
