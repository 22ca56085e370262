"""Sum-of-squares online packing of token ids into sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from lodestone.llm.bpe import END_ID, batches, encoder
from lodestone.llm.scratch import documents, ship

SEQUENCE = 4096
# Open windows a packer holds; beyond these they are cut together.
OPEN_WINDOWS = 512
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length long"
)

# A piece: document's id, start in it, its ids, the document's ids in all.
Piece = tuple[int | None, int, bytes, int]


class Packer:
    """Places pieces of at most `size` ids into windows of `size`.

    A piece goes to a new window or one filled to some level with room for it: to that level for which the sum, over all
    levels, of the squared number of windows partly filled to it is least afterwards; ties go to the fullest. Held are an array
    of these numbers and a stack of windows per level. Full windows leave at once. With more than `open_windows`,
    or at the end, the open ones are cut into full ones, the fullest first; the remainder goes on as an open window, at the end as
    sequences of powers of two. So nothing is ever padded, and at most size + open_windows windows' ids are held.
    """

    def __init__(self, first_id: int, size: int = SEQUENCE, open_windows: int = OPEN_WINDOWS) -> None:
        self.size, self.most = size, open_windows
        self.counts = np.zeros(size + 1, np.int64)
        self.windows: dict[int, list[list[Piece]]] = {}
        self.open = 0
        self.next_id = first_id

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[tuple]:
        total, step = len(ids) // 4, self.size * 4
        for at in range(0, len(ids), step):
            piece = (doc_id, at // 4, ids[at : at + step], total)
            if len(piece[2]) == step:
                yield from self._close([piece])
            else:
                yield from self._place(piece)

    def _place(self, piece: Piece) -> Iterator[tuple]:
        width, counts = len(piece[2]) // 4, self.counts
        levels = np.flatnonzero(counts[1 : self.size - width + 1]) + 1
        best, level = 2 * counts[width] + 1, 0
        if len(levels):
            filled = levels + width
            # Moving a window from one level to another; a full window counts nowhere.
            change = np.where(filled == self.size, 1 - 2 * counts[levels], 2 * (counts[filled] - counts[levels]) + 2)
            at = len(levels) - 1 - int(np.argmin(change[::-1]))
            if change[at] <= best:
                level = int(levels[at])
        window: list[Piece] = []
        if level:
            window = self.windows[level].pop()
            counts[level] -= 1
            self.open -= 1
        window.append(piece)
        if level + width == self.size:
            yield from self._close(window)
        else:
            self._hold(level + width, window)
            if self.open > self.most:
                yield from self._cut(last=False)

    def _hold(self, level: int, window: list[Piece]) -> None:
        self.windows.setdefault(level, []).append(window)
        self.counts[level] += 1
        self.open += 1

    def _cut(self, last: bool) -> Iterator[tuple]:
        pieces = [p for level in sorted(self.windows, reverse=True) for window in self.windows[level] for p in window]
        self.windows, self.open = {}, 0
        self.counts[:] = 0
        left = sum(len(p[2]) for p in pieces) // 4
        while left >= self.size:
            taken, pieces = _take(pieces, self.size)
            left -= self.size
            yield from self._close(taken)
        if left and not last:
            self._hold(left, pieces)
        while left and last:
            power = 1 << (left.bit_length() - 1)
            taken, pieces = _take(pieces, power)
            left -= power
            yield from self._close(taken)

    def _close(self, window: list[Piece]) -> Iterator[tuple]:
        offset, length = 0, sum(len(p[2]) for p in window) // 4
        for doc_id, start, ids, total in window:
            yield doc_id, start, len(ids) // 4, zlib.crc32(ids), total, self.next_id, offset, length
            offset += len(ids) // 4
        self.next_id += 1

    def finish(self) -> Iterator[tuple]:
        yield from self._cut(last=True)


def _take(pieces: list[Piece], ids: int) -> tuple[list[Piece], list[Piece]]:
    """The first `ids` ids, and the rest; one piece may be cut."""
    taken, need = [], ids * 4
    for i, (doc_id, start, data, total) in enumerate(pieces):
        if len(data) >= need:
            taken.append((doc_id, start, data[:need], total))
            rest = [(doc_id, start + need // 4, data[need:], total)] if len(data) > need else []
            return taken, rest + pieces[i + 1 :]
        taken.append(pieces[i])
        need -= len(data)
    return taken, []


def pack(docs: DataFrame, tokenizer: str, size: int = SEQUENCE) -> DataFrame:
    """Pieces of all rows of `docs`: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_length.

    A document is its text's ids (null: none) and the end id. Every Spark partition has a packer of its own, which
    reads the partition once and holds only its open windows, so there is no shuffle and a lost task is packed
    again from its input alone. sequence_id carries the partition in its upper bits. Repeated rows and rows with
    null doc_id are documents like any other; empty texts are one piece, the end id. No rows give none. Other columns are not read.
    """

    def packed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        packer = Packer(TaskContext.get().partitionId() << 36, size)
        end = END_ID.to_bytes(4, "little")
        names = [f.split()[0] for f in PIECES.split(", ")]

        def rows(found: list[tuple]) -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names)

        for part in parts:
            ids = iter(part.column(0).to_pylist())
            for texts in batches(part.column(1).to_pylist()):
                found: list[tuple] = []
                for encoded in encode.batch(texts):
                    found += packer.add(next(ids), encoded + end)
                if found:
                    yield rows(found)
        if found := list(packer.finish()):
            yield rows(found)
        encode.rest()

    ship(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(packed, PIECES)


def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    return pack(documents(spark, sf_dir), tokenizer or word_bpe())
