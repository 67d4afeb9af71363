"""Packing documents into sequences of a fixed length: harmonic packing.

Piece lengths are parted into classes by reciprocals of the capacity: a piece belongs to class ``k`` if ``k``
pieces of its length fit into a sequence and ``k + 1`` don't. A sequence of class ``k`` always takes exactly ``k``
pieces, so a worker fills the sequences of every class on its own, without knowing the other pieces. Documents may
be cut freely, so a rest that would leave more than ``slack`` of its class's sequences empty first gives up the
largest power of two that it holds.

What is left in unfilled sequences when a worker ends (fewer than ``k`` pieces in each class) is cut into
powers of two, largest first. These fill sequences without gaps; the last ones are sequences whose length is a power
of two, which need no padding.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StructField, StructType

from tablegrade.llm.common import col, small_batches, table

#: How byte-level BPE parts a text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Characters of a stretch that is left to the slower encoder.
LONG_STRETCH = 20_000

PIECE = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

_ENCODERS: dict[str, object] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def encoder(path: str):
    """Text to token ids, by the vocabulary of a byte-level BPE file of the ``tokenizers`` library.

    A token's id there is its merge rank, so ``tiktoken`` gives the same ids in a quarter of the time. Strings of
    special tokens are ordinary text. Texts with very long stretches of blanks or without blanks, which ``tiktoken`` can't
    split, are left to ``tokenizers`` itself.
    """
    if path not in _ENCODERS:
        import tiktoken

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        special = {token["id"] for token in content.get("added_tokens", [])}
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(visible)]
        byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
        vocabulary = content["model"]["vocab"]
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if i not in special}
        made = tiktoken.Encoding("byte_bpe", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        whole: list = []

        def encode(text: str) -> list[int]:
            if len(text) > LONG_STRETCH:
                words = text.split()
                longest = len(max(words, key=len, default=""))
                if longest > LONG_STRETCH or len(text) - sum(map(len, words)) - len(words) > LONG_STRETCH:
                    if not whole:
                        from tokenizers import Tokenizer

                        whole.append(Tokenizer.from_file(path))
                        whole[0].encode_special_tokens = True
                    return whole[0].encode(text, add_special_tokens=False).ids
            return made.encode_ordinary(text)

        _ENCODERS[path] = encode
    return _ENCODERS[path]


def cuts(length: int, capacity: int, slack: float) -> list[int]:
    """Lengths of the pieces of a document, in order."""
    found = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        piece = rest
        if capacity - capacity // rest * rest > slack * capacity:
            piece = 1 << (rest.bit_length() - 1)
        found.append(piece)
        rest -= piece
    return found


def powers(length: int) -> list[int]:
    """A length as powers of two, largest first."""
    return [1 << bit for bit in range(length.bit_length() - 1, -1, -1) if length >> bit & 1]


class Worker:
    """The open sequences of one task: fewer than ``k`` pieces for each class ``k``."""

    def __init__(self, capacity: int, slack: float, first: int):
        self.capacity, self.slack, self.next = capacity, slack, first
        self.open: dict[int, list[tuple]] = {}
        self.rows: list[tuple] = []

    def close(self, pieces: list[tuple]) -> None:
        """A sequence of its own for these pieces ``(id, start, ids, document's length)``."""
        offset = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, self.next, offset))
            offset += len(ids)
        self.next += 1

    def add(self, doc: object, ids: np.ndarray) -> None:
        start = 0
        for length in cuts(len(ids), self.capacity, self.slack):
            kind = self.capacity // length
            held = self.open.setdefault(kind, [])
            held.append((doc, start, ids[start : start + length].copy(), len(ids)))
            if len(held) == kind:
                self.close(held)
                self.open[kind] = []
            start += length

    def finish(self) -> None:
        left = []
        for doc, start, ids, total in (piece for kind in sorted(self.open) for piece in self.open[kind]):
            at = 0
            for length in powers(len(ids)):
                left.append((doc, start + at, ids[at : at + length], total))
                at += length
        left.sort(key=lambda piece: -len(piece[2]))
        self.open, size = {}, sum(len(piece[2]) for piece in left)
        rooms = [self.capacity] * (size // self.capacity) + powers(size % self.capacity)
        at = 0
        for room in rooms:
            taken = []
            while room:
                taken.append(left[at])
                room -= len(left[at][2])
                at += 1
            self.close(taken)

    def drain(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def pack(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer: str | None = None,
    capacity: int = 1024,
    slack: float = 1 / 16,
    end_id: int = 0,
) -> DataFrame:
    """One row per piece: the id, ``start`` in its document's ids, ``length``, ``ids_crc32`` (of little-endian unsigned
    32-bit ids), ``doc_tokens``, ``sequence_id`` and ``offset`` there.

    Every document is its ids and then ``end_id``, so a null or empty text is the one id ``end_id``. Ids of documents may
    be null or repeat; each row is packed as a document of its own. Other columns are not read. Nothing is shuffled:
    every partition of ``docs`` fills its own sequences, whose ids start with the partition's number. ``docs`` should come from
    stored files, so that a task that runs again sees the same rows in the same order. ``capacity`` is a power of two.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")
    path = tokenizer or default_tokenizer()
    small_batches(docs.sparkSession)
    source = docs.select(col(id_column).alias(id_column), col(text_column).alias("text"))
    kind = source.schema[0].dataType
    schema = StructType([StructField(id_column, kind), *[StructField(name, LongType()) for name in PIECE]])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        worker = Worker(capacity, slack, TaskContext.get().partitionId() << 36)
        id_type = None

        def rows() -> pa.RecordBatch:
            columns = list(zip(*worker.drain(), strict=True)) or [[]] * 7
            arrays = [pa.array(columns[0], id_type), *[pa.array(x, pa.int64()) for x in columns[1:]]]
            return pa.RecordBatch.from_arrays(arrays, [id_column, *PIECE])

        for batch in batches:
            id_type = batch.column(0).type
            texts = batch.column(1)
            for i, doc in enumerate(batch.column(0).to_pylist()):
                ids = encode(texts[i].as_py() or "")
                ids.append(end_id)
                worker.add(doc, np.array(ids, "<u4"))
                if len(worker.rows) > 50_000:
                    yield rows()
            yield rows()
        if id_type is not None:
            worker.finish()
            yield rows()

    return source.mapInArrow(packed, schema)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1,024 tokens."""
    return pack(table(spark, sf_dir, "documents"))
