"""Token ids of documents in binary files, and a minimal perfect hash index from document keys to their places.

``write_tokens`` sorts the documents by key, encodes them and writes shards. A shard is two files below ``<folder>/data``:

* ``part=ids``: the raw ids of its documents one after the other, little-endian unsigned, 2 bytes each if the vocabulary
  allows, else 4; then the token count of every document (64 bits each), the width and the number of documents (``FOOTER``);
* ``part=docs``: what the index is made of: the token counts and the distinct keys with their first document.

``build_index`` deals the keys by hash into buckets and writes one file of each below ``<folder>/index``: a minimal perfect
hash function in bit arrays (a key takes the first level where no other key has its place; its number is the rank of that bit) and
a slot for every number: fingerprint, shard, document, offset of its ids. A key's bucket, number and slot are found in constant
time, without the other keys. A key that isn't stored meets a slot whose fingerprint differs, but for one in 2**32.

Files are written by Spark's text sink, which takes bytes as they are and ends a file with a line feed. So they are committed with
the job, and a task that runs again leaves nothing twice.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tablegrade.llm.common import col, for_all, small_batches, table
from tablegrade.sources.state_files import shared_folder, stored_once

#: A shard is closed at this size, or this many documents.
SHARD_BYTES = 8 << 20
SHARD_DOCS = 100_000

#: Keys of one index file.
BUCKET_KEYS = 50_000

#: Longer chunks of text are left to the ``tokenizers`` library, whose time grows more slowly with them.
LONGEST = 500

#: Fixed values of the file formats.
FOOTER = struct.Struct("<8sQQ")
FOOTER_NAME = b"TOKENIDS"
INDEX_HEADER = struct.Struct("<8sQQ")
INDEX_NAME = b"MPHINDEX"
SLOT = np.dtype(
    [("print", "<u4"), ("parts", "<u4"), ("shard", "<i8"), ("document", "<i8"), ("documents", "<i8"), ("offset", "<i8"), ("tokens", "<i8")]
)

#: What the word tokenizer parts from the words around it, in Latin-1 text in lower case.
PARTED = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[0-9\xb2\xb3\xb9\xbc-\xbe]"
    r"|[^\x09-\x0D\x20\x85\xa0a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe]+"
)

#: Characters outside Latin-1, and those that Python takes for white space and the tokenizer doesn't.
OTHER = re.compile(r"[^\x00-\x1b\x20-\xff]")

#: Bytes that byte-level tokenizers show as themselves; the others are shown by the signs from 256 on, in order.
SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
SIGNS = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in SHOWN)}

FILES = StructType([StructField("shard", LongType(), False)]).add("part", "string", False).add("value", "binary", False)
ENTRY = "key string, shard long, document long, documents long, offset long, tokens long"
PLACE = "shard long, document long, documents long, offset long, tokens long"

_ENCODERS: dict[str, Encoder] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


class Encoder:
    """Texts to raw ids by a file of the ``tokenizers`` library. Strings of special tokens are ordinary text.

    For word tokenizers in lower case that part words as ``PARTED`` says, ``tiktoken`` gives the same ids of Latin-1 texts in a third of the
    time: a token at a word's end is given to it with a blank there, which no other token has. Texts with other characters or
    very long chunks, and other tokenizers, go through the library itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary, ending = content["model"]["vocab"], content["model"].get("end_of_word_suffix")
        self.kind = "<u2" if max(vocabulary.values()) < 1 << 16 else "<u4"
        normal, split = json.dumps(content.get("normalizer")), json.dumps(content.get("pre_tokenizer"))
        words = json.dumps(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        self.quick = None
        if ending and "Lowercase" in normal and words in split and '"Removed"' in split and "ByteLevel" in split:
            self.quick = self.merges_by_rank(content, ending)

    @staticmethod
    def merges_by_rank(content: dict, ending: str):
        """A ``tiktoken`` encoding with the same merges, or none if the ids aren't in the order of the merges."""
        import tiktoken

        vocabulary = content["model"]["vocab"]
        special = {token["content"] for token in content.get("added_tokens", [])}
        byte_of = {sign: b for b, sign in SIGNS.items()} | {chr(b): b for b in SHOWN}
        merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in content["model"]["merges"]]
        if merged != sorted(merged) or any(vocabulary[t] > merged[0] for t in vocabulary if len(t.removesuffix(ending)) == 1 and t not in special):
            return None
        ranks = {}
        for token, i in vocabulary.items():
            if token not in special:
                ranks[bytes(byte_of[c] for c in token.removesuffix(ending)) + b" " * token.endswith(ending)] = i
        return tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={}).encode_to_numpy

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text."""
        if self.quick is not None and not OTHER.search(text):
            words = PARTED.sub(r" \g<0> ", text.lower()).split()
            if not words:
                return np.empty(0, self.kind)
            if len(max(words, key=len)) <= LONGEST:
                return self.quick(" ".join(words) + " ").astype(self.kind)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind)


def encoder(path: str) -> Encoder:
    """The tokenizer of a file, once per worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Shard:
    """Documents on their way into a shard; ``kind`` is the type of their ids."""

    def __init__(self, kind: str):
        self.kind, self.size = kind, 0
        self.ids: list[np.ndarray] = []
        self.keys: list[str | None] = []
        self.firsts: list[int] = []

    def add(self, key: str | None, ids: np.ndarray) -> None:
        if not self.keys or self.keys[-1] != key:
            self.keys.append(key)
            self.firsts.append(len(self.ids))
        self.ids.append(ids)
        self.size += ids.nbytes

    def full(self) -> bool:
        return self.size >= SHARD_BYTES or len(self.ids) >= SHARD_DOCS

    def files(self) -> dict[str, bytes]:
        counts = [len(ids) for ids in self.ids]
        footer = FOOTER.pack(FOOTER_NAME, np.dtype(self.kind).itemsize, len(counts))
        payload = b"".join([ids.tobytes() for ids in self.ids])
        docs = json.dumps([self.keys, self.firsts, counts]).encode()
        return {"ids": payload + np.array(counts, "<i8").tobytes() + footer, "docs": docs}


def parted(content: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A file of ids: all ids, and the place where each document begins, and the end."""
    content = memoryview(content)[:-1]
    name, width, n = FOOTER.unpack(content[-FOOTER.size :])
    if name != FOOTER_NAME:
        raise ValueError("not a file of token ids")
    end = len(content) - FOOTER.size
    counts = np.frombuffer(content[end - 8 * n : end], "<i8")
    return np.frombuffer(content[: end - 8 * n], f"<u{width}"), np.concatenate(([0], np.cumsum(counts)))


def files_of(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """``number`` and ``content`` of all files below a folder of shards or buckets."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(folder)
    return files.select(F.regexp_extract("path", f"/{name}=(-?[0-9]+)/", 1).cast("long").alias("number"), "content")


def write_tokens(
    docs: DataFrame, folder: str, id_column: str = "doc_id", text_column: str = "text", tokenizer: str | None = None, end_id: int = 2
) -> None:
    """Write the ids of all documents, each ended by ``end_id``, in shards in ascending order of the id column.

    A null or empty text is the one id ``end_id``. Null ids come first. Rows with the same id stand in the order of a hash of their
    texts; they may fill many shards, for rows are dealt by hash and row number too. Other columns are not read. Texts are
    shuffled once.
    """
    path = tokenizer or default_tokenizer()
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(col(id_column).alias("id"), col(text_column).alias("text"))
    rows = rows.select("*", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("id").asc_nulls_first(), "hash", "row"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(F.col("id").cast("string"), "text")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        end = np.array([end_id], encode.kind)
        number, shard = TaskContext.get().partitionId() << 24, Shard(encode.kind)

        def closed() -> pa.RecordBatch:
            parts = shard.files()
            columns = [pa.array([number] * len(parts)), pa.array(list(parts)), pa.array(list(parts.values()), pa.binary())]
            return pa.RecordBatch.from_arrays(columns, FILES.fieldNames())

        for batch in batches:
            texts = batch.column(1)
            for i, key in enumerate(batch.column(0).to_pylist()):
                shard.add(key, np.concatenate((encode.encode(texts[i].as_py() or ""), end)))
                if shard.full():
                    yield closed()
                    number, shard = number + 1, Shard(encode.kind)
        if shard.ids:
            yield closed()

    # an empty shard, so that the folders exist when there are no documents
    none = [(-1, part, bytearray(content)) for part, content in Shard("<u2").files().items()]
    written = rows.mapInArrow(shards, FILES).unionByName(spark.createDataFrame(none, FILES))
    written = written.select("part", "shard", F.col("value").cast("string").alias("value"))
    written.write.partitionBy("part", "shard").text(f"{folder}/data")


def entries(spark: SparkSession, folder: str) -> DataFrame:
    """One row per key and shard that holds documents of it: where they begin, their number and tokens."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys, firsts, counts = json.loads(content.as_py())
                starts = np.concatenate(([0], np.cumsum(np.array(counts, np.int64)))).astype(np.int64)
                bounds = np.array([*firsts, len(counts)], np.int64)
                columns = [
                    pa.array(keys, pa.string()), pa.array([shard] * len(keys), pa.int64()), bounds[:-1], np.diff(bounds),
                    starts[bounds[:-1]], np.diff(starts[bounds]),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [f.split()[0] for f in ENTRY.split(", ")])

    return files_of(spark, f"{folder}/data/part=docs", "shard").mapInArrow(read, ENTRY)


def hashes(key: Column, part: Column) -> list[Column]:
    """The 128 bits that stand for a key and the number of its shard among those that hold it."""
    text = F.coalesce(F.concat(F.lit("k"), key), F.lit(""))
    return [F.xxhash64(F.lit(salt), text, part.cast("long")).alias(salt) for salt in ("h1", "h2")]


def places(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    """Where the keys lie in the bit array of a level."""
    with np.errstate(over="ignore"):
        x = h1.view(np.uint64) + np.uint64(2 * level + 1) * h2.view(np.uint64)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """A minimal perfect hash function of 128-bit keys: bit arrays, one per level, and the ranks of their words."""

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.ranks = np.cumsum(np.bitwise_count(words), dtype=np.int64) - np.bitwise_count(words)

    @classmethod
    def of(cls, h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        sizes, parts = [], []
        while len(h1):
            if len(sizes) == 64:
                raise ValueError("two keys have the same 128 bits")
            size = -(-2 * len(h1) // 64) * 64
            at = places(h1, h2, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            parts.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            left = ~alone[at]
            h1, h2 = h1[left], h2[left]
        return cls(sizes, np.concatenate(parts) if parts else np.empty(0, "<u8"))

    def numbers(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The number of each key, below their count; -1 for keys that are at no level."""
        out = np.full(len(h1), -1, np.int64)
        left, base = np.arange(len(h1)), 0
        for level, size in enumerate(self.sizes):
            at = places(h1[left], h2[left], level, size) + base
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            here = (word >> bit & np.uint64(1)) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[here]] = (self.ranks[at >> 6] + below)[here]
            left, base = left[~here], base + size
        return out


def prints(h2: np.ndarray) -> np.ndarray:
    """The fingerprint of a key."""
    return (h2.view(np.uint64) >> np.uint64(32)).astype("<u4")


def index_file(h1: np.ndarray, h2: np.ndarray, slots: np.ndarray) -> bytes:
    """The index of one bucket; ``slots`` are given in the order of the keys."""
    function = PerfectHash.of(h1, h2)
    ordered = np.empty(len(slots), SLOT)
    ordered[function.numbers(h1, h2)] = slots
    header = INDEX_HEADER.pack(INDEX_NAME, len(function.sizes), len(slots))
    return b"".join([header, np.array(function.sizes, "<i8").tobytes(), function.words.tobytes(), ordered.tobytes()])


def read_index(content: bytes) -> tuple[PerfectHash, np.ndarray]:
    name, levels, n = INDEX_HEADER.unpack_from(content)
    if name != INDEX_NAME:
        raise ValueError("not an index of token files")
    sizes = np.frombuffer(content, "<i8", levels, INDEX_HEADER.size).tolist()
    at = INDEX_HEADER.size + 8 * levels
    words = np.frombuffer(content, "<u8", sum(sizes) // 64, at)
    return PerfectHash(sizes, words), np.frombuffer(content, SLOT, n, at + 8 * len(words))


def build_index(spark: SparkSession, folder: str) -> None:
    """Write the index of all keys of a folder. A task holds the hashes and slots of one bucket."""
    rows = entries(spark, folder)
    by_key = Window.partitionBy("key")
    rows = rows.select("*", (F.row_number().over(by_key.orderBy("shard")) - 1).alias("number"), F.count(F.lit(1)).over(by_key).alias("parts"))
    buckets = max(1, -(-entries(spark, folder).count() // BUCKET_KEYS))
    rows = rows.select("parts", *[f.split()[0] for f in PLACE.split(", ")], *hashes(F.col("key"), F.col("number")))
    rows = rows.select("*", F.pmod("h1", F.lit(buckets)).alias("bucket"))

    def built(group: pd.DataFrame) -> pd.DataFrame:
        slots = np.empty(len(group), SLOT)
        for name in SLOT.names[1:]:
            slots[name] = group[name].to_numpy()
        h1, h2 = (group[h].to_numpy(np.int64) for h in ("h1", "h2"))
        slots["print"] = prints(h2)
        return pd.DataFrame({"bucket": [group["bucket"].iat[0]], "value": [index_file(h1, h2, slots)]})

    files = rows.groupBy("bucket").applyInPandas(built, "bucket long, value binary")
    files.select(F.col("bucket"), F.col("value").cast("string").alias("value")).write.partitionBy("bucket").text(f"{folder}/index")


def looked_up(keys: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """The slots of ``(key, number)``: columns of both, ``parts`` and ``PLACE``. Keys without a slot are left out."""
    rows = keys.select("key", "number", *hashes(F.col("key"), F.col("number")))
    share = max(1, -(-keys.count() // (buckets * 4 * BUCKET_KEYS)))
    rows = rows.select("*", F.pmod("h1", F.lit(buckets)).alias("bucket"), F.pmod("h2", F.lit(share)).alias("share"))
    shares = F.array([F.lit(i).cast("long") for i in range(share)])
    files = index.select(F.col("number").alias("bucket"), "content", F.explode(shares).alias("share"))

    def found(asked: pd.DataFrame, files: pd.DataFrame) -> pd.DataFrame:
        h1, h2 = (asked[h].to_numpy(np.int64) for h in ("h1", "h2"))
        hit = np.zeros(len(asked), bool)
        slots = np.zeros(len(asked), SLOT)
        for content in files["content"]:
            function, stored = read_index(content)
            numbers = function.numbers(h1, h2)
            known = np.flatnonzero(numbers >= 0)
            slots[known] = stored[numbers[known]]
            hit[known] = slots["print"][known] == prints(h2[known])
        out = asked.loc[hit, ["key", "number"]].reset_index(drop=True)
        for name in SLOT.names[1:]:
            out[name] = slots[name][hit].astype(np.int64)
        return out

    grouped = rows.groupBy("bucket", "share").cogroup(files.groupBy("bucket", "share"))
    return grouped.applyInPandas(found, f"key string, number long, parts long, {PLACE}")


def locate(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """Where the documents of the keys (the first column, each key once) lie: ``key`` and ``PLACE``, one row per shard.

    A key whose documents fill several shards has a slot for each; the first tells how many there are.
    """
    index = files_of(spark, f"{folder}/index", "bucket")
    buckets = index.count()
    if not buckets:
        return spark.createDataFrame([], f"key string, {PLACE}")
    keys = keys.select(F.col(keys.columns[0]).cast("string").alias("key"), F.lit(0).cast("long").alias("number"))
    found = first = stored_once(looked_up(keys, index, buckets))
    more = first.filter("parts > 1").select("key", F.explode(F.sequence(F.lit(1), F.col("parts") - 1)).alias("number"))
    if not more.isEmpty():
        found = first.unionByName(looked_up(more, index, buckets))
    return found.select("key", *[f.split()[0] for f in PLACE.split(", ")])


def shard_starts(spark: SparkSession, folder: str) -> DataFrame:
    """``shard`` and ``first``, the number of ids in all shards before it."""
    totals = entries(spark, folder).groupBy("shard").agg(F.sum("tokens").alias("tokens"))
    totals = totals.select("*", F.shiftright("shard", 24).alias("task"))
    tasks = totals.groupBy("task").agg(F.sum("tokens").alias("sum"))
    before = F.sum("sum").over(Window.orderBy("task")) - F.col("sum")
    inside = F.sum("tokens").over(Window.partitionBy("task").orderBy("shard")) - F.col("tokens")
    return totals.join(tasks.select("task", before.alias("before")), "task").select("shard", (F.col("before") + inside).alias("first"))


def fetch(spark: SparkSession, folder: str, keys: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row per document of the keys (the first column, each key once): the key in a column of its own name and type, ``start``
    (ids of all documents before it), ``n_tokens`` and ``ids_crc32``, all read from the files; ``with_ids`` adds ``ids``.

    Keys that aren't stored give no row. A task reads one shard at a time. The places that are asked for go to the files of ids:
    by broadcast if their counted size allows, else both are shuffled.
    """
    small_batches(spark)
    name, kind = keys.columns[0], keys.schema[0].dataType
    fields = [StructField("key", StringType())]
    fields += [StructField(column, LongType()) for column in ("start", "n_tokens", "ids_crc32")]
    fields += [StructField("ids", ArrayType(LongType()))] if with_ids else []
    schema = StructType(fields)
    keys = stored_once(keys.select(F.col(name).cast("string").alias(name)))
    asked = locate(spark, folder, keys).join(shard_starts(spark, folder), "shard")
    asked = asked.groupBy("shard", "first").agg(F.collect_list(F.struct("key", "document", "documents")).alias("asked"))
    files = files_of(spark, f"{folder}/data/part=ids", "shard").withColumnRenamed("number", "shard")
    rows = files.join(for_all(asked, 48, rows=keys.count()), "shard").select("first", "asked", "content")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, asked, content in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                ids, bounds = parted(content.as_py())
                out: list[tuple] = []
                for place in asked.as_py():
                    for document in range(place["document"], place["document"] + place["documents"]):
                        start, end = int(bounds[document]), int(bounds[document + 1])
                        own = ids[start:end]
                        row = (place["key"], first + start, end - start, zlib.crc32(own.astype("<u4").tobytes()))
                        out.append((*row, own.tolist()) if with_ids else row)
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
                columns = [pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=False)]
                if out:
                    yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    found = rows.mapInArrow(read, schema)
    return found.select(F.col("key").cast(kind).alias(name), *schema.fieldNames()[1:])


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token files with their index, and read back by their keys."""
    folder = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    write_tokens(docs, folder)
    build_index(spark, folder)
    return fetch(spark, folder, docs.select("doc_id").distinct())
