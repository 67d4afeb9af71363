"""Finding the reference checks most similar to a column's description.

Similarity search is exact: every query is compared with every document. The comparison itself is a
matrix product inside Spark tasks; pairs are never rows, and each task returns only its best ``k``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tablegrade.schemas import DEFAULT_TOP_K
from tablegrade.sources.state_files import stored_once

#: Largest document set sent to all executors, in bytes of its vectors as doubles.
BROADCAST_BYTES = 64 * 1024 * 1024
#: Documents and queries per block when the documents are too many to broadcast.
BLOCK_ROWS = 16_384

#: Strips that queries and documents are dealt into, so each vector is moved so many times. Queries get more where a
#: strip of them would exceed ``HELD_BYTES`` as doubles, which one task holds while documents pass by.
STRIPS, HELD_BYTES = 8, 64 * 1024 * 1024
#: Vectors that move as one row, in bytes as doubles.
PACKED_BYTES = 1 << 20

_MATCH = "query_id {0}, doc_id {1}, score double"

#: Vectors that can be compared.
_WHOLE = "vector is not null and forall(vector, x -> x is not null)"


def _matrix(vectors: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of unit length; a zero vector stays zero."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    rows = vectors.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(-1, width)
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


#: Scores held at a time within a task.
_SCORES_AT_ONCE = 4_000_000


def _best(queries: np.ndarray, documents: np.ndarray, k: int, digits: int):
    """Row and document positions and scores of each query's best ``k``.

    Documents come in order of their id, which settles ties. Queries go through in slices, so that the
    score matrix stays small however many documents there are.
    """
    step = max(1, _SCORES_AT_ONCE // len(documents))
    slices = [
        (start, _best_of_slice(queries[start : start + step], documents, k, digits))
        for start in range(0, len(queries), step)
    ]
    rows = np.concatenate([found[0] + start for start, found in slices])
    return rows, *(np.concatenate([found[i] for _, found in slices]) for i in (1, 2))


def _reaching(queries: np.ndarray, documents: np.ndarray, k: int, digits: int, least: np.ndarray):
    """As ``_best``, of the documents that reach each query's ``least`` score only."""
    parts, step = [], max(1, _SCORES_AT_ONCE // len(documents))
    for start in range(0, len(queries), step):
        known = least[start : start + step]
        if np.isneginf(known).any():
            rows, docs, values = _best_of_slice(queries[start : start + step], documents, k, digits)
        else:
            raw = queries[start : start + step] @ documents.T
            rows, docs = np.nonzero(raw >= (known - 10.0**-digits)[:, None])
            values = np.round(raw[rows, docs], digits) + 0.0
            order = np.lexsort((docs, -values, rows))
            rows, docs, values = rows[order], docs[order], values[order]
            keep = np.arange(rows.size) - np.searchsorted(rows, rows) < k
            rows, docs, values = rows[keep], docs[keep], values[keep]
        fits = values >= known[rows]
        parts.append((rows[fits] + start, docs[fits], values[fits]))
    return tuple(np.concatenate([part[i] for part in parts]) for i in range(3))


class _Strip:
    """Queries of one strip, held while documents pass by, and the best ``k`` so far of each.

    ``least`` is a score that each query's ``k``-th best reaches; with ``pivots``, rings whose bound doesn't reach it are
    not compared (see :mod:`metric_index`).
    """

    def __init__(self, ids: pa.Array, vectors: np.ndarray, least: np.ndarray, k: int, digits: int, pivots: np.ndarray | None):
        self.ids, self.vectors, self.least, self.k, self.digits = ids, vectors, least, k, digits
        self.angles = None if pivots is None else np.arccos(np.clip(vectors @ pivots.T, -1, 1))
        self.parts: list[tuple] = []
        self.waiting = self.kept = 0

    def meet(self, ids: pa.Array, documents: np.ndarray, ring: tuple[int, float, float] | None) -> None:
        # Ties go to the smaller id, so documents come in its order; null ids first, as Spark sorts them.
        order = pc.sort_indices(ids, null_placement="at_start").to_numpy()
        vectors, least, some = self.vectors, self.least, None
        if ring is not None and self.angles is not None:
            pivot, low, high = ring
            angle = self.angles[:, pivot]
            gap = np.maximum(np.maximum(angle - high, low - angle) - ANGLE_SLACK, 0.0)
            some = np.flatnonzero(np.cos(gap) + 10.0**-self.digits >= least)
            if not len(some):
                return
            vectors, least = (vectors, least) if len(some) == len(vectors) else (vectors[some], least[some])
        rows, docs, scores = _reaching(vectors, documents[order], self.k, self.digits, least)
        self.parts.append((rows if some is None else some[rows], ids.take(pa.array(order[docs])), scores))
        self.waiting += len(rows)
        if self.waiting >= max(len(self.vectors) * self.k // 2, 1):
            self.settle()

    def settle(self) -> None:
        """Cut what was found to the best ``k`` of each query."""
        rows, scores = (np.concatenate([part[i] for part in self.parts]) for i in (0, 2))
        ids = pa.concat_arrays([part[1] for part in self.parts])
        place = np.empty(len(ids), np.int64)
        place[pc.sort_indices(ids, null_placement="at_start").to_numpy()] = np.arange(len(ids))
        order = np.lexsort((place, -scores, rows))
        rows, scores = rows[order], scores[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        keep, last = rank < self.k, rank == self.k - 1
        self.least = self.least.copy()
        self.least[rows[last]] = np.maximum(self.least[rows[last]], scores[last])
        self.parts, self.waiting = [(rows[keep], ids.take(pa.array(order[keep])), scores[keep])], 0

    def found(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        self.settle()
        rows, ids, scores = self.parts[0]
        for start in range(0, len(rows), 50_000):
            cut = slice(start, start + 50_000)
            columns = [self.ids.take(pa.array(rows[cut])), ids[cut], pa.array(scores[cut])]
            yield pa.RecordBatch.from_arrays(columns, names=["query_id", "doc_id", "score"])


#: What rounding may add to an angle.
ANGLE_SLACK = 1e-6


def packed(frame: DataFrame, key: str, width: int, rows: int) -> DataFrame:
    """``block``, ``ids`` and ``vectors`` (bytes) of up to ``rows`` rows each, in place and stored. Floats stay floats."""
    rows = max(1, min(rows, PACKED_BYTES // (8 * max(1, width))))
    kind = frame.schema[key].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                values = part.column("vector").flatten().to_numpy(zero_copy_only=False)
                values = values if values.dtype == np.float32 else values.astype("float64")
                ids = part.column(key)
                ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
                yield pa.RecordBatch.from_arrays([ids, pa.array([values.tobytes()], pa.binary())], names=["ids", "vectors"])

    blocks = frame.select(key, "vector").mapInArrow(pack, f"ids array<{kind}>, vectors binary")
    return stored_once(blocks.withColumn("block", F.monotonically_increasing_id()))


def in_strips(
    queries: DataFrame, documents: DataFrame, counts: tuple[int, int], width: int, k: int, digits: int, pivots: np.ndarray | None = None
) -> DataFrame:
    """Each strip's best ``k`` of every query: all blocks of ``queries`` meet all blocks of ``documents``.

    Both are stored blocks (see ``packed``), ``counts`` their numbers of vectors. Every pair of strips is one task's
    partition, in which the queries are held and the documents pass by, so a vector moves ``STRIPS`` times however
    many blocks there are. ``queries`` may bring ``least``, the score that each one's ``k``-th best reaches, as bytes,
    and documents their ``pivot``, ``low`` and ``high``.
    """
    dealt, pairs = dealt_in_strips(queries, documents, counts, width)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def vectors(row: dict) -> np.ndarray:
            count = len(row["own"])
            values = np.frombuffer(row["vectors"], np.float32 if len(row["vectors"]) == 4 * count * width else np.float64)
            rows = values.reshape(count, width).astype("float64")
            norms = np.linalg.norm(rows, axis=1, keepdims=True)
            return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)

        def strip() -> _Strip:
            least = [np.frombuffer(r["least"]) if r["least"] is not None else np.full(len(r["own"]), -np.inf) for r in held]
            ids = pa.concat_arrays([r["own"] for r in held])
            return _Strip(ids, np.concatenate([vectors(r) for r in held]), np.concatenate(least), k, digits, pivots)

        pair, held, open_strip = None, [], None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in ("pair", "side", "vectors", "least", "pivot", "low", "high")}
                row["own"] = batch.column("doc_ids" if row["side"] else "query_ids")[i].values
                if row["pair"] != pair:
                    if open_strip is not None:
                        yield from open_strip.found()
                    pair, held, open_strip = row["pair"], [], None
                if row["side"] == 0:
                    held.append(row)
                elif held or open_strip is not None:
                    if open_strip is None:
                        open_strip, held = strip(), []
                    ring = None if row["pivot"] is None else (row["pivot"], row["low"], row["high"])
                    open_strip.meet(row["own"], vectors(row), ring)
        if open_strip is not None:
            yield from open_strip.found()

    kinds = (frame.schema["ids"].dataType.elementType.simpleString() for frame in (queries, documents))
    dealt = dealt.repartitionById(pairs, F.col("pair")).sortWithinPartitions("pair", "side", "block")
    return dealt.mapInArrow(match, _MATCH.format(*kinds))


def dealt_in_strips(queries: DataFrame, documents: DataFrame, counts: tuple[int, int], width: int) -> tuple[DataFrame, int]:
    """The blocks of both sides, once for each pair of strips that they belong to, and the number of pairs."""
    across = min(STRIPS, max(1, documents.count()))
    down = max(min(STRIPS, max(1, queries.count())), -(-counts[0] * width * 8 // HELD_BYTES))
    if down > STRIPS:
        across = max(1, min(across, STRIPS * STRIPS // down))

    def rows(frame: DataFrame, side: int, own: int, other: int) -> DataFrame:
        strip, others = F.pmod(F.xxhash64("block"), F.lit(own)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(other - 1)))
        frame = frame.withColumn("strip", strip).withColumn("other", others)
        pair = F.col("other") * down + F.col("strip") if side == 0 else F.col("strip") * down + F.col("other")
        names = {"least": "binary", "pivot": "int", "low": "double", "high": "double"}
        more = [F.col(n) if n in frame.columns else F.lit(None).cast(kind).alias(n) for n, kind in names.items()]
        ids = [
            F.col("ids").alias(name) if own_side else F.lit(None).cast(other_frame.schema["ids"].dataType).alias(name)
            for name, own_side, other_frame in (("query_ids", side == 0, queries), ("doc_ids", side == 1, documents))
        ]
        return frame.select(pair.alias("pair"), F.lit(side).alias("side"), "block", *ids, "vectors", *more)

    return rows(queries, 0, down, across).unionByName(rows(documents, 1, across, down)), across * down


def _best_of_slice(queries: np.ndarray, documents: np.ndarray, k: int, digits: int):
    scores = np.round(queries @ documents.T, digits) + 0.0
    take = min(k, scores.shape[1])
    floor = np.partition(scores, scores.shape[1] - take, axis=1)[:, scores.shape[1] - take]
    rows, docs = np.nonzero(scores >= floor[:, None])
    values = scores[rows, docs]
    order = np.lexsort((docs, -values, rows))
    rows, docs, values = rows[order], docs[order], values[order]
    starts = np.searchsorted(rows, np.arange(scores.shape[0]))
    keep = np.arange(rows.size) - starts[rows] < take
    return rows[keep], docs[keep], values[keep]


def _ranked(matches: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each query's partial results, with their rank.

    Spark cuts each task's rows to the best ``k`` per query before it shuffles them.
    """
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    ranked = matches.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("bigint").alias("rank"), "doc_id", "score")


def top_k_similar(
    queries: DataFrame,
    documents: DataFrame,
    k: int = DEFAULT_TOP_K,
    *,
    digits: int = 6,
    broadcast_bytes: int = BROADCAST_BYTES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The ``k`` documents most similar to each query by cosine, best first, ties by id.

    ``queries`` has ``query_id`` and ``vector``, ``documents`` has ``doc_id`` and ``vector``. A vector
    that is null or holds a null matches nothing, on either side; the others must have one length, or
    a ``ValueError`` is raised. Scores are rounded to ``digits`` before ranking.

    Documents whose vectors fit ``broadcast_bytes`` (their number is counted first) go to every
    executor, and the queries are then read in place without a shuffle. Beyond that, both sides are packed
    into blocks of up to ``block_rows`` and dealt into strips; each pair of strips is one task (see ``in_strips``).
    """
    queries, documents = queries.where(_WHOLE), documents.where(_WHOLE)
    width = F.size("vector")
    size = documents.agg(
        F.count("*").alias("count"), F.min(width).alias("least"), F.max(width).alias("width")
    ).head()
    width, count = size["width"], size["count"]
    if count == 0:
        return _empty(queries, documents)
    if size["least"] != width:
        raise ValueError(f"document vectors of lengths {size['least']} to {width}")
    message = F.concat(F.lit(f"not a query vector of length {width}: "), F.size("vector").cast("string"))
    fits = F.when(F.size("vector") == width, F.col("vector")).otherwise(F.raise_error(message))
    queries = queries.select("query_id", fits.alias("vector"))
    kinds = queries.schema["query_id"].dataType.simpleString(), documents.schema["doc_id"].dataType.simpleString()
    schema = _MATCH.format(*kinds)
    if count * width * 8 <= broadcast_bytes:
        return _against_broadcast(queries, documents, width, k, digits, schema)
    asked, held = packed(queries, "query_id", width, block_rows), packed(documents, "doc_id", width, block_rows)
    asking = asked.agg(F.sum(F.size("ids"))).head()[0] or 0
    return _ranked(in_strips(asked, held, (asking, count), width, k, digits), k)


def _empty(queries: DataFrame, documents: DataFrame) -> DataFrame:
    """No matches, in the shape of matches."""
    return queries.where(F.lit(False)).select(
        "query_id",
        F.lit(0).cast("bigint").alias("rank"),
        F.lit(None).cast(documents.schema["doc_id"].dataType).alias("doc_id"),
        F.lit(0.0).alias("score"),
    )


def _against_broadcast(queries, documents, width, k, digits, schema) -> DataFrame:
    held = documents.select("doc_id", "vector").orderBy("doc_id").toArrow()
    session = queries.sparkSession
    sent = session.sparkContext.broadcast(
        (held.column("doc_id").combine_chunks(), _matrix(held.column("vector"), width))
    )

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix = sent.value
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows, docs, scores = _best(_matrix(batch.column("vector"), width), matrix, k, digits)
            rank = np.arange(rows.size) - np.searchsorted(rows, rows) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("query_id").take(pa.array(rows)),
                    pa.array(rank, pa.int64()),
                    ids.take(pa.array(docs)),
                    pa.array(scores),
                ],
                names=["query_id", "rank", "doc_id", "score"],
            )

    ranked = schema.replace(", doc_id", ", rank bigint, doc_id")
    return queries.select("query_id", "vector").mapInArrow(match, ranked)


def documents_of(matches: DataFrame, knowledge_base: DataFrame) -> DataFrame:
    """Matches with the description and syntax of the documents they name.

    Ids are compared as text. A match whose document is unknown keeps null texts.
    """
    texts = knowledge_base.select(
        F.col("check_id").cast("string").alias("_id"), "check_syntax", "description"
    )
    return matches.join(texts, F.col("doc_id").cast("string") == F.col("_id"), "left").drop("_id")


def format_context(documents: DataFrame) -> DataFrame:
    """The ``context`` text of each query: its documents one after the other in rank order.

    At most ``k`` documents per query. An unknown syntax reads ``None``.
    """
    # The labels and line breaks of a block.
    block = F.concat(
        F.lit("+check_syntax: \n "),
        F.coalesce("check_syntax", F.lit("None")),
        F.lit("\ncheck_description: "),
        F.coalesce("description", F.lit("None")),
        F.lit("\n\n"),
    )
    entries = F.array_sort(F.collect_list(F.struct("rank", block.alias("text"))))
    return documents.groupBy("query_id").agg(
        F.array_join(F.transform(entries, lambda e: e["text"]), "").alias("context")
    )


def last_messages(messages: DataFrame) -> DataFrame:
    """The newest message of each conversation, by ``turn``."""
    return messages.groupBy("conv_id").agg(F.max_by("text", "turn").alias("content"))


def comment_of(content: Column) -> Column:
    """The ``comment`` field of a message that holds a column record as JSON; null otherwise."""
    return F.get_json_object(content, "$.comment")
