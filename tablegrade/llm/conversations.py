"""Repair of conversations: the cheapest edits that give roles in the order ``system? (user assistant)+``.

Every row is a symbol: its role's initial and its fault. The symbols of a conversation, in order, are a text over a small alphabet,
and the same stretches occur in very many conversations. So the texts are compressed by a grammar first (Re-Pair: the
most frequent pairs of neighbouring symbols become symbols of their own, round by round, counted by Spark over all
different texts). What a symbol does is a *transfer matrix* over the four states of the role order: the cheapest cost from state to
state and, as a rope, the edits that have it (the ASCII-least of the cheapest). The matrix of a rule is the min-plus product
of the matrices of its two symbols, so it is worked out once, bottom-up, for all conversations that hold the rule.

Inserted rows belong to the row that follows, so the edits of a stretch end with an edit of its last row. Two different
edits of one stretch are therefore never one the beginning of the other, and the least of two joined stretches is joined
from the least of each.

**Long conversations.** Rows are sorted by conversation and place over all partitions, so a conversation may lie in many. What one
task holds of it, in parts of at most ``PIECE_ROWS`` rows, is a piece. A conversation that a task sees from end to end in one piece
is solved there. Others are put together: rows that repeat a row of an earlier piece are found by their digests, each piece gives the
costs of its transfer matrix, these give the state before each piece, and then each piece gives its edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, LongType, StringType, StructField, StructType

from tablegrade.llm.common import col, small_batches, table
from tablegrade.sources.state_files import stored_once

#: The most rows and characters of a piece.
PIECE_ROWS = 4096
PIECE_CHARS = 4 << 20

#: Rounds of the grammar, and the new symbols of each.
ROUNDS = 5
RULES = 40

#: Texts whose matrices a worker remembers.
REMEMBERED = 100_000

#: Costs of the edits.
RENAME, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

#: States are nothing yet, after the system row, after a user row, after an assistant row. The initial that each takes next:
NEXT = ("u", "u", "a", "u")
AFTER = {"s": 1, "u": 2, "a": 3}
FINAL = (0, 3)
FULL = {"u": "user", "a": "assistant"}
LAWFUL = {"su", "ua", "au"}
SYMBOLS = "brsuaoSUAO"

COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
TEXTS = ["audit", "repaired_sha256"]

# ------------------------------------------------------------------ edits


class Rope:
    """Edits as a tree of joined parts, which are shared; its text is made when it is asked for, and kept."""

    __slots__ = ("known", "left", "right")

    def __init__(self, left: Rope | None = None, right: Rope | None = None, text: str | None = None):
        self.left, self.right, self.known = left, right, text

    def text(self) -> str:
        if self.known is None:
            self.known = self.left.text() + self.right.text()
        return self.known


#: By state before, the states after with cost and edits.
Matrix = list[dict[int, tuple[int, Rope]]]


def better(entry: tuple[int, Rope] | None, cost: int, edits: Rope) -> tuple[int, Rope]:
    """The cheaper of two entries; of equally cheap ones that whose edits come first in ASCII."""
    if entry is None or cost < entry[0] or (cost == entry[0] and edits.text() < entry[1].text()):
        return cost, edits
    return entry


def product(first: Matrix, second: Matrix) -> Matrix:
    """Two stretches, one after the other."""
    out: Matrix = [{} for _ in first]
    for before, row in enumerate(first):
        for middle, (cost, edits) in row.items():
            for after, (more, rest) in second[middle].items():
                old = out[before].get(after)
                if old is None or cost + more <= old[0]:
                    out[before][after] = better(old, cost + more, Rope(edits, rest))
    return out


def inserted(state: int) -> Iterator[tuple[int, int, str]]:
    """The states that inserted rows lead to, each once, with their cost and edits."""
    seen: list[int] = []
    while state not in seen:
        yield state, len(seen) * INSERT, "I" * len(seen)
        seen.append(state)
        state = AFTER[NEXT[state]]


def symbol_matrix(symbol: str) -> Matrix:
    """The matrix of one row. A symbol is ``b`` for a blank row and ``r`` for a repeated one, which must go, else the initial of the
    role (``o`` for one that has no place in the order), as a capital if the text is truncated."""
    initial, extra = symbol.lower(), TRUNCATED * symbol.isupper()
    out: Matrix = [{} for _ in NEXT]
    for before, entries in enumerate(out):
        for state, cost, edits in inserted(before):
            ways = [(state, DELETE, "D")]
            if symbol not in "br":
                ways.append((AFTER[NEXT[state]], RENAME + extra, "R"))
            if initial == NEXT[state] or (initial == "s" and state == 0):
                ways.append((AFTER[initial], extra, "K"))
            for after, more, edit in ways:
                entries[after] = better(entries.get(after), cost + more, Rope(text=edits + edit))
    return out


#: By state, the cost and edits of the rows that end a conversation there.
ENDING = [next((cost, edits) for end, cost, edits in inserted(state) if end in FINAL) for state in range(len(NEXT))]


class Grammar:
    """Rules ``(pair, new symbol)`` in the order in which they apply, and the matrices of all symbols."""

    def __init__(self, rules: list[tuple[str, str]]):
        self.rules = rules
        self.matrices = {symbol: symbol_matrix(symbol) for symbol in SYMBOLS}
        for pair, symbol in rules:
            self.matrices[symbol] = product(self.matrices[pair[0]], self.matrices[pair[1]])
        self.known: dict[str, Matrix] = {}

    def matrix(self, text: str) -> Matrix:
        """The matrix of a text of symbols, which isn't empty."""
        text = text.replace("r", "b")
        if text in self.known:
            return self.known[text]
        short = text
        for pair, symbol in self.rules:
            short = short.replace(pair, symbol)
        row = [self.matrices[symbol] for symbol in short]
        while len(row) > 1:
            # neighbours first, so that ropes stay shallow
            row = [product(*row[i : i + 2]) if i + 1 < len(row) else row[i] for i in range(0, len(row), 2)]
        found = row[0]
        if len(text) <= 64:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[text] = found
        return found

    def solve(self, text: str, state: int, rest: list[int]) -> tuple[int, int, str]:
        """The state after a text, the cost and the edits, if what follows costs ``rest[state after]``."""
        if not text:
            return state, 0, ""
        ways = self.matrix(text)[state].items()
        total = min(cost + rest[after] for after, (cost, _) in ways)
        edits, after = min((rope.text(), after) for after, (cost, rope) in ways if cost + rest[after] == total)
        return after, total - rest[after], edits


def repaired(edits: str, rows: list[tuple[str, str]], state: int) -> list[str]:
    """The lines ``role:text`` that the edits make of ``(role, text)``, from a state on."""
    lines, at = [], iter(rows)
    for edit in edits:
        role, text = ("", "") if edit == "I" else next(at)
        if edit == "D":
            continue
        initial = role[:1] if edit == "K" else NEXT[state]
        lines.append(f"{role if edit == 'K' else FULL[initial]}:{text}")
        state = AFTER[initial]
    return lines


def hashed(lines: list[str]) -> str:
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


# ------------------------------------------------------------------ rows and pieces


def or_space(column: Column) -> Column:
    return F.coalesce(column, F.lit(" "))


def prepared(frame: DataFrame, id_column: str, damaged: bool) -> DataFrame:
    """``conv``, ``turn``, ``role``, ``text`` and ``copies`` of every row; a null role or text is one space.

    ``damaged`` harms rows by the checksum of ``conv:turn``. Rows that it drops stay here, with no copies.
    """
    names = (id_column, "conv"), ("turn", "turn")
    rows = frame.select(*[col(a).alias(b) for a, b in names], *[or_space(col(c)).alias(c) for c in ("role", "text")])
    if not damaged:
        return rows.withColumn("copies", F.lit(1))
    key = F.concat(or_space(F.col("conv").cast("string")), F.lit(":"), or_space(F.col("turn").cast("string")))
    harm = F.crc32(key.cast("binary")) % 20
    text = F.when(harm == 1, "").when(harm == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(harm == 4, "user").otherwise(F.col("role"))
    copies = F.when(harm == 0, 0).when(harm == 3, 2).otherwise(1)
    return rows.select("conv", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))


def fields_of(conv: DataType, *names: tuple[str, DataType]) -> StructType:
    return StructType([StructField("conv", conv), *[StructField(name, kind) for name, kind in names]])


PIECE = [
    ("place", LongType()), ("whole", BooleanType()), ("symbols", StringType()), ("turns", ArrayType(LongType())),
    ("roles", ArrayType(StringType())), ("texts", ArrayType(StringType())),
]


def with_repeats(symbols: str, fresh: set[int]) -> str:
    """The symbols with ``r`` for all rows that are neither blank nor fresh."""
    return "".join(s if s == "b" or i in fresh else "r" for i, s in enumerate(symbols))


def first_places(rows: list[tuple]) -> set[int]:
    """Where each row is met first."""
    places: dict[tuple, int] = {}
    for i, row in enumerate(rows):
        places.setdefault(row, i)
    return set(places.values())


def pieces(rows: DataFrame) -> DataFrame:
    """The rows in order, as pieces: ``conv``, ``place`` (their order), ``symbols`` and lists of their rows.

    A ``whole`` piece is a conversation from end to end. In others, repeated rows don't have their symbol yet. Rows are
    sorted by conversation, turn (nulls first), role and a hash of the text; equal ones may lie in several partitions.
    """
    initial = F.substring("role", 1, 1)
    symbol = F.when(initial.isin(*AFTER), initial).otherwise("o")
    symbol = F.when(F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), symbol).otherwise(F.upper(symbol))
    symbol = F.when(F.col("text").rlike(r"[^\x20\x09-\x0D]"), symbol).otherwise("b")
    rows = rows.select("*", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "hash", "row"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.select("conv", "copies", symbol.alias("symbol"), F.col("turn").cast("long"), "role", "text")
    schema = fields_of(rows.schema["conv"].dataType, *PIECE)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 33
        conv, conv_type, held, chars = None, None, [], 0
        # the first and the last conversation of a task may go on in other tasks
        started, first, parts = False, True, 0

        def close(more: bool) -> pa.RecordBatch:
            nonlocal place, held, chars
            whole = not (first or parts or more)
            symbols, turns, roles, texts = ([row[i] for row in held] for i in range(4))
            text = "".join(symbols)
            if whole:
                text = with_repeats(text, first_places([row[2:] for row in held]))
            lists = [pa.array([turns], pa.list_(pa.int64())), *[pa.array([x], pa.list_(pa.string())) for x in (roles, texts)]]
            columns = [pa.array([conv], conv_type), pa.array([place]), pa.array([whole]), pa.array([text]), *lists]
            place, held, chars = place + 1, [], 0
            return pa.RecordBatch.from_arrays(columns, schema.fieldNames())

        for batch in batches:
            conv_type, made = batch.column(0).type, []
            for now, copies, *row in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                if started and now != conv:
                    made.append(close(False))
                    first, parts = False, 0
                conv, started = now, True
                for _ in range(copies):
                    if len(held) >= PIECE_ROWS or chars >= PIECE_CHARS:
                        made.append(close(True))
                        parts += 1
                    held.append(tuple(row))
                    chars += len(row[3])
            if made:
                yield pa.Table.from_batches(made).combine_chunks().to_batches()[0]
        if started:
            yield close(True)

    return rows.mapInArrow(cut, schema)


def completed(parted: DataFrame) -> DataFrame:
    """Pieces of parted conversations, with the symbol of repeated rows."""
    row = F.posexplode(F.arrays_zip("roles", "texts")).alias("at", "row")
    rows = parted.select("conv", "place", "symbols", row).filter(F.col("symbols").substr(F.col("at") + 1, F.lit(1)) != "b")
    digest = F.sha2(F.concat(F.length("row.roles").cast("string"), F.lit(":"), "row.roles", "row.texts"), 256)
    firsts = rows.groupBy("conv", digest.alias("digest")).agg(F.min(F.struct("place", "at")).alias("first"))
    fresh = firsts.groupBy("first.place").agg(F.collect_list("first.at").alias("fresh"))
    schema = StructType([*parted.schema.fields])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marked = [with_repeats(s, set(f or [])) for s, f in zip(batch["symbols"].to_pylist(), batch["fresh"].to_pylist(), strict=True)]
            columns = [pa.array(marked, pa.string()) if f.name == "symbols" else batch[f.name] for f in schema]
            yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return parted.join(fresh, "place", "left").select(*schema.fieldNames(), "fresh").mapInArrow(mark, schema)


def learn_grammar(texts: DataFrame, rounds: int = ROUNDS, rules: int = RULES) -> list[tuple[str, str]]:
    """The rules that shorten the column ``symbols`` most, from counts over all rows.

    Every round takes the most frequent pairs of neighbours that occur twice at least, ``rules`` of them. So the grammar is bounded; what
    no rule shortens is multiplied symbol by symbol.
    """
    found: list[tuple[str, str]] = []
    texts = texts.select(F.translate("symbols", "r", "b").alias("symbols")).filter(F.length("symbols") > 1)
    texts = stored_once(texts.groupBy("symbols").agg(F.count(F.lit(1)).alias("n")))
    for _ in range(rounds):
        current = F.col("symbols")
        for pair, symbol in found:
            current = F.replace(current, F.lit(pair), F.lit(symbol))
        places = texts.select(current.alias("symbols"), "n").filter(F.length("symbols") > 1)
        places = places.select("symbols", "n", F.explode(F.sequence(F.lit(1), F.length("symbols") - 1)).alias("at"))
        pairs = places.groupBy(F.col("symbols").substr(F.col("at"), F.lit(2)).alias("pair")).agg(F.sum("n").alias("n"))
        best = pairs.filter("n > 1").orderBy(F.desc("n"), "pair").limit(rules).collect()
        if not best:
            break
        found += [(row["pair"], chr(0xE000 + len(found) + i)) for i, row in enumerate(best)]
    return found


# ------------------------------------------------------------------ results


def illegal(roles: list[str]) -> int:
    """Neighbouring roles whose initials aren't in order."""
    initials = [role[:1] for role in roles]
    return sum(a + b not in LAWFUL for a, b in zip(initials, initials[1:], strict=False))


def row_counts(symbols: str) -> list[int]:
    return [symbols.count("b"), symbols.count("r"), sum(s.isupper() for s in symbols)]


def solved_whole(whole: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """The result for conversations of one piece."""
    schema = fields_of(whole.schema["conv"].dataType, *[(n, LongType()) for n in COUNTS], *[(n, StringType()) for n in TEXTS])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(rules)
        for batch in batches:
            out: list[list] = [[] for _ in schema.fields[1:]]
            for symbols, turns, roles, texts in zip(*[batch[c].to_pylist() for c in ("symbols", "turns", "roles", "texts")], strict=True):
                state, cost, edits = grammar.solve(symbols, 0, [c for c, _ in ENDING])
                cost, edits = cost + ENDING[state][0], edits + ENDING[state][1]
                known = {turn for turn in turns if turn is not None}
                gaps = max(known) - min(known) + 1 - len(known) if known else 0
                row = (gaps, *row_counts(symbols), illegal(roles), cost, edits, hashed(repaired(edits, list(zip(roles, texts, strict=True)), 0)))
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            kinds = [pa.int64()] * len(COUNTS) + [pa.string()] * len(TEXTS)
            columns = [batch["conv"], *[pa.array(c, k) for c, k in zip(out, kinds, strict=True)]]
            yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return whole.mapInArrow(solve, schema)


def states_before(parted: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """``place``, the ``state`` before each piece, and ``rest``, what the pieces after it cost by state.

    Of a conversation a task holds 32 numbers for each piece: the costs of its matrix, and the order of its edits by state, which
    decides between equally cheap ways.
    """
    size = len(NEXT)
    numbers = [("place", LongType()), ("costs", ArrayType(LongType())), ("ranks", ArrayType(LongType()))]
    schema = fields_of(parted.schema["conv"].dataType, *numbers)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(rules)
        none = [{state: (0, Rope(text=""))} for state in range(size)]
        for batch in batches:
            costs, ranks = [], []
            for symbols in batch["symbols"].to_pylist():
                matrix = grammar.matrix(symbols) if symbols else none
                costs.append([row[after][0] if after in row else -1 for row in matrix for after in range(size)])
                ordered = [sorted(row, key=lambda after, row=row: row[after][1].text()) for row in matrix]
                ranks.append([row.index(after) if after in row else -1 for row in ordered for after in range(size)])
            kinds = [pa.list_(pa.int64())] * 2
            columns = [batch["conv"], batch["place"], *[pa.array(c, k) for c, k in zip((costs, ranks), kinds, strict=True)]]
            yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    def walk(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        rest = [cost for cost, _ in ENDING]
        ways, rests = [], []
        for costs, ranks in zip(group["costs"].to_numpy()[::-1], group["ranks"].to_numpy()[::-1], strict=True):
            rests.append(rest)
            at = [[k for k in range(size * s, size * s + size) if costs[k] >= 0] for s in range(size)]
            ways.append([min(row, key=lambda k, rest=rest, costs=costs, ranks=ranks: (costs[k] + rest[k % size], ranks[k])) % size for row in at])
            rest = [int(min(costs[k] + rest[k % size] for k in row)) for row in at]
        state, states = 0, []
        for after in reversed(ways):
            states.append(state)
            state = after[state]
        return pd.DataFrame({"place": group["place"].to_numpy(), "state": states, "rest": rests[::-1]})

    measured = parted.select("conv", "place", "symbols").mapInArrow(measure, schema)
    return measured.groupBy("conv").applyInPandas(walk, "place long, state long, rest array<long>")


def solved_parted(parted: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """The result for conversations of several pieces.

    Each piece is repaired by itself; then the pieces of a conversation pass in order through one task, which keeps sums, the running hash
    and the edits, but no texts.
    """
    conv = parted.schema["conv"].dataType
    columns = [("place", LongType()), ("counts", ArrayType(LongType())), ("turns", ArrayType(LongType())), ("ends", ArrayType(StringType()))]
    columns += [("edits", StringType()), ("after", LongType()), ("lines", ArrayType(StringType()))]
    piece_schema = fields_of(conv, *columns)
    schema = fields_of(conv, *[(n, LongType()) for n in COUNTS], *[(n, StringType()) for n in TEXTS])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(rules)
        for batch in batches:
            out: list[list] = [[] for _ in columns[1:]]
            names = ("symbols", "turns", "roles", "texts", "state", "rest")
            for symbols, turns, roles, texts, state, rest in zip(*[batch[c].to_pylist() for c in names], strict=True):
                after, cost, edits = grammar.solve(symbols, state, rest)
                known = sorted({turn for turn in turns if turn is not None})
                lines = repaired(edits, list(zip(roles, texts, strict=True)), state)
                ends = [roles[0][:1], roles[-1][:1]] if roles else []
                row = ([*row_counts(symbols), illegal(roles), cost], [*known[:1], *known[-1:], len(known)], ends, edits, after, ["\n".join(lines)] if lines else [])
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            longs, strings = pa.list_(pa.int64()), pa.list_(pa.string())
            made = [pa.array(c, k) for c, k in zip(out, (longs, longs, strings, pa.string(), pa.int64(), strings), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["conv"], batch["place"], *made], piece_schema.fieldNames())

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_type, conv, started = None, None, False
        sums, span, initial, edits, state, digest, lines = np.zeros(5, np.int64), [], None, [], 0, hashlib.sha256(), 0

        def result() -> pa.RecordBatch:
            cost, ending = ENDING[state]
            for line in repaired(ending, [], state):
                digest.update((("\n" if lines else "") + line).encode())
            gaps = span[1] - span[0] + 1 - span[2] if span else 0
            row = (gaps, *sums[:4].tolist(), int(sums[4]) + cost, "".join(edits) + ending, digest.hexdigest())
            return pa.RecordBatch.from_arrays([pa.array([conv], conv_type), *[pa.array([x]) for x in row]], schema.fieldNames())

        for batch in batches:
            conv_type = batch.column(0).type
            for now, _, counts, turns, ends, text, after, chunk in zip(*[batch[f.name].to_pylist() for f in piece_schema], strict=True):
                if started and now != conv:
                    yield result()
                    sums, span, initial, edits, digest, lines = np.zeros(5, np.int64), [], None, [], hashlib.sha256(), 0
                conv, started = now, True
                sums = sums + counts
                if ends:
                    sums[3] += initial is not None and initial + ends[0] not in LAWFUL
                    initial = ends[1]
                if len(turns) > 1:
                    # turns are in order, so a piece shares at most its first turn with the pieces before
                    span = [span[0], turns[1], span[2] + turns[2] - (span[1] == turns[0])] if span else turns
                edits.append(text)
                state = after
                for part in chunk:
                    digest.update((("\n" if lines else "") + part).encode())
                    lines += 1
        if started:
            yield result()

    todo = parted.join(states_before(parted, rules), "place")
    solved = todo.select("conv", "place", "symbols", "turns", "roles", "texts", "state", "rest").mapInArrow(solve, piece_schema)
    return solved.repartition("conv").sortWithinPartitions("conv", "place").mapInArrow(fold, schema)


def repair(conversations: DataFrame, id_column: str = "conv_id", damaged: bool = False) -> DataFrame:
    """One row per conversation: its id, ``gaps``, numbers of ``blank``, ``duplicate`` and ``truncated`` rows (the first of these faults
    counts), ``illegal`` neighbours, ``cost`` and ``audit`` of the cheapest edits, and ``repaired_sha256`` of the repaired rows.

    Reads the columns ``turn`` (whole numbers), ``role`` and ``text`` besides the id; others are left alone. Null ids are one conversation. Rows stand
    by turn, nulls first, those of one turn by role and a hash of the text. A null role or text is one space: such a text is blank, and such a
    role must be changed. Repeated rows are duplicates. An empty text is blank; a very long one is a piece by itself. A conversation
    without rows after ``damaged`` has zeros, no edits and the hash of an empty text. An empty table gives no rows.

    Rows are shuffled and stored once; only those at the ends of a partition's range and those of conversations that span
    partitions again.
    """
    spark = conversations.sparkSession
    small_batches(spark)
    cut = stored_once(pieces(prepared(conversations, id_column, damaged)))
    parted = stored_once(completed(cut.filter("NOT whole")))
    rules = learn_grammar(cut.filter("whole").select("symbols").unionByName(parted.select("symbols")))
    found = solved_whole(cut.filter("whole"), rules).unionByName(solved_parted(parted, rules))
    return found.withColumnRenamed("conv", id_column)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by their rows' checksums and repaired."""
    return repair(table(spark, sf_dir, "conversations"), damaged=True)
