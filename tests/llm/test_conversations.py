"""Repair of conversations against the cheapest edits found row by row."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tablegrade.llm import conversations
from tablegrade.llm.queries import QUERIES


def damage(row: tuple) -> list[tuple]:
    conv, turn, role, text = (" " if v is None else v for v in row)
    harm = zlib.crc32(f"{conv}:{turn}".encode()) % 20
    if harm == 1:
        text = ""
    if harm == 2:
        text = re.sub("[.!?]", "", text)
    if harm == 4:
        role = "user"
    return [(row[1], role, text)] * {0: 0, 3: 2}.get(harm, 1)


def plain_repair(rows: list[tuple]) -> tuple:
    """The result for the rows ``(turn, role, text)`` of one conversation, in order: all cheapest edits are kept, row by row."""
    turns = {r[0] for r in rows if r[0] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    counts, faults, seen = {"blank": 0, "duplicate": 0, "truncated": 0}, [], set()
    for _, role, text in rows:
        kept = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
        if fault:
            counts[fault] += 1
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    # by the initials made so far, as far as the order needs them: cost, edits, lines
    best = {"": (0, "", [])}

    def put(into, made, entry):
        if made not in into or entry[:2] < into[made][:2]:
            into[made] = entry

    def take(made, initial):
        """What the order allows next: s only first, u after nothing, s or a, and a after u."""
        return initial if (initial, made) in {("s", ""), ("u", ""), ("u", "s"), ("u", "a"), ("a", "u")} else None

    def insertions(states):
        out = dict(states)
        for _ in range(4):
            for made, (cost, edits, lines) in list(out.items()):
                for role in ("user", "assistant"):
                    if take(made, role[0]):
                        put(out, role[0], (cost + 2, edits + "I", [*lines, f"{role}:"]))
        return out

    for (_, role, text), fault in zip(rows, faults, strict=True):
        following = {}
        for made, (cost, edits, lines) in insertions(best).items():
            put(following, made, (cost + 3, edits + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            extra = fault == "truncated"
            if take(made, role[:1]):
                put(following, role[:1], (cost + extra, edits + "K", [*lines, f"{role}:{text}"]))
            for new in ("user", "assistant"):
                if take(made, new[0]):
                    put(following, new[0], (cost + 2 + extra, edits + "R", [*lines, f"{new}:{text}"]))
        best = following
    cost, edits, lines = min((e for made, e in insertions(best).items() if made in ("", "a")), key=lambda e: e[:2])
    return (gaps, *counts.values(), illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def plain_rows(rows: list[tuple], damaged: bool) -> dict:
    by_conv: dict = {}
    for row in rows:
        held = by_conv.setdefault(row[0], [])
        held += damage(row) if damaged else [(row[1], *[" " if v is None else v for v in row[2:]])]
    return {conv: plain_repair(sorted(held, key=lambda r: (r[0] is not None, r[0] or 0))) for conv, held in by_conv.items()}


def made(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def results(frame) -> dict:
    found = frame.collect()
    assert len({r[0] for r in found}) == len(found)
    return {r[0]: tuple(r)[1:] for r in found}


def some_rows(seed: int, convs: int, most: int) -> list[tuple]:
    rng = random.Random(seed)
    roles = ["user", "assistant"] * 3 + ["system", "tool", "", "uber", None]
    texts = [f"Text {i}." for i in range(6)] + ["cut off", " ", "", None, "What? \n", "é!"]
    return [
        (conv, turn if rng.random() < 0.98 else None, rng.choice(roles), f"{rng.choice(texts) or ''}" if rng.random() < 0.9 else rng.choice(texts))
        for conv in range(convs) for turn in rng.sample(range(most + 3), rng.randrange(most))
    ]


def unique(rows: list[tuple]) -> list[tuple]:
    """One row per conversation and turn, so that their order is known."""
    return list({row[:2]: row for row in rows}.values())


def test_op11_by_brute_force(spark, tiny):
    rows = [tuple(r.values()) for r in pq.read_table(f"{tiny}/conversations.parquet", columns=["conv_id", "turn", "role", "text"]).to_pylist()]
    found = results(QUERIES["op11_conversation_repair"](spark, tiny))
    assert found == plain_rows(rows, True)
    assert any(row[5] for row in found.values())


@pytest.mark.parametrize("piece", [4096, 3, 1])
def test_any_roles_and_faults(spark, monkeypatch, piece):
    monkeypatch.setattr(conversations, "PIECE_ROWS", piece)
    rows = unique(some_rows(piece, 300, 12))
    assert results(conversations.repair(made(spark, rows), damaged=True)) == plain_rows(rows, True)


@pytest.mark.parametrize("piece", [4096, 50])
def test_long_conversations(spark, monkeypatch, piece):
    monkeypatch.setattr(conversations, "PIECE_ROWS", piece)
    monkeypatch.setattr(conversations, "ROUNDS", 1)
    rng = random.Random(5)
    rows = [(7, turn, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["Yes.", "no", f"Text {turn}."])) for turn in range(6000)]
    rows += [(row[0] + 10, *row[1:]) for row in unique(some_rows(1, 40, 6))]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(piece > 50).lower())
    try:
        assert results(conversations.repair(made(spark, rows).repartition(5))) == plain_rows(rows, False)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_grammar_gives_what_its_symbols_give():
    rng = random.Random(2)
    plain, ruled = conversations.Grammar([]), conversations.Grammar([("ua", ""), ("", ""), ("Ab", ""), ("u", "")])
    rest = [cost for cost, _ in conversations.ENDING]
    for _ in range(300):
        text = "".join(rng.choice(["ua", "uaua", "Ab", rng.choice(conversations.SYMBOLS)]) for _ in range(rng.randrange(12)))
        for state in range(4):
            assert plain.solve(text, state, rest) == ruled.solve(text, state, rest)


def test_rules_are_learned_from_counts(spark):
    texts = spark.createDataFrame([("uaua",)] * 3 + [("suab",), ("r",), ("",)], "symbols string")
    rules = conversations.learn_grammar(texts, rounds=2, rules=1)
    assert rules == [("ua", ""), ("", "")]


def test_awkward_rows(spark):
    same = (1, 0, "user", "Hi.")
    rows = [same, same, same, (1, 1, "assistant", "x. " * 100_000), (None, None, None, None), (None, None, "user", "Q?"), (2, None, "user", "a"), (3, 5, "system", "S.")]
    frame = made(spark, rows).select("*", F.lit(1).alias("conv"), F.lit(1).alias("place"), F.lit(1).alias("a.b"))
    found = results(conversations.repair(frame))
    assert found == plain_rows(rows, False)
    assert found[1][:7] == (0, 0, 2, 0, 2, 6, "KDDK") and found[None][6] == "DKI"
    assert results(conversations.repair(frame.limit(0))) == {}
    named = frame.select(F.col("conv_id").cast("string").alias("id.x"), "turn", "role", "text", "place")
    assert conversations.repair(named, "id.x").columns[0] == "id.x"
