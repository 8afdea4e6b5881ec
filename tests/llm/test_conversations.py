"""Conversation repair against a plain search over all edits."""

import functools
import hashlib
import random
import re
import zlib

import pytest

from wellfield.llm import conversations as C
from wellfield.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WHITE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, conv string, rank long, block long, audit string"


def after_damage(rows):
    out, text_of = {}, lambda v: " " if v is None else str(v)
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        fault = zlib.crc32(f"{text_of(conv)}:{text_of(turn)}".encode()) % 20
        role, text = text_of(role), text_of(text)
        changed = {1: (role, ""), 2: (role, re.sub("[.!?]", "", text)), 4: ("user", text)}.get(fault, (role, text))
        own += [(turn, *changed)] * (0, 1, 2)[0 if fault == 0 else 2 if fault == 3 else 1]
    return out


def plain(rows, damage=after_damage):
    """Edits are searched from the end: the best rest of an audit does not depend on what stands before it."""
    follow, result = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}, []
    for conv, own in damage(rows).items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        turns = {r[0] for r in own if r[0] is not None}
        seen, faults = set(), []
        for _, role, text in own:
            bare = text.strip(WHITE)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[1][:1] for r in own]

        @functools.lru_cache(None)
        def best(k, last, inserted):
            found = [(0, "", ())] if k == len(own) and last in ("", "a") else []
            go = lambda more, cost, edit, line: more and found.append((cost + more[0], edit + more[1], line + more[2]))  # noqa: E731, B023
            names = {i: C.NAMES[i] for i in follow[last] if i in C.NAMES}
            for initial, name in names.items():
                if inserted < 4:
                    go(best(k, initial, inserted + 1), 5, "I", (f"{name}:",))
            if k < len(own):
                go(best(k + 1, last, 0), 2, "D", ())
                if faults[k] in ("", "truncated"):
                    extra = 5 * (faults[k] == "truncated")
                    if initials[k] in follow[last]:
                        go(best(k + 1, initials[k], 0), extra, "K", (f"{own[k][1]}:{own[k][2]}",))
                    for initial, name in names.items():
                        go(best(k + 1, initial, 0), extra + 1, "R", (f"{name}:{own[k][2]}",))
            return min(found) if found else None

        for k in range(len(own), -1, -1):  # so that no search goes deep
            for last in follow:
                best(k, last, 0)
        cost, audit, lines = best(0, "", 0)
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        result.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(result, key=str)


def frame(spark, rows):
    return spark.createDataFrame([r + ("x", 1, 2, "y") for r in rows], SCHEMA).repartition(4)


def check(spark, rows):
    got = C.repair_conversations(frame(spark, rows))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


def drawn(n, seed):
    """Few conversations of many turns, with nulls, ties of turns, repeated rows, unknown and empty roles."""
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "u2", "Bot", "", None]
    texts = ["Hi.", "What?", "yes", "", None, " \t", "Good! ", "a. ", "b.\n", "ü", *(f"t{k}." for k in range(9))]
    return [(rng.choice([1, 2, 3, 4, None, *range(100, 120)]), rng.choice([None, *range(rng.choice([5, 60]))]), rng.choice(roles), rng.choice(texts)) for _ in range(n)]


@pytest.mark.parametrize("block", [4096, 6])
def test_repairs_match_the_plain_version(spark, monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK_ROWS", block)  # conversations that go on over many blocks
    check(spark, drawn(500, block))


def test_one_conversation_holds_most_turns(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_ROWS", 16)
    rows = [(5, k, ("user", "assistant")[k % 2 if k % 13 else 0], f"text {k % 37}{'.' if k % 5 else ''}") for k in range(300)]
    check(spark, rows + [(k, 0, "user", "Hi.") for k in range(6, 40)])


def test_equal_rows_travel_as_one(spark):
    check(spark, [(1, 1, "user", "Hi.")] * 400 + [(1, 2, "assistant", "Well.")] * 3 + [(2, None, "user", "A.")] * 50)


def test_long_texts_and_names(spark):
    check(spark, [(1, 0, "user", "word " * 100_000 + "."), (1, 1, "assistant" * 50, "x" * 300_000), (3, 7, "user", "\n\r\n"), (3, 9, "assistant", "Fine.")])


def test_nothing_is_left(spark):
    lost = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    got = C.repair_conversations(frame(spark, [(lost, 0, "user", "Hi.")])).collect()
    assert [tuple(r) for r in got] == [(lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert C.repair_conversations(frame(spark, [(1, 0, "user", "Hi.")]).limit(0)).collect() == []


def test_query(spark):
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op13_conversation_repair"](spark, SF).collect()), key=str) == plain(rows)


def test_grammar_tells_what_is_legal():
    """Charts without faults: a role string costs nothing where the grammar has it."""
    for text in ("", "ua", "sua", "uaua", "suauaua"):
        assert C._cheapest(C.Chart([(c, 0, 1) for c in text], C.SEED).sets[-1])[0] == 0
    for text, cost in (("s", 2), ("u", 2), ("us", 1), ("au", 2), ("ssua", 2), ("uas", 2), ("aa", 1), ("uu", 1)):
        assert C._cheapest(C.Chart([(c, 0, 1) for c in text], C.SEED).sets[-1])[0] == cost, text


def test_sets_of_the_chart_stay_small():
    chart = C.Chart([("sua"[k % 3], 0, 1) for k in range(500)], C.SEED)
    assert max(map(len, chart.sets)) <= len(C.STANDS)
