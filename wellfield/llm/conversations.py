"""Repair of conversation structure by error-correcting Earley parsing over blocks of turns."""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, Scratch, ranked

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
NAMES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
#: A conversation is nothing, or an optional system turn and pairs of a user's and an assistant's turn. `Turns` recurs
#: on the left, so every item of the chart starts at place 0 and a set holds a bounded number of items.
GRAMMAR = [("Chat", ()), ("Chat", ("Turns",)), ("Turns", ("u", "a")), ("Turns", ("s", "u", "a")), ("Turns", ("Turns", "u", "a"))]
#: Turns of one task's chart.
BLOCK_ROWS = 4096
BLANK, SEEN, TRUNCATED = 1, 2, 4


class Grammar:
    """The items of GRAMMAR (production, dot) with their Earley steps worked out: `reach[item]` are the items that
    prediction, completion and insertion lead to without a turn, with the number of inserts (the least; an audit of
    inserts alone has no other); `scan[item]` is the terminal that item waits for and the item after it."""

    def __init__(self, rules=GRAMMAR, start="Chat"):
        self.rules, self.start = rules, start
        self.items = [(r, d) for r, (_, body) in enumerate(rules) for d in range(len(body) + 1)]
        number = {item: k for k, item in enumerate(self.items)}
        self.begin = [number[r, 0] for r, (head, _) in enumerate(rules) if head == start]
        self.scan = {number[r, d]: (body[d], number[r, d + 1]) for r, (_, body) in enumerate(rules) for d in range(len(body)) if body[d] in "sua"}
        self.done = {number[r, len(body)] for r, (head, body) in enumerate(rules) if head == start}
        self.reach = {k: self._closure(k, number) for k in range(len(self.items))}
        self.first = self._least([self.reach[k] for k in self.begin])

    def _closure(self, item: int, number: dict) -> dict[int, int]:
        found, waiting = {}, [(0, item)]
        while waiting:
            inserts, k = min(waiting)
            waiting.remove((inserts, k))
            if found.get(k, 1 << 30) <= inserts:
                continue
            found[k] = inserts
            r, d = self.items[k]
            head, body = self.rules[r]
            if d == len(body):  # completion: whatever waits for the head goes on
                waiting += [(inserts, number[r2, d2 + 1]) for r2, (_, b2) in enumerate(self.rules) for d2 in range(len(b2)) if b2[d2] == head]
            elif body[d] in NAMES:  # insertion
                waiting.append((inserts + 1, number[r, d + 1]))
            elif body[d] != "s":  # prediction
                waiting += [(inserts, number[r2, 0]) for r2, (h2, _) in enumerate(self.rules) if h2 == body[d]]
        return found

    @staticmethod
    def _least(maps: list[dict[int, int]]) -> dict[int, int]:
        out: dict[int, int] = {}
        for m in maps:
            for k, n in m.items():
                out[k] = min(n, out.get(k, n))
        return out

    def steps(self, initial: str) -> dict[int, list[tuple[int, str, str]]]:
        """For each item of a set, what consuming a turn with this initial leads to: item, edits, output role ('' for the
        turn's own). Deleting first and inserting later costs the same and comes first among audits, so no insert
        stands right before a delete."""
        out = {}
        for item in range(len(self.items)):
            moves = [(item, "D", "")]
            for k, inserts in self.reach[item].items():
                if k in self.scan:
                    wanted, after = self.scan[k]
                    if wanted == initial:
                        moves.append((after, "I" * inserts + "K", ""))
                    elif wanted in NAMES:
                        moves.append((after, "I" * inserts + "R", wanted))
            out[item] = moves
        return out

    def end(self, item: int) -> int | None:
        """Inserts that complete a chart at this item."""
        return min((n for k, n in self.reach[item].items() if k in self.done), default=None)


PARSER = Grammar()
#: Where a chart may stand between two turns: before the first one, or after a production has consumed one.
SEED = len(PARSER.items)
PARSER.items.append((-1, 0))
PARSER.reach[SEED] = PARSER.first
STANDS = [SEED, *sorted({after for _, after in PARSER.scan.values()})]
STEPS = {initial: {k: v for k, v in PARSER.steps(initial).items() if k in STANDS} for initial in ("s", "u", "a", "")}


class Chart:
    """The chart over one stretch of turns, from one item on.

    Each set maps an item to (cost, rank, item before, edits, role): the least cost of reaching it and, of equally cheap
    audits, the ASCII-least. Ranks stand for the audits' order; as each audit in a set has just consumed a turn, none
    is the beginning of another, so the order of extended audits follows from the ranks and the added edits."""

    def __init__(self, turns: list[tuple], start: int):
        self.turns, self.sets = turns, [{start: (0, 0, None, "", "")}]
        for initial, flags, _ in turns:
            forced, extra, last, best = flags & (BLANK | SEEN), CUT_OFF if flags & TRUNCATED else 0, self.sets[-1], {}
            steps = STEPS[initial if initial in NAMES or initial == "s" else ""]
            for item, (cost, rank, *_) in last.items():
                for after, edits, role in steps[item]:
                    if edits == "D":
                        price = cost + DELETE
                    elif forced:
                        continue
                    else:
                        price = cost + INSERT * (len(edits) - 1) + extra + (KEEP if edits[-1] == "K" else REROLE)
                    if after not in best or (price, rank, edits) < best[after][0]:
                        best[after] = ((price, rank, edits), item, role)
            order = {item: k for k, item in enumerate(sorted(best, key=lambda x: best[x][0][1:]))}
            self.sets.append({item: (key[0], order[item], before, key[2], role) for item, (key, before, role) in best.items()})

    def path(self, item: int) -> list[tuple[str, str]]:
        """Edits and output role of every turn on the way to this item."""
        out = []
        for found in reversed(self.sets[1:]):
            _, _, before, edits, role = found[item]
            out.append((edits, role))
            item = before
        return out[::-1]


def damaged(rows: DataFrame) -> DataFrame:
    """The rows that damage leaves: conv (the id as text), turn, role, text, times. What is null counts as one space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    out = rows.select(text("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"), fault.alias("fault")).where("fault <> 0")
    changed = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return out.select("conv", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), changed.alias("text"), F.when(F.col("fault") == 3, 2).otherwise(1).cast("long").alias("times"))


def _flags(text: Column) -> Column:
    """BLANK, TRUNCATED or neither."""
    bare = F.rtrim(text, F.lit("".join(map(chr, np.flatnonzero(SPACES)))))
    return F.when(bare == "", BLANK).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), 0).otherwise(TRUNCATED)


def _turns(rows: DataFrame) -> DataFrame:
    """conv, turn, role, mark (a hash of the text), flags, times: equal rows as one."""
    narrow = rows.select("conv", "turn", "role", F.sha2("text", 256).alias("mark"), _flags(F.col("text")).alias("flags"), "times")
    turns = narrow.groupBy("conv", "turn", "role", "mark", "flags").agg(F.sum("times").alias("times"))
    first = turns.groupBy("conv", "role", "mark").agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first"))
    seen = F.col("first").eqNullSafe(F.struct(F.col("turn").isNotNull().alias("known"), "turn"))
    return turns.join(first, ["conv", "role", "mark"]).withColumn("flags", F.when((F.col("flags") != BLANK) & ~seen, SEEN).otherwise(F.col("flags")).cast("int")).drop("first")


def _runs(frame: pd.DataFrame) -> Iterator[tuple[str, int, int, list[tuple]]]:
    """The conversations of one block (sorted by rank): name, first row and row after the last, and initial, flags and
    number of each turn. A turn that is there several times is followed by the others as one to be deleted."""
    convs, roles, flags, times = (frame[c].tolist() for c in ("conv", "role", "flags", "times"))
    a = 0
    while a < len(convs):
        b, turns = a, []
        while b < len(convs) and convs[b] == convs[a]:
            initial = roles[b][:1]
            turns.append((initial, flags[b], 1))
            if times[b] > 1:
                turns.append((initial, BLANK if flags[b] & BLANK else SEEN, times[b] - 1))
            b += 1
        yield convs[a], a, b, turns
        a = b


COUNTS = ["blank", "duplicate", "truncated", "illegal"]
SUMMARY = "conv string, block long, start int, stop int, inserts int, cost long, blank long, duplicate long, truncated long, illegal long, first string, last string, ways binary"
CHOICE = ", ".join(SUMMARY.split(", ")[:10])


def _summaries(frame: pd.DataFrame) -> pd.DataFrame:
    """Per conversation of a block its counts and the items where its chart starts and ends. A block's first and last
    conversation may go on in other blocks; they get instead, for each item that they may start from, the (item, cost,
    rank) of the last set, and cost holds what the chart doesn't: all but one of the deletes of equal turns."""
    frame = frame.sort_values("rank")
    rows, block = [], int(frame["block"].iloc[0])
    for conv, a, b, turns in _runs(frame):
        counts = [sum(t for _, f, t in turns if f & flag) for flag in (BLANK, SEEN, TRUNCATED)]
        counts.append(sum(x[0] + y[0] not in LEGAL for x, y in zip(turns, turns[1:])) + sum(t - 1 for _, _, t in turns))
        again = sum(DELETE * (t - 1) for _, _, t in turns)
        if a and b < len(frame):
            cost, _, inserts, stop = _cheapest(Chart(turns, SEED).sets[-1])
            rows.append((conv, block, SEED, stop, inserts, cost + again, *counts, turns[0][0], turns[-1][0], None))
            continue
        ways = [(start, item, cost, rank) for start in (STANDS if not a else [SEED]) for item, (cost, rank, *_) in Chart(turns, start).sets[-1].items()]
        rows.append((conv, block, None, None, None, again, *counts, turns[0][0], turns[-1][0], np.array(ways, np.int64).tobytes()))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in SUMMARY.split(", ")]).astype({c: "Int32" for c in ("start", "stop", "inserts")})


def _cheapest(last: dict) -> tuple[int, int, int, int]:
    """Cost, rank, inserts at the end and item of the best complete chart."""
    return min((found[0] + INSERT * n, found[1], n, item) for item, found in last.items() if (n := PARSER.end(item)) is not None)


def _choose(frame: pd.DataFrame) -> pd.DataFrame:
    """One conversation: its blocks' charts joined from left to right, and the items where each block starts and ends on
    the cheapest way. Among equal costs the audit so far decides, by its rank."""
    frame = frame.sort_values("block")
    sets: list[dict] = [{SEED: (0, 0, None)}]
    for data in frame["ways"]:
        best: dict = {}
        for start, item, cost, rank in np.frombuffer(data, np.int64).reshape(-1, 4).tolist():
            if start in sets[-1]:
                key = (sets[-1][start][0] + cost, sets[-1][start][1], rank)
                if item not in best or key < best[item][0]:
                    best[item] = (key, start)
        order = {item: k for k, item in enumerate(sorted(best, key=lambda x: best[x][0][1:]))}
        sets.append({item: (key[0], order[item], start) for item, (key, start) in best.items()})
    cost, _, inserts, item = _cheapest(sets[-1])
    ways = []
    for found in reversed(sets[1:]):
        ways.append((found[item][2], item))
        item = found[item][2]
    starts, stops = zip(*ways[::-1])
    rest = [0] * (len(frame) - 1)
    border = sum(a + b not in LEGAL for a, b in zip(frame["last"][:-1], frame["first"][1:]))
    totals = {c: [int(frame[c].sum()) + (border if c == "illegal" else 0), *rest] for c in COUNTS}
    return pd.DataFrame({"conv": frame["conv"], "block": frame["block"], "start": starts, "stop": stops, "inserts": [*rest, inserts], "cost": [cost + int(frame["cost"].sum()), *rest], **totals})


def _inserted(before: str, count: int) -> tuple[list[str], str]:
    """The lines of `count` inserts after a turn with this output initial, and the initial after them."""
    lines = []
    for _ in range(count):
        before = "a" if before == "u" else "u"
        lines.append(f"{NAMES[before]}:")
    return lines, before


def _edits(frame: pd.DataFrame, choice: pd.DataFrame) -> pd.DataFrame:
    """A block's turns with the edits on the chosen way; `lead` are inserted lines before a turn, `tail` those after the
    conversation's last one; new_role is the output role, null for a deleted turn."""
    columns = [c.split()[0] for c in EDITS.split(", ")]
    if frame.empty:
        return pd.DataFrame(columns=columns)
    frame = frame.sort_values("rank")
    chosen = {c: (int(x), int(y), int(n)) for c, x, y, n in zip(choice["conv"], choice["start"], choice["stop"], choice["inserts"])}
    given, audits, kept, leads, tails = zip(frame["role"], frame["times"].tolist()), [], [], [], []
    for conv, a, b, turns in _runs(frame):
        start, stop, inserts = chosen[conv]
        path, before = iter(Chart(turns, start).path(stop)), _output(start)
        for role, times in itertools.islice(given, b - a):
            edits, new = next(path)
            stays = NAMES.get(new, role) if edits != "D" else None
            leads.append("\n".join(_inserted(before, len(edits) - 1)[0]))
            if times > 1:
                next(path)
                edits += "D" * (times - 1)
            before = stays[:1] if stays else before
            audits.append(edits)
            kept.append(stays)
            tails.append(None)
        if inserts:
            audits[-1] += "I" * inserts
            tails[-1] = "\n".join(_inserted(before, inserts)[0])
    return frame[columns[:5]].assign(audit=audits, new_role=kept, lead=leads, tail=tails)


EDITS = "conv string, turn_name string, role string, mark string, rank long, audit string, new_role string, lead string, tail string"


def _output(stand: int) -> str:
    """The output initial before a chart's start item ('' at the beginning)."""
    rule, dot = PARSER.items[stand]
    return PARSER.rules[rule][1][dot - 1] if dot else ""


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each conversation's lines; rows come sorted, and only one conversation's hash is held."""
    conv, sha, some = None, None, False

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([sha.hexdigest()])], ["conv", "repaired_sha256"])

    for batch in batches:
        for own, piece in zip(batch.column("conv").to_pylist(), batch.column("piece").to_pylist()):
            if own != conv or sha is None:
                if sha is not None:
                    yield told()
                conv, sha, some = own, hashlib.sha256(), False
            sha.update((("\n" if some else "") + piece).encode())
            some = True
    if sha is not None:
        yield told()


def repair_edits(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """For damaged rows (conv, turn, role, text, times) the edits of every turn, and each conversation's counts and cost."""
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("mark")]
    turns = ranked(scratch, "dealt", _turns(rows), order, "rank")
    turns = scratch.put("turns", turns.withColumn("block", F.floor(F.col("rank") / BLOCK_ROWS)).withColumn("turn_name", F.col("turn").cast("string")))
    scratch.drop("dealt")
    summaries = scratch.put("summaries", turns.drop("turn").groupBy("block").applyInPandas(_summaries, SUMMARY))
    split = summaries.where(F.col("ways").isNotNull()).groupBy("conv").applyInPandas(_choose, CHOICE)
    choices = scratch.put("choices", summaries.where(F.col("ways").isNull()).drop("first", "last", "ways").unionByName(split))
    edits = scratch.put("edits", turns.drop("turn").groupBy("block").cogroup(choices.groupBy("block")).applyInPandas(_edits, EDITS))
    counts = choices.groupBy("conv").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")])
    spans = turns.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")).alias("gaps"))
    return edits, scratch.put("counts", counts.join(spans, "conv").withColumn("gaps", F.coalesce("gaps", F.lit(0))))


def repair_conversations(conversations: DataFrame, *, damage=damaged) -> DataFrame:
    """One row per conv_id: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    conversations has conv_id, turn, role, text; `damage` says what rows stand for it (see damaged()). A turn's first
    fault counts: blank, duplicate (role and text seen before in the conversation) or truncated (no sentence end). Turns
    are kept at no cost, reroled (1), deleted (2; blank and duplicate ones always), and empty ones inserted (5); a
    truncated one that stays costs 5 more. The cheapest edits that make the roles GRAMMAR's, of these the ASCII-least.

    Turns are numbered over all conversations in order and parsed in blocks of BLOCK_ROWS: a block's chart gives the cost
    of every way through it, by the items it starts and ends with. A conversation joins its blocks' costs (a few numbers
    per block), and each block then tells its edits on the chosen way. So a conversation of any length is parsed in
    bounded pieces; equal turns, however many, travel as one with their number. Only the audit (one letter per
    edit) and the digest of a conversation's lines (read in order, one at a time) are made in one place, as the result
    has one value for each.

    Turns go in order of turn (null first); rows with one turn by role and the hash of their text. A null role, text, turn
    or conv_id is one space in what damage hashes and in what is written; null conv_ids are one conversation, whose id
    is null. Texts are read whole; an empty table gives no rows; other columns are ignored.
    """
    scratch = Scratch(conversations.sparkSession, "repair")
    rows = damage(conversations)
    edits, counts = repair_edits(rows, scratch)
    audits = edits.groupBy("conv").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    kept = edits.where(F.col("new_role").isNotNull() | F.col("tail").isNotNull())
    keys = ["conv", "turn_name", "role", "mark"]
    texts = rows.select("conv", F.coalesce(F.col("turn").cast("string"), F.lit("")).alias("turn_name"), "role", "text", F.sha2("text", 256).alias("mark")).dropDuplicates(keys)
    line = F.when(F.col("new_role").isNotNull(), F.concat("new_role", F.lit(":"), "text"))
    piece = F.concat_ws("\n", F.when(F.col("lead") != "", F.col("lead")), line, F.col("tail"))
    lines = texts.join(kept.withColumn("turn_name", F.coalesce("turn_name", F.lit(""))), keys).select("conv", "rank", piece.alias("piece"))
    digests = lines.repartition("conv").sortWithinPartitions("conv", "rank").select("conv", "piece").mapInArrow(_digests, "conv string, repaired_sha256 string")
    all_ids = conversations.select("conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv")).distinct()
    told = all_ids.join(counts, "conv", "left").join(audits, "conv", "left").join(digests, "conv", "left")
    zero = [F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    out = scratch.put("out", told.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")))
    scratch.drop("turns", "summaries", "choices", "edits", "counts")
    return out
