"""Sharding by balanced label propagation over linked documents."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, ranked, shuffle_parts

#: Arrivals at a shard are let in by size class and drawn number; sums are kept for so many steps of that order.
STEPS = 4096


def _literals(values: list[int]) -> Column:
    return F.array(*(F.lit(v).cast("long") for v in values))


def _loads(rows: DataFrame, label: str, shards: int) -> list[int]:
    """Rows by shard; one number for each shard comes to the driver."""
    found = {r[0]: r[1] for r in rows.groupBy(label).agg(F.sum("n")).collect()}
    return [found.get(k, 0) for k in range(shards)]


def _admitted(votes: DataFrame, room: list[int], least: int, turn: int) -> DataFrame:
    """(g, part, aim) of the groups of `least` documents or more that move this round; votes are (g, part, label, n) of
    groups not yet together.

    A group aims for the shard that holds most of its documents, of those with room for all of them; ties by a number
    drawn anew each round. Where none of its own has room, the shard with the most room is its aim. Of the groups that
    want to come to a shard, larger ones are first, then in drawn order, as many as there is room for."""
    free = _literals(room)
    wide = votes.groupBy("g", "part").agg(F.sum("n").alias("members"), F.collect_list(F.struct("label", "n")).alias("own"))  # at most a vote per shard
    wide = wide.where(F.col("members") >= least)
    fits = F.filter("own", lambda v: F.get(free, v["label"]) >= F.col("members"))
    drawn = lambda *what: F.xxhash64(F.lit(turn), "g", "part", *what)
    best = F.array_max(F.transform(fits, lambda v: F.struct(v["n"].alias("n"), drawn(v["label"]).alias("draw"), v["label"].alias("label"))))
    spare = max(range(len(room)), key=lambda k: room[k])
    aim = F.coalesce(best["label"], F.when(F.col("members") <= room[spare], F.lit(spare)))
    aims = wide.select("g", "part", "members", aim.alias("aim")).where("aim is not null")
    size_class = 63 - F.floor(F.log2(F.col("members"))).cast("int")
    aims = aims.withColumn("step", size_class * (STEPS // 64) + F.pmod(drawn(), F.lit(STEPS // 64)).cast("int"))
    coming = aims.groupBy("aim", "step").agg(F.sum("members").alias("m"))  # at most STEPS rows for each shard
    so_far = F.sum("m").over(Window.partitionBy("aim").orderBy("step"))
    last = coming.withColumn("so_far", so_far).where(F.col("so_far") <= F.get(free, F.col("aim"))).groupBy("aim").agg(F.max("step").alias("step"))
    upto = {r["aim"]: r["step"] for r in last.collect()}
    return aims.where(F.col("step") <= F.get(_literals([upto.get(k, -1) for k in range(len(room))]), F.col("aim"))).select("g", "part", "aim")


def propagate(scratch: Scratch, rows: DataFrame, *, shards: int, quota: int, rounds: int, largest: int) -> DataFrame:
    """rows (r, g, part, salt, label) of linked documents with their labels after the rounds, and `home`: whether all of
    the group has come together. No group, or part of one, has more than `largest` documents.

    Each round counts the votes of every group by shard, lets groups move as far as quotas allow, and joins the moves
    to the documents. A group that has come together keeps its place, so later rounds handle what is left. Up to
    `rounds` rounds are for groups of more than an eighth of a shard, while there is room for them, and as many for the
    others. The join is on (g, salt): a group that may be large is spread over several salts."""
    homes, places, names = [], [0] * shards, ["r", "g", "part", "label"]
    levels, done = [quota // 8 + 1, 1] if largest > quota // 8 else [1], set()
    for turn, least in enumerate(level for level in levels for _ in range(rounds)):
        if least in done:
            continue
        room = [max(0, quota - p) for p in places]
        votes = rows.groupBy("g", "part", "label").agg(F.count("*").alias("n"), F.collect_set("salt").alias("at"))
        votes = scratch.put(f"votes{turn}", votes)
        moves = scratch.put(f"moves{turn}", _admitted(votes, room, least, turn))
        cells = votes.select("g", "part", F.explode("at").alias("salt")).distinct().join(moves, ["g", "part"])
        moved = scratch.put(f"moved{turn}", rows.join(cells.select("g", "salt", "aim"), ["g", "salt"], "left"))
        homes.append(moved.where("aim is not null").select("r", "g", "part", F.col("aim").alias("label")))
        rows, come = moved.where("aim is null").drop("aim"), _loads(homes[-1].groupBy("label").agg(F.count("*").alias("n")), "label", shards)
        places = [a + b for a, b in zip(places, come)]
        if not any(come) or rows.limit(1).count() == 0:
            done.add(least)
    out = rows.select(*names, F.lit(False).alias("home"))
    for home in homes:
        out = out.union(home.select(*names, F.lit(True)))
    return out


def _targets(loads: list[int]) -> list[int]:
    """Rows by shard, at most one apart; the fuller shards have the one more."""
    n, shards = sum(loads), len(loads)
    fuller = sorted(range(shards), key=lambda k: (-loads[k], k))[: n % shards]
    return [n // shards + (k in fuller) for k in range(shards)]


def shard_documents(docs: DataFrame, *, shards: int = 24, rounds: int = 8, seed: int = 5) -> DataFrame:
    """One row per row of docs: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Documents with equal texts are linked. Labels start from drawn numbers. In up to `rounds` rounds of joins, linked
    documents move to the shard that holds most of their neighbours, whole groups at a time, under quotas that no shard
    outgrows. Then a repair evens out the counts (law `rows`: at most one apart): the surplus of a shard goes to shards
    with too few rows, first documents without links, then those of groups that are still apart; all others stay where
    they are. Slots count a shard's rows from 0.

    A group larger than a shard is placed in parts of about nine tenths of one. Groups larger than an eighth of a
    mean partition, of which there are at most eight for each partition, are broadcast by hash and number of salts,
    and no join brings more than a salt's rows of them together.

    A null text counts as empty (size 8, CRC 0). Null ids and repeated rows are placed like any other; texts are read
    once, however long. An empty table gives no rows; other columns of docs are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "shards")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.unhex(F.md5(text)).alias("g"), F.xxhash64(F.lit(seed), "doc_id").alias("draw"))
    rows = scratch.put("rows", rows.withColumn("r", F.monotonically_increasing_id()))
    n = rows.count()
    deal = 8 * max(shards, shuffle_parts(spark))
    most, quota = max(1, -(-n // deal)), n // shards
    sizes = scratch.put("sizes", rows.groupBy("g").agg(F.count("*").alias("members")).where("members > 1"))
    largest = sizes.agg(F.max("members")).first()[0] or 0
    parts = F.when(F.col("members") <= max(1, quota), 1).otherwise(F.least(F.lit(deal), F.ceil(F.col("members") * 10 / (9 * max(1, quota))).cast("int")))
    big = sizes.where(F.col("members") > most).select("g", parts.alias("parts"), (parts * F.ceil(F.col("members") / (most * parts)).cast("int")).alias("salts"))
    salted = rows.join(F.broadcast(big), "g", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    salt = F.pmod(F.xxhash64("r", "draw"), "salts").cast("int")
    salted = salted.select("r", "g", F.pmod(F.xxhash64("draw"), F.lit(shards)).cast("int").alias("label"), "salts", salt.alias("salt"), F.pmod(salt, F.coalesce("parts", F.lit(1))).alias("part"))
    spread = sizes.join(F.broadcast(big), "g", "left").select("g", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"))
    linked = scratch.put("linked", salted.join(spread, ["g", "salt"]))
    placed = propagate(scratch, linked, shards=shards, quota=quota, rounds=rounds, largest=largest).select("r", "label", F.when(F.col("home"), 0).otherwise(1).alias("kind"), F.concat("g", F.col("part").cast("string").cast("binary")).alias("unit"))
    own = F.pmod(F.xxhash64("draw"), F.lit(shards)).cast("int")
    line = rows.select("r", "doc_id", "size", "text_crc32", "draw", own.alias("own")).join(placed, "r", "left")
    line = line.withColumn("label", F.coalesce("label", "own")).withColumn("kind", F.coalesce("kind", F.lit(2))).drop("own")
    line = ranked(scratch, "line", line, [F.col("label"), F.col("kind"), F.col("unit"), F.col("draw"), F.col("doc_id"), F.col("r")], "at")
    line = scratch.put("placed", line)
    loads = _loads(line.groupBy("label").agg(F.count("*").alias("n")), "label", shards)
    targets = _targets(loads)
    kept, starts = [min(a, b) for a, b in zip(loads, targets)], [0, *accumulate(loads)][:-1]
    line = line.withColumn("slot", F.col("at") - F.get(_literals(starts), F.col("label")))
    line = line.withColumn("stays", F.col("slot") < F.get(_literals(kept), F.col("label")))
    spare = ranked(scratch, "spare", line.where("NOT stays"), [F.col("kind"), F.col("unit"), F.col("draw"), F.col("doc_id"), F.col("r")], "k")
    ends = list(accumulate(t - k for t, k in zip(targets, kept)))
    to = F.size(F.filter(_literals(ends), lambda e: e <= F.col("k")))
    offset = F.get(_literals([k - e for k, e in zip(kept, [0, *ends])]), to)
    shown = lambda shard, slot: ["doc_id", "size", "text_crc32", F.lit("rows").alias("law"), shard.cast("int").alias("shard"), slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")]
    return line.where("stays").select(*shown(F.col("label"), F.col("slot"))).union(spare.select(*shown(to, F.col("k") + offset)))
