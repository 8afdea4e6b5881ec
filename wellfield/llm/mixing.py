"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, ranked, shuffle_parts, word_count


def _targets(sources: DataFrame, total: float, cap: float) -> tuple[DataFrame, float]:
    """target = min(cap * size, level * weight): what lies above a cap is shared again by weight until none is above."""
    limit, level = F.col("source_size") * cap, float("inf")
    above = F.lit(False)
    while True:
        row = sources.agg(F.sum(F.when(above, limit)).alias("held"), F.sum(F.when(~above, F.col("weight"))).alias("free")).first()
        if not row["free"]:
            return sources.withColumn("target", limit.cast("double")), level
        new = (total - (row["held"] or 0.0)) / row["free"]
        if new == level:
            return sources.withColumn("target", F.least(limit.cast("double"), F.lit(level) * F.col("weight"))), level
        level, above = new, limit < F.lit(new) * F.col("weight")


def _quotas(sources: DataFrame, seats: list[int]) -> DataFrame:
    """sources with `quotas`: for each number of seats, integer seats by the highest quotients target / (2 s + 1), ties
    to the earlier source. A larger house never takes a seat away, so numbers of seats that rise give rising quotas.

    Rounding target / divisor with a divisor that is surely too large gives each source seats that it has in any case;
    only the few seats beyond them are ranked, at most four candidates per source on average."""
    n, total = sources.agg(F.count("*"), F.sum("target")).first()
    nothing = F.array(*(F.lit(0).cast("long") for _ in seats))
    if not n or not total:
        return sources.withColumn("quotas", nothing)
    houses = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.lit(m).cast("long").alias("seats")) for k, m in enumerate(seats))))
    rows = sources.where("target > 0").select("source_rank", "target", (F.col("target") / F.lit(float(total))).alias("share"), houses.alias("house")).select("*", "house.*")
    rows = rows.withColumn("sure", F.floor(F.col("share") * F.greatest(F.lit(0), F.col("seats") - n) + F.when(F.col("seats") > n, 0.5).otherwise(0.0)).cast("long"))
    rest = rows.groupBy("k").agg((F.max("seats") - F.sum("sure")).alias("rest"))  # a row for each number of seats
    more = F.sequence(F.lit(0).cast("long"), F.ceil(F.col("share") * F.lit(2.0 * n)).cast("long") + 2)
    bids = rows.select("source_rank", "k", "target", "sure", F.explode(more).alias("j"))
    bids = bids.select("source_rank", "k", (F.col("target") / (2 * (F.col("sure") + F.col("j")) + 1)).alias("quotient"))
    place = F.row_number().over(Window.partitionBy("k").orderBy(F.desc("quotient"), "source_rank"))
    won = bids.withColumn("place", place).join(F.broadcast(rest), "k").where("place <= rest").groupBy("source_rank", "k").agg(F.count("*").alias("won"))
    got = rows.join(won, ["source_rank", "k"], "left").select("source_rank", F.struct("k", (F.col("sure") + F.coalesce("won", F.lit(0))).alias("seats")).alias("s"))
    got = got.groupBy("source_rank").agg(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["seats"]).alias("quotas"))
    return sources.join(got, "source_rank", "left").withColumn("quotas", F.coalesce("quotas", nothing))


def mix_sources(docs: DataFrame, *, weights=(5.0, 2.0, 1.0), share: float = 1.5, cap: float = 2.0, block_tokens: int = 16, shards: int = 4, seed: int = 17, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of docs: doc_id, source, size, source_size, target, taken, passes, part_words, quotas,
    shard_words, and the columns named in `carry`.

    Sources by code point (null last) weigh `weights`, repeating, and share `share` of all words; no target passes
    `cap` times its source. The mix is `shards` shards of equally many blocks of `block_tokens` words. Highest quotients
    give every source an integer quota of each shard's blocks: the seats of all shards up to this one less those of the
    shards before (`quotas` is the former).

    The draw: a source's documents, ordered by a hash of id and `seed`, fill its blocks one after the other, from the
    start again after the last. Each shard selects as many of the next blocks as its quota. So a document is taken whole
    `passes` times and its first `part_words` words once more; `shard_words` says how many words go to each shard.

    The places of documents come from sums over ranges of the draw, so a source with a third of all rows is spread over
    all of them; the number of ranges follows the cluster and changes no result. Only the words of a text are counted,
    so very long texts cost one pass. Null or empty texts have size 0 and nothing is taken of them; a source of such
    texts has target 0. Repeated rows are rows of their own; equal draws (rows of one id) go by id and size. An empty
    table gives no rows. Other columns of docs are ignored.
    """
    spark = docs.sparkSession
    scratch, slices = Scratch(spark, "mix"), 8 * shuffle_parts(spark)
    drawn = F.xxhash64(F.lit(seed), F.col("doc_id"))
    ranges = F.floor((F.shiftright("draw", 32) + 2**31) * slices / 2**32).cast("int")
    rows = docs.select(*carry, "doc_id", "source", word_count(F.col("text")).alias("size")).withColumn("draw", drawn).withColumn("slice", ranges)
    rows = scratch.put("rows", rows)
    cells = scratch.put("cells", rows.groupBy("source", "slice").agg(F.sum("size").alias("words")))
    totals = cells.groupBy("source").agg(F.sum("words").alias("source_size"))
    sources = ranked(scratch, "ranks", totals, [F.col("source").asc_nulls_last()], "source_rank")
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    sources = scratch.put("sources", sources.withColumn("weight", F.element_at(cycle, (F.col("source_rank") % len(weights) + 1).cast("int"))))
    total = float(share * (sources.agg(F.sum("source_size")).first()[0] or 0))
    targets = scratch.put("targets", _targets(sources, total, cap)[0])
    targets = scratch.put("quotas", _quotas(targets, [round(total * (k + 1) / (block_tokens * shards)) for k in range(shards)]))
    most = F.floor(F.col("source_size") * cap).cast("long")
    targets = targets.select("source", "source_size", "target", "quotas", F.transform("quotas", lambda q: F.least(q * block_tokens, most)).alias("takes"))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("start", F.coalesce(F.sum("words").over(before), F.lit(0)))
    same = cells["source"].eqNullSafe(targets["source"])
    cells = scratch.put("starts", cells.join(targets, same).select(cells["source"].alias("s"), cells["slice"].alias("c"), "start", "source_size", "target", "quotas", "takes"))
    line = Window.partitionBy("source", "slice").orderBy("draw", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("within", F.coalesce(F.sum("size").over(line), F.lit(0)))
    placed = placed.join(cells, placed["source"].eqNullSafe(F.col("s")) & (placed["slice"] == F.col("c"))).withColumn("at", F.col("start") + F.col("within"))
    whole = F.greatest(F.lit(1), F.col("source_size"))
    passes = lambda words: F.floor(words / whole).cast("long")
    part = lambda words: F.greatest(F.lit(0), F.least(F.col("size"), words - passes(words) * whole - F.col("at"))).cast("long")
    placed = placed.withColumn("upto", F.transform("takes", lambda t: passes(t) * F.col("size") + part(t)))
    steps = F.transform("upto", lambda x, k: x - F.when(k > 0, F.get("upto", k - 1)).otherwise(0))
    last = F.element_at("takes", -1)
    return placed.select(
        *carry, "doc_id", "source", "size", "source_size", "target", F.element_at("upto", -1).alias("taken"), passes(last).alias("passes"), part(last).alias("part_words"), "quotas", steps.alias("shard_words"),
    )
