"""Mixing sources to target weights: Pfair release times and deadlines per block, earliest deadline first by slot ranges."""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import stage_table, table

# Documents of one block.
BLOCK = 16
# Target weight of a source is its number of documents to this power, unless weights are given.
POWER = 0.5
# Weights are integers of which all sources together have this many, about.
WHOLE = 1 << 44
# Slots of a range, at least: a range is scheduled in one task.
RANGE = 16_384
# Slots of a range, at most, about, as a task holds its blocks.
MAX_RANGE = 1 << 19
# Sources that one schedule holds; more are scheduled in groups, and inside them again.
TOGETHER = 4096
# Rows that one window group may have, about.
BUCKET_ROWS = 20_000


class Shares:
    """Exact shares of sources of n blocks and integer weight a, where those run dry leave theirs to the others.

    By virtual time v a source has had min(n, a * v). In the phase after some have run dry, all together have had
    C + A * v with integers C (blocks of the dry) and A (weight of the others), so every comparison is one of integers.
    """

    def __init__(self, blocks: list[int], weights: list[int]) -> None:
        self.n, self.a = blocks, weights
        dry: dict[Fraction, list[int]] = {}
        for s, (n, a) in enumerate(zip(blocks, weights)):
            dry.setdefault(Fraction(n, a), []).append(s)
        self.times = sorted(dry)
        self.dry_phase = [0] * len(blocks)
        self.c, self.w = [0], [sum(weights)]
        for p, time in enumerate(self.times):
            for s in dry[time]:
                self.dry_phase[s] = p
            self.c.append(self.c[-1] + sum(blocks[s] for s in dry[time]))
            self.w.append(self.w[-1] - sum(weights[s] for s in dry[time]))
        self.rough = [float(t) for t in self.times]
        self.ends = [self.c[p] + self.w[p] * t for p, t in enumerate(self.times)]
        self.rough_ends = [float(t) for t in self.ends]
        self.total = self.c[-1]

    def phase(self, j: int, a: int) -> int:
        """Phase of the virtual time j / a; the rough guess is corrected exactly."""
        p = bisect_right(self.rough, j / a)
        while p < len(self.times) and self.times[p].numerator * a <= j * self.times[p].denominator:
            p += 1
        while p and self.times[p - 1].numerator * a > j * self.times[p - 1].denominator:
            p -= 1
        return p

    def release(self, s: int, j: int) -> int:
        """First slot of block j: that in which the source's share passes j."""
        p = self.phase(j, self.a[s])
        return self.c[p] + self.w[p] * j // self.a[s]

    def deadline(self, s: int, j: int) -> int:
        """Slot before which block j must have run: the share has then reached j + 1."""
        p = self.phase(j + 1, self.a[s])
        return self.c[p] - (-self.w[p] * (j + 1) // self.a[s])

    def at(self, slot: int) -> list[tuple[int, int]]:
        """Each source's share before a slot, rounded down and up."""
        p = bisect_right(self.rough_ends, slot)
        while p < len(self.ends) and self.ends[p] <= slot:
            p += 1
        while p and self.ends[p - 1] > slot:
            p -= 1
        w, left = self.w[p], slot - self.c[p]
        return [(n, n) if dry < p else (a * left // w, -(-a * left // w))
                for n, a, dry in zip(self.n, self.a, self.dry_phase)]


def state(shares: Shares, before: int, slot: int) -> list[int]:
    """Blocks that each source has had before ``slot``: its share rounded down or up, the sum being ``slot``.

    Among the blocks that may have run already and need not have, those of earliest deadline have, as far as there was
    time after their release: between any slot a and this one run at most slot - a blocks, and those that must run there
    come first. Of all states that can be reached, this leaves the fewest early deadlines, so all deadlines after it can
    be met. No block's time from release to deadline may be longer than from ``before`` to ``slot``.
    """
    if slot >= shares.total:
        return list(shares.n)
    bounds = shares.at(slot)
    out = [low for low, _ in bounds]
    free = slot - sum(out)
    if not free:
        return out
    size = slot - before
    first = [high for _, high in shares.at(before)]
    must = [shares.release(s, j) - before for s, (low, _) in enumerate(bounds) for j in range(first[s], low)]
    # Slots from each place on that nothing has to run in.
    room = np.arange(size, 0, -1) - np.cumsum(np.bincount(must, minlength=size)[::-1])[::-1]
    for _, s in sorted((shares.deadline(s, low), s) for s, (low, high) in enumerate(bounds) if low < high):
        if not free:
            break
        at = shares.release(s, out[s]) - before
        if at <= 0 or room[1:at + 1].min() > 0:
            room[1:max(at, 0) + 1] -= 1
            out[s] += 1
            free -= 1
    return out


def schedule_range(shares: Shares, number: int, size: int) -> Iterator[tuple[int, int, int]]:
    """(source, block, slot) of one range of slots: in each slot the released block of the earliest deadline, ties by
    place of the source. Windows are cut to the range, whose first and last states do not depend on other ranges."""
    begin, end = number * size, min((number + 1) * size, shares.total)
    first = state(shares, max(0, begin - size), begin) if begin else [0] * len(shares.n)
    last = state(shares, begin, end)
    jobs = sorted((max(begin, shares.release(s, j)), min(end, shares.deadline(s, j)), s, j)
                  for s, (a, b) in enumerate(zip(first, last)) for j in range(a, b))
    ready: list[tuple[int, int, int]] = []
    waiting = 0
    for slot in range(begin, end):
        while waiting < len(jobs) and (jobs[waiting][0] <= slot or not ready):
            _, deadline, s, j = jobs[waiting]
            heapq.heappush(ready, (deadline, s, j))
            waiting += 1
        _, s, j = heapq.heappop(ready)
        yield s, j, slot


def schedule(sizes: DataFrame, group: str, range_slots: int) -> DataFrame:
    """(group, member, block, turn): schedules of all groups of (group, member, blocks, weight), ranges apart.

    A group has TOGETHER members, about; its list goes to each of its ranges. A range is longer than any block's time from
    release to deadline, and has at least eight slots a member.
    """
    members = sizes.groupBy(group).agg(
        F.sort_array(F.collect_list(F.struct("member", "blocks", "weight"))).alias("members"), F.sum("blocks").alias("total"),
        F.expr("2 * (sum(weight) div min(weight)) + 4").alias("windows"))
    size = F.greatest(F.lit(range_slots), 8 * F.size("members"), F.col("windows")).cast("long")
    ranges = members.withColumn("size", size).select(
        group, "members", "size", F.explode(F.expr("sequence(0L, (total - 1) div size)")).alias("number"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, held, size, number in zip(batch[group], batch["members"], batch["size"], batch["number"]):
                shares = Shares([int(m["blocks"]) for m in held], [int(m["weight"]) for m in held])
                out = pd.DataFrame(schedule_range(shares, int(number), int(size)), columns=["s", "block", "turn"])
                yield pd.DataFrame({group: name, "member": np.array([m["member"] for m in held], object)[out["s"]],
                                    "block": out["block"], "turn": out["turn"]})

    kinds = dict(sizes.dtypes)
    # One range is the work of a second or so: they are spread by number.
    spread = ranges.repartition(sizes.sparkSession.sparkContext.defaultParallelism * 4, group, "number")
    return spread.mapInPandas(run, f"`{group}` {kinds[group]}, member {kinds['member']}, block long, turn long")


def slots(spark: SparkSession, sizes: DataFrame, together: int = TOGETHER, range_slots: int = RANGE,
          max_range: int = MAX_RANGE) -> DataFrame:
    """(mix_source, mix_block, mix_slot) of all blocks of (mix_source, blocks, weight); weights are doubles.

    Sources of no weight come after all others, evenly. There are two levels, groups scheduled by their members' weights
    and each group's turns among its members, where one would make a task too large: above ``together`` sources, which
    are dealt into groups, or where ranges would be longer than ``max_range`` for the sake of very small weights, whose
    sources are put together.
    """
    sizes = sizes.withColumn("late", F.col("weight") <= 0)
    sums = {r.late: r for r in sizes.groupBy("late").agg(
        F.sum("weight").alias("weight"), F.sum("blocks").alias("blocks"), F.count("*").alias("n")).collect()}
    n, early = sum(r.n for r in sums.values()), sums.get(False)
    total = early.weight if early else 1.0
    whole = F.greatest(F.lit(1), F.round(F.col("weight") / total * WHOLE).cast("long"))
    sizes = sizes.select("late", F.col("mix_source").alias("member"), "blocks",
                         F.when(F.col("late"), F.lit(1)).otherwise(whole).alias("weight"))
    small = F.col("late") | (F.col("weight") * (max_range // 4) < WHOLE)
    slow = sizes.filter(small & ~F.col("late")).agg(F.count("*"), F.coalesce(F.sum("weight"), F.lit(0))).first()
    if n <= together and (not slow[0] or sum(r.blocks for r in sums.values()) <= max_range):
        placed = schedule(sizes, "late", range_slots).withColumn("slot", F.col("turn"))
    else:
        if n > together:
            group = F.concat(F.lit("group "), F.pmod(F.xxhash64("member"), F.lit(-(-n // together))).cast("string"))
        else:
            # As many groups as get a share that is not small; if their share is too small for one, they join a source.
            groups = slow[1] * (max_range // 8) // WHOLE
            host = sizes.filter(~small).orderBy("weight", "member").select("member").first()
            name = F.concat(F.lit("source "), "member")
            together_ = F.lit(f"source {host.member}") if host and not groups else F.concat(
                F.lit("group "), F.pmod(F.xxhash64("member"), F.lit(max(1, groups))).cast("string"))
            group = F.when(small & ~F.col("late"), together_).otherwise(name)
        dealt = stage_table(spark, sizes.withColumn("group", F.concat(F.when(F.col("late"), "late ").otherwise(""), group)),
                            "source-groups")
        inner = schedule(dealt.select("group", "member", "blocks", "weight"), "group", range_slots).select(
            "group", "member", "block", "turn")
        outer = dealt.groupBy("late", F.col("group").alias("member")).agg(
            F.sum("blocks").alias("blocks"), F.sum("weight").alias("weight"))
        outer = schedule(outer, "late", range_slots).select(
            "late", F.col("member").alias("group"), F.col("block").alias("turn"), F.col("turn").alias("slot"))
        placed = inner.join(outer, ["group", "turn"])
    offset = F.when(F.col("late"), F.lit(early.blocks if early else 0)).otherwise(0)
    return placed.select(F.col("member").alias("mix_source"), F.col("block").alias("mix_block"),
                         (F.col("slot") + offset).cast("long").alias("mix_slot"))


def mix(df: DataFrame, weights: dict[str, float] | None = None, power: float = POWER, block: int = BLOCK,
        bucket_rows: int = BUCKET_ROWS, doc_id: str = "doc_id", source: str = "source", together: int = TOGETHER,
        range_slots: int = RANGE) -> DataFrame:
    """All rows of ``df`` with mix_source, mix_rank, mix_block, mix_slot and mix_position, the order to read them in.

    Each source's rows, in an order drawn from a digest of the row, form blocks of ``block``. Block j of a source may run
    from the slot on in which the source's share of all slots passes j, and must before it reaches j + 1; each slot goes
    to the released block of the earliest deadline. So after any number of slots a source has had less than one block
    more or less than its share. When a source has run dry, the others share in proportion to their weights, and the
    bound holds on. Nothing is dropped or repeated. A source without a given weight takes the mean of those given; one
    of weight 0 comes when the others are dry.

    Weights are kept to a part in 2 ** 44 of all, and times are compared as integers. Slots are scheduled in ranges that
    do not wait for each other. Above ``together`` sources there are two levels, each within one block, so a source stays
    within two. Sizes of sources are joined, not collected; rows are numbered in digest buckets of about
    ``bucket_rows``, so no source need fit in a task.

    A null source counts as the source ''. Rows equal in every column follow each other in any order; null ids and null,
    empty or very long texts are rows like others; an empty table gives an empty result. Columns whose names clash with
    the new ones are replaced.
    """
    spark = df.sparkSession
    new = ["mix_source", "mix_rank", "mix_block", "mix_slot", "mix_position"]
    df = df.drop(*new)
    name = F.coalesce(F.col(source).cast("string"), F.lit(""))
    counted = stage_table(spark, df.groupBy(name.alias("mix_source")).agg(F.count("*").alias("rows")), "source-sizes")
    total = counted.agg(F.sum("rows")).first()[0] or 0
    sizes = counted.select("mix_source", F.expr(f"(rows + {block - 1}) div {block}").alias("blocks"),
                           F.pow(F.col("rows").cast("double"), F.lit(power)).alias("weight"))
    if weights is not None:
        mean = sum(weights.values()) / max(1, len(weights))
        given = spark.createDataFrame(list(weights.items()) or [("", 1.0)], "mix_source string, given double")
        sizes = sizes.join(given, "mix_source", "left").select(
            "mix_source", "blocks", F.coalesce("given", F.lit(float(mean))).alias("weight"))
    # As many buckets as exchanges have partitions, so that one source's rows spread evenly.
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // bucket_rows))
    simple = [c for c, kind in df.dtypes if not kind.startswith(("map", "variant"))]
    rows = df.withColumn("mix_source", name).withColumn("_digest", F.xxhash64(*simple)).withColumn(
        "_bucket", F.pmod("_digest", F.lit(buckets)))
    offsets = rows.groupBy("mix_source", "_bucket").agg(F.count("*").alias("_size")).withColumn(
        "_before", F.sum("_size").over(
            Window.partitionBy("mix_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)))
    offsets = offsets.select("mix_source", "_bucket", F.coalesce("_before", F.lit(0)).alias("_before"))
    within = Window.partitionBy("mix_source", "_bucket").orderBy("_digest", doc_id)
    ranked = (
        rows.withColumn("_rank", F.row_number().over(within)).join(offsets, ["mix_source", "_bucket"])
        .withColumn("mix_rank", (F.col("_before") + F.col("_rank") - 1).cast("long"))
        .withColumn("mix_block", F.expr(f"mix_rank div {block}"))
    )
    placed = ranked.join(slots(spark, sizes, together, range_slots), ["mix_source", "mix_block"])
    return placed.withColumn("mix_position", F.expr(f"mix_slot * {block} + mix_rank % {block}")).select(*df.columns, *new)


def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Place of every document in the mixed order."""
    mixed = mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "source", *[c for c in mixed.columns if c.startswith("mix_")])
