"""Spelling variants: a frequency-pruned dictionary of variable-length grams, affected-gram bounds, list merging, verify."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import UPPER, drop_stage, stage_table, table

# Fixed values of the contract.
RUN = r"[A-Za-zÀ-ÿ]+"
TYPO_EVERY = 199
MIN_POINTS = 6
MIN_COUNT = 5
RATIO = 5
# A gram in more words than this is pruned: it grows to the next of LENGTHS. So no list of words is longer, but for
# grams that end with their word.
LIST = 64
LENGTHS = [2, 3, 4, 5, 6, 8, 12, 16, 24, 32, 48, 64, 80]
# Code points of a word from which near words are found by their halves instead; LENGTHS reach that far.
LONG = 64
# Marks of a word's ends; neither is in RUN.
START, END = "^", "$"


def word_counts(df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_points: int = MIN_POINTS) -> DataFrame:
    """(word, n): runs of letters of the whole texts, A-Z lower-cased, one in TYPO_EVERY without one of its letters."""
    runs = df.select(
        F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":")).alias("name"),
        F.explode(F.regexp_extract_all(F.col(text), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.select("name", F.translate("run", UPPER, UPPER.lower()).alias("run"))
    h = F.crc32(F.concat("name", "run"))
    at = F.expr("cast(h % length(run) as int)")
    dropped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.withColumn("h", h).select(
        F.when(F.col("h") % TYPO_EVERY == 0, dropped).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= min_points).groupBy("word").agg(F.count("*").alias("n"))


def decompose(spark: SparkSession, words: DataFrame, limit: int) -> DataFrame:
    """(word, grams): for each position of ``^word$`` its variable-length gram, as an array of (at, size, gram, light).

    The dictionary grows by length: grams of at most ``limit`` occurrences stay, the others are pruned and grow, at each
    of their positions, to the next length. A gram that reaches the end of its word cannot grow; it stays, not light if
    it is frequent. A gram depends on its own characters alone: nothing outside can change it.
    """
    whole = F.concat(F.lit(START), F.col("word"), F.lit(END))
    open_ = words.select("word", F.explode(F.sequence(F.lit(1), F.length("word") + 1)).alias("at"))
    parts, staged = [], None
    for q in LENGTHS:
        grams = open_.withColumn("gram", F.substring(whole, F.col("at"), F.lit(q)))
        # Only the grams that are pruned are joined back; they are few beside their occurrences.
        heavy = grams.groupBy("gram").agg(F.count("*").alias("k")).filter(F.col("k") > limit).select(
            "gram", F.lit(True).alias("heavy"))
        # Two or three of the 90 letters and two marks: 780,000 grams at most.
        heavy = F.broadcast(heavy) if q <= 3 else heavy
        last, staged = staged, stage_table(spark, grams.join(heavy, "gram", "left"), "grams")
        if last is not None:
            drop_stage(spark, last)
        ends = F.col("at") + q > F.length("word") + 2
        light = F.col("heavy").isNull()
        parts.append(stage_table(spark, staged.filter(light | ends).select(
            "word", "at", F.length("gram").alias("size"), "gram", light.alias("light")), "light-grams"))
        open_ = staged.filter(~light & ~ends).select("word", "at")
        if open_.isEmpty():
            break
    drop_stage(spark, staged)
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    split = stage_table(spark, every.groupBy("word").agg(
        F.sort_array(F.collect_list(F.struct("at", "size", "gram", "light"))).alias("grams")), "decomposed")
    for part in parts:
        drop_stage(spark, part)
    return split


def disjoint(grams: Column) -> Column:
    """As many of the grams as fit without sharing a position: always the one that ends first."""
    kind = "array<struct<end:int,at:int,size:int,gram:string,light:boolean>>"
    ordered = F.array_sort(F.transform(grams, lambda g: F.struct(
        (g["at"] + g["size"]).alias("end"), g["at"], g["size"], g["gram"], g["light"])))
    return F.aggregate(ordered, F.array().cast(kind), lambda kept, g: F.when(
        (F.size(kept) == 0) | (F.try_element_at(kept, F.lit(-1))["end"] <= g["at"]), F.concat(kept, F.array(g))).otherwise(kept))


def merged_lists(split: DataFrame) -> DataFrame:
    """Candidates (a, b): each word's probes looked up in the lists of all light grams, and the lists merged by counting."""
    size = F.length("word").alias("size")
    lists = split.select("word", size, F.explode(F.filter("grams", lambda g: g["light"])).alias("g")).select(
        "g.gram", F.col("word").alias("b"), F.col("size").alias("size_b"), F.col("g.at").alias("at_b"))
    asked = split.select("word", size, "least", F.explode("probes").alias("g")).select(
        "g.gram", F.col("word").alias("a"), F.col("size").alias("size_a"), F.col("g.at").alias("at_a"), "least")
    # Before the edit a gram keeps its place from the start, after it its place from the end.
    shift = F.col("at_a") - F.col("at_b")
    placed = (shift == 0) | (shift == F.col("size_a") - F.col("size_b"))
    met = asked.join(lists, "gram").filter(
        (F.col("a") != F.col("b")) & (F.abs(F.col("size_a") - F.col("size_b")) <= 1) & placed)
    shared = met.groupBy("a", "b").agg(F.count_distinct("at_a").alias("shared"), F.first("least").alias("least"))
    return shared.filter(F.col("shared") >= F.col("least")).select("a", "b")


def rest_pairs(weak: DataFrame) -> DataFrame:
    """Candidates among words whose light grams all cross at some letters (``low`` to ``high`` of the marked word): an edit
    there leaves the same rest before and after it. A replaced letter is left out on both sides, an inserted one on one."""
    length = F.length("word")
    at = F.explode(F.sequence("low", "high")).alias("at")
    hole = weak.select("word", "low", at, length.alias("length")).filter((F.col("at") >= 2) & (F.col("at") <= F.col("length") + 2))
    head = F.expr("substring(word, 1, at - 2)")
    bar = F.lit("|")
    dropped = hole.filter(F.col("at") <= F.col("length") + 1).select(
        "word", F.concat(head, bar, F.expr("substring(word, at, length)")).alias("rest"))
    held = hole.filter(F.col("at") > F.col("low")).select(
        "word", F.concat(head, bar, F.expr("substring(word, at - 1, length)")).alias("rest"))
    a, b = dropped.withColumnRenamed("word", "a"), dropped.withColumnRenamed("word", "b")
    # No more words than there are letters have one rest.
    replaced = a.join(b, "rest").filter(F.col("a") < F.col("b")).select("a", "b")
    return replaced.unionByName(a.join(held.withColumnRenamed("word", "b"), "rest").select("a", "b"))


def half_pairs(long: DataFrame) -> DataFrame:
    """Candidates among long words: near words have the first or the last half of the shorter one in common."""
    length = F.length("word")
    half = F.explode(F.array(length - 1, length)).alias("m")
    sides = long.select("word", half).select("word", "m", F.expr("cast(m div 2 as int)").alias("h")).select(
        "word", F.explode(F.array(
            F.xxhash64("m", F.lit("first"), F.substring("word", F.lit(1), F.col("h"))),
            F.xxhash64("m", F.lit("last"), F.expr("right(word, h)")))).alias("key"))
    a, b = sides.withColumnRenamed("word", "a"), sides.withColumnRenamed("word", "b")
    return a.join(b, "key").filter(F.col("a") < F.col("b")).select("a", "b")


def near_words(spark: SparkSession, words: DataFrame, limit: int = LIST) -> DataFrame:
    """(a, b), a < b: all pairs of distinct words that differ by one inserted, deleted or replaced code point.

    Every word files its light grams, by place. It looks up those that share no position; one edit affects one of them at
    most, so a near word shares at least their number less one: lists are merged by counting against that bound. A list
    has at most ``limit`` entries, so candidates grow in proportion to the words.

    A word with fewer than two such grams looks up all its light grams, with the bound one; an edit that affects them all
    is at a letter where they all cross, and there the rests of the words are compared. Words of over LONG code points
    (and of LONG) meet by their halves. Every candidate is verified. No list is cut.
    """
    short = words.filter(F.length("word") <= LONG)
    split = decompose(spark, short, limit)
    light = F.filter("grams", lambda g: g["light"])
    split = split.withColumn("apart", disjoint(light))
    weak = F.size("apart") < 2
    kind = "array<struct<at:int,size:int,gram:string,light:boolean>>"
    split = split.select(
        "word", "grams", F.when(weak, light).otherwise(
            F.transform("apart", lambda g: F.struct(g["at"], g["size"], g["gram"], g["light"]))).cast(kind).alias("probes"),
        F.when(weak, 1).otherwise(F.size("apart") - 1).alias("least"),
        F.when(weak, F.coalesce(F.array_max(F.transform(light, lambda g: g["at"])), F.lit(1))).alias("low"),
        F.when(weak, F.coalesce(F.array_min(F.transform(light, lambda g: g["at"] + g["size"] - 1)), F.length("word") + 2)).alias("high"))
    split = stage_table(spark, split, "probes")
    rests = rest_pairs(split.filter(F.col("low").isNotNull()).select("word", "low", "high"))
    halves = half_pairs(words.filter(F.length("word") >= LONG))
    found = merged_lists(split).unionByName(rests).unionByName(halves)
    near = found.filter(F.levenshtein("a", "b", 1) == 1)
    return near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """(word, root): the last word that forms lead to. A form is some times as frequent as its word, so no chain runs in a
    circle; each round follows twice as many steps as the one before."""
    paths = stage_table(spark, forms.select("word", F.col("form").alias("root")), "paths")
    while True:
        onward = paths.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stage_table(spark, paths.join(onward, "root", "left").select("word", "root", "next"), "steps")
        if step.filter(F.col("next").isNotNull()).isEmpty():
            return paths
        paths = step.select("word", F.coalesce("next", "root").alias("root"))


def group_variants(df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_points: int = MIN_POINTS,
                   min_count: int = MIN_COUNT, ratio: int = RATIO, limit: int = LIST) -> DataFrame:
    """One row per word of the corpus: word, n, n_near, form, form_n and root.

    A word's form is the most frequent of its near words (one edit away; ties: the smallest), if it is at least ``ratio``
    times as frequent as the word; its root is where forms lead to in the end, itself without a form.

    Null and empty texts have no words, repeated rows count again, a null id counts as an empty one. Very long texts are
    read whole, and very long words are compared, too. An empty table gives an empty result. Other columns are ignored.
    """
    spark = df.sparkSession
    counted = word_counts(df, doc_id, text, min_points)
    words = stage_table(spark, counted.filter(F.col("n") >= min_count), "words")
    pairs = stage_table(spark, near_words(spark, words.select("word"), limit), "near-words")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = words.select(F.col("word").alias("b"), F.col("n").alias("n_b"))
    best = both.join(counts, "b").groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("less"), "b")).alias("best"))
    good = -F.col("best.less") >= ratio * F.col("n")
    named = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(good, F.col("best.b")).alias("form"),
        F.when(good, -F.col("best.less")).alias("form_n"))
    named = stage_table(spark, named, "forms")
    return named.join(roots(spark, named.filter(F.col("form").isNotNull())), "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents with their usual spelling."""
    return group_variants(table(spark, folder, "documents"))
