"""SimHash near-duplicates: a byte-position inverted index with count filtering, then verification and components."""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm import line_dedup
from riskloom.llm.common import components, stage_table, table

# Fixed values of the contract: words of a shingle, hash seed, differing bits of a link.
SHINGLE = 3
SEED = 42
MAX_BITS = 2
BYTES = 8
# Two flipped bits touch two bytes at most, so linked fingerprints share this many positional bytes.
MIN_SHARED = BYTES - MAX_BITS
# Fingerprints of one posting that are paired; a longer posting is searched by neighbourhoods instead.
POSTING = 128
CHUNK = 1 << 16
# Near copies, outside the contract: words of a shingle, similarity of the shingle sets, and differing bits of a pair
# that is compared. At similarity 0.8 fingerprints differ in about 10 of 64 bits, with a deviation of 3.
COPY_SHINGLE = 5
COPY_SIMILARITY = 0.8
COPY_BITS = 22
# Least hashes kept of a text; each two neighbours among them make a band key.
MINIMA = 8


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Signed 64-bit SimHash of the whole text; 0 for a text without words."""
    n, ones = 0, np.zeros(64, "i8")
    for hashes in gram_hashes(text, shingle, seed):
        n += len(hashes)
        ones += bit_counts(hashes)
    return majority(ones, n)


def gram_hashes(text: str | None, shingle: int, seed: int) -> Iterator[np.ndarray]:
    """Hashes of the shingles in the order of the text, in pieces of bounded size; none for a text without words."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: A-Z alone are lowered, and words end at ASCII white space
    if not words:
        return
    if len(words) < shingle:
        words, shingle = [b" ".join(words)], 1
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    n, digest = len(words) - shingle + 1, xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        size = min(CHUNK, n - at)
        yield np.fromiter((digest(g, seed) for g, _ in zip(grams, range(size))), "<u8", size)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="i8")


def majority(ones: np.ndarray, n: int) -> int:
    """The signed number whose bits are set in more than half of n hashes."""
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(text: str) -> Column:
    """The fingerprint column of a text column, over Arrow batches."""
    def run(batch: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(x) for x in batch], dtype="int64")

    return F.pandas_udf(run, "long")(text)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def index_masks() -> list[tuple[int, list[int]]]:
    """Bit masks of the index's tuples of positional bytes, and the bits each leaves free.

    The eight positions are taken in four pairs. Two bytes that differ spoil two pairs at most, so linked fingerprints
    agree on two whole pairs: one of six tuples of four positional bytes.
    """
    out = []
    for pairs in combinations(range(BYTES // 2), BYTES // 2 - MAX_BITS):
        mask = sum(0xFFFF << (16 * p) for p in pairs)
        out.append((_signed(mask), [b for b in range(64) if not mask >> b & 1]))
    return out


def shared_bytes(a: Column, b: Column) -> Column:
    """Tally of the byte positions at which two fingerprints agree."""
    differ = a.bitwiseXOR(b)
    return sum(((F.shiftrightunsigned(differ, 8 * i).bitwiseAND(F.lit(0xFF))) == 0).cast("int") for i in range(BYTES))


def links(spark: SparkSession, prints: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that connect all within ``MAX_BITS`` bits, directly or by a path.

    Postings of single positional bytes would each hold a 256th of everything; the index files a fingerprint under six
    tuples of four positional bytes instead, one of which any linked pair shares. Pairs of a posting are tallied over
    all eight positions, those with fewer than ``MIN_SHARED`` dropped, the rest verified bit by bit.

    A posting longer than ``POSTING`` (a large group of near copies) is not paired: each of its fingerprints names
    itself and the values one flipped free bit away. Two fingerprints are within two bits exactly if they name a common
    value, and all that name one are linked to the smallest of them: 33 rows each, however long the posting, no link lost.
    """
    masks = index_masks()
    entry = F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, (m, _) in enumerate(masks)]))
    postings = prints.select("fp", entry.alias("e")).select("fp", "e.t", "e.key")
    postings = postings.withColumn("n", F.count("*").over(Window.partitionBy("t", "key"))).filter(F.col("n") > 1)
    postings = stage_table(spark, postings, "postings")
    light = postings.filter(F.col("n") <= POSTING)
    pairs = light.select("t", "key", F.col("fp").alias("a")).join(
        light.select("t", "key", F.col("fp").alias("b")), ["t", "key"]).filter(F.col("a") < F.col("b")).select("a", "b")
    free = F.element_at(F.array(*[F.array(*[F.lit(0).cast("long"), *[F.lit(_signed(1 << b)) for b in bits]])
                                  for _, bits in masks]), F.col("t") + 1)
    named = postings.filter(F.col("n") > POSTING).select("t", "fp", F.explode(free).alias("bit")).select(
        "t", "fp", F.col("fp").bitwiseXOR(F.col("bit")).alias("value"))
    named = stage_table(spark, named, "neighbours")
    least = named.groupBy("t", "value").agg(F.min("fp").alias("a"), F.count("*").alias("n")).filter(F.col("n") > 1)
    stars = named.join(least, ["t", "value"]).filter(F.col("fp") != F.col("a")).select("a", F.col("fp").alias("b"))
    found = pairs.unionByName(stars)
    return (
        found.filter(shared_bytes(F.col("a"), F.col("b")) >= MIN_SHARED)
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS).distinct()
    )


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, fp (signed), component_id, the smallest doc_id reachable over linked texts.

    Whole texts are hashed in one pass and only (doc_id, fingerprint) goes on. Equal fingerprints are one node from the
    start, so a group of exact copies costs one aggregation that combines before the exchange.

    Null and empty texts have fingerprint 0 and are linked like any other. A null doc_id takes no part in the minimum
    and gets its group's id (null if nothing else is in it). Repeated rows appear each. An empty table gives an empty
    result. Other columns are ignored.
    """
    spark = df.sparkSession
    rows = stage_table(spark, df.select(F.col(doc_id).alias("doc_id"), fingerprints(text).alias("fp")), "prints")
    prints = stage_table(spark, rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-prints")
    found = components(spark, links(spark, prints), "a", "b")
    member = prints.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component"))
    least = member.groupBy("component").agg(F.min("first").alias("component_id"))
    named = member.join(least, "component").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def ascending(hashes: np.ndarray) -> np.ndarray:
    """Distinct values in order."""
    out = np.sort(hashes)
    return out[np.append(True, out[1:] != out[:-1])] if len(out) else out


def gram_set(text: str | None, shingle: int = COPY_SHINGLE, seed: int = SEED) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    pieces = [ascending(x) for x in gram_hashes(text, shingle, seed)]
    return ascending(np.concatenate(pieces)).view("<i8") if pieces else np.zeros(0, "i8")


def sketches(text: str, shingle: int) -> Column:
    """fp, h1 and h2 (a 128-bit name of the text's words), n (distinct shingles) and the least of their hashes."""
    def run(batch: pd.Series) -> pd.DataFrame:
        import xxhash

        out = []
        for x in batch:
            pieces, ones, total = [], np.zeros(64, "i8"), 0
            for hashes in gram_hashes(x, shingle, SEED):
                ones += bit_counts(hashes)
                total += len(hashes)
                pieces.append(ascending(hashes))
            grams = ascending(np.concatenate(pieces)) if pieces else np.zeros(0, "<u8")
            name = xxhash.xxh3_128_digest(b" ".join((x or "").encode().lower().split()))
            out.append((majority(ones, total), *np.frombuffer(name, "<i8").tolist(), len(grams),
                        grams[:MINIMA].view("<i8").tolist()))
        return pd.DataFrame(out, columns=["fp", "h1", "h2", "n", "least"])

    return F.pandas_udf(run, "fp long, h1 long, h2 long, n int, least array<long>")(text)


def indexed_pairs(spark: SparkSession, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes (node, fp) by the byte-position index: those of linked fingerprints, each fingerprint standing
    for its first node, and that node with every other of the same fingerprint."""
    prints = stage_table(spark, nodes.groupBy("fp").agg(F.min("node").alias("first"), F.count("*").alias("n")), "copy-prints")
    first = prints.select("fp", "first")
    linked = links(spark, first.select("fp")).join(first.select(F.col("fp").alias("a"), F.col("first").alias("na")), "a").join(
        first.select(F.col("fp").alias("b"), F.col("first").alias("nb")), "b")
    linked = linked.select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b"))
    same = nodes.select("fp", "node").join(prints.filter(F.col("n") > 1).select("fp", "first"), "fp").filter(
        F.col("node") != F.col("first")).select(F.col("first").alias("a"), F.col("node").alias("b"))
    return linked.unionByName(same)


def near_copies(df: DataFrame, key: str, text: str = "text", shingle: int = COPY_SHINGLE,
                similarity: float = COPY_SIMILARITY, bits: int = COPY_BITS) -> DataFrame:
    """One row per row of ``df``: the key and ``node`` of its words, and ``component``, the least node it is linked to.

    Texts are linked if the sets of their shingles have the similarity, counted exactly. Candidates within ``MAX_BITS`` come
    from the byte-position index of the fingerprints. Texts of the similarity may be further apart, where fingerprints share
    too few bytes for an index of them to be selective: those pairs come from minima of the same hashes, as in line dedup,
    and are dropped before the sets are compared if over ``bits`` apart. Equal words, whatever
    their case and white space, are one node from the start; so are all texts without words. Repeated rows appear each.
    """
    spark = df.sparkSession
    rows = stage_table(spark, df.select(F.col(key), sketches(text, shingle).alias("k")).select(key, "k.*"), "sketches")
    name = F.struct("h1", "h2")
    pairs = [F.when(F.get("least", F.lit(i)).isNotNull(), F.xxhash64(F.get("least", F.lit(i - 1)), F.get("least", F.lit(i))))
             for i in range(1, MINIMA)]
    only = F.when(F.size("least") == 1, F.xxhash64(F.lit(0), F.get("least", F.lit(0))))
    distinct = rows.filter(F.col("n") > 0).groupBy(name.alias("name")).agg(
        F.min("fp").alias("fp"), F.min("n").alias("n"), F.min("least").alias("least"))
    distinct = stage_table(spark, distinct.select(
        F.monotonically_increasing_id().alias("node"), "name", "fp", "n",
        F.array_distinct(F.array_compact(F.array(only, *pairs))).alias("keys")), "distinct-sketches")
    names = distinct.select("node", "name")

    @F.pandas_udf("array<long>")
    def grams(batch: pd.Series) -> pd.Series:
        return pd.Series([gram_set(x, shingle) for x in batch])

    def bodies(nodes: DataFrame) -> DataFrame:
        """Shingle sets of the candidates, from one text each."""
        one = rows.select(key, name.alias("name"), "n").join(names.join(nodes, "node"), "name").groupBy("node").agg(
            F.min(key).alias(key), F.min("n").alias("n"))
        return df.select(key, F.col(text).alias("_text")).join(one, key).select("node", "n", grams("_text").alias("body"))

    def check(pairs: DataFrame, bodies: DataFrame, shingles: line_dedup.Shingles, similarity: float) -> DataFrame:
        prints = distinct.select("node", "fp")
        near = pairs.join(prints.select(F.col("node").alias("a"), F.col("fp").alias("fa")), "a").join(
            prints.select(F.col("node").alias("b"), F.col("fp").alias("fb")), "b")
        near = near.filter(F.bit_count(F.col("fa").bitwiseXOR(F.col("fb"))) <= bits).select("a", "b")
        return line_dedup.verified(near, bodies, shingles, similarity)

    indexed = stage_table(spark, indexed_pairs(spark, distinct.select("node", "fp")), "indexed-pairs")
    found = line_dedup.alike(
        spark, distinct.select("node", "n", "keys"), bodies, lambda body: body, similarity, check, indexed=indexed)
    roots = names.select(F.col("node").alias("component"), F.col("name").alias("root"))
    found = found.join(names, "node").join(roots, "component").select("name", "root")
    return rows.select(key, name.alias("name")).join(found, "name", "left").select(
        key, F.col("name").alias("node"), F.coalesce("root", "name").alias("component"))


def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
