"""Exact top-k search: tiled matrix products of queries and shards, partial selection per tile, tree merging of lists."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import stage_table, table

# Fixed values of the contract: neighbours per query, scale of a component, share of rows that are queries.
K = 20
SCALE = 64.0
QUERY_STEP = 20
# Bytes of one tile of candidates and of one block of queries, as doubles, and query rows of one product; a task holds one
# block and a few tiles, whatever the data's size.
TILE_BYTES = 2 << 20
BLOCK_BYTES = 16 << 20
CHUNK = 256
# Products of components that are worth a task of their own; and the most of a task, where the session's partitions would
# leave more. Bytes of tiles that one task reads at most, about.
WORTH = 2.0 ** 33
MOST = 2.0 ** 38
READ_BYTES = 32 << 20
# Bytes of one entry of a list that is exchanged, about.
ENTRY = 24
# Lists of one query that one merge takes.
FAN_IN = 64
# Doubles, and floats, add integers exactly below these.
EXACT = 2.0 ** 53
EXACT_FLOAT = 2.0 ** 24
LONG = 2 ** 63
TILE = "tile long, ids binary, keys binary, dims int, form string, data binary"
LISTS = "query_key long, query_id long, vec_id long, score long, tile long"


def usable(vector: str, key: str) -> Column:
    """Whether a row takes part: it has an id and a vector without null or non-finite components."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(key).isNotNull() & F.col(vector).isNotNull() & ~odd


def _matrix(ids: np.ndarray, keys: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> dict:
    """One tile: its rows by id, shorter vectors padded with zeros, in the shortest numbers that hold every component."""
    dims = int(sizes.max(initial=0))
    data = np.zeros((len(ids), dims))
    data[np.arange(dims) < sizes[:, None]] = codes
    order = np.lexsort((keys, ids))
    low, high = codes.min(initial=0), codes.max(initial=0)
    form = next((f for f in ("i1", "<i2", "<i4") if np.iinfo(f).min <= low and high <= np.iinfo(f).max), "<f8")
    return {"ids": ids[order].astype("<i8").tobytes(), "keys": keys[order].astype("<i8").tobytes(), "dims": dims,
            "form": form, "data": data[order].astype(form).tobytes()}


def _tiles(limit: int, step: int):
    """Pack rows (part, row_key, vec_id, vector) into tiles that take bounded bytes as doubles. Tile j of a partition has
    the number part + j * step."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        rows = dims = made = part = 0

        def tile() -> pa.RecordBatch:
            made_of = _matrix(*(np.concatenate(x) for x in zip(*held)))
            return pa.RecordBatch.from_pylist([{"tile": part + made * step, **made_of}], schema=pa.schema(
                [("tile", pa.int64()), ("ids", pa.binary()), ("keys", pa.binary()), ("dims", pa.int32()),
                 ("form", pa.string()), ("data", pa.binary())]))

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "row_key"))
            vectors = batch.column("vector")
            sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype("i8")
            codes = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype("f8") * SCALE)
            ends = np.append(0, np.cumsum(sizes))
            begin = 0
            for i, size in enumerate(sizes.tolist()):
                if rows and (rows + 1) * (8 * max(dims, size) + 32) > limit:
                    held.append((ids[begin:i], keys[begin:i], sizes[begin:i], codes[ends[begin]:ends[i]]))
                    yield tile()
                    held, rows, dims, made, begin = [], 0, 0, made + 1, i
                rows, dims = rows + 1, max(dims, size)
            held.append((ids[begin:], keys[begin:], sizes[begin:], codes[ends[begin]:]))
        if rows:
            yield tile()
    return run


def _upto(n: int) -> Column:
    """The numbers 0 to n - 1 as longs."""
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def keyed(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """The usable rows (row_key, vec_id, vector), each under a number of its own."""
    return df.filter(usable(vector, vec_id)).select(
        F.monotonically_increasing_id().alias("row_key"), F.col(vec_id).cast("long").alias("vec_id"),
        F.col(vector).alias("vector"))


def tiles(rows: DataFrame, limit: int, parts: int | None = None) -> DataFrame:
    """Tiles of keyed rows; a tile's number comes from its partition and its place there: (partition, place) in 32 bits
    each, or with ``parts``, as many partitions as there are, the smallest numbers."""
    dealt = rows.repartition(parts) if parts else rows
    part = F.spark_partition_id().cast("long")
    return dealt.select((part if parts else F.shiftleft(part, 32)).alias("part"), "*").mapInArrow(
        _tiles(limit, parts or 1), TILE)


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer products: in floats or doubles where they stay exact, else in whole Python numbers held to the long
    range."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if bound < EXACT:
        kind = "f4" if bound < EXACT_FLOAT else "f8"
        return q.astype(kind) @ c.astype(kind).T
    whole = np.array([[int(x) for x in row] for row in q], dtype=object).reshape(q.shape) @ np.array(
        [[int(x) for x in row] for row in c], dtype=object).reshape(c.shape).T
    return np.clip(whole, -LONG, LONG - 1).astype("i8")


def _best(row: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest values, ties to the smaller place."""
    if len(row) <= k:
        return np.arange(len(row))
    floor = np.partition(row, len(row) - k)[len(row) - k]
    above = np.flatnonzero(row > floor)
    return np.concatenate([above, np.flatnonzero(row == floor)[:k - len(above)]])


def _read(tile) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, keys and components of a tile."""
    ids, keys = (np.frombuffer(x, "<i8") for x in (tile.ids, tile.keys))
    data = np.frombuffer(tile.data, tile.form).reshape(len(ids), tile.dims)
    return ids, keys, data.astype("f8" if tile.form == "<f8" else "f4" if tile.form in ("i1", "<i2") else "f8")


class _Lists:
    """The k best candidates so far of each query of a block."""

    def __init__(self, tile, k: int) -> None:
        self.ids, self.keys, self.data = _read(tile)
        self.place, self.k = tile.place, k
        self.count = np.zeros(len(self.ids), "i8")
        self.score = np.full((len(self.ids), k), -LONG, "i8")
        self.found = np.zeros((len(self.ids), k), "i8")

    def compare(self, tile) -> None:
        ids, _, c = _read(tile)
        q, wide = self.data, max(self.data.shape[1], c.shape[1])
        q, c = (m if m.shape[1] == wide else np.pad(m, ((0, 0), (0, wide - m.shape[1]))) for m in (q, c))
        for at in range(0, len(q), CHUNK):
            self._take(at, _scores(q[at:at + CHUNK], c), ids)

    def _take(self, at: int, scores: np.ndarray, ids: np.ndarray) -> None:
        """Merge the scores of some queries, from number ``at`` on, with all candidates of a tile."""
        k, own = self.k, self.ids[at:at + len(scores)]
        # The last entry of a full list has to be reached; a tie may have the smaller id.
        hit = scores >= self.score[at:at + len(scores), -1:].astype(scores.dtype)
        low, high = np.searchsorted(ids, own, "left"), np.searchsorted(ids, own, "right")
        for i in np.flatnonzero(high > low):
            hit[i, low[i]:high[i]] = False
        crowded = np.flatnonzero(np.count_nonzero(hit, axis=1) > 2 * k)
        if len(crowded):
            held = np.where(hit[crowded], scores[crowded], scores.dtype.type(-LONG))
            floor = np.partition(held, held.shape[1] - k, axis=1)[:, held.shape[1] - k]
            hit[crowded] &= held >= floor[:, None]
            for i in crowded[np.count_nonzero(hit[crowded], axis=1) > 2 * k]:  # many ties
                places = np.flatnonzero(hit[i])
                hit[i] = False
                hit[i, places[_best(scores[i, places], k)]] = True
        flat = np.flatnonzero(hit)  # much faster than by row and column
        if not len(flat):
            return
        row, place = flat // len(ids), flat % len(ids)
        touched = np.unique(row)
        old, slot = np.nonzero(np.arange(k) < self.count[at + touched][:, None])
        old = touched[old]
        row = np.concatenate([old, row])
        score = np.concatenate([self.score[at + old, slot], scores[row[len(old):], place].astype("i8")])
        vec = np.concatenate([self.found[at + old, slot], ids[place]])
        order = np.lexsort((vec, ~score, row))
        row, score, vec = row[order], score[order], vec[order]
        n = np.bincount(row, minlength=len(scores))
        rank = np.arange(len(row)) - (np.cumsum(n) - n)[row]
        keep = rank < k
        row, rank = at + row[keep], rank[keep]
        self.score[row, rank], self.found[row, rank] = score[keep], vec[keep]
        self.count[at:at + len(scores)] = np.maximum(self.count[at:at + len(scores)], np.minimum(n, k))

    def rows(self) -> Iterator[pd.DataFrame]:
        for at in range(0, len(self.ids), 64 * CHUNK):
            row, slot = np.nonzero(np.arange(self.k) < self.count[at:at + 64 * CHUNK, None])
            row += at
            yield pd.DataFrame({"query_key": self.keys[row], "query_id": self.ids[row], "vec_id": self.found[row, slot],
                                "score": self.score[row, slot], "tile": self.place})


def _products(k: int):
    """Lists of query blocks (asks) with the tiles that follow them under the same place."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = None
        for batch in batches:
            for b in batch.itertuples(index=False):
                if b.asks:
                    if block is not None:
                        yield from block.rows()
                    block = _Lists(b, k)
                elif block is not None and block.place == b.place:
                    block.compare(b)
        if block is not None:
            yield from block.rows()
    return run


def _layout(queries: int, components: int, shards: int, candidates: int, size: int, wide: int, k: int) -> tuple[int, int]:
    """Blocks of queries, and salts over which the shards are dealt for each block.

    A shard is sent once a block, a block and the lists of its queries once a salt; of the splits into as many tasks the
    one with the fewest bytes is taken, within the bytes that a task holds.
    """
    work = float(components) * candidates
    tasks = max(1, min(math.ceil(work / WORTH), 4 * wide), math.ceil(work / MOST))
    per_query = size / candidates + ENTRY * k
    blocks = round(math.sqrt(tasks * queries * per_query / max(1, size)))
    blocks = min(queries, max(1, blocks, math.ceil((8 * components + 32 * queries) / BLOCK_BYTES)))
    salts = max(1, math.ceil(tasks / blocks), math.ceil(size / READ_BYTES))
    return blocks, min(shards, salts)


def top_k(df: DataFrame, is_query: Column, k: int = K, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k highest integer inner products of each query row with all other rows: query_id, rank, vec_id, score.

    Each component x counts as floor(64 * x), kept in the shortest numbers that hold a tile. Blocks of queries and tiles
    of candidates meet on (block, salt): one exchange, in which the block comes first and the tiles stream past it. There
    is no join, so nothing is ever broadcast, however small a file looks; no step sends rows through the driver, which
    gets counts alone. A task holds one block, its k best per query and a few tiles, whatever the data's size. Lists of
    the salts are then merged in a tree, at most ``FAN_IN`` at a time, so no task gathers all lists of a query.

    Rows without id or vector, or with a null or non-finite component, take no part. Vectors of other lengths count as
    padded with zeros. Rows of the query's own id are no candidates. Equal rows are candidates each, and each query row
    gets a list of its own. Ties go to the smaller id. Sums outside the range of long are held at its ends. An empty
    table gives an empty result; other columns are ignored.
    """
    spark = df.sparkSession
    base = df.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"), is_query.alias("asks"))
    asking = keyed(base.filter("asks"), "vec_id", "vector")
    asked = asking.agg(F.count("*").alias("n"), F.sum(F.size("vector").cast("long")).alias("components")).first()
    if not asked.n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    shards = stage_table(spark, tiles(keyed(base, "vec_id", "vector"), TILE_BYTES), "shards")
    made = shards.agg(F.count("*").alias("n"), F.sum(F.length("ids") / 8).cast("long").alias("rows"),
                      F.sum(F.length("data") + F.length("ids")).alias("size")).first()
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts, salts = _layout(asked.n, asked.components, made.n, made.rows, made.size, wide, k)
    # Blocks of a partition that are uneven may be a little over the bytes that were reckoned with.
    queries = stage_table(spark, tiles(asking, 2 * BLOCK_BYTES, parts), "query-tiles")
    blocks = queries.agg(F.max("tile")).first()[0] + 1
    sides = [
        side.select(F.explode(spread).alias("place"), "*").select(
            (F.col("place") * over + own).cast("int").alias("place"), F.lit(asks).alias("asks"), "ids", "keys", "dims",
            "form", "data")
        for side, spread, over, own, asks in (
            (queries, _upto(salts), 1, F.col("tile") * salts, True),
            (shards.withColumn("keys", F.lit(b"")), _upto(blocks), salts, F.pmod(F.xxhash64("tile"), F.lit(salts)), False))]
    met = sides[0].unionByName(sides[1]).repartitionById(blocks * salts, F.col("place"))
    lists = met.sortWithinPartitions("place", F.col("asks").desc()).mapInPandas(_products(k), LISTS)
    order = [F.col("score").desc(), F.col("vec_id")]
    groups = salts
    while groups > FAN_IN:
        groups = -(-groups // FAN_IN)
        merge = Window.partitionBy("query_key", "tile").orderBy(*order)
        lists = (
            lists.withColumn("tile", F.pmod(F.xxhash64("tile", F.lit(groups)), F.lit(groups)))
            .withColumn("rank", F.row_number().over(merge)).filter(F.col("rank") <= k).drop("rank")
        )
    last = Window.partitionBy("query_key").orderBy(*order)
    return (
        lists.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Neighbours of every embedding whose id is divisible by 20, against all rows."""
    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % QUERY_STEP == 0)


OP1_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as e
           from embeddings
           where vec_id is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id,
             cast(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) as bigint) as score
      from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id)
select query_id, cast(rank as int) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
where rank <= 20
"""
