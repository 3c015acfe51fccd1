"""Embedding near-dedup: an inverted multi-index on vector halves, traversed to a target recall, then verified."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import components, stage_table, table

# Cosine from which two vectors are linked.
COSINE = 0.93
# Rows that the index is fitted on, at most: those that a hash of id and row draws.
SAMPLE = 20_000
# Vectors of a cell, about; codewords of a half, at most.
CELL = 1024
MAX_CODES = 1024
KMEANS_ROUNDS = 12
# Share of pairs at exactly the threshold whose cell the traversal must reach, and random partners tried for it.
TARGET_RECALL = 0.99
PARTNERS = 4
# Sampled vectors whose neighbourhoods are counted, and sampled neighbours from which a neighbourhood is a ball.
DENSE_SAMPLE = 8192
DENSE = 12
# Vectors of a block, about: two blocks are multiplied in one task.
BLOCK = 1024
SLACK = 1e-9


def unit_vectors(cells: pd.Series, dims: int | None = None) -> np.ndarray:
    """Rows of length one, in double precision, shorter ones padded with zeros."""
    values = [np.asarray(v, "f8") for v in cells]
    dims = dims or max([1, *map(len, values)])
    out = np.zeros((len(values), dims))
    for i, v in enumerate(values):
        out[i, :len(v)] = v
    out /= np.abs(out).max(axis=1, keepdims=True, initial=1e-300)  # squares neither overflow nor vanish
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def squared_distances(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ codes.T + (codes * codes).sum(1)[None, :], 0.0)


def codebook(x: np.ndarray, k: int) -> np.ndarray:
    """k-means of one half of the sample; seeds drawn in proportion to the squared distance to those before."""
    r = np.random.default_rng(1)
    codes = [x[0]]
    near = squared_distances(x, x[:1])[:, 0]
    for _ in range(k - 1):
        if near.sum() <= 0:
            break
        codes.append(x[r.choice(len(x), p=near / near.sum())])
        near = np.minimum(near, squared_distances(x, codes[-1][None])[:, 0])
    centres = np.array(codes)
    for _ in range(KMEANS_ROUNDS):
        at = squared_distances(x, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, x)
        n = np.bincount(at, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


@dataclass
class MultiIndex:
    """Codebooks of both halves, the traversal's reach, and the balls. Its size is set by the parameters, not the data."""

    dims: int
    first: np.ndarray
    second: np.ndarray
    reach: float
    pivots: dict[int, tuple[np.ndarray, np.ndarray]]  # by label: ball numbers and pivot vectors
    radius: float  # angle round a pivot within which all vectors are linked with each other

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = (self.dims + 1) // 2
        return squared_distances(x[:, :half], self.first), squared_distances(x[:, half:], self.second)

    def visited(self, x: np.ndarray) -> list[list[int]]:
        """Cells each vector visits, its own first: pairs of codewords by growing sum of distances, within the reach."""
        return [self.traverse(a, b) for a, b in zip(*self.halves(x))]

    def traverse(self, a: np.ndarray, b: np.ndarray) -> list[int]:
        """Multi-sequence traversal of one vector: from the two sorted lists of distances, a heap yields the pairs in
        order; a pair enters when its two predecessors are out."""
        left, right = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
        a, b = a[left], b[right]
        limit = a[0] + b[0] + self.reach
        heap, out, done = [(a[0] + b[0], 0, 0)], [], set()
        while heap and heap[0][0] <= limit:
            _, i, j = heapq.heappop(heap)
            out.append(int(left[i]) * len(right) + int(right[j]))
            done.add((i, j))
            if i + 1 < len(a) and (j == 0 or (i + 1, j - 1) in done):
                heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
            if j + 1 < len(b) and (i == 0 or (i - 1, j + 1) in done):
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        return out

    def balls(self, x: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Ball of each vector, -1 for none."""
        out = np.full(len(x), -1, "i8")
        for label in np.unique(labels):
            if label in self.pivots:
                at = np.flatnonzero(labels == label)
                names, pivots = self.pivots[label]
                inside = np.arccos(np.clip(x[at] @ pivots.T, -1, 1)) <= self.radius
                out[at] = np.where(inside.any(1), names[inside.argmax(1)], -1)
        return out


def fit_index(sample: pd.DataFrame, rows: int, cosine: float = COSINE, recall: float = TARGET_RECALL,
              cell: int = CELL) -> MultiIndex:
    """Codebooks, reach and balls from the sample of (label, vector).

    The reach is read off pairs at exactly the threshold, the hardest there are: random partners of sampled vectors. It is
    the excess over the own cell's distance within which a share ``recall`` of them lies, seen from the nearer end.
    """
    x = unit_vectors(sample["vector"])
    dims = x.shape[1]
    half = (dims + 1) // 2
    k = int(np.clip(round((rows / cell) ** 0.5), 1, MAX_CODES))
    # half the angle, less what rounding of the angles may add
    index = MultiIndex(dims, codebook(x[:, :half], k), codebook(x[:, half:], k), 0.0, {}, np.arccos(cosine) / 2 - 1e-6)
    r = np.random.default_rng(2)
    probe = np.repeat(x[:2000], PARTNERS, axis=0)
    aside = r.standard_normal(probe.shape)
    aside -= (aside * probe).sum(1, keepdims=True) * probe
    length = np.linalg.norm(aside, axis=1, keepdims=True)
    partner = cosine * probe + (1 - cosine ** 2) ** 0.5 * aside / np.maximum(length, 1e-300)
    excess = []
    mine, yours = index.halves(probe), index.halves(partner)
    for near, far in ((mine, yours), (yours, mine)):
        at = [h.argmin(1) for h in far]
        excess.append(sum(h[np.arange(len(h)), i] - h.min(1) for h, i in zip(near, at)))
    index.reach = float(np.quantile(np.minimum(*excess), recall)) + SLACK if len(probe) else 0.0
    labels, number = sample["label"].to_numpy()[:DENSE_SAMPLE], 0
    for label in np.unique(labels):
        part = x[:DENSE_SAMPLE][labels == label]
        near = np.concatenate([
            np.arccos(np.clip(part[i:i + 512] @ part.T, -1, 1)) <= index.radius for i in range(0, len(part), 512)])
        chosen, free = [], np.ones(len(part), bool)
        for i in np.argsort(-near.sum(1), kind="stable"):
            if free[i] and (near[i] & free).sum() >= DENSE:
                chosen.append(i)
                free &= ~near[i]
        if chosen:
            index.pivots[int(label)] = np.arange(number, number + len(chosen)), part[chosen]
            number += len(chosen)
    return index


def grouped(mask: np.ndarray) -> np.ndarray:
    """Component of each row of a square link matrix, as the smallest row number of it."""
    label = np.arange(len(mask))
    while True:
        low = np.minimum(label, np.where(mask, label[None, :], len(mask)).min(1, initial=len(mask)))
        low = np.minimum(low, low[low])
        if (low == label).all():
            return label
        label = low


def linked(home: pd.DataFrame, visit: pd.DataFrame, dims: int, cosine: float) -> pd.DataFrame:
    """Verified links of two blocks: how many each vector is credited with, and one row that it hangs on.

    A visitor is credited with every link. A home vector is credited only with those visitors that it does not visit
    itself, as it is credited with the others there.
    """
    h = np.frombuffer(b"".join(home["data"]), "f8").reshape(len(home), dims)
    v = np.frombuffer(b"".join(visit["data"]), "f8").reshape(len(visit), dims)
    row_h, row_v = home["row"].to_numpy(), visit["row"].to_numpy()
    mask = v @ h.T >= cosine
    mask &= row_v[:, None] != row_h[None, :]
    ball_h, ball_v = home["ball"].to_numpy(), visit["ball"].to_numpy()
    mask &= (ball_v[:, None] != ball_h[None, :]) | (ball_v[:, None] < 0)
    keep_v, keep_h = mask.any(1), mask.any(0)
    if not keep_v.any():
        return pd.DataFrame({"row": [], "n": [], "root": []}, dtype="int64")
    mask, row_v, row_h = mask[np.ix_(keep_v, keep_h)], row_v[keep_v], row_h[keep_h]
    own = visit["own"].to_numpy()[keep_v]
    cells, place = np.unique(own, return_inverse=True)
    sees = np.array([np.isin(cells, np.frombuffer(c, "<i8")) for c in home["cells"][keep_h]])
    credit = (mask & ~sees[:, place].T).sum(0)
    rows, back = np.unique(np.concatenate([row_v, row_h]), return_inverse=True)
    square = np.zeros((len(rows), len(rows)), bool)
    i, j = np.nonzero(mask)
    square[back[i], back[len(row_v) + j]] = square[back[len(row_v) + j], back[i]] = True
    root = rows[grouped(square)]
    n = np.bincount(back, np.concatenate([mask.sum(1), credit]), len(rows)).astype("i8")
    return pd.DataFrame({"row": rows, "n": n, "root": root})


def near_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                 cosine: float = COSINE, recall: float = TARGET_RECALL, cell: int = CELL) -> DataFrame:
    """One row per row of ``df``: vec_id, n_links, component_id (the smallest vec_id reachable by links) and kept.

    Vectors of one label are linked if their cosine, in double precision, is at least ``cosine``. Codebooks of the vectors'
    halves, fitted on a bounded sample, span a grid of cells; every vector is filed in one and visits the nearest cells
    as far as a share ``recall`` of threshold pairs needs. Vectors met there are verified exactly, so no link is false.

    Cells are cut in blocks of bounded size and block pairs are multiplied in tasks of their own; a task returns counts
    and one row to hang on per vector, never pairs. A dense group (copies, near copies) would still make blocks by its
    square: the sample shows it, and vectors within half the threshold's angle of its pivot, all linked with each other
    for certain, form a ball, counted by its size and left out of products with itself.

    Vectors that are null, of zeros, or hold null or non-finite components link with nothing, nor do those of null label
    or null id; they are their own component and kept (with null id: component null). Shorter vectors count as padded
    with zeros. Repeated rows are vectors of their own and link, equal ids too; each is kept if its id is the
    component's. An empty table gives an empty result. Other columns are ignored.
    """
    spark = df.sparkSession
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fit = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~odd & F.exists(
        "vector", lambda x: x != 0)
    rows = df.select(F.col(vec_id).alias("vec_id"), F.col(label).cast("long").alias("label"),
                     F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.select("vec_id", "label", F.when(F.coalesce(fit, F.lit(False)), F.col("vector")).alias("vector"),
                       F.monotonically_increasing_id().alias("row"))
    rows = stage_table(spark, rows, "vectors")
    usable = rows.filter(F.col("vector").isNotNull())
    count, dims = usable.agg(F.count("*"), F.max(F.size("vector"))).first()
    if not count:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    drawn = F.pmod(F.xxhash64("vec_id", "row"), F.lit(1 << 40)) < int((1 << 40) * min(1.0, SAMPLE / count))
    sample = usable.filter(drawn).select("label", "vector").limit(SAMPLE).toPandas()
    if sample.empty:
        sample = usable.select("label", "vector").limit(SAMPLE).toPandas()
    longest = sample["vector"].map(len).max()
    if longest < dims:  # the sample is padded to the longest vector of the table
        sample.at[0, "vector"] = np.append(sample.at[0, "vector"], np.zeros(dims - len(sample.at[0, "vector"])))
    index = fit_index(sample, count, cosine, recall, cell)
    shared = spark.sparkContext.broadcast(index)

    def file(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = unit_vectors(batch["vector"], shared.value.dims)
                cells = shared.value.visited(x)
                yield pd.DataFrame({
                    "row": batch["row"], "label": batch["label"], "ball": shared.value.balls(x, batch["label"].to_numpy()),
                    "own": [c[0] for c in cells], "cells": [np.array(c, "<i8").tobytes() for c in cells], "visits": cells,
                    "data": [v.tobytes() for v in x]})

    filed = stage_table(spark, usable.select("row", "label", "vector").mapInPandas(
        file, "row long, label long, ball long, own long, cells binary, visits array<long>, data binary"), "filed")
    home = filed.select("row", "label", F.col("own").alias("cell"), "ball")
    visit = filed.select("row", "label", F.explode("visits").alias("cell"), "ball")
    place = ["label", "cell", "ball"]

    def blocks(side: DataFrame, name: str) -> DataFrame:
        """Numbered blocks of each cell and ball: about BLOCK rows each."""
        n = side.groupBy(*place).count().withColumn("n", F.ceil(F.col("count") / BLOCK).cast("int"))
        return n.select("label", "cell", F.col("ball").alias(f"ball_{name}"), F.col("n").alias(f"n_{name}"),
                        F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias(name))

    pairs = blocks(home, "h").join(blocks(visit, "v"), ["label", "cell"]).filter(
        (F.col("ball_h") != F.col("ball_v")) | (F.col("ball_h") < 0))
    pairs = stage_table(spark, pairs, "block-pairs")
    key = ["label", "cell", "ball_h", "h", "ball_v", "v"]

    def dealt(side: DataFrame, name: str) -> DataFrame:
        """Rows of one side, once for each block pair their block is in."""
        block = F.pmod(F.xxhash64("row"), F.col(f"n_{name}")).cast("int")
        met = pairs.select(*key, f"n_{name}").withColumn("ball", F.col(f"ball_{name}"))
        return side.join(met, place).filter(block == F.col(name)).select(*key, *side.drop(*place).columns, "ball")

    nothing = F.lit(None).cast("binary")
    homes = dealt(filed.select("row", "label", F.col("own").alias("cell"), "ball", "own", "cells", "data"), "h").withColumn(
        "home", F.lit(True))
    visitors = dealt(filed.select("row", "label", F.explode("visits").alias("cell"), "ball", "own",
                                  nothing.alias("cells"), "data"), "v").withColumn("home", F.lit(False))

    def verify(group: pd.DataFrame) -> pd.DataFrame:
        return linked(group[group["home"]], group[~group["home"]], shared.value.dims, cosine)

    met = homes.unionByName(visitors).groupBy(*key).applyInPandas(verify, "row long, n long, root long")
    met = stage_table(spark, met, "vector-links")
    inside = filed.filter(F.col("ball") >= 0)
    sizes = inside.groupBy("ball").agg((F.count("*") - 1).alias("n"), F.min("row").alias("root"))
    inside = inside.select("row", "ball").join(sizes, "ball").select("row", "n", "root")
    both = met.unionByName(inside)
    links = both.groupBy("row").agg(F.sum("n").alias("n_links"))
    found = components(spark, both.select("row", "root"), "row", "root").withColumnRenamed("node", "row")
    named = rows.select("vec_id", "row").join(links, "row", "left").join(found, "row", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "row").alias("component"))
    least = named.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return named.join(least, "component").select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Links and component of every vector."""
    return near_vectors(table(spark, folder, "embeddings"))
