"""Quality classifier: a generalised additive model with pairwise interactions, as lookup tables over binned features."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import table

# Labelled rows the model is fitted on at most: those of the smallest digests of their id.
TRAIN_ROWS = 30_000
BINS = 32
ROUNDS = 150
PAIR_ROUNDS = 60
PAIRS = 6
PAIR_BINS = 8
LEAVES = 3
RATE = 0.1
RIDGE = 1.0
# Fixed values of the contract.
THRESHOLD = 0.3
FOLDS = 5

FEATURES = ["log_words", "log_chars", "word_length", "upper_share", "digit_share", "symbol_share", "bang_share",
            "pipe_share", "space_share", "wide_share", "distinct_share", "top_word_share", "repeat_next_share",
            "stop_line_share", "line_words", "dup_line_share", "capital_word_share", "long_word_share"]
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&<>@^~_=+{}[]\\/")] = True


def text_features(text: str | None) -> list[float]:
    """Counts over the whole text, as shares of its bytes, words or lines; zeros for an empty text."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    seen = np.bincount(np.frombuffer(raw, "u1"), minlength=256)
    size, n = len(raw), len(words)
    counts = Counter(words)
    lines = [x for x in map(bytes.rstrip, raw.split(b"\n")) if x]
    return [
        np.log1p(n), np.log1p(size), min(60.0, (size - seen[[32, 9, 10, 11, 12, 13]].sum()) / n),
        seen[65:91].sum() / size, seen[48:58].sum() / size, seen[_SYMBOLS].sum() / size, seen[33] / n, seen[124] / n,
        seen[[32, 9, 10, 11, 12, 13]].sum() / size, seen[128:].sum() / size, len(counts) / n,
        counts.most_common(1)[0][1] / n, sum(map(bytes.__eq__, words, words[1:])) / n,
        sum(x[-1:] in (b".", b"!", b"?", b'"', b":") for x in lines) / len(lines), np.log1p(n / len(lines)),
        1 - len(set(lines)) / len(lines), sum(w[:1].isupper() for w in words) / n, sum(len(w) > 24 for w in words) / n,
    ]


@dataclass
class AdditiveModel:
    """Bin edges and lookup tables; small, and its size is set by the parameters alone."""

    base: float
    edges: list[np.ndarray]
    tables: np.ndarray
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for j, (edges, values) in enumerate(zip(self.edges, self.tables)):
            out += values[np.searchsorted(edges, x[:, j], "right")]
        coarse = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.pair_edges)]
        for (a, b), values in zip(self.pairs, self.pair_tables):
            out += values[coarse[a], coarse[b]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    """Borders between bins of about equal counts; fewer where values repeat."""
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def line_tree(g: np.ndarray, h: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """A shallow tree on one feature's bins: the best cuts by gradient gain, and a Newton step for each leaf."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = (1e-9, None, 0)
        for a, b in parts:
            cg, ch = np.cumsum(g[a:b]), np.cumsum(h[a:b])
            if b - a < 2:
                continue
            won = _gain(cg[:-1], ch[:-1]) + _gain(cg[-1] - cg[:-1], ch[-1] - ch[:-1]) - _gain(cg[-1], ch[-1])
            i = int(won.argmax())
            best = max(best, (float(won[i]), (a, b), a + i + 1), key=lambda x: x[0])
        if best[1] is None:
            break
        parts.remove(best[1])
        parts += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def box_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """A tree of depth two on a pair's bins, one cut on each axis: its gain and its step for each cell."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    tg, th = cg[-1, -1], ch[-1, -1]

    def quarters(c: np.ndarray, t: float) -> list[np.ndarray]:
        a, b = c[:-1, -1:], c[-1:, :-1]
        one = c[:-1, :-1]
        return [one, a - one, b - one, t - a - b + one]

    gs, hs = quarters(cg, tg), quarters(ch, th)
    won = sum(_gain(a, b) for a, b in zip(gs, hs))
    if not won.size:
        return 0.0, np.zeros_like(g)
    i, j = np.unravel_index(int(won.argmax()), won.shape)
    step = [a[i, j] / (b[i, j] + RIDGE) for a, b in zip(gs, hs)]
    out = np.empty_like(g)
    out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1], out[i + 1:, j + 1:] = step
    return float(won[i, j] - _gain(tg, th)), out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pair_rounds: int = PAIR_ROUNDS) -> AdditiveModel:
    """Cyclic boosting: the features take turns, each adding a shallow tree to its table; then the best pairs do."""
    n, width = x.shape
    rate = (y.sum() + 1) / (n + 2)
    base = float(np.log(rate / (1 - rate)))
    edges = [_edges(x[:, j], BINS) for j in range(width)]
    bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]
    tables, margin = np.zeros((width, BINS + 1)), np.full(n, base)
    pair_edges = [_edges(x[:, j], PAIR_BINS) for j in range(width)]
    coarse = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(pair_edges)]

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return y - p, p * (1 - p)

    for _ in range(rounds if n else 0):
        for j in range(width):
            g, h = (np.bincount(bins[j], s, BINS + 1) for s in slopes())
            step = RATE * line_tree(g, h)
            tables[j] += step
            margin += step[bins[j]]
    side = PAIR_BINS + 1
    cells = {(a, b): coarse[a] * side + coarse[b] for a in range(width) for b in range(a)}

    def box(pair: tuple[int, int]) -> tuple[float, np.ndarray]:
        return box_tree(*(np.bincount(cells[pair], s, side * side).reshape(side, side) for s in slopes()))

    pairs = sorted(cells, key=lambda p: (-box(p)[0], p))[:PAIRS] if n else []
    pair_tables = np.zeros((len(pairs), side, side))
    for _ in range(pair_rounds if n else 0):
        for k, pair in enumerate(pairs):
            step = RATE * box(pair)[1]
            pair_tables[k] += step
            margin += step.ravel()[cells[pair]]
    return AdditiveModel(base, edges, tables, pairs, pair_edges, pair_tables)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is kept from training: crc32 of its id as text leaves 0 modulo five; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS) -> AdditiveModel:
    """Fit on at most ``rows`` labelled documents that are not held out; that bound is all the driver receives.

    The sample is the labelled ids of the smallest digests, so it does not depend on the order of the rows. Ids, then
    features of those documents alone, are joined. Each (id, label) counts once, however often its label or its document
    is repeated; of several texts under one id it is the one of least digest. An id with both labels counts once for each.
    """
    sample = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out())
        .select("doc_id", F.col(label).cast("double").alias("y")).distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(rows)
    )
    kinds = dict(documents.dtypes)
    schema = f"doc_id {kinds['doc_id']}, y double, digest long, x array<double>"

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        least: dict[tuple, int] = {}  # one for each sampled row at most
        for batch in batches:
            out = []
            for key, y, digest, text in zip(batch["doc_id"], batch["y"], batch["digest"], batch["text"]):
                if digest < least.get((key, y), 1 << 63):
                    least[key, y] = digest
                    out.append((key, y, digest, text_features(text)))
            yield pd.DataFrame(out, columns=["doc_id", "y", "digest", "x"])

    # At most ``rows`` ids of sixteen bytes.
    chosen = documents.select("doc_id", "text", F.xxhash64("text").alias("digest")).join(F.broadcast(sample), "doc_id")
    each = chosen.select("doc_id", "y", "digest", "text").mapInPandas(measure, schema).groupBy("doc_id", "y").agg(
        F.min(F.struct("digest", "x")).alias("least"))
    found = each.select("y", F.col("least.x").alias("x")).toPandas()
    assert len(found) <= rows
    order = sorted(range(len(found)), key=lambda i: (found["y"][i], list(found["x"][i])))
    x = np.array([found["x"][i] for i in order], "f8").reshape(-1, len(FEATURES))
    return fit(x, found["y"].to_numpy("f8")[order])


def score_documents(documents: DataFrame, model: AdditiveModel, threshold: float = THRESHOLD) -> DataFrame:
    """Every row with score (0 to 1) and predicted; other columns pass through, columns of those names are replaced.

    One pass without a shuffle; a batch's features are binned and the tables' values added in numpy. Null and empty
    texts have zero features and are scored like any other; repeated rows get equal scores.
    """
    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        x = np.array([text_features(t) for t in text], "f8").reshape(-1, len(FEATURES))
        return pd.Series(np.round(model.score(x), 9))

    return documents.withColumn("score", score("text")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document; labels of held-out rows are not looked at."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = train(documents, table(spark, folder, "labels"))
    return score_documents(documents, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
