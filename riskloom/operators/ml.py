"""Model work on Spark ML: preprocessing, training, scoring and tree explanations."""

from __future__ import annotations

import sys
from dataclasses import dataclass
from math import ceil
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import columns as C
from riskloom.operators.modeling import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from riskloom.operators.ordered import MAX_ROWS_PER_TASK, exact_quantiles
from riskloom.session import ensure_checkpoint_dir

# The batch functions below travel to the tasks by value: workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Training settings.
RARE_LEVEL_ROWS = 100
# Rare categories of a feature that are named in the plan; those of a wider one are joined.
MAX_LEVELS = 10_000
INFREQUENT = "__infrequent__"
LOGISTIC_ITERATIONS = 300
INVERSE_PENALTY = 1.0
BOOSTING_ROUNDS = 1000
# Rounds that must follow the best one without a lower validation loss, and rounds that the first fit has beyond these.
PATIENCE = 75
FIRST_ROUNDS = 25
PARTITION_ROWS = 200_000
LEARNING_RATE = 0.05
TREE_DEPTH = 5
SUBSAMPLE = 0.8
SEED = 42
# Spark trees have no missing branch; a value below every real one lets a split set missing apart.
MISSING_NUMBER = -1e9


def class_weights(train: DataFrame) -> DataFrame:
    """Balanced weight of each class: all rows over twice the class's rows."""
    counts = train.groupBy("is_fraud").agg(F.count(F.lit(1)).alias("transactions"))
    rows = train.agg(F.count(F.lit(1))).scalar()
    return counts.select("is_fraud", "transactions",
                         C.rounded(rows / (2 * F.col("transactions")), 9).alias("class_weight"))


def with_class_weight(df: DataFrame, weights: DataFrame) -> DataFrame:
    """Attach the weight by label; the weight table has one row per class."""
    return df.join(F.broadcast(weights.select("is_fraud", "class_weight")), "is_fraud")


def numeric_fit(train: DataFrame, columns: list[str] = NUMERIC_FEATURES,
                max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """Exact median, and mean and population deviation after imputing it, of every numeric feature, unrounded."""
    medians = exact_quantiles(train, columns, [0.5], max_rows).select("feature", F.col("value").alias("median"))
    # Imputing the median shifts the moments in closed form, so one aggregation of the raw column is enough.
    known = [F.struct(
        F.lit(c).alias("feature"), F.count(F.lit(1)).alias("rows"), F.count(F.col(c)).alias("known"),
        F.avg(F.col(c).cast("double")).alias("mean"), F.var_pop(F.col(c).cast("double")).alias("var"),
    ) for c in columns]
    moments = train.agg(F.array(*known).alias("m")).select(F.inline("m"))
    share = F.col("known") / F.col("rows")
    mean = share * F.col("mean") + (1 - share) * F.col("median")
    between = share * (1 - share) * (F.col("mean") - F.col("median")) * (F.col("mean") - F.col("median"))
    return moments.join(medians, "feature").select(
        "feature", "median", mean.alias("mean"), F.sqrt(share * F.col("var") + between).alias("scale"))


def numeric_preprocessing(train: DataFrame, columns: list[str] = NUMERIC_FEATURES,
                          max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """The fitted numbers as a report, to six places."""
    return numeric_fit(train, columns, max_rows).select(
        "feature", *[C.rounded(F.col(c), 6).alias(c) for c in ("median", "mean", "scale")])


def categorical_levels(train: DataFrame, columns: list[str] = CATEGORICAL_FEATURES,
                       rare_rows: int = RARE_LEVEL_ROWS) -> DataFrame:
    """Rows of every category after filling the mode, and the level it trains as: itself or the rare pool."""
    long = train.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "feature", "category")
    counts = long.groupBy("feature", "category").agg(F.count(F.lit(1)).alias("n"))
    known = counts.filter(F.col("category").isNotNull())
    # Most rows first, then the smallest text, as one comparable value.
    modes = known.groupBy("feature").agg(
        F.min(F.struct((-F.col("n")).alias("by"), F.col("category").alias("mode"))).alias("best"))
    missing = counts.filter(F.col("category").isNull()).select("feature", F.col("n").alias("missing"))
    filled = known.join(modes, "feature").join(missing, "feature", "left").select(
        "feature", "category",
        (F.col("n") + F.when(F.col("category") == F.col("best.mode"), F.coalesce("missing", F.lit(0)))
         .otherwise(0)).alias("transactions"))
    return filled.withColumn(
        "level", F.when(F.col("transactions") >= rare_rows, F.col("category")).otherwise(INFREQUENT))


@dataclass
class Preprocessing:
    """Fitted parameters: three numbers per numeric feature, the closed domain of each categorical one."""

    numeric: dict[str, tuple[float, float, float]]
    levels: dict[str, dict[str, list[str]]]
    # Rare categories of features with more than MAX_LEVELS of them, as a stored (feature, category) table.
    wide: DataFrame | None = None

    @staticmethod
    def fit(train: DataFrame) -> Preprocessing:
        numeric = {r["feature"]: (r["median"], r["mean"], r["scale"]) for r in numeric_fit(train).collect()}
        domains = categorical_levels(train)
        sizes = domains.groupBy("feature").agg(F.count(F.lit(1)).alias("levels")).collect()
        broad = [r["feature"] for r in sizes if r["levels"] > MAX_LEVELS]
        wide = None
        if broad:
            ensure_checkpoint_dir(train.sparkSession)
            wide = domains.filter(F.col("feature").isin(broad) & (F.col("level") == INFREQUENT)).select(
                "feature", "category").checkpoint()
        rare = (F.col("level") == INFREQUENT) & ~F.col("feature").isin(broad)
        table = domains.groupBy("feature").agg(
            F.sort_array(F.collect_list(F.when(F.col("level") != INFREQUENT, F.col("category")))).alias("frequent"),
            F.sort_array(F.collect_list(F.when(rare, F.col("category")))).alias("rare"),
            # Most rows first, then the smallest text.
            F.min(F.struct((-F.col("transactions")).alias("by"), F.col("category").alias("mode"))).alias("best"))
        levels = {r["feature"]: {"frequent": r["frequent"], "rare": r["rare"], "mode": [r["best"]["mode"]]}
                  for r in table.collect()}
        return Preprocessing(numeric, levels, wide)

    def apply(self, df: DataFrame) -> DataFrame:
        """Impute and scale numbers, pool rare categories; an unseen category stays itself and encodes to zeros."""
        made = {}
        for name, (median, mean, scale) in self.numeric.items():
            value = F.coalesce(F.col(name).cast("double"), F.lit(median))
            made[f"n_{name}"] = (value - F.lit(mean)) / F.lit(scale or 1.0)
        for name, level in self.levels.items():
            value = F.coalesce(F.col(name).cast("string"), F.lit(level["mode"][0]))
            made[f"c_{name}"] = F.when(value.isin(level["rare"]), INFREQUENT).otherwise(value) if level["rare"] else value
        out = df.withColumns(made)
        if self.wide is not None:
            for name in self.levels:
                pool = self.wide.filter(F.col("feature") == name).select(
                    F.col("category").alias("_rare"), F.lit(True).alias("_pooled"))
                out = out.join(pool, out[f"c_{name}"] == F.col("_rare"), "left").withColumn(
                    f"c_{name}", F.when(F.col("_pooled"), INFREQUENT).otherwise(F.col(f"c_{name}"))).drop("_rare", "_pooled")
        return out


def probability(model_output: DataFrame) -> Column:
    return vector_to_array(model_output["probability"])[1]


def train_logistic(train: DataFrame, iterations: int = LOGISTIC_ITERATIONS) -> tuple[Preprocessing, PipelineModel]:
    """L2 logistic regression with balanced classes on scaled numbers and one-hot categories.

    The penalty is per row here, so the inverse strength is divided by the (weighted) number of rows.
    """
    preparation = Preprocessing.fit(train)
    weights = class_weights(train)
    rows = train.count()
    ready = with_class_weight(preparation.apply(train), weights)
    categories = [f"c_{c}" for c in CATEGORICAL_FEATURES]
    numbers = [f"n_{c}" for c in NUMERIC_FEATURES]
    indexer = StringIndexer(inputCols=categories, outputCols=[f"i_{c}" for c in categories], handleInvalid="keep",
                            stringOrderType="alphabetAsc")
    # The last slot is the indexer's "unseen" one; dropping it turns an unseen category into zeros.
    encoder = OneHotEncoder(inputCols=indexer.getOutputCols(), outputCols=[f"v_{c}" for c in categories], dropLast=True)
    assembler = VectorAssembler(inputCols=numbers + encoder.getOutputCols(), outputCol="features")
    regression = LogisticRegression(
        labelCol="is_fraud", weightCol="class_weight", maxIter=iterations, regParam=1.0 / (INVERSE_PENALTY * rows),
        elasticNetParam=0.0, standardization=False)
    fitted = Pipeline(stages=[indexer, encoder, assembler, regression]).fit(ready)
    # A fitted regression drags its training rows and session along in a summary; the saved form has coefficients only.
    ensure_checkpoint_dir(train.sparkSession)
    path = f"{train.sparkSession.sparkContext.getCheckpointDir()}/logistic-{uuid4().hex}"
    fitted.write().save(path)
    return preparation, PipelineModel.load(path)


def score_logistic(preparation: Preprocessing, model: PipelineModel, df: DataFrame) -> DataFrame:
    output = model.transform(preparation.apply(df))
    return output.select(*df.columns, probability(output).alias("fraud_probability"))


def _tree_inputs(df: DataFrame) -> DataFrame:
    made = {f"c_{c}": F.coalesce(F.col(c).cast("string"), F.lit(C.MISSING_CATEGORY)) for c in CATEGORICAL_FEATURES}
    made |= {f"n_{c}": F.coalesce(F.col(c).cast("double"), F.lit(MISSING_NUMBER)) for c in NUMERIC_FEATURES}
    return df.withColumns(made)


def _in_fixed_parts(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt by a hash of the key and sorted, as many to a partition on any machine: rows are subsampled by partition,
    so the model does not depend on how the table was stored. A round is several short passes: a few large partitions."""
    parts = max(1, ceil(df.count() / PARTITION_ROWS))
    return df.repartition(parts, key).sortWithinPartitions(key)


def train_gbt(train: DataFrame, validation: DataFrame, rounds: int = BOOSTING_ROUNDS, max_bins: int = 256,
              patience: int = PATIENCE, key: str = "transaction_key") -> PipelineModel:
    """Boosted trees with balanced classes, as many as the loss on the validation rows asks for, ``rounds`` at most.

    Training ends when ``patience`` rounds after the best one did not lower the loss on the validation rows; the trees up
    to the best round are the model. The trainer's own validation ends at the first such round, so trees are fitted
    without it, for a number of rounds that doubles until enough of them follow the best; the seed makes every shorter fit
    a prefix of a longer one. Category domains come from the training rows only, rare categories pooled; an unseen one
    has its own slot.
    """
    domains = categorical_levels(train.select(*CATEGORICAL_FEATURES))
    pools = {r["feature"]: r["frequent"] for r in domains.filter(F.col("level") != INFREQUENT).groupBy("feature").agg(
        F.sort_array(F.collect_list("category")).alias("frequent")).collect()}
    weights = class_weights(train)
    categories = [f"c_{c}" for c in CATEGORICAL_FEATURES]
    indexer = StringIndexerModel.from_arrays_of_labels(
        [[*pools.get(c, []), C.MISSING_CATEGORY] if C.MISSING_CATEGORY not in pools.get(c, []) else pools[c]
         for c in CATEGORICAL_FEATURES], categories, [f"i_{c}" for c in categories], handleInvalid="keep")
    assembler = VectorAssembler(
        inputCols=[f"n_{c}" for c in NUMERIC_FEATURES] + indexer.getOutputCols(), outputCol="features")
    largest = max(len(labels) for labels in indexer.labelsArray) + 1
    # The trainer reads its rows several times: the assembled features are kept, not what they are made of.
    inputs, checked = (
        assembler.transform(indexer.transform(_tree_inputs(with_class_weight(_in_fixed_parts(rows, key), weights)))).withColumn(
            "held_out", F.lit(held_out)).select("is_fraud", "class_weight", "held_out", "features").cache()
        for rows, held_out in ((train, False), (validation, True)))

    def grown(n: int) -> GBTClassificationModel:
        return GBTClassifier(
            labelCol="is_fraud", weightCol="class_weight", maxIter=n, stepSize=LEARNING_RATE, maxDepth=TREE_DEPTH,
            subsamplingRate=SUBSAMPLE, seed=SEED, maxBins=max(max_bins, largest), featureSubsetStrategy="0.8").fit(inputs)

    tried = min(rounds, patience + FIRST_ROUNDS)
    while True:
        trees = grown(tried)
        losses = trees.evaluateEachIteration(checked)
        best = min(range(tried), key=lambda i: (losses[i], i)) + 1
        if tried - best >= patience or tried == rounds:
            break
        tried = min(rounds, 2 * tried)
    model = PipelineModel([indexer, assembler, trees if best == tried else grown(best)])
    inputs.unpersist()
    checked.unpersist()
    return model


def validation_losses(model: PipelineModel, train: DataFrame, validation: DataFrame) -> list[float]:
    """Weighted log loss on the validation rows after each tree, from the model's own staged evaluation."""
    inputs = _tree_inputs(with_class_weight(validation, class_weights(train)))
    for stage in model.stages[:-1]:
        inputs = stage.transform(inputs)
    return list(model.stages[-1].evaluateEachIteration(inputs))


POLICY = "trained on the train period; identifiers, supplied velocity and network features are no inputs"


def model_metadata(model: PipelineModel, train: DataFrame, validation: DataFrame, roc_auc: float, pr_auc: float
                   ) -> DataFrame:
    """One row: features, rows of both periods, trees kept, areas on validation, and the feature policy."""
    names = [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES]
    row = (", ".join(names), len(names), train.count(), validation.count(), len(model.stages[-1].treeWeights),
           roc_auc, pr_auc, POLICY)
    return train.sparkSession.createDataFrame([row], (
        "features string, feature_count int, training_rows long, validation_rows long, best_iteration int, "
        "roc_auc double, pr_auc double, feature_policy string"))


def score_gbt(model: PipelineModel, df: DataFrame) -> DataFrame:
    output = model.transform(_tree_inputs(df))
    return output.select(*df.columns, probability(output).alias("fraud_probability"))


def tree_nodes(model: GBTClassificationModel, folder: str) -> pd.DataFrame:
    """The trees as a node table, read back from the saved model. Its size is the model's, not the data's."""
    model.write().overwrite().save(folder)
    saved = SparkSession.active().read.parquet(f"{folder}/data")
    return saved.select("treeID", "nodeData.*").toPandas()


def feature_importance(model: PipelineModel, folder: str, df: DataFrame) -> DataFrame:
    """Gain share and number of splits of every feature."""
    gbt = model.stages[-1]
    names = [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES]
    nodes = tree_nodes(gbt, folder)
    used = nodes[nodes["leftChild"] >= 0]["split"].map(lambda s: s["featureIndex"]).value_counts()
    gains = gbt.featureImportances.toArray()
    rows = [(n, float(gains[i]), int(used.get(i, 0))) for i, n in enumerate(names)]
    return df.sparkSession.createDataFrame(rows, "feature string, gain_importance double, split_count int").orderBy(
        F.desc("gain_importance"), "feature")


# A leaf as plain data: value, its features, each feature's tests, each feature's share of training
# rows passing those tests.
LeafRule = tuple[float, list[int], list[list[tuple]], list[float]]


def leaf_rules(nodes: pd.DataFrame, tree_weights: list[float]) -> list[LeafRule]:
    """Every leaf of every tree; values already in log-odds (twice the boosted margin)."""
    rules = []
    for tree, table in nodes.groupby("treeID"):
        by_id = table.set_index("id").to_dict("index")
        scale = 2.0 * tree_weights[int(tree)]
        stack = [(0, {}, {})]
        while stack:
            node_id, tests, shares = stack.pop()
            node = by_id[node_id]
            if node["leftChild"] < 0:
                used = sorted(tests)
                rules.append((scale * node["prediction"], used, [tests[f] for f in used], [shares[f] for f in used]))
                continue
            split = node["split"]
            feature, cut = split["featureIndex"], list(split["leftCategoriesOrThreshold"])
            kind = ("in", cut) if split["numCategories"] >= 0 else ("le", cut[0])
            for child, wanted in ((node["leftChild"], True), (node["rightChild"], False)):
                share = by_id[child]["rawCount"] / max(node["rawCount"], 1)
                stack.append((
                    child,
                    {**tests, feature: tests.get(feature, []) + [(*kind, wanted)]},
                    {**shares, feature: shares.get(feature, 1.0) * share},
                ))
    return rules


def _passes(values: np.ndarray, tests: list[tuple]) -> np.ndarray:
    held = np.ones(len(values), dtype=bool)
    for kind, cut, wanted in tests:
        went_left = values <= cut if kind == "le" else np.isin(values, cut)
        held &= went_left == wanted
    return held.astype(float)


def leaf_contributions(x: np.ndarray, rules: list[LeafRule]) -> tuple[np.ndarray, float]:
    """Shapley values of a sum of leaves for a batch of rows, and the base value.

    A leaf pays its value when every feature test passes; a feature left out passes with the share of training rows that
    did. For such a product a feature's Shapley value is (passed - share) times the integral over t from 0 to 1 of the
    other features' share + t * (passed - share): choosing each with probability t gives every order its weight. The
    integrand is a polynomial, so a few Gauss points are exact; products of all but one come from running products. The
    time is the square of a leaf's features, the subsets are never listed.
    """
    total = np.zeros(x.shape)
    base = 0.0
    for value, features, tests, shares in rules:
        m = len(features)
        base += value * float(np.prod(shares)) if m else value
        if not m:
            continue
        points, point_weights = np.polynomial.legendre.leggauss((m + 1) // 2)
        gaps = [_passes(x[:, f], t) - share for f, t, share in zip(features, tests, shares)]
        terms = [share + np.outer((points + 1) / 2, gap) for gap, share in zip(gaps, shares)]
        before, after = [np.ones_like(terms[0])], [np.ones_like(terms[0])]
        for term in terms[:-1]:
            before.append(before[-1] * term)
        for term in reversed(terms[1:]):
            after.append(after[-1] * term)
        for i, f in enumerate(features):
            total[:, f] += value * gaps[i] * (point_weights / 2 @ (before[i] * after[m - 1 - i]))
    return total, base


def tree_contributions(model: PipelineModel, df: DataFrame, folder: str, keep: list[str]) -> DataFrame:
    """Per-row contributions of the boosted trees in log-odds, with the base value.

    Spark spreads the rows; each task explains its Arrow batches against the broadcast leaf table.
    """
    gbt = model.stages[-1]
    rules = df.sparkSession.sparkContext.broadcast(leaf_rules(tree_nodes(gbt, folder), list(gbt.treeWeights)))
    names = [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES]
    prepared = _tree_inputs(df)
    for stage in model.stages[:-1]:
        prepared = stage.transform(prepared)
    inputs = prepared.select(*keep, vector_to_array("features").alias("x"))
    schema = T.StructType([*inputs.schema, T.StructField("parts", T.ArrayType(T.DoubleType())),
                           T.StructField("base_value", T.DoubleType())])

    def explain(batches):
        for batch in batches:
            n = batch.num_rows
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, len(names))
            parts, base = leaf_contributions(x, rules.value)
            starts = pa.array(np.arange(n + 1, dtype="i4") * len(names), pa.int32())
            made = [pa.ListArray.from_arrays(starts, pa.array(parts.ravel())), pa.array(np.full(n, float(base)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, "parts", "base_value"])

    found = inputs.mapInArrow(explain, schema)
    # Numbers alone pass through Python; the named entries are made of them in the row.
    entries = [F.struct(F.lit(n).alias("feature"), F.col("x")[i].alias("value"), F.col("parts")[i].alias("contribution"))
               for i, n in enumerate(names)]
    return found.select(*keep, F.array(*entries).alias("contributions"), "base_value")
