"""The fitted preprocessing as a pipeline stage that is saved and loaded with its model."""

from __future__ import annotations

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession

from riskloom.operators import ml


class PreprocessingWriter(MLWriter):
    def __init__(self, model: PreprocessingModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        fitted = self.model.fitted
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={
            "numeric": fitted.numeric, "levels": fitted.levels, "wide": fitted.wide is not None})
        if fitted.wide is not None:  # rare categories of very wide features are a table, in the model's folder
            fitted.wide.write.mode("overwrite").parquet(f"{path}/wide")


class PreprocessingReader(MLReader):
    def load(self, path: str) -> PreprocessingModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        wide = self.sparkSession.read.parquet(f"{path}/wide") if metadata["wide"] else None
        numeric = {name: tuple(values) for name, values in metadata["numeric"].items()}
        model = PreprocessingModel(ml.Preprocessing(numeric, metadata["levels"], wide))
        model._resetUid(metadata["uid"])
        return model


class PreprocessingModel(Model, MLWritable, MLReadable):
    """Imputes and scales numbers and pools rare categories, with numbers fitted on the training rows."""

    def __init__(self, fitted: ml.Preprocessing) -> None:
        super().__init__()
        self.fitted = fitted

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.fitted.apply(dataset)

    def write(self) -> PreprocessingWriter:
        return PreprocessingWriter(self)

    @classmethod
    def read(cls) -> PreprocessingReader:
        return PreprocessingReader()


class PreprocessingEstimator(Estimator):
    def _fit(self, dataset: DataFrame) -> PreprocessingModel:
        return PreprocessingModel(ml.Preprocessing.fit(dataset))


def logistic_pipeline(train: DataFrame, iterations: int = ml.LOGISTIC_ITERATIONS) -> PipelineModel:
    """Preprocessing, encoding and regression as one model, which saves and loads as one."""
    preparation, model = ml.train_logistic(train, iterations)
    return PipelineModel([PreprocessingModel(preparation), *model.stages])


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    output = model.transform(df)
    return output.select(*df.columns, ml.probability(output).alias("fraud_probability"))


def load(spark: SparkSession, path: str) -> PipelineModel:
    return PipelineModel.load(path)
