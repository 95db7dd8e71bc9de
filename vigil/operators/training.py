"""Models over feature rows, with pyspark.ml."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, CountVectorizer, Imputer, OneHotEncoder, RegexTokenizer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def preparation(numeric: Sequence[str], categorical: Sequence[str] = (), text: str | None = None, terms: int = 100) -> list:
    """Stages: medians for missing numbers, standardisation, one-hot categories, TF-IDF of a text column, one vector `features`."""
    stages: list = [Imputer(strategy="median", inputCols=list(numeric), outputCols=[f"{c}__i" for c in numeric]), VectorAssembler(inputCols=[f"{c}__i" for c in numeric], outputCol="numeric__v"), StandardScaler(withMean=True, inputCol="numeric__v", outputCol="numeric__s")]
    parts = ["numeric__s"]
    for c in categorical:
        stages += [StringIndexer(inputCol=c, outputCol=f"{c}__x", handleInvalid="keep"), OneHotEncoder(inputCol=f"{c}__x", outputCol=f"{c}__o")]
        parts.append(f"{c}__o")
    if text:
        stages += [RegexTokenizer(inputCol=text, outputCol="text__t", pattern="[^a-z0-9]+"), CountVectorizer(inputCol="text__t", outputCol="text__c", vocabSize=terms), IDF(inputCol="text__c", outputCol="text__f")]
        parts.append("text__f")
    return [*stages, VectorAssembler(inputCols=parts, outputCol="features")]


def tuned(df: DataFrame, stages: list, label: str = "label", folds: int = 3, seed: int = 7) -> PipelineModel:
    """Boosted trees for two classes, a forest for more, the best of a small grid by macro F1 over folds."""
    two = df.select(label).distinct().count() <= 2
    model = GBTClassifier(labelCol=label, seed=seed, maxIter=10) if two else RandomForestClassifier(labelCol=label, seed=seed, numTrees=20)
    grid = ParamGridBuilder().addGrid(model.maxDepth, [2, 4]).build()
    score = MulticlassClassificationEvaluator(labelCol=label, metricName="f1")
    return CrossValidator(estimator=Pipeline(stages=[*stages, model]), estimatorParamMaps=grid, evaluator=score, numFolds=folds, seed=seed).fit(df).bestModel


def stacked(df: DataFrame, base: PipelineModel, extra: Sequence[str], label: str = "label") -> PipelineModel:
    """A second model over the first one's probabilities and further columns; the first stays as it is."""
    first = with_probability(df, base)
    return Pipeline(stages=[VectorAssembler(inputCols=["p__base", *extra], outputCol="stack__v"), LogisticRegression(featuresCol="stack__v", labelCol=label, predictionCol="stack__y", probabilityCol="stack__p", rawPredictionCol="stack__r")]).fit(first)


def with_probability(df: DataFrame, model: PipelineModel) -> DataFrame:
    """df with p__base, the probability of the last class, and top__class with top__p."""
    p = vector_to_array(F.col("probability"))
    return model.transform(df).withColumn("p__base", F.element_at(p, -1)).withColumn("top__p", F.array_max(p)).withColumn("top__class", (F.array_position(p, F.array_max(p)) - 1).cast("int"))
