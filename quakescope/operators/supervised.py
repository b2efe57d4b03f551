"""Supervised zones: tree ensembles that learn a label of the events, with a held-out split.

The split is by a hash of the id, so an event is on the same side in every
run; MLlib trains on binned statistics that its executors add up, and the
evaluation is one count per (label, prediction).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakescope.operators.clean import all_present
from quakescope.schema import FEATURES

#: Sixteenths of the ids that are held out; trees, depth and seed of the ensembles.
HELD_OUT, TREES, DEPTH, SEED = 4, 20, 6, 42


def held_out(id_column: str = "id", share: int = HELD_OUT) -> Column:
    """Whether the id's hash is in the first ``share`` sixteenths; null ids count as empty."""
    digit = F.substring(F.md5(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")), 1, 1)
    return F.conv(digit, 16, 10).cast("int") < share


@dataclass
class Supervised:
    model: PipelineModel
    label: str
    features: tuple[str, ...]

    def predict(self, df: DataFrame) -> DataFrame:
        """The rows with all features present, all their columns and ``predicted`` (int); a map-only pass."""
        out = self.model.transform(df.filter(all_present(list(self.features))))
        return out.select(*df.columns, F.col("_predicted").cast("int").alias("predicted"))


def learn_label(df: DataFrame, label: str, method: str = "forest", features: Sequence[str] = FEATURES,
                trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> Supervised:
    """Train on all rows of ``df`` with a label and all features present.

    ``forest`` takes any labels 0, 1, ...; ``boosted`` (gradient-boosted
    trees) 0 and 1.  Rows without a label or with a missing feature don't
    teach; without any row that does, it raises.
    """
    rows = df.filter(F.col(label).isNotNull() & all_present(list(features)))
    rows = rows.select(*features, F.col(label).cast("double").alias("_label"))
    if rows.isEmpty():
        raise ValueError("no labelled rows with all features present")
    vectors = VectorAssembler(inputCols=list(features), outputCol="_vector")
    shared = dict(featuresCol="_vector", labelCol="_label", predictionCol="_predicted", maxDepth=depth, seed=seed)
    if method == "forest":
        trainer = RandomForestClassifier(numTrees=trees, probabilityCol="_p", rawPredictionCol="_raw", **shared)
    elif method == "boosted":
        trainer = GBTClassifier(maxIter=trees, **shared)
    else:
        raise ValueError(f"unknown method '{method}': forest or boosted")
    return Supervised(Pipeline(stages=[vectors, trainer]).fit(rows), label, tuple(features))


def confusion(predicted: DataFrame, label: str) -> DataFrame:
    """label, predicted, events: one row for each pair that occurs."""
    return predicted.groupBy(F.col(label).cast("int").alias("label"), "predicted").agg(F.count(F.lit(1)).alias("events"))


def evaluation(counts: DataFrame) -> DataFrame:
    """events, labels, accuracy and the share of the most frequent label, from ``confusion``'s counts."""
    each = counts.groupBy("label").agg(F.sum("events").alias("events"), F.sum(F.when(F.col("label") == F.col("predicted"), F.col("events")).otherwise(0)).alias("right"))
    total = F.sum("events").cast("double")
    return each.agg(F.coalesce(F.sum("events"), F.lit(0)).alias("events"), F.count("label").alias("labels"),
                    F.try_divide(F.sum("right").cast("double"), total).alias("accuracy"), F.try_divide(F.max("events").cast("double"), total).alias("majority"))


def evaluated(df: DataFrame, label: str, method: str = "forest", features: Sequence[str] = FEATURES, id_column: str = "id", **options) -> DataFrame:
    """One row: train_rows, test_rows, confusion_rows, labels, accuracy, majority of a model trained on one side of the split.

    Rows without a label or with a missing feature are on neither side.  The
    rows are read several times: give a written table.
    """
    rows = df.filter(F.col(label).isNotNull() & all_present(list(features))).withColumn("_held", held_out(id_column))
    model = learn_label(rows.filter("NOT _held"), label, method, features, **options)
    tested = model.predict(rows.filter("_held"))
    sides = rows.agg(F.count_if(~F.col("_held")).alias("train_rows"), F.count_if("_held").alias("test_rows")).first()
    result = evaluation(confusion(tested, label))
    return result.select(F.lit(sides["train_rows"]).cast("long").alias("train_rows"), F.lit(sides["test_rows"]).cast("long").alias("test_rows"),
                         F.col("events").cast("long").alias("confusion_rows"), "labels", "accuracy", "majority")
