"""Batch scoring with a saved pipeline."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolescope.functions.columns import ref
from rolescope.functions.encode import class_of, lookup
from rolescope.operators.features import FeatureSpec, feature_frame


def score(df: DataFrame, model: PipelineModel, spec: FeatureSpec, keep: tuple[str, ...],
          descriptions: dict[int, str] | None = None) -> DataFrame:
    """``keep, predicted_class, p_1.., confidence_pct[, description]`` for every row.

    The saved pipeline holds the fitted preprocessing, so raw columns go in and no category order
    or vector layout has to be restated. It is a projection: no shuffle.
    """
    classes = spec.roles.label_values
    out = model.transform(feature_frame(df, spec, keep))
    probability = vector_to_array(F.col("probability"))
    scored = out.select(*map(ref, keep),
                        class_of(F.col("prediction"), classes).alias("predicted_class"),
                        probability.alias("p"))
    columns = [*map(ref, keep), F.col("predicted_class"),
               *[F.round(F.col("p")[i], 4).alias(f"p_{c}") for i, c in enumerate(classes)],
               F.round(F.array_max("p") * 100, 2).alias("confidence_pct")]
    if descriptions:
        columns.append(lookup(F.col("predicted_class"), descriptions).alias("description"))
    return scored.select(*columns)


def sample(scored: DataFrame, order: tuple[str, ...], n: int = 10) -> DataFrame:
    """The first ``n`` scored rows by key."""
    return scored.orderBy(*map(ref, order)).limit(n)
