"""Direct tree forecast: boosted trees on the ratio of a day to the level known 90 days before.

One pooled model for all series, with the series as a feature: training is distributed, and the
number of series does not change the number of models.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import HOLDOUT_DAYS
from ..session import materialize
from .features import FEATURES, _has_null, eligible_rows, make_features
from .rollups import SERIES

SERIES_CODES = ["series_code_0", "series_code_1", "series_code_2"]


def _series_codes() -> dict[str, Column]:
    """Three hashed coordinates of the series' name, whatever the number of series.

    Splits on them can single out any series, and no list of names exists anywhere.
    """
    return {name: F.pmod(F.xxhash64(SERIES, F.lit(k)), F.lit(1 << 20)) / float(1 << 20) for k, name in enumerate(SERIES_CODES)}


def direct_tree(df: DataFrame, iterations: int = 20, depth: int = 5, learning_rate: float = 0.1,
                seed: int = 42, horizon: int = HOLDOUT_DAYS) -> DataFrame:
    """Holdout predictions of the eligible series, never below zero."""
    usable = materialize(eligible_rows(make_features(df, horizon)).withColumns(_series_codes()), "features")
    train = usable.filter(~F.col("is_holdout") & ~_has_null([*FEATURES, "target_ratio"]))
    model = Pipeline(stages=[
        VectorAssembler(inputCols=[*FEATURES, *SERIES_CODES], outputCol="features"),
        GBTRegressor(featuresCol="features", labelCol="target_ratio", predictionCol="ratio",
                     maxIter=iterations, maxDepth=depth, stepSize=learning_rate, maxBins=64,
                     minInstancesPerNode=10, seed=seed),
    ]).fit(train)
    scored = model.transform(usable.filter("is_holdout"))
    return scored.select("ds", SERIES, "y", F.greatest(F.col("ratio") * F.col("level"), F.lit(0.0)).alias("yhat"))
