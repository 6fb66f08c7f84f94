"""Random hyper-parameter search by cross-validated AUC."""

from __future__ import annotations

import random
from collections.abc import Sequence
from itertools import product

from pyspark.ml import Estimator
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame

from retourlens.functions.scalar import linspace_ints
from retourlens.session import shared_dir

# The search spaces of the two tree families, by MLlib name.
GBT_SPACE = {
    "maxIter": [500, 550, 600, 650, 700, 750],
    "stepSize": [0.05, 0.06, 0.07, 0.08],
    "maxDepth": [5, 6, 7, 8],
    "minInstancesPerNode": [7],
    "featureSubsetStrategy": ["0.6", "0.7", "0.8"],
}
FOREST_SPACE = {
    "numTrees": linspace_ints(600, 900, 8),
    "featureSubsetStrategy": ["sqrt"],
    "maxDepth": [12, 15, 18, 21, 24],
    "minInstancesPerNode": [2, 3, 4],
    "bootstrap": [True],
}
DRAWS, FOLDS, SEED = 20, 5, 1001


def draw(space: dict[str, Sequence], n_iter: int, seed: int) -> list[dict]:
    """``n_iter`` grid points without replacement, all of a smaller grid."""
    grid = [dict(zip(space, values)) for values in product(*space.values())]
    return random.Random(seed).sample(grid, min(n_iter, len(grid)))


def random_search(
    est: Estimator,
    space: dict[str, Sequence],
    train: DataFrame,
    n_iter: int = DRAWS,
    fold: str = "fold",
    folds: int = FOLDS,
    seed: int = SEED,
    parallelism: int = 2,
) -> tuple[dict, float, DataFrame, object]:
    """Best parameters, best mean AUC, all results and the refitted model.

    ``train`` is assembled and carries the fold number. The first draw wins a
    tie. The result table has one row per draw.
    """
    spark = train.sparkSession
    shared_dir(spark)
    draws = draw(space, n_iter, seed)
    maps = [{est.getParam(name): value for name, value in d.items()} for d in draws]
    evaluator = BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0)
    search = CrossValidator(
        estimator=est,
        estimatorParamMaps=maps,
        evaluator=evaluator,
        numFolds=folds,
        foldCol=fold,
        parallelism=parallelism,
    ).fit(train)
    rows = [
        (i, {k: str(v) for k, v in d.items()}, float(a), float(s))
        for i, (d, a, s) in enumerate(zip(draws, search.avgMetrics, search.stdMetrics))
    ]
    results = spark.createDataFrame(
        rows, "draw int, params map<string,string>, mean_auc double, std_auc double"
    )
    best = max(range(len(draws)), key=lambda i: search.avgMetrics[i])
    return draws[best], search.avgMetrics[best], results, search.bestModel
