"""Regression scores per vector dimension."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def regression_eval(
    predictions: DataFrame,
    label: str = "y",
    predicted: str = "p",
    by: list[str] | None = None,
) -> DataFrame:
    """MSE, RMSE, MAE and R² for each dimension over all rows and steps.

    ``predicted`` holds one vector per step (``[T, D]``); the label vector is
    the target of every step, or holds one per step, too. The aggregate combines on the map side, so only
    dimensions times partitions are shuffled.
    """
    by = by or []
    if isinstance(predictions.schema[label].dataType.elementType, T.ArrayType):
        pairs = F.arrays_zip(F.col(label).alias("y"), F.col(predicted).alias("p"))
        steps = predictions.select(*by, F.explode(pairs).alias("_step")).select(*by, "_step.y", "_step.p")
    else:
        steps = predictions.select(*by, F.col(label).alias("y"), F.explode(predicted).alias("p"))
    cells = steps.select(*by, F.posexplode(F.arrays_zip("y", "p")))
    y = F.col("col.y").cast("double")
    p = F.col("col.p").cast("double")
    scores = cells.groupBy(*by, F.col("pos").alias("dim")).agg(
        F.count("*").alias("n"),
        F.avg((y - p) * (y - p)).alias("mse"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.var_pop(y).alias("_spread"),
    )
    # A constant label column has no spread and so no R².
    r2 = F.lit(1.0) - F.try_divide("mse", "_spread")
    return scores.select(
        *by, "dim", "n", "mse", F.sqrt("mse").alias("rmse"), "mae", r2.alias("r2")
    )


def macro_average(scores: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Plain mean of each score over the dimensions; R² over those that have one."""
    return scores.groupBy(*(by or [])).agg(
        F.count("*").alias("dims"),
        F.count("r2").alias("r2_dims"),
        F.avg("mse").alias("mse"),
        F.avg("rmse").alias("rmse"),
        F.avg("mae").alias("mae"),
        F.avg("r2").alias("r2"),
    )
