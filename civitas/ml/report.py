"""J-20: the tables of a comparison page, from published outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import axis_limits
from ..operators.joins import distinct_union
from ..operators.profile import crosstab
from . import compare as C

METRICS = ["accuracy_test", "precision_weighted_test", "recall_weighted_test", "f1_weighted_test", "r2_test", "mae_test", "rmse_test"]


def comparison_tables(board: DataFrame | None = None, classes: DataFrame | None = None, values: DataFrame | None = None,
                      year_col: str = "annee", year=None, labels=None) -> dict[str, Callable[[], DataFrame]]:
    """The page's tables by name, each planned only when asked for; an output
    that is missing leaves its tables out.

    ``board``: ``metrics``, the test metrics it has, long. ``classes`` (y_true,
    y_pred): ``confusion``. ``values`` (y_true, y_pred): of one ``year`` or
    all, ``residuals`` and ``limits``, the common range of both axes. Both:
    ``years``, the years that occur, as text."""
    def of_year(df):
        return df if year is None or year_col not in df.columns else df.where(F.col(year_col).cast("string") == str(year))

    out: dict[str, Callable[[], DataFrame]] = {}
    if board is not None:
        out["metrics"] = lambda: C.metric_comparison(board, METRICS)
    if classes is not None:
        out["confusion"] = lambda: crosstab(of_year(classes), "y_true", "y_pred", labels)
    if values is not None:
        out["residuals"] = lambda: C.residual_table(of_year(values), "y_true", "y_pred")
        out["limits"] = lambda: axis_limits(of_year(values), "y_true", "y_pred")
    dated = [df.select(F.col(year_col).cast("string").alias(year_col)) for df in (classes, values) if df is not None and year_col in df.columns]
    if dated:
        out["years"] = lambda: distinct_union(dated, year_col)
    return out
