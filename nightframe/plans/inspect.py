"""Tables behind a stage inspection."""

from __future__ import annotations

from pyspark.sql import DataFrame

from nightframe.operators import stages as S
from nightframe.plans.preprocess import preprocess


def stage_table(lines: DataFrame, models: DataFrame, **options) -> DataFrame:
    """Every pixel at every stage, with the change from the stage before."""
    return S.stage_rows(preprocess(lines, models, snapshot=True, **options))
