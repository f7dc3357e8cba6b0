"""Saving fitted models and loading the one a registry stage points at."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from tidemark.operators.registry import current_stages, latest_version


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def stage_model_row(versions: DataFrame, events: DataFrame, name: str, stage: str = "Production") -> DataFrame:
    """Version, source folder and run of the model in a stage: at most one row."""
    mine = events.where(F.col("name") == name)
    return latest_version(current_stages(mine), stage).join(
        versions.where(F.col("name") == name), ["name", "version"])


def load_stage_model(versions: DataFrame, events: DataFrame, name: str,
                     stage: str = "Production") -> tuple[PipelineModel, int] | None:
    """The fitted model and its version, or None when nothing is in that stage."""
    row = stage_model_row(versions, events, name, stage).first()
    return None if row is None else (PipelineModel.load(row["source"]), row["version"])
