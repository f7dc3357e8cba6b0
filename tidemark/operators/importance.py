"""Which columns a fitted model relies on."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoderModel, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F


def slot_names(model: PipelineModel) -> list[tuple[str, str]]:
    """(source column, slot name) of every vector slot, in assembler input order.

    The number of slots of an encoded column comes from its indexer, never from name prefixes.
    """
    labels: dict[str, list[str]] = {}
    source_of: dict[str, str] = {}
    encoded: dict[str, str] = {}
    inputs: list[str] = []
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel) and stage.isSet("inputCols"):
            for source, out, values in zip(stage.getInputCols(), stage.getOutputCols(), stage.labelsArray):
                labels[out], source_of[out] = list(values), source
        elif isinstance(stage, OneHotEncoderModel):
            encoded.update(zip(stage.getOutputCols(), stage.getInputCols()))
        elif isinstance(stage, VectorAssembler):
            inputs = stage.getInputCols()
    slots = []
    for name in inputs:
        if name in encoded:
            index = encoded[name]
            slots += [(source_of[index], f"{source_of[index]}={v}") for v in labels[index]]
        else:
            slots.append((name, name))
    return slots


def slot_weights(model: PipelineModel, slots: int) -> list[float]:
    """Tree importances, absolute linear coefficients, or equal shares for other models."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        return [float(v) for v in last.featureImportances.toArray()]
    if hasattr(last, "coefficients"):
        return [abs(float(v)) for v in last.coefficients.toArray()]
    return [1.0 / slots] * slots


def slot_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """One row per vector slot: index, source column, slot name, importance."""
    names = slot_names(model)
    weights = slot_weights(model, len(names))
    if len(weights) != len(names):
        raise ValueError(f"model has {len(weights)} slots, the assembler {len(names)}")
    rows = [(i, source, slot, w) for i, ((source, slot), w) in enumerate(zip(names, weights))]
    return spark.createDataFrame(rows, "idx int, feature string, slot string, importance double")


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Importance summed over the slots of each source column, largest first."""
    return (slot_importance(spark, model).groupBy("feature").agg(F.sum("importance").alias("importance"))
            .orderBy(F.col("importance").desc(), "feature"))
