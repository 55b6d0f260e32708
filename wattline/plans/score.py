"""Batch scoring: one plan for any number of files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from wattline.operators.contracts import RAW, Contract
from wattline.operators.models import load_model, predict
from wattline.plans.prepare import PrepareOptions, prepare
from wattline.sources.delimited import BLANK_NAME, normalize_header, scan_directory
from wattline.sources.tables import load_champion, save_predictions

SOURCE = "source_file"


def predict_batch(
    df: DataFrame, model: PipelineModel, options: PrepareOptions = PrepareOptions(), keys: Sequence[str] = ()
) -> DataFrame:
    """The training transforms, then the model: (keys, timestamp, prediction)."""
    engineered = prepare(df, options, keys)
    return predict(model, engineered.drop(options.target), [*keys, "timestamp"])


def score_files(
    spark: SparkSession, path: str, model: PipelineModel, options: PrepareOptions = PrepareOptions()
) -> DataFrame | None:
    """Predictions for every file of a directory; values never fill from one file into another.

    The files together must keep the raw contract, as training data must.
    """
    raw = scan_directory(spark, path)
    if raw is None:
        return None
    Contract(RAW, "raw").check(raw.drop(SOURCE))
    names = ["timestamp" if c == BLANK_NAME else c for c in raw.columns]
    return predict_batch(normalize_header(raw.toDF(*names)), model, options, [SOURCE])


def score_job(
    spark: SparkSession, path: str, registry: str, out: str, options: PrepareOptions = PrepareOptions()
) -> str | None:
    """Load the champion, score the directory, write one folder per file."""
    model = load_model(load_champion(spark, registry)["model_path"])
    predictions = score_files(spark, path, model, options)
    return None if predictions is None else save_predictions(predictions, out, SOURCE)
