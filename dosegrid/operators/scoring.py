"""Scoring of pair tables with any vectorised model function."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


def score_pairs(pairs: DataFrame, load: Callable[[], Callable[[pd.DataFrame], pd.Series]], keys: list[str], into: str = "prediction") -> DataFrame:
    """Keys and a prediction for each pair. `load` runs once in each task and gives the model; a batch on which it fails is scored row by row, and rows on which it fails get null."""
    schema = ", ".join(f"`{k}` {pairs.schema[k].dataType.simpleString()}" for k in keys) + f", `{into}` double"

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()

        def one(row: pd.DataFrame) -> float | None:
            try:
                return float(model(row).iloc[0])
            except Exception:
                return None

        for batch in batches:
            try:
                found = model(batch).astype("float64").to_numpy()
            except Exception:
                found = [one(batch.iloc[k : k + 1]) for k in range(len(batch))]
            yield batch[keys].assign(**{into: pd.array(found, dtype="float64")})

    return pairs.mapInPandas(score, schema)
