"""The sequence features are stateless column expressions, so a stream of sites takes them as a table does."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.functions.sequence import feature_columns


def stream_features(sites: DataFrame, names: list[str] | None = None) -> DataFrame:
    """All columns of a (streaming) frame and the features of its sequence column."""
    return sites.select("*", *feature_columns(F.col("sequence"), names))
