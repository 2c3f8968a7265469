"""Technical metadata of the raw layer."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_ingest_metadata(
    df: DataFrame,
    source: str,
    batch_ts: datetime | str,
    has_phi: bool = False,
    has_pii: bool = False,
) -> DataFrame:
    """Add ``_loaded_at``, ``_source``, ``_has_phi`` and ``_has_pii``.

    The batch timestamp is a parameter, so rebuilding a batch after a failure gives equal rows.
    """
    return df.select(
        "*",
        F.lit(batch_ts).cast("timestamp").alias("_loaded_at"),
        F.lit(source).alias("_source"),
        F.lit(has_phi).alias("_has_phi"),
        F.lit(has_pii).alias("_has_pii"),
    )
