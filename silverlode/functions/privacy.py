"""Constant masks for tagged columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Mask text per tag.
MASKS = {"PII": "** PII **", "EMAIL": "** EMAIL **", "PHONE": "** PHONE **"}


def mask_columns(df: DataFrame, tags: Mapping[str, str]) -> DataFrame:
    """Replace each tagged column by its mask.

    The mask is a constant, also for NULL: whether a value exists stays hidden too.
    """
    unknown = sorted(set(tags.values()) - set(MASKS))
    if unknown:
        raise ValueError(f"unknown mask tags: {unknown}")
    return df.select(
        *[F.lit(MASKS[tags[name]]).alias(name) if name in tags else F.col(name) for name in df.columns]
    )
