"""Any table as a message source."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RAW_COLUMNS = {
    "file": "string", "id": "bigint", "type": "string", "date": "string",
    "date_unixtime": "string", "from_id": "string", "text": "string",
}


def from_table(df: DataFrame, mapping: Mapping[str, Column | str]) -> DataFrame:
    """Raw messages from a table. Columns left out are null, ``type`` defaults to message."""
    unknown = sorted(set(mapping) - set(RAW_COLUMNS))
    if unknown:
        raise ValueError(f"unknown message columns: {unknown}")
    defaults = {"type": F.lit("message")}

    def cell(name: str) -> Column:
        value = mapping.get(name, defaults.get(name, F.lit(None)))
        return (F.col(value) if isinstance(value, str) else value).cast(RAW_COLUMNS[name])

    return df.select(*[cell(name).alias(name) for name in RAW_COLUMNS])
