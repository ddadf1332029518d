"""Column expressions that build records out of fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def without_commas(field: Column) -> Column:
    return F.replace(field, F.lit(","), F.lit(""))


def csv_record(key: Column, *fields: Column) -> Column:
    """`key,field,...` with the commas taken out of the fields; a missing field is left empty."""
    parts = [key.cast("string"), *(without_commas(field) for field in fields)]
    return F.concat_ws(",", *(F.coalesce(part, F.lit("")) for part in parts))


def tsv_record(*fields: Column) -> Column:
    """Fields joined by tabs; a missing field is left empty. The fields themselves hold no tabs."""
    return F.concat_ws("\t", *(F.coalesce(field.cast("string"), F.lit("")) for field in fields))
