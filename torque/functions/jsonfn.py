"""JSON columns: validate, parse and serialise on the executors.

A JSON column holds text that must parse.  ``try_parse_json`` gives NULL for
text that does not, so validity is a plain column test and invalid rows can be
routed to quarantine instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Test fixture rule: every tenth event loses its closing character, so some
# rows hold invalid JSON (the driver's events all parse).
DAMAGE_MODULUS = 10


def damage_rule(event_id: Column, text: Column) -> Column:
    return F.when(event_id % DAMAGE_MODULUS == 0,
                  F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)


def is_valid_json(text: Column) -> Column:
    """True when the text parses, false when it does not, NULL for NULL."""
    return F.when(text.isNotNull(), F.try_parse_json(text).isNotNull())


def json_check(df: DataFrame, column: str, fields: Mapping[str, str] | None = None) -> DataFrame:
    """Adds ``props_valid`` and one typed column per requested top-level field
    (NULL when the text is invalid or the field is absent)."""
    v = F.try_parse_json(F.col(column))
    out = df.withColumn("props_valid", is_valid_json(F.col(column)))
    for name, typ in (fields or {}).items():
        out = out.withColumn(name, F.try_variant_get(v, f"$.{name}", typ))
    return out


def split_valid(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows) by JSON validity of ``column``.  A NULL
    column is allowed (stored as NULL, never parsed), so it is valid."""
    ok = F.coalesce(is_valid_json(F.col(column)), F.lit(True))
    return df.filter(ok), df.filter(~ok)


def to_json_text(c: Column) -> Column:
    """Serialise a struct or map column to JSON text."""
    return F.to_json(c)
