"""Masking of personal data, driven by column tags."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TAG = "pii_category"

# Who sees clear text, which customer columns are tagged, mask texts.
EXEMPT_ROLES = ("data_engineers", "compliance_officer")
CUSTOMER_TAGS = {"emirates_id": "national_id", "email": "email", "phone": "phone"}
FULL_MASK = "***MASKED***"


def _masked_national_id(c: Column) -> Column:
    return F.concat(F.lit("***-"), F.right(c, F.lit(4)))


def _masked_email(c: Column) -> Column:
    at = F.instr(c, "@")
    # Without an @ there is no domain to keep, so nothing of the value is kept.
    return F.when(at == 0, F.lit(FULL_MASK)).otherwise(
        F.concat(F.substring(c, 1, 3), F.lit("***@***"), F.substr(c, at + 1))
    )


def _masked_phone(c: Column) -> Column:
    return F.concat(F.substring(c, 1, 4), F.lit("******"), F.right(c, F.lit(2)))


MASKS = {"national_id": _masked_national_id, "email": _masked_email, "phone": _masked_phone}


def mask(c: Column | str, category: Column | str) -> Column:
    """Mask one value. ``category`` is a category name, or a column of names."""
    value = F.col(c) if isinstance(c, str) else c
    if isinstance(category, str):
        return MASKS[category](value) if category in MASKS else F.lit(FULL_MASK)
    chosen = F.lit(FULL_MASK)
    for name, expression in MASKS.items():
        chosen = F.when(category == name, expression(value)).otherwise(chosen)
    return chosen


def register_mask(spark: SparkSession, name: str = "governed_mask") -> None:
    """Offer the mask to SQL as a temporary function of (value, category)."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(value STRING, category STRING) RETURNS STRING
        RETURN CASE category
            WHEN 'national_id' THEN concat('***-', right(value, 4))
            WHEN 'email' THEN if(instr(value, '@') = 0, '{FULL_MASK}',
                concat(substr(value, 1, 3), '***@***', substr(value, instr(value, '@') + 1)))
            WHEN 'phone' THEN concat(substr(value, 1, 4), '******', right(value, 2))
            ELSE '{FULL_MASK}' END
    """)


def tag(df: DataFrame, tags: Mapping[str, str] = CUSTOMER_TAGS) -> DataFrame:
    """Record the category of each column in its metadata; it follows the column."""
    for name, category in tags.items():
        df = df.withMetadata(name, {**df.schema[name].metadata, TAG: category})
    return df


def masked_view(df: DataFrame, role: str, exempt: Collection[str] = EXEMPT_ROLES) -> DataFrame:
    """The frame as ``role`` may see it: every tagged column masked unless exempt."""
    if role in exempt:
        return df
    return df.select(
        *[
            mask(F.col(f.name), f.metadata[TAG]).alias(f.name, metadata=f.metadata) if TAG in f.metadata else F.col(f.name)
            for f in df.schema.fields
        ]
    )
