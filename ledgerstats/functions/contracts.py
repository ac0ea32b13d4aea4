"""Text of the entity catalogue: contract lists, identifiers, category flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How contracts are listed, and which category sets which flag.
CONTRACT_SEPARATOR = ", "
CATEGORY_FLAGS = {
    "is_app": "app",
    "is_nft": "nft",
    "is_guild": "guild",
    "is_defi": "defi",
    "is_dao": "dao",
}


def identifier(text: Column) -> Column:
    """An identifier without surrounding spaces and without any single quote."""
    return F.replace(F.trim(text), F.lit("'"), F.lit(""))


def category_flags(category: Column) -> list[Column]:
    return [
        F.coalesce(F.contains(category, F.lit(word)), F.lit(False)).alias(flag)
        for flag, word in CATEGORY_FLAGS.items()
    ]
