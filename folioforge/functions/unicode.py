"""Functions that need Unicode decomposition, which Spark lacks: Arrow-batched UDFs."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _ascii_slug(title: str, limit: int) -> str:
    plain = unicodedata.normalize("NFKD", title).encode("ascii", "ignore").decode().lower()
    slug = re.sub(r"[^a-z0-9]+", "-", plain).strip("-")
    return slug[:limit].rstrip("-") or "section"


def slugify(c: Column, limit: int = 60) -> Column:
    """ASCII slug of at most ``limit`` characters; ``section`` where nothing is left; null stays null."""

    @F.pandas_udf("string")
    def run(titles: pd.Series) -> pd.Series:
        return titles.map(lambda t: None if t is None else _ascii_slug(t, limit))

    return run(c)


def normalize_title(c: Column) -> Column:
    """Lower case, without combining marks, white space collapsed; null stays null."""

    @F.pandas_udf("string")
    def run(titles: pd.Series) -> pd.Series:
        def one(t: str | None) -> str | None:
            if t is None:
                return None
            marks = unicodedata.normalize("NFKD", t.lower())
            return " ".join("".join(c for c in marks if not unicodedata.combining(c)).split())

        return titles.map(one)

    return run(c)


def python_round(c: Column, digits: int = 1) -> Column:
    """Rounding of the binary value, half to even, as the data model's coordinates are rounded."""

    @F.pandas_udf("double")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if pd.isna(v) else round(v, digits))

    return run(c)
