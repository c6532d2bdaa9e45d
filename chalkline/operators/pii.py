"""Hashing, generalising and looking for personal data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chalkline.functions.exprs import birth_year, hashed

# Column names that must not reach the published tables.
FORBIDDEN_COLUMNS = ("first_name", "last_name", "email", "birth_date", "student_name", "given_name", "family_name")

# Shapes of personal data looked for inside string columns.  One character before
# the "@" is enough to find an address and keeps the search linear in the text.
PII_SHAPES = {
    "email": r"[A-Za-z0-9._%+-]@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "birth_date": r"\b(19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}\b",
    "phone": r"\b[0-9]{3}-[0-9]{3}-[0-9]{4}\b",
}

# How each kind of field is masked and in which layer.
MASKING = {
    "first_name": ("direct identifier", "SHA-256 hash", "silver"),
    "last_name": ("direct identifier", "SHA-256 hash", "silver"),
    "email": ("direct identifier", "SHA-256 hash", "silver"),
    "birth_date": ("quasi identifier", "generalised to birth year", "silver"),
}


def hash_pii_columns(
    df: DataFrame,
    name_cols: Sequence[str],
    email_col: str,
    birth_date_col: str,
    canonicalize: bool = False,
) -> DataFrame:
    """Replace names and e-mail by hashes and the birth date by its year.

    Other columns keep their order; hashes and ``birth_year`` follow them.
    """
    gone = {*name_cols, email_col, birth_date_col}
    return df.select(
        *[c for c in df.columns if c not in gone],
        *[hashed(c, canonicalize).alias(f"{c}_hash") for c in name_cols],
        hashed(email_col, canonicalize).alias("email_hash"),
        birth_year(birth_date_col).alias("birth_year"),
    )


def forbidden_columns(df: DataFrame, names: Sequence[str] = FORBIDDEN_COLUMNS) -> DataFrame:
    """One row per column of ``df`` that must not be there; reads the schema only."""
    found = sorted(set(df.columns) & set(names))
    return df.sparkSession.createDataFrame([(c,) for c in found], "column_name string")


def pii_inventory(df: DataFrame, shapes: dict[str, str] | None = None) -> DataFrame:
    """Hits of every shape in every string column, counted in one pass over the table."""
    shapes = shapes or PII_SHAPES
    texts = [c for c, t in df.dtypes if t == "string"]
    cells = [(c, s) for c in texts for s in shapes]
    counts = df.agg(*[F.count_if(F.col(c).rlike(shapes[s])).alias(f"h{i}") for i, (c, s) in enumerate(cells)])
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(s).alias("shape"),
            F.col(f"h{i}").alias("hits"),
            F.lit(c in FORBIDDEN_COLUMNS).alias("forbidden_name"),
        )
        for i, (c, s) in enumerate(cells)
    ]
    return counts.select(F.inline(F.array(*rows)))


def masking_table(df: DataFrame) -> DataFrame:
    """Field, class, masking method and layer for the masked fields found in ``df``."""
    present = [f for f in MASKING if f"{f}_hash" in df.columns or (f == "birth_date" and "birth_year" in df.columns)]
    rows = [(f, *MASKING[f]) for f in present]
    return df.sparkSession.createDataFrame(rows, "field string, classification string, method string, layer string")
