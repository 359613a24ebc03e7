"""The cleaning job: raw wide title table → cleaned wide table.

Fixed order (the reference leaves trigger order open; imputation needs the
episode fill first): drop blanks → trim studio → fill sentinels → parse
duration → impute duration → (guard) → collapse rating → de-duplicate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfwise.operators import clean, constraints


def clean_titles(raw: DataFrame, guard: str | None = None, strict_duration: bool = False) -> DataFrame:
    """Run C1→C9 on a raw wide title table.

    ``guard``: None (no validation), ``"strict"`` (raise on any violation,
    the reference's whole-statement rollback) or ``"drop"`` (keep only
    valid rows; the rejected ones are available from
    ``constraints.split_valid``).
    """
    df = (raw.transform(clean.drop_blank_rows)
          .transform(clean.trim_column)
          .transform(clean.fill_missing)
          .transform(lambda d: clean.parse_duration(d, strict=strict_duration))
          .transform(clean.impute_duration))
    if guard == "strict":
        df = constraints.validate(df, strict=True)
    elif guard == "drop":
        df, _ = constraints.split_valid(df)
    return df.transform(clean.collapse_rating).transform(clean.dedupe_by_key)
