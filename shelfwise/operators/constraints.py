"""Constraint checks (V1-V6) as violation frames.

The reference rejects a whole statement when any changed row breaks a rule
(trigger + ROLLBACK) and enforces PK/FK/UNIQUE/length in storage. Here every
rule is a distributed filter/aggregate/anti-join that returns the offending
rows; ``validate(strict=True)`` turns a non-empty result into an error before
anything is written, ``split_valid`` keeps the good rows and reports the rest.
NULL measures pass the range rules (SQL three-valued logic).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values that must equal the reference's -----------------------
SCORE_MIN, SCORE_MAX = 0.0, 10.0          # score outside [0, 10] is rejected
RANKING_MIN_EXCLUSIVE = 0                 # ranking <= 0 is rejected
COUNT_MIN = 0                             # members/favorites < 0 are rejected
GENRE_NAME_MAX, STUDIO_NAME_MAX = 500, 255
RULE_MESSAGES = {
    "score_range": "Score must be between 0 and 10",
    "ranking_positive": "Ranking must be a positive number",
    "counts_non_negative": "Members and Favorites must be non-negative",
}
# -------------------------------------------------------------------------


def _rules() -> dict[str, Column]:
    return {
        "score_range": (F.col("score") < SCORE_MIN) | (F.col("score") > SCORE_MAX),
        "ranking_positive": F.col("ranking") <= RANKING_MIN_EXCLUSIVE,
        "counts_non_negative": (F.col("members") < COUNT_MIN) | (F.col("favorites") < COUNT_MIN),
    }


def check_score(df: DataFrame) -> DataFrame:
    """V1: rows with score < 0 or > 10."""
    return df.filter(F.coalesce(_rules()["score_range"], F.lit(False)))


def check_ranking(df: DataFrame) -> DataFrame:
    """V2: rows with ranking <= 0."""
    return df.filter(F.coalesce(_rules()["ranking_positive"], F.lit(False)))


def check_counts(df: DataFrame) -> DataFrame:
    """V3: rows with members < 0 or favorites < 0."""
    return df.filter(F.coalesce(_rules()["counts_non_negative"], F.lit(False)))


def violations(df: DataFrame, key: str = "title_id") -> DataFrame:
    """All range-rule violations as (key, rule, message) rows; a row breaking
    two rules appears twice. One scan, no shuffle."""
    rules = _rules()
    flags = F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()])
    msg = F.create_map(*[x for n, m in RULE_MESSAGES.items() for x in (F.lit(n), F.lit(m))])
    return (df.select(key, F.explode(F.array_compact(flags)).alias("rule"))
            .withColumn("message", msg[F.col("rule")]))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows)."""
    bad = reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in _rules().values()])
    return df.filter(~bad), df.filter(bad)


def validate(df: DataFrame, strict: bool = True) -> DataFrame:
    """Raise (strict) on the first violated rule, as the reference's guard
    rolls the whole statement back; else return only the valid rows."""
    if not strict:
        return split_valid(df)[0]
    flags = df.agg(*[F.max(F.coalesce(cond, F.lit(False))).alias(name) for name, cond in _rules().items()]).first()
    for name in _rules():
        if flags[name]:
            raise ValueError(RULE_MESSAGES[name])
    return df


def check_primary_key(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """V4: key values that are NULL or occur more than once, with their count.

    A partial aggregate: the hot-key case costs one row per map task."""
    keys = [key] if isinstance(key, str) else list(key)
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.filter((F.col("n_rows") > 1) | null_key)


def check_foreign_key(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """V5: child rows whose non-NULL foreign key has no parent row."""
    return (child.filter(F.col(fk).isNotNull())
            .join(parent.select(F.col(pk).alias(fk)), on=fk, how="left_anti"))


def check_length(df: DataFrame, col: str, max_len: int) -> DataFrame:
    """V6: values longer than the declared NVARCHAR width."""
    return df.filter(F.length(F.col(col)) > max_len)
