"""Equi-joins in the null-matching form the pipeline needs.

No join here is forced to broadcast: small sides are broadcast by the engine
when their measured size allows it, and skewed keys of the rest are split at run
time (see `starq.session`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from starq.operators.keys import require_unique


def enrich(
    left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool = True, guard: str | None = None
) -> DataFrame:
    """m:1 left join that adds the columns of `right` the left side lacks.

    `guard` names the join in the error raised when a key of `right` is not
    unique; without it the caller vouches for uniqueness.
    """
    keys = list(keys)
    new = [c for c in right.columns if c not in left.columns]
    side = right.select(*keys, *new)
    if guard:
        side = require_unique(side, keys, guard)
    if not null_safe:
        return left.join(side, keys, "left")
    side = side.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *new)
    condition = F.lit(True)
    for k in keys:
        condition &= left[k].eqNullSafe(side[f"_k_{k}"])
    return left.join(side, condition, "left").select(*left.columns, *new)


def missing_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in df.columns]


def require_columns(df: DataFrame, columns: Sequence[str], what: str) -> None:
    missing = missing_columns(df, columns)
    if missing:
        raise ValueError(f"{what} is missing columns: {missing}")
