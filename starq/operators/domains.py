"""Keys of junk dimensions as expressions: ranks in a bitmap of the domains' product.

Each attribute has a small domain of sorted values. A combination's place is its
mixed-radix number over those domains, so places ascend as the combinations do. One
pass over the fact gathers which places occur, kept as 64-bit words; a combination's key
is the number of marked places up to its own, looked up by place. So the fact gets its keys by an expression,
without a join, and the dimension is read off the bitmap, without a sort.

Sizes are checked, not assumed: an attribute with more than `MOST_VALUES` values, or a
product above `MOST_PLACES`, gives no domain, and the caller numbers and joins a set.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from itertools import accumulate
from math import prod

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starq.session import stage as keep_staged

MOST_VALUES = 64
MOST_PLACES = 4096
_WORD = 64


@dataclass(frozen=True)
class Domain:
    """The attributes of a dimension, and for each the sorted values it may have."""

    attributes: tuple[str, ...]
    values: tuple[tuple, ...]

    @property
    def places(self) -> int:
        return prod(len(v) for v in self.values)

    @property
    def strides(self) -> list[int]:
        return [prod(len(v) for v in self.values[i + 1:]) for i in range(len(self.values))]

    def place(self) -> Column:
        """The combination's number from 0; NULL where a value is NULL or outside its domain.

        Every attribute occurs once in the expression, however costly what stands behind it is.
        """
        out = F.lit(0).cast("bigint")
        for name, values, stride in zip(self.attributes, self.values, self.strides):
            at = F.array_position(F.array(*[F.lit(v) for v in values]), F.col(name))
            # Position 0 stands for an absent value.
            out = out + F.get(_longs([None, *range(0, len(values) * stride, stride)]), at.cast("int"))
        return out


def _longs(values: Sequence[int | None]) -> Column:
    """A constant array."""
    return F.expr(f"array({', '.join('null' if v is None else f'{v}L' for v in values)})")


@dataclass(frozen=True)
class JunkKey:
    """A domain and its bitmap."""

    name: str
    domain: Domain
    words: tuple[int, ...]

    def key(self) -> Column:
        """The key of a row's combination, from 1; NULL where the combination did not occur."""
        bits = [word >> i & 1 for word in self.words for i in range(_WORD)][: self.domain.places]
        ranks = [rank if bit else None for bit, rank in zip(bits, accumulate(bits))]
        return F.get(_longs(ranks).cast("array<bigint>"), self.domain.place().cast("int"))

    def dimension(self, spark: SparkSession) -> DataFrame:
        """The key and the attributes of every combination that occurs."""
        rows = spark.range(self.domain.places).withColumnRenamed("id", "_place")
        columns = {
            name: F.element_at(
                F.array(*[F.lit(v) for v in values]),
                (F.pmod(F.floor(F.col("_place") / stride), F.lit(len(values))) + 1).cast("int"),
            )
            for name, values, stride in zip(self.domain.attributes, self.domain.values, self.domain.strides)
        }
        return rows.withColumns(columns).select(self.key().alias(self.name), *columns).where(F.col(self.name).isNotNull())


def _small_domains(
    df: DataFrame, names: Sequence[str], limit: int, stage: Callable[[DataFrame], DataFrame]
) -> dict[str, tuple]:
    """The values of those text columns that have few, found in one pass.

    A column's distinct values are counted where they are; only columns within the limit
    send their values.
    """
    if not names:
        return {}
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(n).cast("string").alias("v")) for i, n in enumerate(names)])
    found = df.select(F.explode(pairs).alias("p")).select("p.i", "p.v").where("v is not null").distinct()
    distinct = stage(found)
    sizes = {r.i: r.n for r in distinct.groupBy("i").agg(F.count("*").alias("n")).collect()}
    few = [i for i in range(len(names)) if sizes.get(i, 0) <= limit]
    rows = distinct.where(F.col("i").isin(few)).collect()
    return {names[i]: tuple(sorted(r.v for r in rows if r.i == i)) for i in few}


def junk_keys(
    df: DataFrame, dimensions: Mapping[str, tuple[str, Sequence[str]]],
    stage: Callable[[DataFrame], DataFrame] = keep_staged,
    most_values: int = MOST_VALUES, most_places: int = MOST_PLACES,
) -> dict[str, JunkKey]:
    """Keys for those dimensions (name -> key, attributes) whose domains are small enough.

    Attributes are texts or booleans without NULLs. df should be staged: it is read twice.
    """
    types = dict(df.dtypes)
    usable = {n: d for n, d in dimensions.items() if all(types.get(a) in ("string", "boolean") for a in d[1])}
    texts = sorted({a for _, attributes in usable.values() for a in attributes if types[a] == "string"})
    values = _small_domains(df, texts, most_values, stage)
    values.update({a: (False, True) for _, attributes in usable.values() for a in attributes if types[a] == "boolean"})
    domains = {
        n: Domain(tuple(attributes), tuple(values[a] for a in attributes))
        for n, (_, attributes) in usable.items() if all(values.get(a) for a in attributes)
    }
    domains = {n: d for n, d in domains.items() if d.places <= most_places}
    if not domains:
        return {}
    # One row: a set of `most_places` numbers at most for each dimension.
    row = df.agg(*[F.collect_set(d.place()).alias(n) for n, d in domains.items()]).first()
    return {n: JunkKey(usable[n][0], d, _bitmap(row[n], d.places)) for n, d in domains.items()}


def _bitmap(places: Sequence[int], count: int) -> tuple[int, ...]:
    """The places as bits of signed words."""
    words = [0] * -(-count // _WORD)
    for p in places:
        words[p // _WORD] |= 1 << p % _WORD
    return tuple(w - (1 << _WORD) if w >> (_WORD - 1) else w for w in words)
