"""Surrogate ids that outlive a run: known keys keep theirs, new ones go on from the highest.

The registry is a layer (`sources.versions`) with one table of keys and ids and the
high-water mark in its manifest; keys of a run and the new mark become visible
together. Repeating a run with the same batch id adds nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starq.operators.keys import number_rows
from starq.session import stage as keep_staged
from starq.sources.versions import Layer

TABLE, MARK = "keys", "high"


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equal keys; NULL is a key like any other."""
    out = F.lit(True)
    for k in keys:
        out = out & left[k].eqNullSafe(right[f"_known_{k}"])
    return out


class KeyRegistry:
    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], start: int = 1):
        self.layer, self.keys, self.start = Layer(spark, folder), list(keys), start

    def known(self) -> DataFrame | None:
        """keys and `id` so far."""
        manifest = self.layer.manifest()
        return self.layer.read(TABLE, manifest) if TABLE in manifest.tables else None

    def high(self) -> int:
        return self.layer.manifest().marks.get(MARK, self.start - 1)

    def register(self, df: DataFrame, batch: str, order: Sequence[str] = ()) -> int:
        """Gives ids to the keys of df that have none, in order of their first appearance.

        order: columns whose smallest values count as a key's place (by default the keys
        themselves, NULL first). Returns how many keys are new.
        """
        manifest = self.layer.manifest()
        high = manifest.marks.get(MARK, self.start - 1)
        if TABLE in manifest.tables and batch in manifest.tables[TABLE]["batches"]:
            return 0
        place = F.min(F.struct(*order)).alias("_place") if order else F.lit(0).alias("_place")
        fresh = df.groupBy(*self.keys).agg(place)
        known = self.known()
        if known is not None:
            renamed = known.select(*[F.col(k).alias(f"_known_{k}") for k in self.keys])
            fresh = fresh.join(renamed, _same(fresh, renamed, self.keys), "left_anti")
        fresh = keep_staged(fresh)
        added = fresh.count()
        numbered = number_rows(fresh, ["_place", *self.keys], "id", high + 1).select(*self.keys, "id")
        self.layer.append(batch, {TABLE: numbered}, marks={MARK: high + added})
        return added

    def look_up(self, df: DataFrame, name: str) -> DataFrame:
        """df with its id as `name`: one join on the keys, NULL where a key is not registered."""
        known = self.known()
        if known is None:
            return df.withColumn(name, F.lit(None).cast("bigint"))
        known = known.select(*[F.col(k).alias(f"_known_{k}") for k in self.keys], F.col("id").alias("_id"))
        joined = df.join(known, _same(df, known, self.keys), "left")
        return joined.select(*[F.col(c) for c in df.columns], F.col("_id").alias(name))
