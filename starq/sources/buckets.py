"""Catalog layers whose tables are bucketed by key.

Rows that have a key lie in one file per bucket, sorted by it, so that joins and
aggregates on the key need no exchange of the table. Rows without a key would all
share one bucket; they stand apart, in files of even size, and a view joins both.
There the key is a literal NULL: a filter for rows with a key prunes that side while
planning, and what is left is the bucketed scan alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

_MARK = "__v_"


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def bucket_layer(
    spark: SparkSession, tables: Mapping[str, DataFrame], keys: Mapping[str, str], database: str,
    location: str | None = None, buckets: int | None = None,
) -> list[str]:
    """Write tables to a catalog database, each bucketed by its key, and switch its names to them.

    `buckets` defaults to the session's shuffle partitions; fewer would make the engine
    shuffle both sides of a join again. All data is written before the first name is
    switched; a view is replaced as a whole, several tables one after another. Tables of
    earlier runs go last. A table without its key column, or without a key in `keys`, is
    kept as it is. Returns the names that were switched.

    A key may be NULL in any number of rows. Rows with equal keys share a bucket: a key
    that few values fill is not one to bucket by.
    """
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_ident(database)}{where}")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    before = {t.name: t.tableType for t in spark.catalog.listTables(database) if not t.isTemporary}
    version = _MARK + uuid.uuid4().hex
    views = {}
    for name, df in tables.items():
        key, columns = keys.get(name), ", ".join(map(_ident, df.columns))
        keyed = key in df.columns

        def save(writer, part: str) -> str:
            stored = f"{_ident(database)}.{_ident(f'{name}{version}_{part}')}"
            writer.format("parquet").saveAsTable(stored)
            return stored

        if not keyed:
            views[name] = f"SELECT {columns} FROM {save(df.write, 'rows')}"
            continue
        with_key = df.where(f"{_ident(key)} is not null").repartition(buckets, F.col(_ident(key)))
        bucketed = save(with_key.write.bucketBy(buckets, key).sortBy(key), "keyed")
        apart = save(df.where(f"{_ident(key)} is null").write, "unkeyed")
        null = f"CAST(NULL AS {df.schema[key].dataType.simpleString()}) AS {_ident(key)}"
        rest = ", ".join(null if c == key else _ident(c) for c in df.columns)
        views[name] = f"SELECT {columns} FROM {bucketed} UNION ALL SELECT {rest} FROM {apart}"
    for name, sql in views.items():
        if before.get(name.lower(), "VIEW") != "VIEW":
            spark.sql(f"DROP TABLE {_ident(database)}.{_ident(name)}")
        spark.sql(f"CREATE OR REPLACE VIEW {_ident(database)}.{_ident(name)} AS {sql}")
    for old in before:
        name, mark, _ = old.partition(_MARK)
        if mark and name in {n.lower() for n in views}:
            spark.sql(f"DROP TABLE IF EXISTS {_ident(database)}.{_ident(old)}")
    return list(views)


def bucketed_tables(spark: SparkSession, database: str, keys: Mapping[str, str]) -> set[str]:
    """The tables of a database that `bucket_layer` keeps by the given keys at present."""
    names = {t.name for t in spark.catalog.listTables(database) if not t.isTemporary}
    found = set()
    for stored in names:
        name, mark, part = stored.partition(_MARK)
        if mark and part.endswith("_keyed") and name in keys:
            columns = spark.catalog.listColumns(f"{_ident(database)}.{_ident(stored)}")
            if any(c.isBucket and c.name == keys[name] for c in columns):
                found.add(name)
    return found
