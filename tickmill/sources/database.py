"""SQL databases over JDBC: partitioned reads, and writes that executors stage and one transaction takes over.

A write first fills a staging table beside the target, from all executors, each batch in its own connection. Only then does
one transaction on the driver, whose statements the database runs, change the target; readers see the table before it or
after it. A run that is lost leaves a staging table, which the next one drops, so every write may be repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _execute(spark: SparkSession, url: str, statements: list[str]) -> list[int]:
    """Runs statements in one transaction; their row counts."""
    connection = spark._jvm.java.sql.DriverManager.getConnection(url)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        counts = [statement.executeUpdate(s) for s in statements]
        connection.commit()
        return counts
    except BaseException:
        connection.rollback()
        raise
    finally:
        connection.close()


def tables(spark: SparkSession, url: str) -> set[str]:
    """Lower-case names of the database's tables."""
    connection = spark._jvm.java.sql.DriverManager.getConnection(url)
    try:
        found, out = connection.getMetaData().getTables(None, None, None, None), set()
        while found.next():
            out.add(found.getString("TABLE_NAME").lower())
        return out
    finally:
        connection.close()


def read(spark: SparkSession, url: str, table: str, column: str | None = None, parts: int = 8, where: str | None = None) -> DataFrame:
    """A table, in `parts` ranges of a numeric column if one is given; `where`, a condition of the database's own SQL, is evaluated there, as are Spark's filters on columns. Nulls of the column are in the first range."""
    name = f"(SELECT * FROM {table} WHERE {where}) t" if where else table
    if column is None:
        return spark.read.jdbc(url, name)
    lo, hi = spark.read.jdbc(url, f"(SELECT min({column}) AS lo, max({column}) AS hi FROM {name if where else table + ' t'}) b").first()
    if lo is None:
        return spark.read.jdbc(url, name)
    return spark.read.jdbc(url, name, column=column, lowerBound=int(lo), upperBound=int(hi) + 1, numPartitions=parts)


def _staged(df: DataFrame, url: str, table: str, batch: int, parts: int | None) -> str:
    """A staging table with df's rows; columns have the target's types, nested ones travel as JSON."""
    spark, stage = df.sparkSession, f"{table}_staged"
    flat = df.select(*(F.to_json(f.name).alias(f.name) if f.dataType.typeName() in ("array", "struct", "map") else F.col(f.name) for f in df.schema))
    drop = [f"DROP TABLE {stage}"] if stage.lower() in tables(spark, url) else []
    _execute(spark, url, [*drop, f"CREATE TABLE {stage} AS SELECT {', '.join(df.columns)} FROM {table} WITH NO DATA"])
    (flat.repartition(parts) if parts else flat).write.mode("append").option("batchsize", batch).jdbc(url, stage)
    return stage


def upsert(df: DataFrame, url: str, table: str, key: str, active: str | None = "active", batch: int = 1000, parts: int | None = None) -> dict:
    """df's rows replace those of equal key or are added, and are active; rows that df lacks stay, inactive. Keys of df are unique. Returns the rows merged and deactivated."""
    stage = _staged(df, url, table, batch, parts)
    values = [c for c in df.columns if c != key]
    sets = [f"{c} = s.{c}" for c in values] + ([f"{active} = true"] if active else [])
    names, given = [*df.columns, *([active] if active else [])], [*(f"s.{c}" for c in df.columns), *(["true"] if active else [])]
    merge = f"MERGE INTO {table} t USING {stage} s ON t.{key} = s.{key} WHEN MATCHED THEN UPDATE SET {', '.join(sets)} WHEN NOT MATCHED THEN INSERT ({', '.join(names)}) VALUES ({', '.join(given)})"
    off = [f"UPDATE {table} SET {active} = false WHERE {active} = true AND NOT EXISTS (SELECT 1 FROM {stage} s WHERE s.{key} = {table}.{key})"] if active else []
    counts = _execute(df.sparkSession, url, [*off, merge, f"DROP TABLE {stage}"])
    return {"merged": counts[len(off)], "deactivated": counts[0] if active else 0}


def replace(df: DataFrame, url: str, table: str, column: str, batch: int = 1000, parts: int | None = None) -> dict:
    """df's rows in place of all that have one of its values in `column`, such as a model's budgets."""
    stage = _staged(df, url, table, batch, parts)
    names = ", ".join(df.columns)
    counts = _execute(df.sparkSession, url, [f"DELETE FROM {table} WHERE {column} IN (SELECT {column} FROM {stage})", f"INSERT INTO {table} ({names}) SELECT {names} FROM {stage}", f"DROP TABLE {stage}"])
    return {"deleted": counts[0], "inserted": counts[1]}


def insert_absent(df: DataFrame, url: str, table: str, key: str, batch: int = 1000, parts: int | None = None) -> int:
    """Adds df's rows whose key the table lacks; the number added."""
    stage = _staged(df, url, table, batch, parts)
    names = ", ".join(df.columns)
    return _execute(df.sparkSession, url, [f"INSERT INTO {table} ({names}) SELECT {names} FROM {stage} s WHERE NOT EXISTS (SELECT 1 FROM {table} t WHERE t.{key} = s.{key})", f"DROP TABLE {stage}"])[0]
