"""Sinks: partitioned and bucketed tables, upserts, replacement of one model's rows, insert-if-absent, manifests, reports, the serving table, versions of several tables."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns of the serving tables that each version adds; names and types are fixed values of the data model.
TABLES = {
    1: {
        "positions": "position_id string, fen string, prev_fen string, opp_prev_uci string, category string, phase string, source_rating smallint, active boolean",
        "category_budgets": "model string, tc_class string, category string, rating int, budget_s double, budget_strict_s double, p_inf double, sparse boolean, half_width int",
        "users": "user_id bigint, created_at timestamp",
        "user_settings": "user_id bigint, tc_class string, rating int, category_mix string",
        "attempts": "attempt_id bigint, user_id bigint, position_id string, seconds double, solved boolean, created_at timestamp",
    },
    2: {
        "positions": "move_number smallint, side string, best_uci string, best_win_pct float, lines array<struct<uci:string,cp:int,mate:int,win_pct:float>>, n_acceptable_lines int, gap_1_2 double, source_game_id string, source_month string, source_tc_class string",
        "users": "name string, rating int",
        "user_settings": "target_offset int, default_class string, strictness string, continue_after_budget boolean, updated_at timestamp",
        "attempts": "tc_class string, target_rating int, budget_model string, strictness string, budget_s double, time_ms int, move_uci string, played_win_pct double, loss_win_pct double, acceptable boolean, is_best boolean, within_budget boolean, graded_by string, mode string, propensity double",
    },
}

#: (table, column, table that it refers to, its key)
REFERENCES = (("user_settings", "user_id", "users", "user_id"), ("attempts", "user_id", "users", "user_id"), ("attempts", "position_id", "positions", "position_id"))


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """zstd Parquet; Spark's commit makes the write all or nothing, and _SUCCESS comes last."""
    w = df.write.mode(mode).option("compression", "zstd")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def upsert(current: DataFrame, new: DataFrame, key: str, active: str = "active") -> DataFrame:
    """The table after the merge: new rows win and are active, rows that are only in the old table stay, inactive. One shuffle of either side on the key."""
    values = [c for c in new.columns if c != key]
    joined = current.select(F.col(key), *(F.col(c).alias(f"_old_{c}") for c in values), F.lit(True).alias("_was")).join(new.withColumn("_is", F.lit(True)), key, "full_outer")
    return joined.select(key, *(F.when(F.col("_is"), F.col(c)).otherwise(F.col(f"_old_{c}")).alias(c) for c in values), F.coalesce("_is", F.lit(False)).alias(active))


def upsert_counts(current: DataFrame, new: DataFrame, key: str, active: str = "active") -> dict:
    """Rows that the merge adds, updates and deactivates."""
    j = current.select(key, F.col(active).alias("_a")).withColumn("_was", F.lit(True)).join(new.select(key).withColumn("_is", F.lit(True)), key, "full_outer")
    return j.agg(F.count_if(F.col("_was").isNull()).alias("added"), F.count_if(F.col("_was") & F.col("_is")).alias("updated"), F.count_if(F.col("_was") & F.col("_is").isNull() & F.col("_a")).alias("deactivated")).first().asDict()


def replace_partition(df: DataFrame, path: str, column: str) -> None:
    """Rewrites the partitions of `column` that df holds and leaves the others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(column).parquet(path)


def insert_absent(current: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The table with those new rows whose key it lacks."""
    return current.unionByName(new.join(current.select(key), key, "left_anti").select(*current.columns))


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows that break a foreign key; null keys don't."""
    return child.where(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")


def check_references(tables: dict[str, DataFrame]) -> None:
    """Raises if a row of a table refers to one that another lacks; tables that aren't given aren't checked."""
    for child, key, parent, parent_key in REFERENCES:
        if child in tables and parent in tables and (lost := orphans(tables[child], key, tables[parent], parent_key).limit(5).collect()):
            raise ValueError(f"{child}.{key} refers to missing {parent}: {', '.join(str(r[key]) for r in lost)}")


def write_serving(pool: DataFrame, path: str) -> None:
    """Positions laid out for lookups by category and rating."""
    pool.repartition("category").sortWithinPartitions("source_rating").write.mode("overwrite").option("compression", "zstd").partitionBy("category").parquet(path)


def migrate(spark: SparkSession, database: str, version: int = max(TABLES)) -> list[str]:
    """Brings a database of the session's catalogue to a version: missing tables are created, missing columns added, rows stay. Returns the tables that hold something else."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    wanted: dict[str, dict] = {}
    for step in range(1, version + 1):
        for name, ddl in TABLES[step].items():
            spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({ddl}) USING parquet")
            wanted.setdefault(name, {}).update((f.name, f.dataType) for f in T._parse_datatype_string(ddl))
    for name, columns in wanted.items():
        have = set(spark.table(f"{database}.{name}").columns)
        if new := ", ".join(f"{c} {t.simpleString()}" for c, t in columns.items() if c not in have):
            spark.sql(f"ALTER TABLE {database}.{name} ADD COLUMNS ({new})")
    return [name for name, columns in wanted.items() if {f.name: f.dataType for f in spark.table(f"{database}.{name}").schema} != columns]


def downgrade(spark: SparkSession, database: str, version: int = 0) -> list[str]:
    """Takes a database of the session's catalogue down to a version: later columns and tables go, rows stay. Version 0 drops it. Returns the tables that changed."""
    if version == 0:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
        return list(TABLES[1])
    changed = []
    keep: dict[str, list[str]] = {}
    for step in range(1, version + 1):
        for name, ddl in TABLES[step].items():
            keep.setdefault(name, []).extend(f.name for f in T._parse_datatype_string(ddl))
    for name in dict.fromkeys(name for tables in TABLES.values() for name in tables):
        if not spark.catalog.tableExists(f"{database}.{name}"):
            continue
        if name not in keep:
            spark.sql(f"DROP TABLE {database}.{name}")
            changed.append(name)
        elif spark.table(f"{database}.{name}").columns != keep[name]:
            # written whole beside it before either name changes, so a run that is lost can be repeated
            spark.sql(f"DROP TABLE IF EXISTS {database}.{name}_lower")
            spark.sql(f"CREATE TABLE {database}.{name}_lower USING parquet AS SELECT {', '.join(keep[name])} FROM {database}.{name}")
            spark.sql(f"ALTER TABLE {database}.{name} RENAME TO {database}.{name}_upper")
            spark.sql(f"ALTER TABLE {database}.{name}_lower RENAME TO {database}.{name}")
            spark.sql(f"DROP TABLE {database}.{name}_upper")
            changed.append(name)
    return changed


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, order: tuple[str, ...] = (), path: str | None = None) -> None:
    """A catalogue table hashed on a key into buckets, sorted within them: tables of one key and number of buckets join on it without a shuffle."""
    w = df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("compression", "zstd").bucketBy(buckets, key).sortBy(key, *order)
    (w.option("path", path) if path else w).saveAsTable(table)


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of Hadoop's API, so that small files go wherever tables go."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _renamed(spark: SparkSession, source: str, target: str, replace: bool) -> bool:
    """Renames a file over another one at once, or only where none is; false if there is one."""
    jvm = spark._jvm
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE if replace else kind.NONE
    a, b = (jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    fs, b = _hadoop(spark, target)
    a, b = fs.makeQualified(a), fs.makeQualified(b)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(b.toUri(), spark._jsc.hadoopConfiguration()).rename(a, b, how)
    except Exception as e:
        if "FileAlreadyExists" not in str(e):
            raise
        return False
    return True


def write_text(spark: SparkSession, path: str, text: str, replace: bool = True) -> bool:
    """A small file: written beside its place and renamed over it, so readers find the old one or the new one, complete. Without `replace` an existing file stays and false is returned."""
    fs, _ = _hadoop(spark, path)
    name = f"{path}.{uuid.uuid4().hex}.part"
    part = spark._jvm.org.apache.hadoop.fs.Path(name)
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if _renamed(spark, name, path, replace):
        return True
    fs.delete(part, False)
    return False


def read_text(spark: SparkSession, path: str) -> str | None:
    """The contents of a small file; None if there is none."""
    fs, target = _hadoop(spark, path)
    if not fs.exists(target):
        return None
    got = fs.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(got)).decode()
    finally:
        got.close()


def write_json(spark: SparkSession, path: str, value) -> None:
    """A small file, complete or absent, keys sorted."""
    write_text(spark, path, json.dumps(value, sort_keys=True, indent=1, default=str))


def check_manifest(spark: SparkSession, folder: str, settings: dict) -> None:
    """Writes the settings of a run beside its output; refuses to resume one that was begun with others."""
    path = f"{folder.rstrip('/')}/_manifest.json"
    now = json.loads(json.dumps(settings, default=str))
    found = read_text(spark, path)
    if found is None:
        write_json(spark, path, settings)
        return
    old = json.loads(found)
    changed = sorted(k for k in {*old, *now} if old.get(k) != now.get(k))
    if changed:
        raise ValueError(f"{folder} was made with other settings: {', '.join(changed)}")


def markdown(title: str, df: DataFrame, most: int = 10_000) -> str:
    """A small result as a Markdown table, whole; a result of more than `most` rows is no report and raises."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{title} has more than {most} rows")
    return _table(title, df.columns, rows)


def _cell(v) -> str:
    return "" if v is None else f"{v:g}" if isinstance(v, float) else str(v)


def _table(title: str, names: list[str], rows) -> str:
    lines = [f"## {title}", "", "| " + " | ".join(names) + " |", "|" + " --- |" * len(names)]
    return "\n".join([*lines, *("| " + " | ".join(map(_cell, r)) + " |" for r in rows)]) + "\n"


def write_report(spark: SparkSession, folder: str, job: str, report: dict) -> None:
    """A job's report as <job>.json and <job>.md: single values as a list, lists of rows and nested values as tables."""
    single = {k: v for k, v in report.items() if not isinstance(v, dict) and not (isinstance(v, list) and v and isinstance(v[0], dict))}
    parts = [f"# {job}\n", "".join(f"- {k}: {', '.join(map(_cell, v)) if isinstance(v, list) else _cell(v)}\n" for k, v in single.items())]
    for k, v in report.items():
        if k not in single:
            rows = v if isinstance(v, list) else [{"name": a, "value": b} for a, b in v.items()]
            parts.append(_table(k, list(rows[0]) if rows else ["name", "value"], (r.values() for r in rows)))
    write_json(spark, f"{folder}/{job}.json", report)
    write_text(spark, f"{folder}/{job}.md", "\n".join(parts))


# --- versions of several tables at once ---


class Snapshots:
    """A log of versions of a set of tables under one folder. A version is one small file that names each table's folder; folders don't change once a version names them.

    A load writes new folders, then the next version's file, which appears at once or not at all, and only if no other load took its number.
    Readers take the latest file and so see all tables of one load, also while another runs.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _listed(self, folder: str) -> list[str]:
        fs, path = _hadoop(self.spark, folder)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._listed(f"{self.folder}/_versions") if n.endswith(".json") and n[:-5].isdigit())

    def current(self, version: int | None = None) -> dict:
        """{version, tables: {name: path}} of a version, the latest if none is given; version 0 without tables if there is none."""
        known = self.versions()
        if not known and version is None:
            return {"version": 0, "tables": {}}
        text = read_text(self.spark, f"{self.folder}/_versions/{version or known[-1]:012d}.json")
        if text is None:
            raise FileNotFoundError(f"{self.folder} has no version {version}")
        return json.loads(text)

    def tables(self, version: int | None = None) -> dict[str, DataFrame]:
        return {name: self.spark.read.parquet(f"{self.folder}/{path}") for name, path in self.current(version)["tables"].items()}

    def place(self, table: str) -> str:
        """A new folder for a table, of this load alone, relative to the log's."""
        return f"{table}/{uuid.uuid4().hex}"

    def commit(self, base: dict, tables: dict[str, str]) -> dict:
        """The version after `base`, with these tables in place of or besides its own. Raises if another load came first: what it wrote may not be in `base`."""
        new = {"version": base["version"] + 1, "tables": {**base["tables"], **tables}}
        if not write_text(self.spark, f"{self.folder}/_versions/{new['version']:012d}.json", json.dumps(new, sort_keys=True), replace=False):
            raise RuntimeError(f"{self.folder}: version {new['version']} was written by another load")
        return new

    def expire(self, keep: int) -> int:
        """Drops all versions but the last `keep`, then folders that no version names; the number of folders. Not beside a load that runs, whose folders no version names yet."""
        known = self.versions()
        for v in known[: max(0, len(known) - keep)]:
            fs, path = _hadoop(self.spark, f"{self.folder}/_versions/{v:012d}.json")
            fs.delete(path, False)
        named = {p for v in self.versions() for p in self.current(v)["tables"].values()}
        gone = 0
        for table in {p.split("/")[0] for p in named}:
            for x in self._listed(f"{self.folder}/{table}"):
                if f"{table}/{x}" not in named:
                    fs, path = _hadoop(self.spark, f"{self.folder}/{table}/{x}")
                    gone += bool(fs.delete(path, True))
        return gone
