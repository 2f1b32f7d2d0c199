"""Publishing tables and views, and the report of what was loaded."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: The log of versions beside them.
LOG = "published"
REPORT_SCHEMA = "table STRING, file STRING, status STRING, n_rows BIGINT, message STRING"


@dataclass(frozen=True)
class Outcome:
    """What became of one table or file."""

    table: str
    status: str
    n_rows: int | None = None
    message: str = ""
    file: str | None = None


def target_namespace(custom: str | None, default: str) -> str:
    """The custom namespace, trimmed and in upper case, or else the default as it stands."""
    return default if custom is None else custom.strip().upper()


def with_audit_time(df: DataFrame, column: str = "loaded_at") -> DataFrame:
    """Add the time of the write, one value for the whole table."""
    return df.withColumn(column, F.current_timestamp())


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Offer a lazy frame under a name."""
    df.createOrReplaceTempView(name)
    return df


def publish_table(
    df: DataFrame,
    table: str,
    *,
    namespace: str | None = None,
    default_namespace: str = "default",
    path: str | None = None,
    audit_column: str | None = None,
    partition_by: Sequence[str] = (),
) -> Outcome:
    """Replace a table at once, schema included, and count its rows while writing them.

    The rows are written to a new folder, and then the table's name is pointed to it: in the catalog
    the table is a view of that folder, and with `path` the folder is named by the last line of a log,
    see `read_published`. Readers of the version before go on undisturbed, and a write that fails
    leaves the old rows. Old folders stay until `drop_old_versions`. A failure is returned and not
    raised, see `raise_failed`.
    """
    spark, counter = df.sparkSession, Observation()
    out = df if audit_column is None else with_audit_time(df, audit_column)
    out = out.observe(counter, F.count(F.lit(1)).alias("n_rows"))
    version = f"v-{uuid.uuid4().hex}"
    try:
        if path is not None:
            out.write.partitionBy(*partition_by).parquet(f"{path}/{version}")
            n_rows = counter.get["n_rows"]
            line = spark.range(1).select(
                F.lit(version).alias("version"),
                F.current_timestamp().alias("published_at"),
                F.lit(n_rows).cast("bigint").alias("n_rows"),
            )
            line.coalesce(1).write.mode("append").parquet(f"{path}/{LOG}")
        else:
            database = target_namespace(namespace, default_namespace)
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
            folder = f"{spark.catalog.getDatabase(f'`{database}`').locationUri}/{table}_versions/{version}"
            out.write.partitionBy(*partition_by).parquet(folder)
            n_rows = counter.get["n_rows"]
            name = f"`{database}`.`{table}`"
            if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
                spark.sql(f"DROP TABLE {name}")
            spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{folder}`")
    except Exception as error:
        return Outcome(table, "failed", message=str(error).split("\n")[0])
    return Outcome(table, "loaded", n_rows)


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The last version that `publish_table` finished under a path."""
    return spark.read.parquet(f"{path}/{published_versions(spark, path).first()['version']}")


def published_versions(spark: SparkSession, path: str) -> DataFrame:
    """version, published_at and n_rows of what was published under a path, the last one first."""
    return spark.read.parquet(f"{path}/{LOG}").orderBy(F.desc("published_at"), "version")


def drop_old_versions(spark: SparkSession, folder: str, current: str, keep: int = 1) -> list[str]:
    """Delete the version folders under a table's folder but the current one and the `keep` newest others.

    Returns what was deleted. Readers of a version that goes fail, so keep those that may be read.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s for s in store.listStatus(path) if s.getPath().getName().startswith("v-")]
    others = [s for s in found if s.getPath().getName() != current]
    old = sorted(others, key=lambda s: s.getModificationTime(), reverse=True)[keep:]
    for status in old:
        store.delete(status.getPath(), True)
    return [status.getPath().getName() for status in old]


def current_version(spark: SparkSession, table: str) -> tuple[str, str]:
    """(folder, version) that the name of a published catalog table points to."""
    files = spark.table(table).inputFiles()
    if files:
        found = re.search(r"(.*)/(v-[0-9a-f]{32})/", files[0])
        if found:
            return found[1], found[2]
    raise ValueError(f"{table} is no published table")


def publish_changed(
    table: str,
    files: DataFrame,
    load: Callable[[list[str]], DataFrame],
    *,
    namespace: str | None = None,
    default_namespace: str = "default",
    audit_column: str | None = None,
) -> tuple[Outcome, dict[str, int]]:
    """Bring a table of one partition per source file up to date with the files there are now.

    `files` has source_file, source_path and sha256; `load` gives the rows of the files with these
    paths, with their `source_file`. Only files whose hash is new are loaded: their rows go to partitions
    of a new version, and the list of files (`<table>_files`: file, hash and version) is replaced at
    once. The table is a view of the partitions that the list names, so a restated file changes its
    partition only, a file that is gone leaves with the next list, and a load that fails changes
    nothing. Returns the outcome, with the rows that were loaded, and the numbers of files by what became
    of them. Loads of one table must not overlap. A changed schema needs a full load.
    """
    spark, database = files.sparkSession, target_namespace(namespace, default_namespace)
    name, listed = f"`{database}`.`{table}`", f"`{database}`.`{table}_files`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    parts = f"{spark.catalog.getDatabase(f'`{database}`').locationUri}/{table}_parts"
    columns = ["source_file", "sha256", "version"]
    known = (
        spark.table(listed).select(columns)
        if spark.catalog.tableExists(listed)
        else spark.createDataFrame([], ", ".join(f"{c} STRING" for c in columns))
    )
    now = files.select("source_file", "source_path", F.col("sha256").alias("__sha"))
    state = (
        F.when(F.col("__sha").isNull(), "gone")
        .when(F.col("sha256").isNull(), "new")
        .when(F.col("sha256") != F.col("__sha"), "restated")
        .otherwise("kept")
    )
    # One row per file: as many as a folder lists.
    compared = known.join(now, "source_file", "full").withColumn("state", state).collect()
    counts = {s: sum(r.state == s for r in compared) for s in ("new", "restated", "gone", "kept")}
    fresh, version, n_rows = [r for r in compared if r.state in ("new", "restated")], f"v-{uuid.uuid4().hex}", 0
    if not fresh and not counts["gone"]:
        return Outcome(table, "loaded", 0), counts
    try:
        if fresh:
            counter, rows = Observation(), load([r.source_path for r in fresh])
            rows = rows if audit_column is None else with_audit_time(rows, audit_column)
            rows = rows.observe(counter, F.count(F.lit(1)).alias("n_rows"))
            rows.write.partitionBy("source_file").parquet(f"{parts}/version={version}")
            n_rows = counter.get["n_rows"]
        kept = [(r.source_file, r.sha256, r.version) for r in compared if r.state == "kept"]
        listing = kept + [(r.source_file, r["__sha"], version) for r in fresh]
        frame = spark.createDataFrame(listing, ", ".join(f"{c} STRING" for c in columns))
        outcome = publish_table(frame.coalesce(1), f"{table}_files", namespace=database)
        if outcome.status == "loaded" and not spark.catalog.tableExists(name):
            spark.sql(
                f"CREATE VIEW {name} AS SELECT p.* EXCEPT (version) FROM parquet.`{parts}` AS p LEFT SEMI JOIN "
                f"{listed} AS f ON p.version = f.version AND p.source_file = f.source_file"
            )
    except Exception as error:
        return Outcome(table, "failed", message=str(error).split("\n")[0]), counts
    return Outcome(table, outcome.status, n_rows, outcome.message), counts


def file_hashes(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """source_file, source_path and sha256 of the files of a folder, by their contents."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return found.select(
        F.col("_metadata.file_name").alias("source_file"),
        F.col("path").alias("source_path"),
        F.sha2("content", 256).alias("sha256"),
    ).where(~F.startswith("source_file", F.lit("~$")))


def raise_failed(outcomes: Sequence[Outcome]) -> None:
    """Raise once all tables had their turn, if any failed."""
    failed = [f"{o.table}: {o.message}" for o in outcomes if o.status == "failed"]
    if failed:
        raise RuntimeError("tables not loaded: " + "; ".join(failed))


def load_report(spark: SparkSession, outcomes: Sequence[Outcome]) -> DataFrame:
    rows = [(o.table, o.file, o.status, o.n_rows, o.message) for o in outcomes]
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def reasons_per_file(rows: DataFrame, table: str) -> DataFrame:
    """Report lines with the rows of each source file: loaded, or not and why, in one pass.

    `rows` has `source_file`, and `reason`, which is missing for the rows that are loaded.
    """
    loaded = F.col("message").isNull()
    counts = rows.groupBy(F.col("source_file").alias("file"), F.col("reason").alias("message"))
    return counts.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(table).alias("table"),
        "file",
        F.when(loaded, "loaded").otherwise("skipped").alias("status"),
        "n_rows",
        F.coalesce("message", F.lit("")).alias("message"),
    )
