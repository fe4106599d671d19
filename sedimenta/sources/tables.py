"""Layer tables: replaced whole under a stable name, merged by key, held between steps.

A table `stage.orders_stage` is a view over its current version, a Parquet table of its own.
A load writes a new version and then points the view at it, so readers never see a half-written
table, a failed load leaves the old data in place, and a load may read what it replaces. A keyed
table (the stage layer) is a view over one version of each of its buckets, so a merge rewrites only
the buckets it touches.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sedimenta.operators.upsert import merge_native, merge_rows, require_unique

_VERSION_PROPERTY = "current_version"
_PREVIOUS_PROPERTY = "previous_version"
_NOTE = "note."
_SEPARATOR = "__v"


def load_stamp() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S_%f")


def _unique() -> str:
    # A retried load must not meet the files of the attempt that failed.
    return f"{load_stamp()}_{uuid4().hex[:8]}"


def ensure_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    if not spark.catalog.tableExists(name):
        return {}
    return {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def current_version(spark: SparkSession, name: str) -> str | None:
    """The Parquet table behind a layer table, or None before its first load."""
    return _properties(spark, name).get(_VERSION_PROPERTY)


def publish(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Create or replace a layer table with the rows of `df`.

    With `partition_by`, rows are rebalanced on those columns first: a small partition becomes
    one file, and a partition that holds a third of the table is split over many tasks. The
    version before this one is kept for readers that have started; older ones go.
    """
    spark = df.sparkSession
    version = f"{name}{_SEPARATOR}{_unique()}"
    if partition_by:
        columns = ", ".join(f"`{c}`" for c in partition_by)
        df = spark.sql(f"SELECT /*+ REBALANCE({columns}) */ * FROM {{rows}}", rows=df)
    writer = df.write.format("parquet").mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(version)

    properties = _properties(spark, name)
    previous = properties.get(_VERSION_PROPERTY)
    told = {_VERSION_PROPERTY: version} | ({_PREVIOUS_PROPERTY: previous} if previous else {})
    listed = ", ".join(f"'{key}' = '{value}'" for key, value in told.items())
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({listed}) AS SELECT * FROM {version}")
    # Only a version that was published goes; one that another load is writing is not known here.
    if outdated := properties.get(_PREVIOUS_PROPERTY):
        spark.sql(f"DROP TABLE IF EXISTS {outdated}")
    return spark.table(name)


def marks(spark: SparkSession, name: str) -> dict[str, str]:
    """What a load has noted about a layer table (see `note`)."""
    found = _properties(spark, name)
    return {key.removeprefix(_NOTE): value for key, value in found.items() if key.startswith(_NOTE)}


def note(spark: SparkSession, name: str, **told: str) -> None:
    """Note something about a layer table; the next `publish` forgets it."""
    listed = ", ".join(f"'{_NOTE}{key}' = '{value}'" for key, value in told.items())
    spark.sql(f"ALTER VIEW {name} SET TBLPROPERTIES ({listed})")


def replace_partitions(rows: DataFrame, name: str, column: str, values: Sequence) -> DataFrame:
    """Replace some partitions of a published table by the rows of `rows` that belong to them.

    `values` are the partitions (None for rows without a value). Files of all others stay as they
    are; a partition that `rows` has nothing for is gone afterwards. `rows` must not read the table.
    """
    spark = rows.sparkSession
    version = current_version(spark, name)
    known = [v for v in values if v is not None]
    wanted = F.col(column).isin(known) if known else F.lit(False)
    if None in values:
        wanted = F.col(column).isNull() | wanted
    rows = rows.filter(F.coalesce(wanted, F.lit(False))).select(*spark.table(version).columns)
    rows = spark.sql(f"SELECT /*+ REBALANCE(`{column}`) */ * FROM {{rows}}", rows=rows)
    # At most as many values as were given.
    filled = {r[0] for r in rows.select(column).distinct().collect()}
    mode = "spark.sql.sources.partitionOverwriteMode"  # a setting of the session, not of a write by name
    usual = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows.write.insertInto(version, overwrite=True)
    finally:
        spark.conf.set(mode, usual)
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {version}").filter("col_name = 'Location'")
    location = described.first().data_type
    for value in set(values) - filled:
        folder = "__HIVE_DEFAULT_PARTITION__" if value is None else value
        release(spark, f"{location}/{column}={folder}")
    spark.catalog.refreshTable(version)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def ensure_table(spark: SparkSession, name: str, schema: StructType) -> DataFrame:
    """The table, created empty with an explicit schema when it does not exist."""
    if not spark.catalog.tableExists(name):
        return publish(spark.createDataFrame([], schema), name)
    return spark.table(name)


def shared_folder(spark: SparkSession) -> str:
    """Where intermediate results are written: the folder of `spark.checkpoint.dir`, which every
    executor reaches. A session without it cannot hold results."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{named}/_held"


def hold(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write a result that is read more than once and return it as a scan, with its path.

    Unlike a cache, the files survive the loss of an executor and are read column by column.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}_{_unique()}"
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def release(spark: SparkSession, path: str) -> None:
    """Delete a held result; one that is gone already is no error."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def accepts_merge(spark: SparkSession, name: str) -> bool:
    """Whether a table merges by itself: it is a table, and not one of plain files."""
    if not spark.catalog.tableExists(name):
        return False
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    plain = {"parquet", "orc", "csv", "json", "text", "avro", "hive"}
    return described.get("Type") != "VIEW" and described.get("Provider", "hive").lower() not in plain


# A keyed table is cut into buckets by the low bits of a hash of its key. A merge writes the buckets
# that the batch touches and leaves the files of the others as they are. A bucket that would pass
# this many rows is parted by the next bits as it is written, so buckets grow in number and not in
# size, and a batch of some keys rewrites a share of the table that shrinks as the table grows.
BUCKET_ROWS = 4_000_000

_KEYED, _KEYED_BEFORE = "keyed_buckets", "keyed_buckets_before"
_BUCKET = "_bucket"
# Catalogs bound the length of a property, so a long list is told in several.
_PROPERTY_CHARS = 3_000


class ChangedMeanwhile(RuntimeError):
    """Another load has published the table since this one read it; run the merge again."""


@dataclass(frozen=True)
class Bucket:
    """Rows whose key hashes end in `index`, `depth` bits long; no version while there are none."""

    depth: int
    index: int
    version: str = ""
    rows: int = 0

    @property
    def name(self) -> str:
        return f"{self.depth}x{self.index}"

    def parted(self, times: int) -> list[Bucket]:
        return [Bucket(self.depth + times, self.index + (k << self.depth)) for k in range(1 << times)]


def _bucket_of(key: str, buckets: Iterable[Bucket]) -> Column:
    """The name of the bucket that holds a key; every key falls into one of a table's buckets."""
    by_depth: dict[int, list[str]] = {}
    for bucket in buckets:
        by_depth.setdefault(bucket.depth, []).append(bucket.name)
    hashed = F.xxhash64(key)
    names = [
        (F.concat(F.lit(f"{depth}x"), F.pmod(hashed, F.lit(1 << depth)).cast("string")), known)
        for depth, known in sorted(by_depth.items())
    ]
    return F.coalesce(*[F.when(name.isin(known), name) for name, known in names])


def _root(spark: SparkSession, name: str) -> str:
    database, _, table = name.rpartition(".")
    location = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{location}/{table}__buckets"


def _buckets(spark: SparkSession, name: str, told_by: str = _KEYED) -> list[Bucket]:
    """The buckets of a keyed table, each with the version that holds it."""
    properties, told = _properties(spark, name), ""
    while (part := properties.get(f"{told_by}.{len(told) // _PROPERTY_CHARS}")) is not None:
        told += part
        if len(part) < _PROPERTY_CHARS:
            break
    entries = [entry.split(":") for entry in told.split(",") if entry]
    return [Bucket(*map(int, bucket.split("x")), version, int(n)) for bucket, version, n in entries]


def _point(
    spark: SparkSession, name: str, schema: StructType, buckets: list[Bucket], before: list[Bucket]
) -> None:
    """Point the table's view at a version of each bucket, all at once, unless it has been pointed
    elsewhere than at `before` since."""
    if _buckets(spark, name) != before:
        raise ChangedMeanwhile(name)
    columns = ", ".join(f"`{f.name}`" for f in schema)
    held = [b for b in buckets if b.rows]
    if held:
        paths = ",".join(f"{b.version}/{_BUCKET}={b.name}" for b in held)
        body = f"SELECT {columns} FROM parquet.`{_root(spark, name)}/{{{paths}}}`"
    else:
        nulls = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema)
        body = f"SELECT {nulls} WHERE false"
    told = []
    for key, listed in ((_KEYED, buckets), (_KEYED_BEFORE, before)):
        text = ",".join(f"{b.name}:{b.version}:{b.rows}" for b in listed)
        parts = [text[at : at + _PROPERTY_CHARS] for at in range(0, len(text) + 1, _PROPERTY_CHARS)]
        told += [f"'{key}.{n}' = '{part}'" for n, part in enumerate(parts)]
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({', '.join(told)}) AS {body}")


def ensure_keyed(spark: SparkSession, name: str, schema: StructType) -> DataFrame:
    """The keyed table, created empty with an explicit schema when it does not exist."""
    if not spark.catalog.tableExists(name):
        _point(spark, name, schema, [], [])
    return spark.table(name)


def upsert(held: DataFrame, name: str, key: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Merge a held batch into a keyed table by primary key; running it twice changes nothing more.

    A table that accepts MERGE does it itself. Otherwise only the buckets that hold keys of the
    batch are read, merged and written, parted where they grow beyond `bucket_rows`, and then the
    view moves to them; files of other buckets stay. Buckets replaced by the merge before this one
    are deleted, those replaced now stay for readers that have started. Of two loads at once the
    later one to finish is refused (`ChangedMeanwhile`) and changes nothing. The batch is read
    several times, so it should be a scan (see `hold`), not a plan. An empty batch changes nothing;
    a key that repeats in the batch is refused; rows without a key are all kept, as no key matches.
    """
    spark = held.sparkSession
    require_unique(held, key)
    if accepts_merge(spark, name):
        merge_native(name, held, key)
        return spark.table(name)
    target = ensure_keyed(spark, name, held.schema)
    before = _buckets(spark, name)
    buckets = {b.name: b for b in before} or {"0x0": Bucket(0, 0)}
    # One row for each bucket that the batch touches.
    touched = dict(held.groupBy(_bucket_of(key, buckets.values())).count().collect())
    if not touched:
        return target
    written: list[Bucket] = []
    for told, n in touched.items():
        rows_after = buckets[told].rows + n
        written += buckets[told].parted(max(0, math.ceil(math.log2(rows_after / bucket_rows))))
    root, version = _root(spark, name), f"v{_unique()}"
    paths = [f"{root}/{b.version}/{_BUCKET}={b.name}" for b in map(buckets.get, touched) if b.rows]
    rows = held
    if paths:
        rows = merge_rows(spark.read.schema(target.schema).parquet(*paths), held, key)
    rows = rows.select(*target.columns, _bucket_of(key, written).alias(_BUCKET))
    rows = spark.sql(f"SELECT /*+ REBALANCE({_BUCKET}) */ * FROM {{rows}}", rows=rows)
    rows.write.mode("errorifexists").partitionBy(_BUCKET).parquet(f"{root}/{version}")
    # Answered from the footers and the folders' names.
    found = spark.read.schema(f"{_BUCKET} string").parquet(f"{root}/{version}").groupBy(_BUCKET).count()
    counts = dict(found.collect())
    now = [b for b in before if b.name not in touched]
    now += [
        Bucket(b.depth, b.index, version, counts[b.name]) if b.name in counts else b for b in written
    ]
    outdated = _buckets(spark, name, _KEYED_BEFORE)
    try:
        _point(spark, name, target.schema, now, before)
    except ChangedMeanwhile:
        release(spark, f"{root}/{version}")
        raise
    in_use = {(b.version, b.name) for b in (*before, *now)}
    for bucket in outdated:
        if bucket.rows and (bucket.version, bucket.name) not in in_use:
            release(spark, f"{root}/{bucket.version}/{_BUCKET}={bucket.name}")
    return spark.table(name)
