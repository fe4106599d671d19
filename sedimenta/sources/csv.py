"""All-text CSV: the scan behind the raw layer and the landing archive."""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256
from urllib.parse import quote, unquote
from uuid import uuid4

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Texts that mean "missing" in the source extracts.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

INGEST_COLUMN = "ingest_ts"
# Bytes of an archived part, of what a task holds of it, and the most tasks of one copy.
PART_BYTES, _BLOCK, MOST_TASKS = 256 << 20, 8 << 20, 10_000
# Names of stores in Spark that the file systems of tasks know by another.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}
_UNFIT = "_unfit_record"
# Put behind a record to see where its fields end.
_END = "<\u0001end\u0001>"


# How a line goes on, for the state it begins in: whole fields with their commas, then perhaps a
# quoted field that stays open. A quote opens a field only as its first character.
_QUOTED = r'[^"]*+(?:""[^"]*+)*+'
_FIELDS = rf'(?:"{_QUOTED}"[^,]*+,|[^",][^,]*+,|,)*+'
_OPENS = rf'^{_FIELDS}"{_QUOTED}$'
_STAYS_OPEN = rf'^{_QUOTED}$|^{_QUOTED}"[^,]*+,{_FIELDS}"{_QUOTED}$'


def _columns(spark: SparkSession, path: str) -> list[str]:
    """The header's names; only the header is read."""
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    return reader.option("encoding", "UTF-8").option("multiLine", True).csv(path).columns


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of CSV files as they are written, with line breaks inside quotes.

    Returns file, is_first (the record that begins its file) and record. Files are split anywhere,
    and a split is read by a task of its own. A line maps the state it begins in (outside of
    quotes or inside) to the one it ends in; such maps compose, so one small row for each split
    tells every split the state it begins in. A split that no quoted break touches is passed on
    line by line; in the others lines are put in order and joined, also over the splits' ends.
    Lines end with \\n or \\r\\n; empty ones outside of quotes are no records.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("line"),
    )
    has = F.contains("line", F.lit('"'))
    opens = has & F.col("line").rlike(_OPENS)
    stays = ~has | F.col("line").rlike(_STAYS_OPEN)
    # The state a line ends in, from outside and from inside. Lines that swap the two (flip) or
    # always end alike (fixed) are all that matters; the others keep the state.
    lines = lines.withColumn("from_out", opens.cast("int")).withColumn("from_in", stays.cast("int"))
    flip = ((F.col("from_out") == 1) & (F.col("from_in") == 0)).cast("int")
    fixed = F.when(F.col("from_out") == F.col("from_in"), F.col("from_out"))
    lines = lines.withColumn("flip", flip).withColumn("fixed", fixed)

    # Each split as a map of its own: its last fixed state and the flips since then.
    splits = lines.groupBy("file", "split").agg(
        F.min("at").alias("first_at"),
        (F.max("from_out") == 1).alias("opens"),
        (F.min("from_in") == 0).alias("closes"),
        F.max(F.when(F.col("fixed").isNotNull(), F.struct("at", "fixed"))).alias("last"),
    )
    swaps = lines.filter("flip = 1").select("file", "split", F.col("at").alias("swap"))
    since = swaps.join(splits.select("file", "split", "last.at"), ["file", "split"])
    since = since.filter("at is null or swap > at").groupBy("file", "split").agg(
        (F.count(F.lit(1)) % 2).alias("split_flip")
    )
    splits = splits.join(since, ["file", "split"], "left").fillna({"split_flip": 0})
    splits = splits.withColumn("split_fixed", F.col("last.fixed"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The state after a split: its last fixed state or the one before it, flipped as often as told.
    turned = F.sum("split_flip").over(upto)
    anchor = F.when(F.col("split_fixed").isNotNull(), (F.col("split_fixed") + turned - F.col("split_flip")) % 2)
    splits = splits.withColumn("turned", turned).withColumn("anchor", anchor)
    after = (F.coalesce(F.last("anchor", ignorenulls=True).over(upto), F.lit(0)) + F.col("turned")) % 2
    splits = splits.withColumn("after", after)
    in_order = Window.partitionBy("file").orderBy("split")
    splits = splits.withColumn("state", F.coalesce(F.lag("after").over(in_order), F.lit(0)))
    # A record that is open at a split's end began in the last split that is not wholly inside.
    begun = F.when((F.col("state") == 0) | F.col("closes"), F.col("split"))
    splits = splits.withColumn("lead", F.last(begun, ignorenulls=True).over(before))
    first_line = F.min(F.when(F.col("split") == 0, F.col("first_at"))).over(Window.partitionBy("file"))
    splits = splits.select("file", "split", "opens", "state", "after", "lead", first_line.alias("first_line"))

    # One row for each split, a millionth of what the split holds, so lines need not move to it.
    known = lines.join(F.broadcast(splits), ["file", "split"])
    # Written so that what is asked of a record is never asked of a line before its split is known.
    record = F.when(~F.col("opens") & (F.col("state") == 0), F.col("line")).alias("record")
    whole = known.filter("not opens and state = 0")
    whole = whole.select("file", (F.col("at") == F.col("first_line")).alias("is_first"), record)

    mixed = known.filter("opens or state = 1")
    walk = Window.partitionBy("file", "split").orderBy("at")
    mixed = mixed.withColumn("turned", F.sum("flip").over(walk))
    mixed = mixed.withColumn("anchor", F.when(F.col("fixed").isNotNull(), (F.col("fixed") + F.col("turned")) % 2))
    ends = (F.coalesce(F.last("anchor", ignorenulls=True).over(walk), F.col("state")) + F.col("turned")) % 2
    mixed = mixed.withColumn("ends", ends)
    starts = (F.coalesce(F.lag("ends").over(walk), F.col("state")) == 0).cast("int")
    mixed = mixed.withColumn("starts", starts).withColumn("number", F.sum("starts").over(walk))
    total = F.sum("starts").over(Window.partitionBy("file", "split"))
    # The record that is open at the end of a split goes on in the next one.
    open_end = (F.col("after") == 1) & (F.col("number") == total)
    began = F.when(F.col("number") == 0, F.col("lead")).otherwise(F.col("split"))
    number = F.when((F.col("number") == 0) | open_end, F.lit(-1)).otherwise(F.col("number"))
    mixed = mixed.withColumn("began", began).withColumn("number", number)
    joined = mixed.groupBy("file", "began", "number").agg(
        F.max(F.col("at") == F.col("first_line")).alias("is_first"),
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("split", "at", "line"))), lambda x: x["line"]), "\n"
        ).alias("record"),
    )
    found = whole.unionByName(joined.select("file", "is_first", "record"))
    found = found.withColumn("record", F.regexp_replace("record", r"\r\z", ""))
    return found.filter("record <> ''")


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column text exactly as written.

    Only the header is read while planning. Files whose header differs from the first fail the
    read instead of having their values assigned by position, and so does a record with more
    fields than the header, with the record in the message; missing last fields are null. Line
    breaks inside quotes are part of a value, and large files are split all the same (see
    `read_records`).
    """
    columns = _columns(spark, path)
    names = [f"`{c}`" for c in columns]
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}
    records = read_records(spark, path)

    # The first record of each file is its header.
    places = ", ".join(f"f{i} string" for i in range(len(columns) + 1))
    heading = F.regexp_replace("record", "^\ufeff", "")
    given = F.from_csv(heading, places, options)
    same = F.lit(True)
    for i, name in enumerate([*columns, None]):
        same = same & given[f"f{i}"].eqNullSafe(F.lit(name))
    wrong = F.raise_error(F.concat(F.lit("a file has another header: "), F.col("record"))).cast("boolean")
    is_row = F.when(~F.col("is_first"), F.lit(True)).when(same, F.lit(False)).otherwise(wrong)
    records = records.filter(is_row)

    # The mark behind a record that is no longer than the header is one of its first fields; only
    # records that do not have as many fields as the header are parsed for it.
    schema = ", ".join(f"{name} string" for name in [*names, _UNFIT])
    row = F.from_csv("record", schema, options | {"columnNameOfCorruptRecord": _UNFIT})
    rows = records.select("record", row.alias("row"))
    marked = F.from_csv(F.concat(F.col("record"), F.lit(f",{_END}")), places, options)
    ended = F.array_contains(F.array(*[marked[f"f{i}"] for i in range(len(columns) + 1)]), _END)
    surplus = ~F.coalesce(ended, F.lit(False))
    message = F.concat(F.lit("record with more fields than the header: "), F.col("record"))
    unfit = F.col("row")[_UNFIT].isNotNull() & surplus
    fits = F.when(unfit, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return rows.filter(fits).select(*[F.col("row")[c].alias(c) for c in columns])


def null_tokens_to_null(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.when(~F.col(f"`{c}`").isin(*NULL_TOKENS), F.col(f"`{c}`")).alias(c) for c in df.columns]
    )


def scan_raw(spark: SparkSession, path: str) -> DataFrame:
    """The raw layer's scan: all text, the usual tokens for "missing" turned into null."""
    return null_tokens_to_null(read_text(spark, path))


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark names it, and the path within."""
    scheme, _, rest = uri.partition(":")
    if scheme == "file" or not rest or "/" in scheme:
        return fs.LocalFileSystem(), re.sub("^/+", "/", rest if scheme == "file" else uri)
    return fs.FileSystem.from_uri(_SCHEMES.get(scheme, scheme) + ":" + quote(rest, safe="/:@"))


def _copy_parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Copy the byte ranges of the rows; a part has its name only once it is whole, and a task that
    runs again writes the same bytes under the same name."""
    for batch in batches:
        sums = []
        for row in batch.itertuples():
            (source, path), (target, folder) = _store(row.path), _store(unquote(row.folder))
            unfinished, left, known = f"{folder}/_unfinished-{uuid4().hex}", row.length, sha256()
            with source.open_input_file(path) as file, target.open_output_stream(unfinished, compression=None) as out:
                file.seek(row.start)
                while left:
                    block = file.read(min(left, _BLOCK))
                    if not block:
                        raise OSError(f"{row.path} became shorter while it was copied")
                    known.update(block)
                    out.write(block)
                    left -= len(block)
            if target.get_file_info(f"{folder}/{row.name}").type == fs.FileType.File:
                target.delete_file(unfinished)  # a lost task had copied it
            else:
                target.move(unfinished, f"{folder}/{row.name}")
            sums.append(known.hexdigest())
        yield batch[["path", "start", "length", "name"]].assign(sha256=sums)


def archive(
    spark: SparkSession, path: str, landing: str, table: str, ingest_ts: str, part_bytes: int = PART_BYTES
) -> str:
    """Keep an input byte for byte, compressed or not, in a folder of its load; returns that folder.

    Files are cut into ranges of `part_bytes` that tasks copy unread; the parts' names
    (`part-file-range-name`) give their order, so the parts of a file joined are the file (an
    empty one has none). What is to be copied is written first, as `_listed`, what was copied with its SHA-256 as `_copied`.
    Earlier loads stay, and a load time that exists already is refused. Executors must reach both
    folders by the file systems that pyarrow knows (local or mounted, HDFS, S3, GCS).
    """
    folder = f"{landing}/{table}/{INGEST_COLUMN}={ingest_ts}"
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    # A row for each file, not for what it holds.
    files = files.withColumn("file", F.row_number().over(Window.orderBy("path")) - 1)
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(part_bytes).cast("long")))
    ranges = files.withColumn("start", start)
    number = F.lpad((F.col("start") / part_bytes).cast("long").cast("string"), 7, "0")
    name = F.concat_ws("-", F.lit("part"), F.lpad(F.col("file").cast("string"), 5, "0"), number, F.element_at(F.split("path", "/"), -1))
    ranges = ranges.select("path", "start", F.least(F.lit(part_bytes), F.col("length") - F.col("start")).alias("length"), name.alias("name"))
    ranges.write.mode("errorifexists").parquet(f"{folder}/_listed")
    # Where the list lies tells tasks the folder in full, whatever short form the caller gave.
    listed = spark.read.parquet(f"{folder}/_listed").withColumn("folder", F.regexp_extract("_metadata.file_path", "^(.*)/_listed/", 1))
    n_tasks = max(1, min(listed.count(), MOST_TASKS))
    copied = listed.repartition(n_tasks, "name").mapInPandas(
        _copy_parts, "path string, start long, length long, name string, sha256 string"
    )
    copied.write.mode("errorifexists").parquet(f"{folder}/_copied")
    return folder
