"""Scans and sinks with fixed schemas."""

from __future__ import annotations

import csv
import re
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from roadgrain import schemas as S
from roadgrain.operators.rows import unfold
from roadgrain.session import fresh_path

MALFORMED = "_malformed"
#: Different headers that the files of one folder may have.
MOST_HEADERS = 64


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Column names in the first line of a CSV file or folder; a byte-order mark is ignored."""
    line = spark.read.text(path).limit(1).collect()
    return next(csv.reader([line[0][0]]), []) if line else []


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a fixed schema: the header must match exactly, bad cells become null.

    The first header is compared before anything is read; ``enforceSchema=false`` makes
    Spark compare the header of every other file in the folder as well.
    """
    header = read_header(spark, path)
    if header != schema.names:
        raise ValueError(f"Unexpected columns in {path}. Expected {schema.names}; found {header}.")
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("dateFormat", "yyyy-MM-dd")
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, S.RAW_SCHEMA)


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, S.CALENDAR_SCHEMA)


def listing(spark: SparkSession, path: str) -> DataFrame:
    """file and length of every file below a folder (or of one file); no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("path").alias("file"), "length")


def below(folder: str, file: str) -> Column:
    """The part of a file's path behind the folder; empty if the folder is the file."""
    plain = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/", folder).rstrip("/")
    return F.regexp_extract(file, re.escape(plain) + "/?(.*)$", 1)


def file_headers(spark: SparkSession, path: str) -> DataFrame:
    """file and header (its first line) of every file of a CSV folder that has a line.

    The first line of a file is the earliest row of the task that reads the file's first block,
    so one pass over the lines finds all headers, with one row per file leaving the tasks.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
        F.monotonically_increasing_id().alias("place"),
    )
    return lines.where("start = 0").groupBy("file").agg(F.min_by("value", "place").alias("header"))


def header_names(header: str) -> list[str]:
    return next(csv.reader([header.removeprefix("\ufeff")]), [])


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """CSV files as text cells, each file under its own header, for the contract checks.

    Files of a folder may order their columns differently: those with the same header are read
    together and all are put together by name; a column that a file lacks is null in its rows.
    A line with too few or too many fields keeps its raw text in ``_malformed``. Spark
    reads an empty cell as null, so in a line with the right number of fields null is
    turned back into empty text; only a field that is not there stays null.
    Raises ``FileNotFoundError`` for an absent path, ``ValueError`` if there is no header,
    if one repeats a name, or if there are more than ``MOST_HEADERS`` different ones. Files
    without any line are passed over.
    """
    try:
        headers = file_headers(spark, path).groupBy("header").agg(F.collect_list("file").alias("files")).limit(MOST_HEADERS + 1)
        found = {row["header"]: [unquote(file) for file in row["files"]] for row in headers.collect()}
    except AnalysisException as error:
        raise FileNotFoundError(path) from error
    if len(found) > MOST_HEADERS:
        raise ValueError(f"The files of {path} have more than {MOST_HEADERS} different headers.")
    tables = []
    for header, files in sorted(found.items()):
        names = header_names(header)
        if not names:
            raise ValueError(f"{path} is empty or has no header.")
        if len(names) != len(set(names)):
            raise ValueError(f"{path} contains duplicate column names.")
        tables.append(_cells_under(spark, path if len(found) == 1 else files, names))
    if not tables:
        raise ValueError(f"{path} is empty or has no header.")
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), tables)


def _cells_under(spark: SparkSession, files: str | list[str], header: list[str]) -> DataFrame:
    schema = StructType([StructField(name, StringType()) for name in [*header, MALFORMED]])
    lines = (
        spark.read.schema(schema)
        .option("header", True)
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("columnPruning", False)  # fields are counted even if few columns are used
        .csv(files)
    )
    whole = F.col(MALFORMED).isNull()
    return lines.select(
        *[F.when(whole, F.coalesce(F.col(f"`{n}`"), F.lit(""))).otherwise(F.col(f"`{n}`")).alias(n) for n in header],
        MALFORMED,
    )


def write_stage(data: DataFrame, path: str, columns: list[str], file_format: str = "parquet", by_month: bool = False) -> str:
    """Write a stage output with a fixed column order, in parallel.

    ``by_month`` adds a ``year_month`` partition folder so that date filters skip
    files. The rebalance hint brings the rows of a month together and lets AQE merge
    small months into one task and split a month that holds most rows over many tasks,
    by size and without a salt to choose.
    """
    if by_month:
        months = data.select(*columns, F.date_format("date", "yyyy-MM").alias("year_month"))
        writer = months.hint("rebalance", "year_month").write.partitionBy("year_month")
    else:
        writer = data.select(*columns).write
    writer = writer.mode("overwrite")
    if file_format == "csv":
        writer.option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
    else:
        writer.parquet(path)
    return path


def read_stage(
    spark: SparkSession,
    path: str,
    schema: StructType,
    file_format: str = "parquet",
    date_range: tuple[str, str] | None = None,
) -> DataFrame:
    """Read a stage output and require its exact column list; the month folder is not part of it.

    ``date_range`` (both ISO dates included) selects the month folders as well as the
    rows, because a filter on the date alone cannot skip a folder.
    """
    if file_format == "csv":
        data = read_csv(spark, path, schema)
    else:
        data = spark.read.parquet(path)
    columns = [name for name in data.columns if name != "year_month"]
    if columns != schema.names:
        raise ValueError(f"Unexpected columns in {path}. Expected {schema.names}; found {columns}.")
    if date_range:
        first, last = date_range
        data = data.where(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
        if "year_month" in data.columns:
            data = data.where(F.col("year_month").between(first[:7], last[:7]))
    return data.select(*columns)


def stored(data: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet to the shared folder and read again."""
    path = fresh_path(data.sparkSession, name)
    data.write.parquet(path)
    return data.sparkSession.read.schema(data.schema).parquet(path)


def fingerprint(data: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Row count and two sums of row digests: the same for any row order and partitioning.

    Each row's MD5 is cut into two 60-bit numbers which are summed as decimals, so that
    repeated rows count and nothing overflows. Every cell is written with its length, null
    is a mark of its own, and names and types are part of each row's text, so different
    rows or schemas have different texts.
    """
    chosen = data.select(*[F.col(f"`{name}`") for name in columns or data.columns])
    cells = [
        F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("n"))
        for text in (F.col(f"`{name}`").cast("string") for name in chosen.columns)
    ]
    digest = F.md5(F.concat_ws("|", F.lit(", ".join(f"{name} {kind}" for name, kind in chosen.dtypes)), *cells))

    def part(start: int):
        return F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(38,0)")

    return chosen.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(part(1)), F.lit(0)).cast("string").alias("digest_low"),
        F.coalesce(F.sum(part(16)), F.lit(0)).cast("string").alias("digest_high"),
    )


#: Largest file whose bytes are read into one row for a digest.
MOST_BYTES = 1 << 30


def file_digests(spark: SparkSession, path: str, most_bytes: int = MOST_BYTES) -> DataFrame:
    """file (below ``path``), length and SHA-256 of the bytes of every file of a folder, or of one file.

    A file is one row of one task, so the listing is asked first and a larger file than
    ``most_bytes`` is refused before any content is read. Raises ``FileNotFoundError`` for an absent path.
    """
    try:
        largest = listing(spark, path).agg(F.max_by(F.struct("file", "length"), "length")).first()[0]
    except AnalysisException as error:
        raise FileNotFoundError(path) from error
    if largest and largest["length"] > most_bytes:
        raise ValueError(f"{largest['file']} has {largest['length']} bytes, more than the {most_bytes} that a digest may read.")
    contents = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return contents.select(below(path, "path").alias("file"), "length", F.sha2("content", 256).alias("sha256"))


def input_digest(spark: SparkSession, path: str, most_bytes: int = MOST_BYTES) -> str:
    """The SHA-256 of a file; for a folder that of its files' sorted names and digests, 100 bytes or so for each file."""
    digests = file_digests(spark, path, most_bytes)
    line = F.concat_ws(" ", "file", "sha256")
    whole = F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256)
    return digests.agg(F.when(F.max("file") == "", F.max("sha256")).otherwise(whole)).first()[0]


def same_content(left: DataFrame, right: DataFrame) -> bool:
    """Whether two tables hold the same rows; two one-row results reach the driver."""
    return fingerprint(left).first() == fingerprint(right, left.columns).first()


def catalogue(results: dict[str, DataFrame], samples: int = 5) -> DataFrame:
    """One row per named result: schema, row count and its first rows as JSON.

    The results' own order decides which rows are the first ones.
    """
    listing = None
    for name, data in results.items():
        count = data.agg(F.count(F.lit(1))).scalar()
        head = data.limit(samples).agg(F.collect_list(F.to_json(F.struct(*data.columns)))).scalar()
        row = data.sparkSession.range(1).select(
            F.lit(name).alias("result"),
            F.lit(data.schema.simpleString()).alias("schema"),
            count.alias("row_count"),
            head.alias("sample_rows"),
        )
        listing = row if listing is None else listing.unionByName(row)
    return listing


def report_rows(one_row: DataFrame, section: str, *keys: str) -> DataFrame:
    """A one-row result as report lines (section, name, value text)."""
    names = [name for name in one_row.columns if name not in keys]
    return unfold(
        one_row,
        [
            {"section": F.lit(section), "name": F.lit(name), "value": F.col(name).cast("string")}
            for name in names
        ],
        *keys,
    )
