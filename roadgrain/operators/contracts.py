"""Strict reads: rows of text cells checked against a contract.

Bad rows are reported, never dropped silently: ``check_rows`` adds the list of issues to
every row, ``good_rows`` gives the typed rows without issues, ``issue_report`` counts.
A distributed file has no row numbers, so an issue carries the offending cell instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadgrain.functions.derive import decimal_number, is_finite
from roadgrain.functions.text import strip
from roadgrain.operators.rows import unfold
from roadgrain.schemas import CLASSES
from roadgrain.sources.files import MALFORMED, MOST_HEADERS, file_headers, header_names, read_cells

ISSUE_TYPE = "array<struct<issue:string,column_name:string,cell:string>>"
SALTS = 16


@dataclass(frozen=True)
class Cell:
    """One required column: its kind and limits.

    Kinds: text, int, float, date (canonical ISO), flag (true or false in any case).
    """

    name: str
    kind: str = "text"
    low: float | None = None
    high: float | None = None
    choices: tuple[str, ...] | None = None
    finite: bool = False

    @property
    def issue(self) -> str:
        return {
            "int": "invalid integer",
            "float": "invalid number",
            "date": "invalid date",
            "flag": "invalid boolean",
        }.get(self.kind, "unsupported value")

    def value(self) -> Column:
        cell = F.col(f"`{self.name}`")
        if self.kind == "int":
            return cell.try_cast("bigint")
        if self.kind == "float":
            return decimal_number(cell)
        if self.kind == "date":
            parsed = cell.try_cast("date")
            return F.when(parsed.cast("string") == cell, parsed)
        if self.kind == "flag":
            lowered = F.lower(cell)
            return F.when(lowered == "true", F.lit(True)).when(lowered == "false", F.lit(False))
        return cell

    def problem(self, value: Column, blank_is_missing: bool) -> Column:
        """Name of the first broken rule, null for a good cell; ``value`` is the parsed cell."""
        cell = F.col(f"`{self.name}`")
        absent = cell.isNull() | (cell == "") if blank_is_missing else cell.isNull()
        result = F.when(absent, "incomplete")
        if self.kind != "text":
            result = result.when(value.isNull(), self.issue)
        if self.choices:
            result = result.when(~cell.isin(list(self.choices)), "unsupported value")
        if self.finite:
            result = result.when(~is_finite(value), "non-finite number")
        if self.low is not None:
            result = result.when(value < self.low, "out of range")
        if self.high is not None:
            result = result.when(value > self.high, "out of range")
        return result


@dataclass(frozen=True)
class Contract:
    """Required columns, the unique key if any, and whether empty text counts as missing."""

    name: str
    cells: tuple[Cell, ...]
    key: str | None = None
    blank_is_missing: bool = False

    @property
    def columns(self) -> list[str]:
        return [cell.name for cell in self.cells]


# ---------------------------------------------------------------- fixed values
def _counts(*names: str) -> tuple[Cell, ...]:
    return tuple(Cell(name, "int", low=0) for name in names)


def _numbers(*names: str, finite: bool = False) -> tuple[Cell, ...]:
    return tuple(Cell(name, "float", finite=finite) for name in names)


CORRIDOR_SUMMARY = Contract(
    "corridor summary",
    (
        Cell("corridor"),
        Cell("record_count", "int"),
        *_numbers("average_traffic_volume", "average_speed", "average_congestion_level", "average_travel_time_index"),
        Cell("low_congestion_count", "int"),
        Cell("medium_congestion_count", "int"),
        Cell("high_congestion_count", "int"),
    ),
    key="corridor",
)
HIGH_CONGESTION = Contract(
    "high-congestion corridors",
    (
        Cell("corridor"),
        *_counts("total_records", "high_congestion_count"),
        Cell("high_congestion_percentage", "float", low=0, high=100),
    ),
    key="corridor",
)
DAY_TYPE_SUMMARY = Contract(
    "day-type summary",
    (
        Cell("day_type"),
        *_counts("record_count"),
        *_numbers(
            "average_traffic_volume",
            "average_speed",
            "average_congestion_level",
            "average_travel_time_index",
            finite=True,
        ),
        *_counts("high_congestion_count"),
        Cell("high_congestion_percentage", "float", low=0, high=100, finite=True),
    ),
    blank_is_missing=True,
)
DAY_OF_WEEK_SUMMARY = Contract(
    "day-of-week summary",
    (
        Cell("day_of_week", "int", low=1, high=7),
        *_counts("record_count"),
        *_numbers("average_traffic_volume", "average_speed", "average_congestion_level", finite=True),
        Cell("high_congestion_percentage", "float", low=0, high=100, finite=True),
    ),
    blank_is_missing=True,
)
ADVISORY_ROWS = Contract(
    "advisory",
    (
        Cell("date", "date"),
        Cell("corridor"),
        Cell("congestion_class", choices=tuple(CLASSES)),
        Cell("festival_flag", "flag"),
        Cell("holiday_flag", "flag"),
        Cell("weather"),
        Cell("roadwork", choices=("Yes", "No")),
        Cell("advisory_level"),
        Cell("recommendation"),
        Cell("personnel_action"),
        Cell("diversion_action"),
        Cell("roadwork_action"),
    ),
    blank_is_missing=True,
)
# ------------------------------------------------------------ end fixed values


def missing_columns(columns: list[str], contract: Contract) -> list[str]:
    return [name for name in contract.columns if name not in columns]


def require_columns(columns: list[str], contract: Contract) -> None:
    """Fail on an empty header, repeated names or missing required columns; extra ones are fine."""
    if not columns:
        raise ValueError(f"{contract.name}: empty or has no header.")
    if len(columns) != len(set(columns)):
        raise ValueError(f"{contract.name}: contains duplicate column names.")
    missing = missing_columns(columns, contract)
    if missing:
        raise ValueError(f"{contract.name}: missing required columns: {', '.join(missing)}.")


def check_rows(cells: DataFrame, contract: Contract, malformed: str | None = None) -> DataFrame:
    """Add ``issues`` to every row of text cells.

    ``malformed`` names a column that holds the raw line when the reader met a wrong
    number of fields. Repeated keys are found with a group-by that merges before its shuffle;
    the rows meet them by key and a salt, so one very frequent key is spread over ``SALTS`` tasks.
    """
    require_columns([name for name in cells.columns if name != malformed], contract)
    columns = cells.columns

    def issue(name: Column, column: str) -> Column:
        cell = F.col(f"`{column}`") if column else F.lit(None).cast("string")
        return F.struct(name.alias("issue"), F.lit(column).alias("column_name"), cell.alias("cell"))

    found = []
    if malformed:
        wrong = F.when(F.col(malformed).isNotNull(), "wrong number of fields")
        found.append(F.struct(wrong.alias("issue"), F.lit("").alias("column_name"), F.col(malformed).alias("cell")))
    if contract.key:
        key = F.col(f"`{contract.key}`")
        repeated = (
            cells.groupBy(key.alias("_key"))
            .agg(F.count(F.lit(1)).alias("_copies"))
            .where("_copies > 1 AND _key <> ''")
            .withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        )
        salt = F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in columns]), F.lit(SALTS)).cast("int")
        cells = cells.withColumn("_salt", salt)
        cells = cells.join(repeated, (key == F.col("_key")) & (F.col("_salt") == F.col("_slot")), "left")
        columns = [*columns, "_copies"]
        if not contract.blank_is_missing:
            found.append(issue(F.when(key == "", "empty key"), contract.key))
        found.append(issue(F.when(F.col("_copies").isNotNull(), "duplicate key"), contract.key))
    # Parse every cell once, in a projection of its own, then test the parsed values.
    parsed = cells.select(
        *[F.col(f"`{name}`") for name in columns],
        *[cell.value().alias(f"_value{i}") for i, cell in enumerate(contract.cells) if cell.kind != "text"],
    )
    for i, cell in enumerate(contract.cells):
        value = F.col(f"_value{i}") if cell.kind != "text" else F.col(f"`{cell.name}`")
        found.append(issue(cell.problem(value, contract.blank_is_missing), cell.name))
    issues = F.filter(F.array(*found), lambda i: i.getField("issue").isNotNull())
    return parsed.select(
        *[F.col(f"`{name}`") for name in columns if name != "_copies"], issues.cast(ISSUE_TYPE).alias("issues")
    )


def good_rows(checked: DataFrame, contract: Contract) -> DataFrame:
    """Typed contract columns of the rows without issues."""
    return checked.where(F.size("issues") == 0).select(*[c.value().alias(c.name) for c in contract.cells])


def bad_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("issues") > 0)


def issue_report(checked: DataFrame) -> DataFrame:
    """Rows (issue, column_name, row_count, example) plus ``no records`` for an empty table."""
    found = (
        checked.select(F.inline_outer("issues"))
        .where("issue IS NOT NULL")
        .groupBy("issue", "column_name")
        .agg(F.count(F.lit(1)).alias("row_count"), F.min("cell").alias("example"))
    )
    empty = checked.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(
        F.lit("no records").alias("issue"),
        F.lit("").alias("column_name"),
        F.col("n").alias("row_count"),
        F.lit(None).cast("string").alias("example"),
    )
    return found.unionByName(empty)


def strict_rows(cells: DataFrame, contract: Contract, malformed: str | None = None) -> DataFrame:
    """Typed rows, failing at run time on the first row with an issue."""
    checked = check_rows(cells, contract, malformed)
    text = F.concat_ws(" ", F.lit(contract.name + ":"), F.col("issues")[0]["issue"], F.col("issues")[0]["column_name"])
    return good_rows(checked.where(F.assert_true(F.size("issues") == 0, text).isNull()), contract)


def check_files(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """``check_rows`` of CSV files, each read under its own header; columns the contract doesn't name are left out.

    A file without a required column fails the whole read, as do an absent path and an empty one.
    """
    for row in file_headers(spark, path).select("header").distinct().limit(MOST_HEADERS + 1).collect():
        require_columns(header_names(row["header"]), contract)
    return check_rows(read_cells(spark, path).select(*contract.columns, MALFORMED), contract, MALFORMED)


# ----------------------------------------------------------- raw text file checks
TIME_SHAPE = {
    "date": (r"^\d{4}-\d{1,2}-\d{1,2}$", "date"),
    "timestamp": (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$", "timestamp_ntz"),
}


@dataclass(frozen=True)
class RawFile:
    """What a raw text file must hold."""

    columns: tuple[str, ...]
    categories: tuple[str, ...]
    time_column: str
    time_kind: str = "timestamp"

    def time(self) -> Column:
        shape, kind = TIME_SHAPE[self.time_kind]
        cell = F.col(f"`{self.time_column}`")
        return F.when(cell.rlike(shape), cell.try_cast(kind))


# The generated data sets.
RAW_FILES = {
    "traffic.csv": RawFile(
        ("timestamp", "junction", "traffic_volume", "congestion_level", "weather", "signal_status"),
        ("junction", "congestion_level", "weather", "signal_status"),
        "timestamp",
    ),
    "toll.csv": RawFile(("timestamp", "toll_plaza", "vehicle_count", "transaction_count"), ("toll_plaza",), "timestamp"),
    "signal.csv": RawFile(("timestamp", "junction", "signal_status"), ("junction", "signal_status"), "timestamp"),
    "festival_calendar.csv": RawFile(
        ("date", "festival_name", "is_festival", "is_holiday", "day_type"),
        ("festival_name", "is_festival", "is_holiday", "day_type"),
        "date",
        "date",
    ),
}

def raw_file_findings(cells: DataFrame, wanted: RawFile) -> DataFrame:
    """Findings (check, column_name, row_count, detail) of one raw table of text cells.

    Missing columns (without a row count), blank cells per column, surplus duplicate
    rows, and every distinct unparseable time with its row count.
    """
    present = [name for name in wanted.columns if name in cells.columns]
    missing = [name for name in wanted.columns if name not in cells.columns]
    # Equal rows are merged once; every check then weighs a row by its copies. The checks
    # group the same way, so Spark reads and shuffles the cells a single time.
    merged = cells.groupBy(*[F.col(f"`{name}`") for name in cells.columns]).agg(F.count(F.lit(1)).alias("_copies"))
    copies, nothing = F.col("_copies"), F.lit(None).cast("string")

    def finding(check: str, column: str, rows: Column) -> dict[str, Column]:
        return {"check": F.lit(check), "column_name": F.lit(column), "row_count": rows, "detail": nothing}

    blanks = merged.agg(
        F.sum(copies - 1).alias("surplus"),
        *[
            F.sum(F.when(F.coalesce(strip(F.col(f"`{name}`")), F.lit("")) == "", copies)).alias(f"c{i}")
            for i, name in enumerate(present)
        ],
    )
    rows = [finding("missing column", name, F.lit(-1).cast("bigint")) for name in missing]
    rows += [finding("missing values", name, F.col(f"c{i}")) for i, name in enumerate(present)]
    rows.append(finding("duplicate rows", "", F.col("surplus")))
    counted = unfold(blanks, rows).where("row_count <> 0")
    findings = counted.withColumn("row_count", F.when(F.col("row_count") > 0, F.col("row_count")))
    if wanted.time_column in cells.columns:
        # Tied to the copies, so that the filter stays above the group-by and the shuffle is shared.
        bad_times = (
            merged.where(F.when(copies > 0, wanted.time().isNull()))
            .groupBy(F.col(f"`{wanted.time_column}`").alias("detail"))
            .agg(F.sum(copies).alias("row_count"))
            .select(F.lit("invalid time").alias("check"), F.lit(wanted.time_column).alias("column_name"), "row_count", "detail")
        )
        findings = findings.unionByName(bad_times)
    return findings


def raw_file_profile(cells: DataFrame, wanted: RawFile) -> DataFrame:
    """One row: row count, first and last time, and the sorted values of each category as an array."""
    categories = [name for name in wanted.categories if name in cells.columns]
    # Rows are merged by hash to the combinations of category values, which are few.
    merged = cells.groupBy(*[F.col(f"`{name}`") for name in categories]).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(wanted.time()).alias("_first"), F.max(wanted.time()).alias("_last")
    )
    return merged.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"),
        F.min("_first").cast("string").alias("minimum_time"),
        F.max("_last").cast("string").alias("maximum_time"),
        *[F.array_sort(F.collect_set(F.col(f"`{name}`"))).alias(f"{name}_values") for name in categories],
    )


def category_values(cells: DataFrame, wanted: RawFile) -> DataFrame:
    """Rows (column_name, value, row_count): every value of every category column; absent cells are null."""
    categories = [name for name in wanted.categories if name in cells.columns]
    merged = cells.groupBy(*[F.col(f"`{name}`") for name in categories]).agg(F.count(F.lit(1)).alias("_rows"))
    values = unfold(merged, [{"column_name": F.lit(name), "value": F.col(f"`{name}`")} for name in categories], "_rows")
    return values.groupBy("column_name", "value").agg(F.sum("_rows").alias("row_count"))


def _whole_file_finding(spark: SparkSession, check: str) -> DataFrame:
    nothing = {"row_count": F.lit(None).cast("bigint"), "detail": F.lit(None).cast("string")}
    return unfold(spark.range(1), [{"check": F.lit(check), "column_name": F.lit(""), **nothing}])


def registry_findings(
    spark: SparkSession, tables: dict[str, DataFrame | str | None], registry: dict[str, RawFile] | None = None
) -> DataFrame:
    """Findings of every registered file; an absent one is a finding and the rest still run.

    A text in place of a table is the finding of a file that couldn't be read.
    """
    result = None
    for name, wanted in (registry or RAW_FILES).items():
        cells = tables.get(name)
        if cells is None:
            found = _whole_file_finding(spark, "missing file")
        elif isinstance(cells, str):
            found = _whole_file_finding(spark, cells)
        else:
            found = raw_file_findings(cells, wanted)
        named = found.withColumn("dataset", F.lit(name))
        result = named if result is None else result.unionByName(named)
    return result


def folder_findings(spark: SparkSession, folder: str, registry: dict[str, RawFile] | None = None) -> DataFrame:
    """``registry_findings`` of a folder: what is there is read, absent and empty files are findings.

    A dataset may be a file or a folder of part files. An absent folder lacks every file.
    """
    tables: dict[str, DataFrame | str | None] = {}
    for name in registry or RAW_FILES:
        try:
            tables[name] = read_cells(spark, f"{folder.rstrip('/')}/{name}").drop(MALFORMED)
        except FileNotFoundError:
            continue
        except ValueError as error:
            tables[name] = "duplicate column names" if "duplicate" in str(error) else "empty file"
    return registry_findings(spark, tables, registry)
