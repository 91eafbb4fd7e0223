"""File sources: CSV ingestion with fixed string schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewater.functions import lexicon as lx
from tidewater.functions import sqlexpr as sx
from tidewater.schemas import SOURCE_COLUMNS


def source_schema(name: str) -> StructType:
    """All-string schema of a source file: nothing is inferred."""
    return StructType([StructField(c, StringType(), True) for c in SOURCE_COLUMNS[name]])


def normalize_nulls(df: DataFrame) -> DataFrame:
    """Null tokens (``""``, ``NA``, ``N/A`` and the reader's default list)
    become null in every string column (S2). One projection, built as SQL
    text so the driver makes a single call however many columns there are."""
    tokens = ", ".join(sx.s(t) for t in lx.NA_TOKENS)
    exprs = []
    for f in df.schema.fields:
        name = f"`{f.name}`"
        if isinstance(f.dataType, StringType):
            exprs.append(f"CASE WHEN {name} IN ({tokens}) THEN NULL ELSE {name} END AS {name}")
        else:
            exprs.append(name)
    return df.selectExpr(*exprs)


def assert_source_marker(spark: SparkSession, source_dir: str) -> None:
    """Refuse a source folder whose README lacks the demo marker.

    A folder without README passes. Checked once per folder, on the driver:
    the README is one small text file.
    """
    path = f"{source_dir.rstrip('/')}/README.md"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
    if not fs.exists(jvm_path):
        return
    hit = (spark.read.text(path, wholetext=True)
           .filter(F.contains(F.col("value"), F.lit(lx.SOURCE_MARKER))).limit(1).count())
    if hit == 0:
        raise RuntimeError("Source README lacks the demo marker; refusing to load.")


CORRUPT = "_corrupt"


def csv_options(multiline: bool) -> dict[str, object]:
    return {"header": True, "multiLine": multiline, "escape": '"', "mode": "PERMISSIVE", "emptyValue": "",
            "columnNameOfCorruptRecord": CORRUPT, "enforceSchema": False}


def header_schema(spark: SparkSession, path: str, name: str, multiline: bool = False) -> StructType:
    """All-string schema in the order of the file's own header, plus the corrupt-record column.
    A column that the source needs and the file lacks is an error; others are read and ignored."""
    header = spark.read.options(**csv_options(multiline)).csv(path).columns
    missing = [c for c in SOURCE_COLUMNS[name] if c not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return StructType([StructField(c, StringType(), True) for c in [*header, CORRUPT]])


def _read_csv(spark: SparkSession, source_dir: str, name: str, multiline: bool) -> DataFrame:
    path = f"{source_dir.rstrip('/')}/{name}.csv"
    schema = header_schema(spark, path, name, multiline)
    df = spark.read.schema(schema).options(**csv_options(multiline)).csv(path)
    return df.where(reads_all(df))


def reads_all(df: DataFrame):
    """True for every row, but needs every column: a parser that skips the columns a query doesn't
    use would miss rows with too many or too few fields."""
    return F.length(F.concat_ws("", *[F.col(f"`{c}`") for c in df.columns if c != CORRUPT])) >= 0


def read_source(spark: SparkSession, source_dir: str, name: str, multiline: bool = False) -> DataFrame:
    """Read ``<dir>/<name>.csv``: columns bound by header name, all strings.

    Missing files raise ``AnalysisException`` from Spark, missing columns ``ValueError``. Rows
    whose fields don't match the header are left to ``read_rejects``. Files are split over tasks;
    ``multiline`` reads quoted line breaks and takes a file as one task. Typing happens in the
    ``clean_*`` operators with ``try_cast``.
    """
    df = _read_csv(spark, source_dir, name, multiline).where(F.col(CORRUPT).isNull())
    return normalize_nulls(df.select(*SOURCE_COLUMNS[name]))


def read_landing(spark: SparkSession, source_dir: str, name: str, multiline: bool = False) -> DataFrame:
    """All rows of a file in one parse: the source's columns with nulls normalised, and ``_corrupt``, the
    raw text of a row whose fields don't match the header (else null)."""
    df = _read_csv(spark, source_dir, name, multiline)
    tidy = normalize_nulls(df.select(*SOURCE_COLUMNS[name], F.struct(CORRUPT).alias(CORRUPT)))  # the raw text stays as it is
    return tidy.withColumn(CORRUPT, F.col(f"{CORRUPT}.{CORRUPT}"))


def read_rejects(spark: SparkSession, source_dir: str, name: str, multiline: bool = False) -> DataFrame:
    """Rows of the file that ``read_source`` leaves out: ``table``, ``row_key`` (the first field),
    ``reason`` and the raw ``row``."""
    df = _read_csv(spark, source_dir, name, multiline).where(F.col(CORRUPT).isNotNull())
    return df.select(F.lit(name).alias("table"), F.col(f"`{SOURCE_COLUMNS[name][0]}`").alias("row_key"),
                     F.lit("fields do not match the header").alias("reason"), F.col(CORRUPT).alias("row"))


def extract_all(spark: SparkSession, source_dir: str, multiline: bool = False) -> dict[str, DataFrame]:
    """All five sources, lazily."""
    assert_source_marker(spark, source_dir)
    return {name: read_source(spark, source_dir, name, multiline) for name in lx.SOURCE_NAMES}


def source_row_counts(sources: dict[str, DataFrame]) -> DataFrame:
    """Rows per source and their total (S6), in one aggregate.

    Columns: ``source``, ``n_rows``; the total has ``source='total'``.
    """
    from tidewater.sinks.warehouse import count_rows_by_name
    return count_rows_by_name(sources, "source")
