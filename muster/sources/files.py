"""Landed files: delimited, JSON, Parquet.  Text layers are read as text and typed by the rollups."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muster.operators.columns import quoted, resolve_column

_RAW = "_raw_line"


def _glob_any_case(prefix: str) -> str:
    """File-name pattern of a prefix in any case."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in prefix) + "*"


def _without_long_lines(rows: DataFrame, names: Sequence[str], fields: Column) -> DataFrame:
    """Only malformed lines carry their text; of these, short ones stay.

    The reader must see whole lines to tell, hence ``columnPruning`` is off in both readers.  Spark
    refuses to read the text of malformed lines alone, so the filter looks at a field too.
    """
    some_field = F.length(F.coalesce(quoted(names[0]), F.lit(""))) >= 0
    return rows.filter((F.col(_RAW).isNull() | (fields <= len(names))) & some_field)


def _field_count(separator: str) -> Column:
    """Fields of a line; separators within quotes part nothing."""
    bare = F.regexp_replace(_RAW, r'"(?:[^"]|"")*"', "")
    return F.size(F.split(bare, separator))


def read_tsv(
    spark: SparkSession, path: str | Sequence[str], header: Sequence[str] | None = None, **options
) -> DataFrame:
    """Tab-separated text, Latin-1, all columns text, file names in ``_file``.

    Lines with more fields than the header are dropped, lines with fewer are padded with nulls.
    Quoted fields lose their quotes, doubled ones become single; ``multiLine=True`` lets them span lines.
    All files of one call must share one header line, which is taken from them unless given.
    """
    reader = spark.read.options(
        sep="\t", quote='"', escape='"', encoding="ISO-8859-1", header=True, **options
    )
    names = list(header) if header else reader.option("inferSchema", False).csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _RAW]])
    rows = (
        reader.schema(schema)
        .options(
            mode="PERMISSIVE", columnNameOfCorruptRecord=_RAW, columnPruning=False,
            enforceSchema=False,
        )
        .csv(path)
    )
    kept = _without_long_lines(rows, names, _field_count("\t"))
    return kept.select(*[quoted(n) for n in names], F.col("_metadata.file_path").alias("_file"))


def _listing(spark: SparkSession, path: str | Sequence[str], prefix: str | None = None) -> DataFrame:
    """Column ``path`` of the files below a path, of those whose name starts with a prefix in any case."""
    reader = spark.read.format("binaryFile").options(recursiveFileLookup=True)
    if prefix is not None:
        reader = reader.option("pathGlobFilter", _glob_any_case(prefix))
    return reader.load(path).select("path")


_QUARTER = r"(?i)(\d{4}q[1-4])[^/]*/"


def listed_quarters(spark: SparkSession, root: str, prefix: str) -> set[str]:
    """Quarters that have a file of this name."""
    quarter = F.lower(F.regexp_extract("path", _QUARTER, 1)).alias("quarter")
    return {r.quarter for r in _listing(spark, root, prefix).select(quarter).distinct().collect()}


# A task per file.
_FIRST_LINES = {
    "spark.sql.files.maxPartitionBytes": f"{1 << 60}b",
    "spark.sql.files.openCostInBytes": f"{1 << 60}b",
}
_ROW_OF_TASK = (1 << 33) - 1  # bits of a row's number within its task


def header_lines(spark: SparkSession, path: str | Sequence[str], prefix: str | None = None) -> DataFrame:
    """``path, line`` of the files below a path, as bytes, with files in compressed form decoded; empty files have none.

    The scan itself keeps the first row of each task.  A Python function that stops after it would still be sent
    all others, one by one.
    """
    reader = spark.read.options(recursiveFileLookup=True)
    if prefix is not None:
        reader = reader.option("pathGlobFilter", _glob_any_case(prefix))
    first = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_OF_TASK)) == 0
    lines = reader.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("line"))
    return lines.filter(first)


def _by_header(spark: SparkSession, path: str | Sequence[str], prefix: str | None = None) -> dict[str, list[str]]:
    """Files by their header line.  Executors open them; the driver gets one line of each."""
    before = {k: spark.conf.get(k, None) for k in _FIRST_LINES}
    try:
        for k, v in _FIRST_LINES.items():
            spark.conf.set(k, v)
        found = header_lines(spark, path, prefix).collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        found = []
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    layouts: dict[str, list[str]] = {}
    for row in sorted(found):
        layouts.setdefault(bytes(row.line).decode("latin-1"), []).append(unquote(row.path))
    return layouts


def read_table_files(spark: SparkSession, root: str, prefix: str) -> DataFrame | None:
    """All files below ``root`` whose name starts with ``prefix``, in any case, at any depth.

    Files are read together by header line, so that a column is always found by its name.  Column
    names come out in upper case, and ``_quarter`` is the ``2020q1`` part of the path.  None when
    there are no such files.
    """
    quarter = F.lower(F.regexp_extract("_file", _QUARTER, 1)).alias("_quarter")
    table = None
    for line, paths in sorted(_by_header(spark, root, prefix).items()):
        header = [c.strip('"') for c in line.split("\t")]
        rows = read_tsv(spark, paths, header).select(
            *[quoted(c).alias(c.upper()) for c in header], quarter
        )
        table = rows if table is None else table.unionByName(rows, allowMissingColumns=True)
    return table


def _csv_layouts(spark: SparkSession, path: str, **options) -> list[tuple[DataFrameReader, list[str]]]:
    """A reader and its files for each header line below a path, so that columns are found by name."""
    reader = lambda: spark.read.options(header=True, quote='"', escape='"', **options)
    return [(reader(), paths) for _, paths in sorted(_by_header(spark, path).items())]


def read_bulk_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Quoted CSV, all text, columns found by the header of each file.

    Lines with too many fields are dropped.  Bytes that are no UTF-8 become replacement characters.  With
    ``multi_line`` fields may hold line breaks; then a file is read by one task, else it is split.
    """
    table = None
    for reader, paths in _csv_layouts(spark, path, multiLine=multi_line, encoding="UTF-8"):
        names = reader.csv(paths[0]).columns
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _RAW]])
        rows = reader.schema(schema).options(
            mode="PERMISSIVE", columnNameOfCorruptRecord=_RAW, columnPruning=False
        ).csv(paths)
        kept = _without_long_lines(rows, names, _field_count(",")).select(*[quoted(n) for n in names])
        table = kept if table is None else table.unionByName(kept, allowMissingColumns=True)
    return table


def read_json_config(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """One JSON document as one row of the given type."""
    return (
        spark.read.text(path, wholetext=True)
        .select(F.from_json("value", ddl).alias("doc"))
    )


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet layer, or no rows of its schema when the layer is not there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_roster(
    spark: SparkSession, path: str, types: dict[str, str], multi_line: bool = False
) -> DataFrame:
    """Roster CSV: columns found by the header, cast to their types; flags are never null.

    ``multi_line`` as in ``read_bulk_csv``.
    """
    raw = None
    for reader, paths in _csv_layouts(spark, path, multiLine=multi_line):
        part = reader.csv(paths)
        raw = part if raw is None else raw.unionByName(part, allowMissingColumns=True)
    columns = []
    for name, dtype in types.items():
        found = resolve_column(raw, [name])
        text = F.lit(None) if found is None else quoted(found)
        if dtype == "boolean":
            columns.append(F.coalesce(text.try_cast("boolean"), F.lit(False)).alias(name))
        elif dtype == "bigint":
            columns.append(text.try_cast("double").cast("bigint").alias(name))
        else:
            columns.append(text.try_cast(dtype).alias(name))
    return raw.select(*columns)
