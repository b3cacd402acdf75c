"""CSV to bronze: full, whole folder, incremental by key, explicit timestamp format."""

from __future__ import annotations

import posixpath
import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.sources.tables import Lake

# strftime letters that may occur in a timestamp format, and what they become
STRFTIME = {
    "%Y": "yyyy",
    "%m": "MM",
    "%d": "dd",
    "%H": "HH",
    "%M": "mm",
    "%S": "ss",
    "%f": "SSSSSS",
}


#: How CSV is written and read: quotes inside quotes are doubled, white space stays, a cell that does not
#: fit its type is an error.
CSV_FORM = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def csv_options(multi_line: bool = True) -> dict:
    """Reader options. ``multi_line`` allows line breaks in quoted cells; without it Spark may split a large file."""
    return CSV_FORM | {"mode": "FAILFAST", "multiLine": multi_line}


def datetime_pattern(fmt: str) -> str:
    """A strftime format as a Spark pattern; literal text after the fields is quoted."""
    out, literal, i = [], "", 0
    while i < len(fmt):
        token = fmt[i : i + 2]
        if token in STRFTIME:
            if literal:
                out.append(_literal(literal))
                literal = ""
            out.append(STRFTIME[token])
            i += 2
        else:
            literal += fmt[i]
            i += 1
    if literal:
        out.append(_literal(literal))
    return "".join(out)


def _literal(text: str) -> str:
    return f"'{text}'" if any(c.isalnum() or c == "+" for c in text) else text


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    timestamp_columns: list[str] | None = None,
    timestamp_format: str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """One CSV with header. A malformed cell raises. Times keep their wall clock as ``timestamp_ntz``.

    Without ``schema`` Spark makes one extra pass over the file to infer it; give the
    schema for large inputs. ``timestamp_format`` (strftime letters) is applied to
    ``timestamp_columns``, which are then read as text first; fractions of up to six digits are
    kept. One file with ``multi_line`` is one task; pass False where no cell has a line break.
    """
    reader = spark.read.options(**csv_options(multi_line))
    if schema is not None and not timestamp_format:
        return reader.schema(schema).csv(path)
    if timestamp_format:
        header = reader.csv(path).columns
        names = timestamp_columns or [c for c in header if "timestamp" in c.lower()]
        inferred = schema or reader.option("inferSchema", True).csv(path).schema
        typed = T.StructType(
            [
                T.StructField(f.name, T.TimestampNTZType() if f.name in names else f.dataType)
                for f in inferred
            ]
        )
        pattern = datetime_pattern(timestamp_format)
        return (
            spark.read.options(**csv_options(multi_line)).option("timestampNTZFormat", pattern).schema(typed).csv(path)
        )
    df = reader.option("inferSchema", True).csv(path)
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(f"`{c}`").cast("timestamp_ntz") for c in zoned}) if zoned else df


def with_load_metadata(df: DataFrame, source: str, loaded_at: Column | None = None) -> DataFrame:
    """Add ``_loaded_at`` and ``_source_file``."""
    when = F.localtimestamp() if loaded_at is None else loaded_at
    return df.withColumns({"_loaded_at": when, "_source_file": F.lit(source)})


def ingest_csv(lake: Lake, path: str, table: str, **read_options) -> DataFrame:
    """Load one CSV into ``bronze.<table>``, replacing it; running it again changes nothing."""
    df = read_csv(lake.spark, path, **read_options)
    return lake.write(with_load_metadata(df, path), "bronze", table)


def list_csv(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the ``*.csv`` entries of a folder on any Hadoop file system."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/*.csv")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(status.getPath().toString() for status in found or [])


def ingest_dir(lake: Lake, folder: str, **read_options) -> dict[str, DataFrame]:
    """Load every CSV of a folder; the table takes the file's stem as its name."""
    paths = list_csv(lake.spark, folder)
    if not paths:
        warnings.warn(f"no CSV files in {folder}")
        return {}
    return {
        (stem := posixpath.splitext(posixpath.basename(p))[0]): ingest_csv(lake, p, stem, **read_options)
        for p in paths
    }


def high_water_mark(lake: Lake, table: str, key: str):
    """The highest key stored in a bronze table, None when there is none."""
    if not lake.exists("bronze", table):
        return None
    return lake.read("bronze", table).agg(F.max(key)).first()[0]


def ingest_incremental(lake: Lake, path: str, table: str, key: str, **read_options) -> int:
    """Append CSV rows whose key exceeds the highest one loaded; returns the table's rows.

    A missing table, or one without any key, gets a full load. Rows at or below the
    high-water mark are skipped, also when they arrive late. The mark reaches the scan as a
    literal filter.
    """
    high = high_water_mark(lake, table, key)
    if high is None:
        return ingest_csv(lake, path, table, **read_options).count()
    stored = lake.read("bronze", table)
    fresh = read_csv(lake.spark, path, **read_options).filter(F.col(key) > F.lit(high))
    batch = with_load_metadata(fresh, path).select(
        *(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in stored.schema)
    )
    return lake.append(batch, "bronze", table).count()


def copy_csv(
    spark: SparkSession,
    sources: list[str],
    target: str,
    rename: dict[str, str] | None = None,
    sort_by: list[str] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Read cleaned CSVs, rename columns, concatenate, optionally sort, write as raw CSV.

    Columns stay text, so values are copied unchanged.
    """
    frames = [spark.read.options(**csv_options()).csv(p, schema=schema) for p in sources]
    out = frames[0].withColumnsRenamed(rename or {})
    for frame in frames[1:]:
        out = out.unionByName(frame.withColumnsRenamed(rename or {}), allowMissingColumns=True)
    if sort_by:
        out = out.orderBy(*sort_by)
    out.write.mode("overwrite").options(**CSV_FORM).csv(target)
    return spark.read.options(**csv_options()).csv(target)
