"""Raw recordings: headerless CSV files, one file per recording.

Layout: ``<root>/<class folder>[/<severity>]/<name>.csv``; the top folder
names the class (``normal`` = 0, ``imbalance`` = 1, others skipped); cells
that are not numbers become NULL.  Row order is the file order and is made
explicit as a dense ``sample_idx`` per file.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.functions import to_double
from tremor.operators.features import CHANNELS
from tremor.operators.ordering import with_sample_index

# Class folder names and their labels.
LABELS = {"normal": 0, "imbalance": 1}


_PATTERN = "*.[cC][sS][vV]"


def _one_slash(c: Column) -> Column:
    """Path URIs with one slash after the scheme (``file:///a`` and ``file:/a`` are the same)."""
    return F.regexp_replace(c, r"^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def qualified(spark: SparkSession, root: str) -> str:
    """``root`` as the URI under which Spark lists it (scheme, absolute path, escapes)."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(conf).makeQualified(path).toUri().toString().rstrip("/")


def _reader(spark: SparkSession):  # noqa: ANN202
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", _PATTERN)


def broken_files(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, broken_lines) of the files with a line that is no UTF-8.  Lines are checked in the splits that Spark reads, and a
    file's verdict is a sum over its splits: no file passes through one task or one row."""
    lines = _reader(spark).text(path).select(F.col("_metadata.file_path").alias("file_path"), "value")
    return lines.where(~F.is_valid_utf8("value")).groupBy("file_path").agg(F.count(F.lit(1)).alias("broken_lines"))


def skipped_files(spark: SparkSession, path: str) -> DataFrame:
    """S3: (file_path, reason) of the files that :func:`scan_csv` leaves out: without a line (``empty``), or with bytes that are no text."""
    scan = _reader(spark).text(path)
    listed = spark.createDataFrame([(f,) for f in scan.inputFiles()], "file_path string").select(_one_slash(F.col("file_path")).alias("file_path"))
    read = scan.select(_one_slash(F.col("_metadata.file_path")).alias("file_path")).distinct()
    empty = listed.join(read, "file_path", "left_anti").withColumn("reason", F.lit("empty"))
    broken = broken_files(spark, path).select(_one_slash(F.col("file_path")).alias("file_path"), F.lit("not text").alias("reason"))
    return empty.unionByName(broken)


def scan_csv(spark: SparkSession, path: str, channels: Sequence[str] = CHANNELS) -> DataFrame:
    """S1 + S3: read headerless CSV files with the channel names, every cell
    coerced to double (junk and NaN -> NULL).  Files with bytes that are no text are left
    out whole, rows before the break included (:func:`skipped_files` lists them).

    Adds ``file_path`` and the split start ``file_block_start`` from the
    hidden ``_metadata`` column and a scan-order id.
    """
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in channels])
    raw = _reader(spark).schema(schema).option("header", "false").option("mode", "PERMISSIVE").csv(path)
    rows = raw.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("file_block_start"),
        F.monotonically_increasing_id().alias("__scan_id"),
        *[to_double(c).alias(c) for c in channels],
    )
    return rows.join(broken_files(spark, path), "file_path", "left_anti")


def label_from_path(root: str, labels: Mapping[str, int] = LABELS):
    """(label, severity, name) columns from the path below ``root`` (a URI as listed, see
    :func:`qualified`); label NULL for folders that are not class folders.  A
    Hive-style folder ``name=value`` counts by its value."""
    base = _one_slash(F.lit(root.rstrip("/") + "/"))
    path = _one_slash(F.col("file_path"))
    rel = F.when(F.startswith(path, base), F.substr(path, F.length(base) + 1))
    # Hive-style folders ("label=normal") count by their value
    parts = F.transform(F.split(rel, "/"), lambda p: F.regexp_replace(p, r"^[^=]+=", ""))
    top = F.lower(F.get(parts, F.lit(0)))
    label = F.lit(None).cast("int")
    for name, v in labels.items():
        label = F.when(top == name, F.lit(v)).otherwise(label)
    severity = F.when(F.size(parts) > 2, F.get(parts, F.lit(1)))
    return label.alias("label"), severity.alias("severity"), F.try_element_at(parts, F.lit(-1)).alias("file_name")


def read_recordings(spark: SparkSession, root: str, channels: Sequence[str] = CHANNELS,
                    labels: Mapping[str, int] = LABELS, max_rows: int | None = None) -> DataFrame:
    """Every recording below ``root`` with label, severity and the
    dense ``sample_idx`` in file order; ``max_rows`` keeps the first rows of
    each file (``nrows``), not a global limit."""
    scanned = scan_csv(spark, root, channels)
    lab = scanned.select("*", *label_from_path(qualified(spark, root), labels)).where(F.col("label").isNotNull())
    ordered = with_sample_index(lab, ["file_path"], ["file_block_start", "__scan_id"])
    if max_rows is not None:
        ordered = ordered.where(F.col("sample_idx") < max_rows)
    return ordered.drop("file_block_start", "__scan_id")


def load_table(spark: SparkSession, path: str, target: str = "fault_label", fmt: str = "csv",
               schema: T.StructType | None = None, validate: bool = True) -> DataFrame:
    """Read a processed feature table (CSV with header, or Parquet) and
    check it: empty -> ValueError, missing target -> ValueError."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        df = reader.option("header", "true").option("inferSchema", "false" if schema else "true").csv(path)
    else:
        df = reader.format(fmt).load(path)
    if validate:
        if target not in df.columns:
            raise ValueError(f"target column {target!r} not found")
        if df.isEmpty():
            raise ValueError("empty table")
    return df


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> None:
    """Write a table (train / test split, drift report, metrics) as
    Parquet, CSV with header or JSON."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", "true").csv(path)
    else:
        w.format(fmt).save(path)
