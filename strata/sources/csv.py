"""CSV landing files.

Every business column is read as text; types come later from metadata.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from strata.functions.headers import normalize_headers, normalize_name

#: Bytes read at a time, and files open at a time, while headers are looked up.
PROBE_BYTES = 4096
PROBE_THREADS = 16


def scan_csv(spark: SparkSession, path, schema: StructType | None = None, **options) -> DataFrame:
    """Header row, every column STRING (no inference). Empty fields are NULL,
    short rows are padded with NULL, surplus fields of long rows are dropped."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    for k, v in options.items():
        reader = reader.option(k, v)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def scan_csv_inferred(spark: SparkSession, path_glob, **options) -> DataFrame:
    """Exploratory read with type inference (one extra pass over the data)."""
    return scan_csv(spark, path_glob, inferSchema=True, **options)


def string_schema(names) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


def _first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a file given as a URI, decompressed if its name says so; None if empty.

    Opens the file with Spark's own file system and credentials, reads
    ``PROBE_BYTES`` at a time until the line ends, and closes it.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = path.getFileSystem(conf).open(path, PROBE_BYTES)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        body = stream if codec is None else codec.createInputStream(stream)
        line = jvm.org.apache.hadoop.io.Text()
        read = jvm.org.apache.hadoop.util.LineReader(body, PROBE_BYTES).readLine(line)
        return line.toString().removeprefix("\ufeff") if read else None
    finally:
        stream.close()


def first_lines(spark: SparkSession, files: list[str]) -> list[tuple[str, str]]:
    """``(file, header)`` of each file (a URI) that is not empty, at most
    ``PROBE_THREADS`` files open at a time. No Spark job, no more than a few KB a file."""
    with ThreadPoolExecutor(PROBE_THREADS) as pool:
        lines = pool.map(lambda f: _first_line(spark, f), files)
        return [(f, x) for f, x in zip(files, lines, strict=True) if x is not None]


def csv_headers(spark: SparkSession, paths, glob: str = "*.csv") -> DataFrame:
    """``(path, header)`` for each file of a folder, or of a list of files, that
    is not empty. Files are listed by Spark, and only their first lines are read."""
    files = spark.read.option("pathGlobFilter", glob).text(paths).inputFiles()
    return spark.createDataFrame(first_lines(spark, files), "path string, header string")


def _layout(header_line: str) -> tuple[str, ...]:
    """Normalised column names of a header line, in order."""
    import csv as pycsv
    fields = next(pycsv.reader([header_line]), [])
    return tuple(normalize_name(f) for f in fields)


def header_groups(spark: SparkSession, paths, glob: str = "*.csv") -> list[list[str]]:
    """Files grouped by column layout, each group sorted: headers that normalise
    to the same names in the same order are one layout.

    One probe; the driver holds file names and header lines, as it holds Spark's
    own file index, never rows.
    """
    files = spark.read.option("pathGlobFilter", glob).text(paths).inputFiles()
    groups: dict[tuple, list[str]] = {}
    for file, header in first_lines(spark, files):
        groups.setdefault(_layout(header), []).append(unquote(file))
    return [sorted(groups[k]) for k in sorted(groups)]


def scan_csv_groups(spark: SparkSession, groups: list[list[str]],
                    normalize: bool = True) -> DataFrame:
    """One CSV read per group of files, combined by column name (a column
    missing from a group is NULL there). Exactly the files given are read, so
    one that arrives meanwhile is never read by another file's header."""
    out = None
    for files in groups:
        df = scan_csv(spark, files)
        df = normalize_headers(df) if normalize else df
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def scan_csv_folder(spark: SparkSession, folder: str, glob: str = "*.csv",
                    normalize: bool = True) -> DataFrame:
    """All files of an object's folder, with headers matched per file; the
    probe for headers runs when this is called."""
    groups = header_groups(spark, folder, glob)
    if not groups:
        raise FileNotFoundError(f"no {glob} files with a header in {folder}")
    return scan_csv_groups(spark, groups, normalize)
