"""CSV files with a header, quotes doubled inside quoted fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# A doubled quote stands for a quote; Spark's own default, a backslash, splits such fields.
_QUOTING = {"header": True, "quote": '"', "escape": '"'}


# A compressed file is read by one task, so none holds more rows. The fast level takes hardly
# longer than no compression, and what is written shrinks to about a third.
_PACKED = {
    "compression": "gzip",
    "zlib.compress.level": "BEST_SPEED",
    "maxRecordsPerFile": 500_000,
}


_BAD_LINE = "_bad_line"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    infer: bool = False,
    **options,
) -> DataFrame:
    """Scan CSV files.

    With ``schema`` nothing is read before the job runs, and column names are checked against
    the header of every file; an unnamed cell there is the name "". Without one, every column
    is text, or typed from an extra pass over the data with ``infer``. A malformed value, or a
    row with too many or too few fields, fails the job instead of losing or nulling fields.
    Texts with line breaks need ``multiLine=True``, which reads each file in one task.
    """
    reader = spark.read.options(**_QUOTING, mode="FAILFAST")
    if schema is not None:
        reader = reader.schema(schema).options(enforceSchema=False)
    elif infer:
        reader = reader.options(inferSchema=True, preferDate=True)
    return reader.options(**options).csv(path)


def read_csv_split(
    spark: SparkSession, path: str | list[str], schema: StructType, **options
) -> tuple[DataFrame, DataFrame]:
    """Scan CSV files that may hold malformed rows: the good rows, and the others with their file.

    A row with a value that does not parse, or with too many or too few fields, is bad: the
    second frame has its whole line as ``line`` and the ``file`` it came from. Every field is
    parsed, whichever columns are used, so that a row is good or bad for all readers. The header is checked as in
    ``read_csv``; a file with another header fails the job.
    """
    whole = StructType([*schema.fields, StructField(_BAD_LINE, StringType())])
    reader = spark.read.options(
        **_QUOTING, mode="PERMISSIVE", columnNameOfCorruptRecord=_BAD_LINE, enforceSchema=False
    )
    rows = reader.schema(whole).options(columnPruning=False, **options).csv(path)
    # Spark refuses queries that use nothing but the line, so the test names the fields too.
    fields = F.concat_ws("", *[F.col(f"`{name}`").cast("string") for name in schema.names])
    bad = F.col(_BAD_LINE).isNotNull() & (F.length(fields) >= 0)
    good = rows.filter(~bad).drop(_BAD_LINE)
    others = rows.filter(bad).select(
        F.col(_BAD_LINE).alias("line"), F.col("_metadata.file_path").alias("file")
    )
    return good, others


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", packed: bool = True) -> None:
    """Write CSV files with a header, times as ISO text, spaces at the ends of text kept.

    Null is an empty field; empty text is read back as null too. Files are ``packed`` by gzip,
    which every reader here recognises by their names.
    """
    text = {
        name: F.col(name).cast("string")
        for name, type_ in df.dtypes
        if type_.startswith("timestamp")
    }
    writer = df.withColumns(text).write.mode(mode).options(**_QUOTING)
    writer = writer.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    writer.options(**(_PACKED if packed else {})).csv(path)
