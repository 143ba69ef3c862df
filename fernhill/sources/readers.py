"""File readers (S1–S4, S7, S8) and the audit/source-file columns.

Schemas are always given where the shape is known: inference is one more full
pass over the input, which at 100 TB is a whole extra job.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: the 18 fields of a CDN access log line, in file order
ACCESS_LOG_SCHEMA = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("time", T.StringType()),
    T.StructField("cs_method", T.StringType()),
    T.StructField("c_ip", T.StringType()),
    T.StructField("cs_version", T.StringType()),
    T.StructField("cd_referrer", T.StringType()),
    T.StructField("cs_user_agent", T.StringType()),
    T.StructField("filesize", T.IntegerType()),
    T.StructField("cs_bytes", T.IntegerType()),
    T.StructField("sc_bytes", T.IntegerType()),
    T.StructField("s_ip", T.StringType()),
    T.StructField("time_taken", T.DoubleType()),
    T.StructField("sc_status", T.StringType()),
    T.StructField("cs_uri_query", T.StringType()),
    T.StructField("cs_uri_stem", T.StringType()),
    T.StructField("x_byte_range", T.StringType()),
    T.StructField("comment", T.StringType()),
    T.StructField("sc_x_hw", T.StringType()),
])


def read_access_log(spark: SparkSession, path: str | list[str],
                    schema: T.StructType = ACCESS_LOG_SCHEMA, glob: str | None = None) -> DataFrame:
    """Tab-separated log, no header, ``#`` comment lines, permissive.

    Short rows pad with null; unparsable numbers become null. Gzip files do not
    split, so each ``.log.gz`` is one task: land many mid-sized files.
    """
    r = (spark.read.schema(schema)
         .option("sep", "\t").option("comment", "#").option("header", False)
         .option("mode", "PERMISSIVE"))
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.csv(path)


def read_json_feed(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None,
                   glob: str | None = None, recursive: bool = True) -> DataFrame:
    """JSON lines (plain or ``.gz``), permissive.

    With ``schema`` (recommended) there is no inference pass. A
    ``_corrupt_record`` string field in the schema keeps rows that do not parse.
    ``recursive`` reads nested folders without turning folder names into columns.
    """
    r = spark.read.option("mode", "PERMISSIVE").option("recursiveFileLookup", recursive)
    if schema is not None:
        r = r.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.json(path)


def read_report_csv(spark: SparkSession, path: str | list[str], na_values: Iterable[str] = (),
                    schema: T.StructType | str | None = None, multiline: bool = False,
                    corrupt_col: str | None = None, **opts) -> DataFrame:
    """CSV report with a header; blanks after the delimiter dropped.

    Standard quoting: a quote inside a quoted field is doubled, a backslash is
    plain text. ``multiline`` also reads line breaks inside quoted fields; such a
    file cannot be split, so land it in parts (S4). Rows with too few or too many
    fields are padded or cut; ``corrupt_col`` names a text column that holds the
    raw line of each such row (null for good rows), to count or set aside.

    Every column is read as text and typed once, later, by the load projection
    (no per-file or per-chunk inference). Empty fields, quoted or not, are null
    (the reader's own rule); values listed in ``na_values`` become null as well;
    other text such as "NA" is kept. Big files split on their own.
    """
    def reader():
        r = (spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True)
             .option("quote", '"').option("escape", '"').option("multiLine", multiline)
             .option("mode", "PERMISSIVE"))
        for k, v in opts.items():
            r = r.option(k, v)
        return r

    if corrupt_col is not None:
        # the reader fills the column only when the schema names it
        known = reader().csv(path).schema if schema is None else schema
        known = T.StructType.fromDDL(known) if isinstance(known, str) else known
        schema = T.StructType([*known.fields, T.StructField(corrupt_col, T.StringType())])
        opts["columnNameOfCorruptRecord"] = corrupt_col
    df = (reader() if schema is None else reader().schema(schema)).csv(path)
    na = [v for v in na_values if v != ""]
    if not na:
        return df
    return df.select([
        F.when(F.col(f"`{c}`").isin(na), F.lit(None).cast("string")).otherwise(F.col(f"`{c}`")).alias(c)
        if c != corrupt_col and isinstance(df.schema[c].dataType, T.StringType) else F.col(f"`{c}`")
        for c in df.columns])


def read_staged(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Staged parquet, one file or a whole prefix; schemas of parts merged."""
    return spark.read.option("mergeSchema", True).parquet(*([path] if isinstance(path, str) else path))


def source_file_column() -> Column:
    """Full path of the file each row came from (hidden file-source metadata)."""
    return F.col("_metadata.file_path")


def with_source_file(df: DataFrame, name: str = "source_filename") -> DataFrame:
    """Add the source file path. Apply directly on a file-source DataFrame."""
    return df.withColumn(name, source_file_column())


def schema_profile(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, nullable, filled) of every column;
    ``filled`` counts its non-null rows, all columns in one map-side combined pass.
    """
    counts = df.agg(*[F.count(F.col("`" + f.name.replace("`", "``") + "`")).alias(f"n{i}")
                      for i, f in enumerate(df.schema.fields)])
    rows = [F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column_name"),
                     F.lit(f.dataType.simpleString()).alias("data_type"), F.lit(f.nullable).alias("nullable"),
                     F.col(f"n{i}").alias("filled"))
            for i, f in enumerate(df.schema.fields)]
    return counts.select(F.inline(F.array(*rows)))


def sample_rows(df: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows for looking at by eye (a limit is the feature here)."""
    return df.limit(n)
