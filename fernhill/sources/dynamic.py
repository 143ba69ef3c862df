"""Rows as dynamic values, looked up by exact name.

Files of one report may differ in their headers: columns come and go, change places or spelling.
Each row is read once into one VARIANT value, an object from its own file's
column names to text, so any mix of files is one plan without a common schema and without a pass over
the files to merge theirs. Names are matched exactly, case and blanks included; what a row's file lacks is null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .split_csv import split_layouts

FILE, ROW = "landed file", "row"


def read_dynamic_csv(spark: SparkSession, path: str | list[str], glob: str | None = None, **opts) -> tuple[DataFrame, list[list[str]]]:
    """CSV files with any headers: (file, row) rows, and the distinct headers.

    Quoting is that of ``read_report_csv``, fields may hold line breaks, big files are
    read by byte ranges, all values are text and empty fields are null. A header that holds a name twice fails the read."""
    records, layouts = split_layouts(spark, path, glob, with_file=True)
    for names in layouts:
        if len(set(names)) < len(names):
            raise ValueError(f"a column name twice in the header {', '.join(names)}")
    if not layouts:
        return spark.createDataFrame([], f"`{FILE}` string, `{ROW}` variant"), []
    width = max(map(len, layouts))
    rules = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "true", "mode": "PERMISSIVE", **{k: str(v) for k, v in opts.items()}}
    fields = F.from_csv(F.regexp_replace("text", "\r$", ""), ", ".join(f"c{k} string" for k in range(width)), rules)
    names = F.element_at(F.array(*(F.array(*map(F.lit, n)) for n in layouts)), F.col("layout") + 1)
    values = F.slice(F.array(*(F.col(f"fields.c{k}") for k in range(width))), F.lit(1), F.size(names))
    row = F.to_variant_object(F.map_from_arrays(names, values))
    return records.select(F.col("file").alias(FILE), "layout", fields.alias("fields")).select(f"`{FILE}`", row.alias(ROW)), layouts


def read_dynamic_json(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """JSON lines with any fields: (file, row) rows."""
    r = spark.read.option("singleVariantColumn", ROW)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.json(path).select(F.col("_metadata.file_path").alias(FILE), ROW)


def by_name(row: Column | str, name: str, kind: str = "string") -> Column:
    """The value that a dynamic row has under exactly this name; null if it has none or if it is not of the kind."""
    if "'" in name and '"' in name:
        raise ValueError(f"a name with both kinds of quotes cannot be looked up: {name}")
    quote = '"' if "'" in name else "'"
    return F.try_variant_get(row, f"$[{quote}{name}{quote}]", kind)


def dynamic_columns(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named columns of dynamic rows as text, and the file they came from."""
    return rows.select(f"`{FILE}`", *(by_name(ROW, n).alias(n) for n in dict.fromkeys(names) if n != FILE))
