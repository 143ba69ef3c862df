"""Column shaping."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def q(name: str) -> str:
    """Back-quote a column name that may hold blanks, dots, %, / or -."""
    return "`" + name.replace("`", "``") + "`"


def shape(df: DataFrame, keep: Sequence[str] | None = None, rename: Mapping[str, str] | None = None,
          drop: Iterable[str] | None = None) -> DataFrame:
    """Keep, rename and drop columns in one projection; names become text."""
    rename = dict(rename or {})
    dropped = set(drop or [])
    cols = list(keep) if keep is not None else list(df.columns)
    return df.select([F.col(q(c)).alias(str(rename.get(c, c))) for c in cols if c not in dropped])


class MissingColumns(ValueError):
    """Raised when a file lacks columns a load needs."""


def require_columns(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Fail before any action when ``wanted`` is not inside the file's columns (exact names)."""
    require_names(df.columns, wanted)
    return df


def require_names(have: Iterable[str], wanted: Iterable[str]) -> None:
    """P7 for a list of column names."""
    have = set(have)
    gap = [c for c in wanted if c not in have]
    if gap:
        raise MissingColumns(f"missing columns: {gap}; file has {sorted(have)}")


def keep_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Only the wanted columns, in the given order."""
    require_columns(df, wanted)
    return df.select([F.col(q(c)) for c in wanted])


def blank_nulls(df: DataFrame) -> DataFrame:
    """Null text -> empty string in every string column; other columns unchanged."""
    return df.select([
        F.coalesce(F.col(q(f.name)), F.lit("")).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(q(f.name))
        for f in df.schema.fields])
