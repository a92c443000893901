"""Declarative rename/cast projections."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# What text must at least look like to be cast; other text is NULL without trying,
# because each failed try costs an exception.
_NUMBER = r"[-+]?([0-9.]+(e[-+]?[0-9]+)?[df]?|nan|inf(inity)?|0x[0-9a-fp.+-]+)"
_BLANK = r"[\s\p{Cntrl}]*"
_PLAUSIBLE = {
    **dict.fromkeys(["tinyint", "smallint", "int", "bigint"], r"[-+]?[0-9.]+"),
    **dict.fromkeys(["float", "double"], _NUMBER),
    "boolean": r"(t|true|y|yes|1|f|false|n|no|0)",
}


def convert(column: Column, data_type: str, strict: bool = True, is_text: bool = False) -> Column:
    """Cast; bad text fails the job when ``strict``, otherwise becomes NULL.
    ``is_text`` says that the column is a string."""
    if data_type == "timestamp":
        return F.to_timestamp(column) if strict else F.try_to_timestamp(column)
    if strict:
        return column.cast(data_type)
    if is_text and data_type in _PLAUSIBLE:
        plausible = column.rlike(f"(?i)^{_BLANK}{_PLAUSIBLE[data_type]}{_BLANK}$")
        return F.when(plausible, column.try_cast(data_type))
    return column.try_cast(data_type)


@dataclass(frozen=True)
class Field:
    """One output column: its name, the source column, a type and a divisor."""

    name: str
    source: str | None = None
    data_type: str | None = None
    divisor: int | None = None

    @property
    def origin(self) -> str:
        return self.source or self.name

    def column(self, strict: bool = True, is_text: bool = False) -> Column:
        out = F.col(self.origin)
        if self.data_type:
            out = convert(out, self.data_type, strict, is_text)
        if self.divisor:
            out = out / F.lit(self.divisor)
        return out.alias(self.name)


def project(df: DataFrame, fields: Iterable[Field], strict: bool = True) -> DataFrame:
    """Keep, rename and cast the listed columns; everything else is dropped."""
    types = dict(df.dtypes)
    return df.select(*[f.column(strict, types.get(f.origin) == "string") for f in fields])


def cast_failures(df: DataFrame, fields: Iterable[Field]) -> DataFrame:
    """Per column, how many non-NULL values a lenient cast would turn into NULL."""
    types = dict(df.dtypes)
    typed = [f for f in fields if f.data_type]

    def lost(f: Field) -> Column:
        cast = convert(F.col(f.origin), f.data_type, strict=False, is_text=types.get(f.origin) == "string")
        return F.count_if(F.col(f.origin).isNotNull() & cast.isNull())

    counts = df.agg(*[lost(f).alias(f.name) for f in typed])
    pairs = F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.col(f.name).alias("violations")) for f in typed
    ])
    return counts.select(F.inline(pairs))
