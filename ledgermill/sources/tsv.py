"""Tab-delimited quarterly files to typed rows."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions.sqltext import any_of
from ledgermill.schema import QUARTER, SOURCES

RAW_LINE = "_line"
REJECTED = "rejected"


class HeaderMismatch(ValueError):
    """The first line of a file is not the declared column list."""


class RejectRateExceeded(RuntimeError):
    """Too large a share of the lines of a file failed to parse."""


def header_of(name: str, declared: T.StructType | None = None) -> str:
    return "\t".join((declared or SOURCES[name]).fieldNames())


def verify_header(spark: SparkSession, path: str, name: str, declared: T.StructType | None = None) -> None:
    """Compare the first line of a file, or of one file of a folder, with the declared columns, in order and exactly.

    This is the cheap look before a load; the load itself finds a header in every file or fails.
    """
    expected = (declared or SOURCES[name]).fieldNames()
    first = spark.read.text(path).head()
    got = first[0].rstrip("\r").split("\t") if first else []
    if got != expected:
        raise HeaderMismatch(f"{name}: header is {got}, declared are {expected}")


# What a text needs to become a number. The cast decides; but it raises an error inside for every text that is none, which
# takes longer than all else that is done with a line.
MAY_BE_WHOLE, MAY_BE_DOUBLE = "^[^!-*,/:-~]*[0-9][^!-*,/:-~]*$", "[0-9nN]"


def _bare(value: str) -> str:
    """SQL for a line without the carriage return at its end; most have none anywhere and are not matched."""
    return f"CASE WHEN contains({value}, '\r') THEN regexp_replace({value}, '\\r$', '') ELSE {value} END"


def is_header(name: str, declared: T.StructType | None = None) -> Column:
    return F.expr(_bare("value")) == header_of(name, declared)


def is_blank() -> Column:
    return F.expr(_bare("value")) == ""


def parse(lines: DataFrame, name: str, declared: T.StructType | None = None) -> DataFrame:
    """Every data line of ``lines`` (a column ``value``, headers among them) as typed columns, with a flag for lines that
    cannot be taken. Other columns pass through.

    Nothing is quoted or escaped, short lines end in NULLs, an empty field is NULL, and bytes that are not UTF-8 become
    U+FFFD. Fields are cast explicitly: a line is rejected when a field does not fit its type or when it has more
    fields than declared, and it keeps its text. A short line is not rejected for being short; a blank line is none.
    """
    schema = declared or SOURCES[name]
    others = [c for c in lines.columns if c != "value"]
    fields = (lines.where(~is_header(name, declared) & ~is_blank())
              .selectExpr(*others, f"{_bare('make_valid_utf8(value)')} AS {RAW_LINE}")
              .selectExpr("*", f"split({RAW_LINE}, '\t', -1) AS _fields"))
    casts, misfits = [], [f"size(_fields) > {len(schema.fields)}"]
    for k, f in enumerate(schema.fields):
        field = f"nullif(get(_fields, {k}), '')"
        if isinstance(f.dataType, T.StringType):
            casts.append(f"{field} AS {f.name}")
        else:
            likely = MAY_BE_DOUBLE if isinstance(f.dataType, T.DoubleType) else MAY_BE_WHOLE
            casts.append(f"CASE WHEN {field} RLIKE '{likely}' THEN try_cast({field} AS {f.dataType.simpleString()}) END "
                         f"AS {f.name}")
            misfits.append(f"({field} IS NOT NULL AND {f.name} IS NULL)")
    names = [*others, *[f.name for f in schema.fields]]
    typed = fields.selectExpr(*others, *casts, RAW_LINE, "_fields")  # a cast is done once, its result looked at twice
    return (typed.selectExpr(*names, RAW_LINE, f"{any_of(misfits)} AS {REJECTED}")
            .selectExpr(*names, REJECTED, f"CASE WHEN {REJECTED} THEN {RAW_LINE} END AS {RAW_LINE}"))


def scan(spark: SparkSession, path: str, name: str, declared: T.StructType | None = None) -> DataFrame:
    """The lines of a file or of a folder of files, parsed."""
    return parse(spark.read.text(path), name, declared)


@dataclass(frozen=True)
class Accounting:
    """Lines of one file: those seen in its text, and those parsed and rejected. The first number is counted apart."""

    file: str
    lines: int
    parsed: int
    rejected: int

    @property
    def agrees(self) -> bool:
        return self.lines == self.parsed + self.rejected

    @property
    def reject_rate(self) -> float:
        return self.rejected / self.lines if self.lines else 0.0

    def check(self, ceiling: float) -> None:
        if self.reject_rate > ceiling:
            raise RejectRateExceeded(f"{self.file}: {self.rejected} of {self.lines} lines rejected")


def accounting(scanned: DataFrame) -> DataFrame:
    """One row: lines, parsed, rejected and the reject rate."""
    return scanned.agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(~F.col(REJECTED)).alias("parsed"),
        F.count_if(F.col(REJECTED)).alias("rejected"),
        F.coalesce(F.try_divide(F.count_if(F.col(REJECTED)), F.count(F.lit(1))), F.lit(0.0)).alias("reject_rate"))


def accepted(scanned: DataFrame, quarter: str) -> DataFrame:
    """Typed rows tagged with their dataset quarter."""
    return scanned.where(~F.col(REJECTED)).drop(REJECTED, RAW_LINE).withColumn(QUARTER, F.lit(quarter))
