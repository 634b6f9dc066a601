"""Declared schemas of the source files and of the rule output."""
from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"str": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "dbl": T.DoubleType()}


def _struct(spec: str, default: str = "str") -> T.StructType:
    fields = []
    for item in spec.split():
        name, _, kind = item.partition(":")
        fields.append(T.StructField(name, _TYPES[kind or default]))
    return T.StructType(fields)


# --- fixed values: column order and types of the four source files ------------------------------------------
SUB = _struct(
    "adsh cik:long name sic:int countryba stprba cityba zipba bas1 bas2 baph countryma stprma cityma zipma mas1 "
    "mas2 countryinc stprinc ein former changed afs wksi:int fye form period fy:int fp filed accepted "
    "prevrpt:int detail:int instance nciks:int aciks")
NUM = _struct("adsh tag version ddate qtrs:int uom segments coreg value:dbl footnote")
TAG = _struct("tag version custom:int abstract:int datatype iord crdr tlabel doc")
PRE = _struct("adsh report:int line:int stmt inpth:int rfile tag version plabel negating:int")

SOURCES: dict[str, T.StructType] = {"sub": SUB, "num": NUM, "tag": TAG, "pre": PRE}

# A number of the raw fact table identifies itself by these columns.
NUM_KEY = ["adsh", "tag", "version", "ddate", "qtrs", "uom", "segments", "coreg"]

QUARTER = "dataset_quarter"


def staged(name: str) -> T.StructType:
    """The staged form of a source file: its columns and the quarter it came with."""
    return T.StructType(SOURCES[name].fields + [T.StructField(QUARTER, T.StringType())])


# Every rule yields these columns.
RULE_OUTPUT = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("n", T.LongType()),
    T.StructField("cik", T.LongType()),
    T.StructField("adsh", T.StringType()),
    T.StructField("period_end", T.DateType()),
    T.StructField("qtrs", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    T.StructField("observed", T.DoubleType()),
    T.StructField("expected", T.DoubleType()),
    T.StructField("diff", T.DoubleType()),
    T.StructField("message", T.StringType()),
])
