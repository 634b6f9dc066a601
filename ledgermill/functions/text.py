"""Text helpers."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def filing_url(cik: Column, adsh: Column) -> Column:
    """Where a filing is published; NULL without an accession number."""
    return F.concat(F.lit("https://www.sec.gov/Archives/edgar/data/"), cik.cast("string"), F.lit("/"),
                    F.replace(adsh, F.lit("-"), F.lit("")), F.lit("/"), adsh, F.lit("-index.htm"))


def taxonomy_of(version: Column) -> Column:
    return F.substring_index(version, "/", 1)


def is_amended(form: Column) -> Column:
    return form.endswith("/A")


