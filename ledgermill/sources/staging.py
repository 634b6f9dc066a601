"""The Parquet staging area: one folder per file kind, quarter and load, partitioned by acceptance.

A load never touches what an earlier one wrote. Its four files are written to folders of their own, and one append to the
log, made when all of them are there and have passed the gate, makes them the current ones; readers look up the current
load of each quarter. A load that crashes or fails leaves the former one readable, and what it wrote is never read.

The lines of a file are counted in its text, by an observer in front of the parser, and again behind it as parsed or
rejected, all in the pass that writes them.
"""
from __future__ import annotations

import time
import uuid
import warnings
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions.picking import pick_first
from ledgermill.schema import QUARTER, SOURCES, staged
from ledgermill.settings import Settings
from ledgermill.sources import tsv

LOG_SCHEMA = ("dataset_quarter string, file string, lines bigint, rows bigint, rejects bigint, bytes bigint, "
              "seconds double, status string, load string, finished_at timestamp")
LOAD = "load"


def _exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def _size(spark: SparkSession, path: str) -> int:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(jvm_path).getLength() if files.exists(jvm_path) else 0


def _log(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/ingest_log"
    if not _exists(spark, path):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def append_log(spark: SparkSession, root: str, rows: list[tuple]) -> None:
    """One file with all rows, so that they appear together."""
    (spark.createDataFrame(rows, LOG_SCHEMA.rsplit(",", 1)[0]).withColumn("finished_at", F.current_timestamp())
     .coalesce(1).write.mode("append").parquet(f"{root}/ingest_log"))


def ingest_log(spark: SparkSession, root: str) -> DataFrame:
    """The latest finished entry per quarter and file. The log only grows, by two rows per file of a load."""
    return pick_first(_log(spark, root).where("status <> 'running'"), [QUARTER, "file"], [F.desc("finished_at"), F.desc(LOAD)])


def current_loads(spark: SparkSession, root: str) -> DataFrame:
    """``dataset_quarter, file, load``: the last complete load of each. A later failed or running one changes nothing."""
    done = _log(spark, root).where("status = 'complete'")
    return pick_first(done, [QUARTER, "file"], [F.desc("finished_at"), F.desc(LOAD)]).select(QUARTER, "file", LOAD)


def complete_quarters(spark: SparkSession, root: str) -> list[str]:
    """Quarters all of whose files are complete; a handful of names, read to the driver."""
    done = (current_loads(spark, root).groupBy(QUARTER).agg(F.count(F.lit(1)).alias("files"))
            .where(F.col("files") == len(SOURCES)))
    return sorted(row[0] for row in done.select(QUARTER).collect())


def new_load() -> str:
    """A name for a load; later ones sort behind earlier ones."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def write_version(lines: DataFrame, root: str, name: str, quarter: str, load: str,
                  declared: T.StructType | None = None) -> tuple[tsv.Accounting, int]:
    """Write the lines of one file under a new load; returns its accounting and the headers met.

    Nothing reads the rows before the log names the load.
    """
    text, rows = Observation("text"), Observation("rows")
    header = tsv.is_header(name, declared)
    seen = lines.observe(text, F.count_if(~header & ~tsv.is_blank()).alias("lines"),
                         F.count_if(header).alias("headers"))
    parsed = tsv.parse(seen, name, declared).observe(
        rows, F.count_if(~F.col(tsv.REJECTED)).alias("parsed"), F.count_if(tsv.REJECTED).alias("rejected"))
    (parsed.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
     .partitionBy(tsv.REJECTED).parquet(f"{root}/{name}/{QUARTER}={quarter}/{LOAD}={load}"))
    before, behind = text.get, rows.get
    return tsv.Accounting(name, before["lines"], behind["parsed"], behind["rejected"]), before["headers"]


def load_quarter(spark: SparkSession, folder: str, quarter: str, root: str, settings: Settings | None = None,
                 force: bool = False, declared: Mapping[str, T.StructType] | None = None) -> dict[str, tsv.Accounting]:
    """Stage the four files ``<folder>/<file>.txt`` of a quarter; nothing is done for a complete quarter.

    ``declared`` replaces the columns of some files, for quarters delivered under an earlier declaration. A file without
    a header, a difference between the lines counted in the text and behind the parser (a warning), and too many rejects
    are found in the pass that writes; the quarter then keeps its former load.
    """
    settings, declared = settings or Settings(), declared or {}
    if not force and quarter in complete_quarters(spark, root):
        rows = ingest_log(spark, root).where((F.col(QUARTER) == quarter) & (F.col("status") == "complete")).collect()
        return {r["file"]: tsv.Accounting(r["file"], r["lines"], r["rows"], r["rejects"]) for r in rows}  # four rows
    sources = {name: f"{folder}/{name}.txt" for name in SOURCES}
    for name, path in sources.items():
        tsv.verify_header(spark, path, name, declared.get(name))
    load = new_load()
    append_log(spark, root, [(quarter, name, None, None, None, None, None, "running", load) for name in SOURCES])

    def write(name: str) -> tuple[tuple[tsv.Accounting, int], int, float]:
        started = time.perf_counter()
        lines = spark.read.text(sources[name])
        written = write_version(lines, root, name, quarter, load, declared.get(name))
        return written, len(lines.inputFiles()), time.perf_counter() - started

    written = {}
    # submissions beside numbers: a compressed file is one task, and they have too few of them to keep a cluster busy; a load
    # that crashes goes no further than the files it has begun
    for names in (("sub", "num"), ("tag",), ("pre",)):
        with ThreadPoolExecutor(len(names)) as pool:
            written.update(zip(names, pool.map(write, names), strict=True))
    results, log, failure = {}, [], None
    for name, ((results[name], headers), files, seconds) in written.items():
        if not results[name].agrees:
            warnings.warn(f"{quarter} {name}: {results[name].parsed} lines parsed and {results[name].rejected} rejected, "
                          f"{results[name].lines} in the text")
        try:
            if headers != files:
                raise tsv.HeaderMismatch(f"{name}: {headers} headers in {files} files")
            results[name].check(settings.max_reject_rate)
        except (tsv.RejectRateExceeded, tsv.HeaderMismatch) as problem:
            failure = failure or problem
        size = _size(spark, f"{root}/{name}/{QUARTER}={quarter}/{LOAD}={load}/{tsv.REJECTED}=false")
        log.append((quarter, name, results[name].lines, results[name].parsed, results[name].rejected, size, seconds))
    # one entry for all four files: they become current together or not at all
    append_log(spark, root, [(*row, "failed" if failure else "complete", load) for row in log])
    if failure:
        raise failure
    return results


def load_quarters(spark: SparkSession, source: str, quarters: Iterable[str], root: str,
                  settings: Settings | None = None, force: bool = False) -> list[str]:
    """Stage the wanted quarters that are not complete, from ``<source>/<quarter>``; returns those loaded."""
    wanted = list(quarters)
    done = set() if force else set(complete_quarters(spark, root))
    todo = [quarter for quarter in wanted if quarter not in done]
    for quarter in todo:
        load_quarter(spark, f"{source}/{quarter}", quarter, root, settings, force=force)
    return todo


def _staged_lines(spark: SparkSession, root: str, name: str, rejected: str, quarters: Iterable[str] | None
                  ) -> DataFrame | None:
    """Rows of the current loads. Only their folders are listed, and files with differing columns are read by name."""
    loads = current_loads(spark, root).where(F.col("file") == name)
    if quarters is not None:
        loads = loads.where(F.col(QUARTER).isin(list(quarters)))
    loads = loads.collect()
    paths = [f"{root}/{name}/{QUARTER}={r[QUARTER]}/{LOAD}={r[LOAD]}" for r in loads]  # one per quarter
    if not paths:
        return None
    return (spark.read.option("mergeSchema", True).option("basePath", f"{root}/{name}").parquet(*paths)
            .where(F.col(tsv.REJECTED).cast("string") == rejected).drop(LOAD))


def read_staged(spark: SparkSession, root: str, name: str, quarters: Iterable[str] | None = None) -> DataFrame:
    """Staged rows of complete quarters, of ``quarters`` alone if given; one that is not complete gives no rows even
    when named. The quarter stays a partition column, so filters on it, and joins that restrict it, prune files."""
    complete = complete_quarters(spark, root)
    return read_current(spark, root, name, complete if quarters is None else sorted(set(quarters) & set(complete)))


def read_current(spark: SparkSession, root: str, name: str, quarters: Iterable[str] | None = None) -> DataFrame:
    """Staged rows of the current loads of one file, whatever became of the other files of its quarters."""
    rows = _staged_lines(spark, root, name, "false", quarters)
    if rows is None:
        return spark.createDataFrame([], staged(name))
    have = set(rows.columns)
    return rows.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                         for f in staged(name).fields])


def rejects(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The text of rejected lines with their quarter, of current loads."""
    rows = _staged_lines(spark, root, name, "true", complete_quarters(spark, root))
    if rows is None:
        return spark.createDataFrame([], f"{tsv.RAW_LINE} string, {QUARTER} string")
    return rows.select(tsv.RAW_LINE, F.col(QUARTER).cast("string").alias(QUARTER))


def superseded(spark: SparkSession, root: str) -> DataFrame:
    """``dataset_quarter, file, load``: loads that ended before the current one of their file began, or that failed."""
    current = current_loads(spark, root).withColumnRenamed(LOAD, "current")
    met = _log(spark, root).groupBy(QUARTER, "file", LOAD).agg(F.max(F.col("status") == "failed").alias("failed"))
    return (met.join(current, [QUARTER, "file"], "left")
            .where(f"{LOAD} < current OR (failed AND NOT {LOAD} <=> current)").select(QUARTER, "file", LOAD))


def vacuum(spark: SparkSession, root: str) -> int:
    """Delete the folders of superseded loads, for instance of crashed ones; returns their number."""
    rows = superseded(spark, root).collect()  # one per load and file
    deleted = 0
    for r in rows:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{r['file']}/{QUARTER}={r[QUARTER]}/{LOAD}={r[LOAD]}")
        deleted += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return deleted


def staged_tables(spark: SparkSession, root: str, quarters: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """The four raw tables of a warehouse from the staging area."""
    return {f"raw_{name}": read_staged(spark, root, name, quarters) for name in SOURCES}


def write_text(df: DataFrame, name: str, path: str, declared: T.StructType | None = None) -> None:
    """Write rows as a tab-delimited source file set (a folder of part files, each with a header), compressed, which
    readers know by the names of the files."""
    columns = [F.col(f.name).cast("string").alias(f.name) for f in (declared or SOURCES[name]).fields]
    (df.select(*columns).write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "")
     .option("escape", "").option("nullValue", "").option("emptyValue", "").option("compression", "gzip").csv(path))
