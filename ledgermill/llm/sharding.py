"""Sharding by sampled splitters, with DataFrame operations alone.

Records are ordered by a hash of their text (equal texts stand together), their id, and a number of their own, so that
splitters can fall among equal rows too. A sample that draws each record with a chance in proportion to its size yields
splitters at equal weights. Ranges that still hold too many records (many small ones, or an unlucky sample) are
subdivided by splitters of a second sample, taken inside them. The records are partitioned by range and subrange, and
exact sizes, added up in order, place each of them; running sums inside a subrange place its records, so the law holds
exactly however the samples fell.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.common import written

SHARDS = 40
RANGES = 2048      # ranges of about equal bytes
ROWS = 500_000     # records of a range beyond which it is subdivided; each piece is ordered by one task
SAMPLE = 16_384    # records drawn, on average: the bound on what one task sorts to find the splitters
OVERHEAD = 16      # bytes that a record takes besides its text


def records(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """What sharding needs of each record: id, size, checksum of the text, and the key that orders records.

    A null text has no bytes and the checksum of an empty one. A null id sorts first.
    """
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    return docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + OVERHEAD).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("own")).withColumn(
            "key", F.struct("h", F.coalesce("doc_id", F.lit(-2 ** 63)).alias("id"), "own"))


def splitters(keyed: DataFrame, ranges: int = RANGES, sample: int = SAMPLE) -> DataFrame:
    """One row: the ordered ``bounds`` between ranges of about equal size, and the ``total`` size."""
    whole = keyed.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("total"))
    chance = F.col("size") * sample / F.col("total")
    draw = F.pmod(F.xxhash64("key", F.lit(20_011)), F.lit(2 ** 40)) / float(2 ** 40)
    drawn = (keyed.crossJoin(F.broadcast(whole)).where(draw < chance)
             .select("key", F.greatest(chance, F.lit(1.0)).alias("weight")))
    # the sample is bounded by the parameter (a record heavier than a step of it is drawn once, with its weight)
    line = Window.orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    step = F.floor(F.sum("weight").over(line) * ranges / sample)
    bounds = (drawn.select("key", step.alias("step")).groupBy("step").agg(F.min("key").alias("key"))
              .agg(F.array_sort(F.array_distinct(F.collect_list("key"))).alias("bounds")))
    return bounds.crossJoin(whole)


def place_among(bounds: str, top: int) -> str:
    """SQL for the number of ``bounds`` (fewer than 2**(top + 1)) that a key is not below, by bisection of that array."""
    return (f"aggregate(sequence({top}, 0, -1), 0, (at, bit) -> if(at + shiftleft(1, bit) <= size({bounds}) "
            f"AND {bounds}[least(at + shiftleft(1, bit), size({bounds})) - 1] <= key, at + shiftleft(1, bit), at))")


def subdivisions(placed: DataFrame, sums: DataFrame, most_rows: int, drawn: int = 8) -> DataFrame:
    """``range, cuts``: ordered splitters of the ranges with more than ``most_rows`` records.

    About ``drawn`` records are drawn for each piece of ``most_rows``, and every ``drawn``-th is a splitter, so what one
    task orders to find them is small against the range.
    """
    overfull = sums.where(F.col("n") > most_rows).select("range", "n")
    draw = F.pmod(F.xxhash64("key", F.lit(30_011)), F.lit(2 ** 40)) / float(2 ** 40)
    sample = placed.join(overfull, "range").where(draw < F.lit(float(drawn)) / most_rows).select("range", "key")
    line = F.row_number().over(Window.partitionBy("range").orderBy("key"))
    return sample.withColumn("line", line).where(F.col("line") % drawn == 0).groupBy("range").agg(
        F.array_sort(F.collect_list("key")).alias("cuts"))


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, ranges: int = RANGES, sample: int = SAMPLE,
                   most_rows: int = ROWS) -> DataFrame:
    """Every record with its ``shard`` (0 to ``shards`` - 1) and its ``slot`` in it, counted from 0 without gaps.

    The middle of a record on the line of all sizes decides its shard, so shards differ from equal bytes by less than
    the largest record. Equal texts share a shard unless its boundary falls among them. Equal rows may swap places.
    """
    keyed = written(records(docs), "keys")
    bounds = splitters(keyed, ranges, sample)
    placed = written(keyed.crossJoin(F.broadcast(bounds)).select(
        "doc_id", "size", "text_crc32", "key", F.expr(place_among("bounds", (ranges + 1).bit_length())).alias("range")), "placed")
    sums = written(placed.groupBy("range").agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n")), "sums")
    # written, so that the join is planned on the true size: a splitter for most_rows records
    cuts = written(subdivisions(placed, sums, most_rows), "cuts")
    parted = placed.join(cuts, "range", "left").withColumn("part", F.expr(
        f"if(cuts IS NULL, 0, {place_among('cuts', 24)})")).drop("cuts")
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranged = sums.select("range", F.sum("s").over(Window.partitionBy()).alias("total"),
                         F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("range_bytes"),
                         F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("range_rows"))
    before = Window.partitionBy("range").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parted.groupBy("range", "part").agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n")).join(
        F.broadcast(ranged), "range").select(  # one row per range, of which the parameter bounds the number
            "range", "part", "total", (F.col("range_bytes") + F.coalesce(F.sum("s").over(before), F.lit(0))).alias("bytes_before"),
            (F.col("range_rows") + F.coalesce(F.sum("n").over(before), F.lit(0))).alias("rows_before"))
    inside = Window.partitionBy("range", "part").orderBy("key")
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    # dealt by both columns, so that the pieces of a range go to different tasks
    ordered = parted.repartition("range", "part").withColumns({
        "bytes_to": F.sum("size").over(running), "row": F.row_number().over(inside)}).join(
            written(starts, "starts"), ["range", "part"])
    middle = 2 * (F.col("bytes_before") + F.col("bytes_to")) - F.col("size")
    numbered = ordered.select(
        "doc_id", "size", "text_crc32", (F.col("row") - 1 + F.col("rows_before")).alias("position"),
        F.least(F.lit(shards - 1), (middle * shards / (2 * F.col("total"))).cast("int")).alias("shard"))
    numbered = written(numbered, "numbered")
    firsts = numbered.groupBy("shard").agg(F.min("position").alias("first"))
    return numbered.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("position") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
