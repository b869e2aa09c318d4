"""Records of delimited text whose quoted fields may hold line breaks, by many tasks.

A line break inside quotes cannot be told from the end of a record by looking
at one line, which is why such files are usually read whole. Here lines are
read by splits, and the quotes of each split are counted first: where they do
not pair in a line, a field is open at its end. Sums over the splits before it
say whether a split begins inside quotes; running sums say so for each line.
Only lines of records that span several are moved, to be joined again; a file
without such lines is read in a single further pass.

Quotes inside a quoted field are doubled, so they pair; a quote in the middle
of a field that is not quoted does not, and such files need to be read whole.
A file whose quotes do not pair at all fails and is named.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daymart.operators.lookup import broadcast_if_small
from daymart.operators.scratch import settle


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """line with where it stands: file, the first byte of its split, and a place that grows in the split."""
    text = spark.read.option("lineSep", "\n").text(path)
    line = F.regexp_replace("value", "^﻿|\r$", "").alias("line")
    where = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    lines = text.select(*where, F.monotonically_increasing_id().alias("place"), line)
    quotes = F.char_length("line") - F.char_length(F.replace(F.col("line"), F.lit('"')))
    return lines.withColumn("odd", quotes % 2)


def split_records(spark: SparkSession, path: str) -> DataFrame:
    """file, text and is_head (the file's first record) of each record that is not blank."""
    lines = _lines(spark, path)
    summed = lines.groupBy("file", "block").agg(F.sum("odd").alias("odd"), F.min("place").alias("first"))
    blocks = settle(summed, "blocks")
    heads = blocks.filter("block = 0").select("file", F.col("first").alias("head"))
    broken = settle(blocks.groupBy("file").agg(F.sum("odd").alias("odd")).filter("odd > 0").select("file"), "broken")
    headed = lines.join(broadcast_if_small(heads), "file")
    whole = headed.join(broadcast_if_small(broken), "file", "left_anti")
    records = whole.select("file", F.col("line").alias("text"), (F.col("place") == F.col("head")).alias("is_head"))
    if not broken.isEmpty():
        records = records.unionByName(_joined(headed.join(broadcast_if_small(broken), "file", "left_semi")))
    return records.filter(F.col("is_head") | (F.trim("text") != ""))


def _joined(lines: DataFrame) -> DataFrame:
    """Records of files of which some span lines. A window is one split, or the splits of one file."""
    in_split = W.partitionBy("file", "block").orderBy("place")
    earlier = in_split.rowsBetween(W.unboundedPreceding, -1)
    counted = lines.withColumn("inside", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)

    splits = counted.groupBy("file", "block").agg(
        F.sum("odd").alias("odd"),
        F.max(F.when(F.col("inside") == 0, F.col("place"))).alias("last_outside"),
        F.max(F.when(F.col("inside") == 1, F.col("place"))).alias("last_inside"),
    )
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    splits = splits.withColumn("begins", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    # The line of a split that begins its last record, if any does.
    last = F.when(F.col("begins") == 0, F.col("last_outside")).otherwise(F.col("last_inside"))
    splits = splits.withColumn("last", last).withColumn("open", F.last("last", ignorenulls=True).over(before))
    unpaired = F.sum("odd").over(W.partitionBy("file")) % 2 == 1
    problem = F.raise_error(F.concat(F.lit("the quotes do not pair in "), "file"))
    splits = splits.select("file", "block", "begins", "open", F.when(unpaired, problem).otherwise(F.lit(True)).cast("boolean").alias("paired"))

    known = counted.join(broadcast_if_small(settle(splits.filter("paired").drop("paired"), "splits")), ["file", "block"])
    begins: Column = (F.col("inside") + F.col("begins")) % 2 == 0
    upto = in_split.rowsBetween(W.unboundedPreceding, W.currentRow)
    record = F.last(F.when(begins, F.col("place")), ignorenulls=True).over(upto)
    rows = known.withColumn("record", F.coalesce(record, F.col("open")))
    rows = rows.withColumn("alone", begins & (F.col("odd") == 0))
    alone = rows.filter("alone").select("file", F.col("line").alias("text"), (F.col("place") == F.col("head")).alias("is_head"))
    parts = F.sort_array(F.collect_list(F.struct("block", "place", "line")))
    several = rows.filter("not alone").groupBy("file", "record", "head").agg(parts.alias("parts"))
    text = F.array_join(F.transform("parts", lambda part: part["line"]), "\n")
    return alone.unionByName(several.select("file", text.alias("text"), (F.col("record") == F.col("head")).alias("is_head")))
