"""Tolerant JSON-lines scans, file sinks, previews, and an upserting SQLite sink."""

from __future__ import annotations

import sqlite3
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import strip, tag_list, whole_number
from ..operators.chunks import last_of


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value, _line_number, ord``: lines with their number in their file and in all files, by name; both from 1.

    A scan task numbers its lines as it reads; of these numbers only the first of each block of a file is
    aggregated. Texts are in no window and no shuffle; blocks are joined back by name, a row each.
    """
    meta = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    lines = spark.read.text(path).select("value", *meta).withColumn("_at", F.monotonically_increasing_id())
    counts = lines.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("_first"))
    in_order = lambda w: F.coalesce(F.sum("n").over(w.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = counts.select("_file", "_block", "_first", in_order(Window.partitionBy("_file")).alias("_lines"), in_order(Window.partitionBy(F.lit(0))).alias("_all"))
    local = F.col("_at") - F.col("_first") + 1
    return lines.join(blocks, ["_file", "_block"]).select("value", (local + F.col("_lines")).alias("_line_number"), (local + F.col("_all")).alias("ord"))


def read_jsonl(spark: SparkSession, path: str, schema: str, keep_bad: bool = True, lists: Callable = tag_list) -> DataFrame:
    """One row per filled line of a file or of a folder of files, with ``_line_number``, and ``ord`` over all files.

    Any JSON object is accepted, whatever its fields' types: whole numbers are read from text and fractions,
    lists from text by ``lists``, texts from any value. With ``keep_bad`` another line comes back with
    ``_parse_error`` and ``_raw_line``; else it is dropped. A record's own ``_line_number`` stays. Fields that
    the schema doesn't name are kept, as text, in the JSON object ``_extra``.
    """
    filled = numbered_lines(spark, path).where(strip(F.col("value")) != "")
    m = F.col("_m")
    parsed = filled.withColumn("_m", F.when(strip(F.col("value")).startswith("{"), F.from_json("value", "map<string,string>", {"mode": "PERMISSIVE"})))
    names = {f.name: f.dataType.simpleString() for f in StructType.fromDDL(schema)}
    read = {"string": lambda c: c, "bigint": whole_number, "array<string>": lists}
    fields = [read[kind](m[name]).alias(name) for name, kind in names.items()]
    known = [*names, "ord", "_line_number", "_parse_error", "_raw_line", "_extra"]
    own = F.coalesce(whole_number(m["_line_number"]), F.col("_line_number")).alias("_line_number")
    extra = F.map_filter(m, lambda k, v: ~k.isin(known))
    older = F.coalesce(F.from_json(m["_extra"], "map<string,string>"), F.create_map().cast("map<string,string>"))
    extra = F.map_concat(extra, F.map_filter(older, lambda k, v: ~F.map_contains_key(extra, k)))
    bad = F.col("_m").isNull()
    out = parsed.select("ord", own, F.when(bad, "not a JSON object").alias("_parse_error"), F.when(bad, F.col("value")).alias("_raw_line"), *fields, F.when(F.size(extra) > 0, F.to_json(extra)).alias("_extra"))
    return out if keep_bad else out.where("_parse_error is null").drop("_parse_error", "_raw_line")


def write_jsonl(df: DataFrame, path: str, *order: str, without: Sequence[str] = ()) -> None:
    """JSON lines; with ``order``, range-sorted part files, so that their names and lines give that order back."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    placed.drop(*without).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_library(blocks: DataFrame, path: str, order: Sequence[str], text: str = "block") -> None:
    """Text blocks in order, each followed by a blank line: range-sorted part files, in name order."""
    filled = blocks.where(F.coalesce(F.col(text), F.lit("")) != "")
    filled.repartitionByRange(*order).sortWithinPartitions(*order).select(F.col(text).alias("value")).write.mode("overwrite").option("lineSep", "\n").text(path)


def write_parts(blocks: DataFrame, path: str, order: str = "position", text: str = "block", by: str = "library") -> None:
    """One text file for each ``part`` of each library, in a folder ``file=<library>_partNNN``; a part's blocks in order."""
    named = blocks.select(F.format_string("%s_part%03d", by, "part").alias("file"), order, F.col(text).alias("value"))
    named.repartition("file").sortWithinPartitions("file", order).select("file", "value").write.mode("overwrite").option("lineSep", "\n").partitionBy("file").text(path)


def write_documents(df: DataFrame, folder: str, name: str = "file_name", text: str = "content") -> None:
    """One text file per row in a folder that all executors share; rows of one name: the last written stays."""

    def run(rows):
        base = Path(folder)
        base.mkdir(parents=True, exist_ok=True)
        for row in rows:
            (base / row[name]).write_text(row[text] or "", encoding="utf-8")

    df.select(name, text).foreachPartition(run)


def preview(df: DataFrame, texts: Sequence[str], characters: int = 5000) -> DataFrame:
    """Texts cut to a preview, lists and structs as JSON: a table for a spreadsheet."""
    out = []
    for name, kind in df.dtypes:
        if name in texts:
            out.append(F.substring(F.coalesce(F.col(name), F.lit("")), 1, characters).alias(f"{name}_preview"))
        elif kind.startswith(("array", "struct", "map")):
            out.append(F.coalesce(F.to_json(name), F.lit("")).alias(name))
        else:
            out.append(F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name))
    return df.select(*out)


def upsert(old: DataFrame | None, new: DataFrame, key: str = "doc_id", order: str = "ord") -> DataFrame:
    """Rows of earlier runs and of this one; the last value of a key at the place of its first."""
    both = new if old is None else old.withColumn("_run", F.lit(0)).unionByName(new.withColumn("_run", F.lit(1)), allowMissingColumns=True)
    if old is None:
        return last_of(new, key, order)
    both = both.withColumn("_order", F.struct("_run", order))
    return last_of(both, key, "_order").drop("_run", "_order")


def write_sqlite(df: DataFrame, path: str, table: str = "documents", key: str = "doc_id", batch: int = 1000) -> None:
    """Insert or replace rows by key, streamed through the driver a batch at a time (SQLite has one writer)."""
    names = df.columns
    kinds = {n: "INTEGER" if t in ("int", "bigint", "boolean") else "TEXT" for n, t in df.dtypes}
    columns = ", ".join(f'"{n}" {kinds[n]}' + (" PRIMARY KEY" if n == key else "") for n in names)
    flat = df.select(*[F.col(n) if t in ("int", "bigint") else F.to_json(n).alias(n) if t.startswith(("array", "struct", "map")) else F.col(n).cast("string").alias(n) for n, t in df.dtypes])
    insert = f'INSERT OR REPLACE INTO "{table}" VALUES ({", ".join("?" * len(names))})'
    with sqlite3.connect(path) as db:
        db.execute(f'CREATE TABLE IF NOT EXISTS "{table}" ({columns})')
        held = []
        for row in flat.toLocalIterator():
            held.append(tuple(row))
            if len(held) == batch:
                db.executemany(insert, held)
                held = []
        db.executemany(insert, held)
