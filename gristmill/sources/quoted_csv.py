"""Records of quoted CSV files, read by as many tasks as the files have blocks.

A line break inside quotes ends a line but no record, so whether a line begins a record
depends on the quotes of everything before it in its file.  Only their parity matters:
one aggregation counts the quotes of each block, a running sum over the blocks of a file
tells which of them begin inside quotes, and then every block joins its own lines to
records, in order and without a shuffle.  Records that reach over blocks come out in
fragments, at most two a block, and are stitched afterwards.

Quotes may stand around whole fields only, doubled inside them, as CSV writers put them;
a quote elsewhere raises.  The charset has to keep ASCII's bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RECORD = "file_path string, file_block long, file_row long, raw binary, open_before boolean, open_after boolean"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines as bytes, with their file and the offset of their block."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("file_block"), F.col("value").cast("binary").alias("line"),
    )


def _open_blocks(lines: DataFrame) -> DataFrame:
    """Per block of a file: does it begin, does it end inside quotes?  One short row for each block (128 MB by default)."""
    quotes = F.char_length(F.regexp_replace(F.decode("line", "ISO-8859-1"), '[^"]+', ""))
    counts = lines.groupBy("file_path", "file_block").agg(F.sum(quotes).alias("quotes"))
    so_far = F.sum("quotes").over(Window.partitionBy("file_path").orderBy("file_block"))
    opens, ends = (so_far - F.col("quotes")) % 2 == 1, so_far % 2 == 1
    return counts.select(F.xxhash64("file_path").alias("file_hash"), "file_block", opens.alias("opens"), (opens | ends).alias("shares"))


class _Block:
    """Lines of one block that are not yet a whole record, and whether they end inside quotes."""

    def __init__(self, file_path: str, file_block: int, opens: bool):
        self.key, self.inside, self.row = (file_path, file_block), opens, 0
        self.pending: list[bytes] = []
        self.pending_row, self.pending_opens = 0, opens

    def add(self, lines: pa.Array) -> Iterator[tuple]:
        """Whole records of some more lines: (first row, bytes, begun before the block)."""
        odd = pc.bit_wise_and(pc.count_substring(lines, '"'), 1).to_pylist()
        for line, flips in zip(lines.to_pylist(), odd):
            if not self.pending:
                self.pending_row, self.pending_opens = self.row, self.inside
            self.pending.append(line)
            self.row += 1
            self.inside ^= bool(flips)
            if not self.inside:
                yield self.pending_row, b"\n".join(self.pending), self.pending_opens
                self.pending = []

    def rest(self) -> Iterator[tuple]:
        if self.pending:
            yield self.pending_row, b"\n".join(self.pending), self.pending_opens


def _records_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.split(" ")[0] for field in RECORD.split(", ")]
    types = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.bool_(), pa.bool_()]

    def rows(block: _Block, found, open_after: bool) -> list[tuple]:
        return [(*block.key, row, raw, before, open_after) for row, raw, before in found]

    block = None
    for batch in batches:
        out: list[tuple] = []
        ends = pc.run_end_encode(batch.column("file_block")).run_ends.to_pylist()
        cuts = sorted({*ends, *pc.run_end_encode(batch.column("file_path")).run_ends.to_pylist()})
        for begin, end in zip([0, *cuts], cuts):
            key = batch.column("file_path")[begin].as_py(), batch.column("file_block")[begin].as_py()
            if block is None or block.key != key:
                out += rows(block, block.rest(), True) if block else []
                block = _Block(*key, batch.column("opens")[begin].as_py())
            out += rows(block, block.add(batch.column("line").slice(begin, end - begin)), False)
        yield pa.RecordBatch.from_arrays([pa.array(values, t) for values, t in zip(zip(*out) if out else [[]] * 6, types)], names)
    if block:
        last = rows(block, block.rest(), True)
        if last:
            yield pa.RecordBatch.from_arrays([pa.array(values, t) for values, t in zip(zip(*last), types)], names)


def _stitched(fragments: DataFrame) -> DataFrame:
    """Fragments of a record put together; it belongs to the block and row it begins in."""
    in_file = Window.partitionBy("file_path").orderBy("file_block", "file_row")
    numbered = fragments.withColumn("record", F.sum(F.when(F.col("open_before"), 0).otherwise(1)).over(in_file))
    inside = F.array_sort(F.collect_list(F.struct("file_block", "file_row", "raw", "open_after")))
    whole = numbered.groupBy("file_path", "record").agg(inside.alias("f"))
    closed = F.when(F.element_at("f", -1)["open_after"], F.raise_error(F.concat(F.lit("a quoted field is not closed in "), "file_path"))).otherwise(F.lit(True))
    text = F.aggregate(F.slice("f", 2, F.greatest(F.size("f") - 1, F.lit(0))), F.col("f")[0]["raw"], lambda a, x: F.concat(a, F.lit(b"\n"), x["raw"]))
    return whole.select("file_path", F.col("f")[0]["file_block"].alias("file_block"), F.col("f")[0]["file_row"].alias("file_row"), F.when(closed, text).alias("raw"))


def records(spark: SparkSession, path: str, charset: str) -> DataFrame:
    """``file_path, file_block, file_row, record``: all records as text, header lines included, blank lines left out."""
    lines = _lines(spark, path)
    blocks = _open_blocks(lines)
    # a broadcast join keeps the order of the lines: the blocks rely on it
    known = lines.withColumn("file_hash", F.xxhash64("file_path")).join(F.broadcast(blocks), ["file_hash", "file_block"], "left")
    opens = F.coalesce("opens", F.raise_error(F.lit("the files changed while they were read")).cast("boolean"))
    joined = lambda some: some.select("file_path", "file_block", "line", opens.alias("opens")).mapInArrow(_records_of_blocks, RECORD)
    whole = joined(known).where(~F.col("open_before") & ~F.col("open_after"))
    # only blocks that share a record with a neighbour are gone through again
    shared = joined(known.where("shares")).where(F.col("open_before") | F.col("open_after"))
    every = whole.drop("open_before", "open_after").unionByName(_stitched(shared))
    text = F.col("raw").cast("string") if charset.upper() == "UTF-8" else F.decode("raw", charset)
    return every.select("file_path", "file_block", "file_row", F.regexp_replace(text, r"\r\z", "").alias("record")).where("record <> ''")


def fields(record: Column, names: list[str]) -> Column:
    """A struct of text columns from a record; raises on a quote outside of a quoted field."""
    quoted_gone = F.regexp_replace(record, r'(?<![^,])"[^"]*+(?:""[^"]*+)*+"(?![^,])', "")
    stray = F.raise_error(F.concat(F.lit("a quote outside of a quoted field, read this file with split=False: "), F.left(record, F.lit(80))))
    checked = F.when(F.contains(record, F.lit('"')) & F.contains(quoted_gone, F.lit('"')), stray.cast("string")).otherwise(record)
    schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in names)
    return F.from_csv(checked, schema, {"quote": '"', "escape": '"', "multiLine": "true"})
