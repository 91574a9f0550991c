"""Operator 10: benchmark decontamination by suffix arrays of the training documents.

Documents stay where they are read: each task sorts the word suffixes of some megabytes of text at a time and finds
where every test suffix lies among them. Suffixes of the shard that begin with a window of the test's are hits; the test
suffixes next to any suffix of the shard give its longest match. The benchmark comes in blocks of bounded size, each
broadcast by itself; a larger one takes a pass, and a suffix array, for each block, which costs less than the searches.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .suffixes import Shard, Tests

WINDOW = 10
#: Words of a shard, and bytes of benchmark text that are broadcast at a time.
SHARD_WORDS = 600_000
BLOCK_BYTES = 8_000_000
FOUND = "n_words long, n_hit long, items array<string>, longest long, longest_start long, longest_item string"


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int):
    """The distinct rows of the benchmark in blocks that the driver can hold: each a call that gathers one.

    A block is of twice block_bytes at most, or one row.
    """
    held = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).where("text is not null and item is not null").distinct()
    own = lambda n: F.pmod(F.xxhash64("item", "text"), F.lit(n))
    size = F.sum(F.octet_length("text") + 64)
    n = 1 + (held.agg(size).first()[0] or 0) // block_bytes
    while n > 1 and not held.groupBy(own(n)).agg(size.alias("size"), F.count("*").alias("rows")).where((F.col("size") > 2 * block_bytes) & (F.col("rows") > 1)).isEmpty():
        n *= 2
    for k in range(n):
        part = held if n == 1 else held.where(own(n) == k)
        yield lambda part=part: [tuple(r) for r in part.collect()]


def _searched(batches, text_at: int, tests: Tests):
    """(batch, results of its rows), as shards fill up."""
    shard, held = Shard(tests), []
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            for text in part.column(text_at).to_pylist():
                shard.add(text)
            held.append(part)
            if shard.n >= SHARD_WORDS:
                yield pa.Table.from_batches(held), shard.search()
                shard, held = Shard(tests), []
    if held:
        yield pa.Table.from_batches(held), shard.search()


def _pass(docs: DataFrame, cols: list[str], text_col: str, items: list, window: int, give: str, schema: str) -> DataFrame:
    spark = docs.sparkSession
    shared, text_at = spark.sparkContext.broadcast(items), cols.index(text_col)

    def run(batches):
        from ledgerloom.llm import op10_decontaminate as own
        from ledgerloom.llm import suffixes

        for rows, found in own._searched(batches, text_at, suffixes.Tests(shared.value, window)):
            if give == "clean":
                yield from rows.filter(pa.array([not x[1] for x in found])).to_batches()
            else:
                kinds = (pa.int64(), pa.int64(), pa.list_(pa.string()), pa.int64(), pa.int64(), pa.string())
                names = ["n_words", "n_hit", "items", "longest", "longest_start", "longest_item"]
                more = [pa.array(x, k) for x, k in zip(list(zip(*found))[:6], kinds)]
                if give == "hits":
                    more.append(pa.array([[{"a": a, "b": b} for a, b in x[6]] for x in found], pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))))
                    names.append("hit")
                yield from pa.table([rows.column(i) for i in range(rows.num_columns) if i != text_at] + more, [c for c in rows.column_names if c != text_col] + names).to_batches()

    return docs.select(*cols).mapInArrow(run, schema)


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, n_words, n_hit, items, longest, longest_start, longest_item) of every document row.

    A word is hit if it lies in any occurrence of `window` consecutive words of an item, or of all words of a shorter
    item. items: ids, as sorted strings, of the items with an occurrence; longest, longest_start, longest_item: words and
    place of the longest verbatim match of any length with a run of words of one item (of equal ones the first, of the
    item that is lowest as a string); 0, -1 and null without one. Null and empty texts have no words; items without words or with a null id are left out; equal item ids count once; an empty
    benchmark hits nothing. Rows stay as many as they are, repeated ids too. Other columns are not read.
    """
    common.prepare(docs.sparkSession)
    kind, parts, rows = docs.schema[id_col].dataType.simpleString(), [], docs.select(id_col, text_col)
    blocks = list(_blocks(benchmark, item_col, item_text_col, block_bytes))
    if len(blocks) == 1:
        return _pass(rows, [id_col, text_col], text_col, blocks[0](), window, "found", f"`{id_col}` {kind}, {FOUND}")
    rows = rows.select(F.monotonically_increasing_id().alias("row"), id_col, text_col)
    for block in blocks:
        parts.append(_pass(rows, ["row", id_col, text_col], text_col, block(), window, "hits", f"row long, `{id_col}` {kind}, {FOUND}, hit array<struct<a:long,b:long>>"))
    return _merged(reduce(DataFrame.union, parts), id_col)


def _merged(found: DataFrame, id_col: str) -> DataFrame:
    """One row for each document row, from what each block found there: at most as many as there are blocks."""
    hit = F.array_sort(F.flatten(F.collect_list("hit")))
    best = F.min(F.when(F.col("longest") > 0, F.struct((-F.col("longest")).alias("n"), "longest_start", "longest_item")))
    g = found.groupBy("row").agg(F.first(id_col).alias(id_col), F.first("n_words").alias("n_words"), hit.alias("hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), best.alias("best"))
    step = "aggregate(hit, struct(0L AS n, 0L AS at), (x, h) -> struct(x.n + greatest(0L, h.b - greatest(x.at, h.a)) AS n, greatest(x.at, h.b) AS at), x -> x.n)"
    return g.select(id_col, "n_words", F.expr(step).alias("n_hit"), "items", F.coalesce(-F.col("best.n"), F.lit(0)).cast("long").alias("longest"), F.coalesce("best.longest_start", F.lit(-1)).cast("long").alias("longest_start"), "best.longest_item")


def remove(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs, all columns as they are, without those that hold an occurrence; one pass for each block."""
    common.prepare(docs.sparkSession)
    for block in _blocks(benchmark, item_col, item_text_col, block_bytes):
        docs = _pass(docs, docs.columns, text_col, block(), window, "clean", docs.schema)
    return docs


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = matches(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "longest", "longest_start", "longest_item",
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that hold a passage of the benchmark."""
    return remove(docs, common.table(spark, sf_dir, "benchmark"))
