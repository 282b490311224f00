"""Exact duplicates by deterministic block naming, with DataFrame operations only.

Every text is cut into blocks of `BLOCK` characters. The distinct blocks of the corpus are sorted
and numbered, and each text becomes the sequence of its blocks' numbers. Then adjacent pairs of
numbers are sorted and numbered in turn, which halves every sequence, until each document is one
number: its identity, equal for two documents only if their texts are.

Blocks are sorted by a 128-bit key in place of their characters, so that the texts move once. The
keys are no matter of trust: `collisions` groups the blocks by key and looks at the blocks
themselves, and if any key stands for two blocks, all keys are taken anew with another seed.

Copies are combined before each shuffle by the partial step of the aggregations, and names come back
by joins of stored tables, which Spark splits where a name is on very many rows.

Null texts count as empty and are equal to empty ones. A null id is the smallest; of rows with
equal text and equal id, one stays. Of the input only the id and the text are read. An empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platterflow.llm.common import ascii_lower, id_and_text, small_side
from platterflow.session import keep

BLOCK = 1024
SEEDS = 8


def _blocks(text: Column, block: int) -> Column:
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block}}}"), F.lit(0))
    return F.when(text == "", F.array(F.lit(""))).otherwise(cut)


def _key(block: Column, seed: int) -> Column:
    return F.struct(F.xxhash64(F.lit(2 * seed), block).alias("a"), F.xxhash64(F.lit(2 * seed + 1), block).alias("b"))


def collisions(texts: DataFrame, block: int, seed: int) -> DataFrame:
    """The keys that stand for more than one block of the column `text`."""
    blocks = texts.select(F.explode(_blocks(F.col("text"), block)).alias("block"))
    keyed = blocks.select(_key(F.col("block"), seed).alias("key"), "block").select("key.*", "block")
    return keyed.groupBy("a", "b").agg(F.size(F.collect_set("block")).alias("n")).filter("n > 1")


def _named(parts: DataFrame, *by: str) -> DataFrame:
    """Replaces the columns `by` by one integer name, in the sorted order of their distinct values."""
    order = parts.select(*by).distinct()
    names = keep(order.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("name", F.monotonically_increasing_id()))
    return keep(parts.join(small_side(names), list(by)).select("row_id", "n", "at", "name"))


def identities(rows: DataFrame) -> DataFrame:
    """From rows of (row_id, keys): the identity (level, name) of each row."""
    parts = rows.select("row_id", F.size("keys").alias("n"), F.posexplode("keys").alias("at", "key"))
    parts = _named(parts.select("row_id", "n", "at", "key.a", "key.b"), "a", "b")
    level, whole = 0, []
    while True:
        whole.append(parts.filter("n = 1").select("row_id", F.lit(level).alias("level"), "name"))
        longer = parts.filter("n > 1")
        if longer.isEmpty():
            break
        # A last part without a neighbour is paired with -1, which is no name.
        pairs = longer.groupBy("row_id", F.floor(F.col("at") / 2).cast("int").alias("at")).agg(
            F.ceil(F.max("n") / 2).cast("int").alias("n"),
            F.max(F.when(F.col("at") % 2 == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(F.col("at") % 2 == 1, F.col("name"))), F.lit(-1).cast("bigint")).alias("right"))
        parts = _named(keep(pairs), "left", "right")
        level += 1
    found = whole[0]
    for more in whole[1:]:
        found = found.unionByName(more)
    return found


def exact_groups(docs: DataFrame, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, keep_id, group_size, kept and text_sha256 of the lower-cased text."""
    texts = id_and_text(docs, id_col, text_col).select("doc_id", ascii_lower(F.col("text")).alias("text"))
    seed = next((s for s in range(SEEDS) if collisions(texts, block, s).isEmpty()), None)
    if seed is None:
        raise ValueError("No seed gives the blocks of this corpus keys of their own.")
    rows = keep(texts.select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id", F.sha2("text", 256).alias("text_sha256"),
        F.transform(_blocks(F.col("text"), block), lambda b: _key(b, seed)).alias("keys")))
    named = keep(rows.select("row_id", "doc_id", "text_sha256").join(identities(rows.select("row_id", "keys")), "row_id"))
    groups = keep(named.groupBy("level", "name").agg(
        F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row_id")).alias("last")))
    return named.join(groups, ["level", "name"]).select(
        "doc_id", F.col("last.doc_id").alias("keep_id"), "group_size",
        (F.col("row_id") == F.col("last.row_id")).alias("kept"), "text_sha256")


def without_copies(docs: DataFrame, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns.

    Of rows with equal text and equal id, the one with the smallest other columns stays.
    """
    dropped = exact_groups(docs, block, id_col, text_col).filter(~F.col("kept"))
    itself = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    marks = keep(dropped.groupBy(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).agg(F.max(itself).alias("__again")))
    sha = F.sha2(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), 256)
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__of") == F.col("__sha"))
    marked = docs.withColumn("__of", sha).join(small_side(marks), same, "left")
    again = marked.filter("__again").groupBy("__id", "__sha").agg(F.min(F.struct(*docs.columns)).alias("__row"))
    return marked.filter(F.col("__again").isNull()).select(*docs.columns).unionByName(again.select("__row.*"))
