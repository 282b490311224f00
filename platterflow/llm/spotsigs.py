"""Document fingerprints from spot signatures, with DataFrame operations only.

A spot is an occurrence of a very common word, the anchor; its signature is the anchor and the
chain of the `CHAIN` content words that follow it, other common words skipped. Common words are
spread evenly over prose and rare in lists and menus, so the set of signatures describes the prose.
A text without any anchor takes every word as one. The fingerprint is the sorted set of 32-bit
hashes of the signatures, as text of 8 hex digits each.

Two fingerprints are compared by Jaccard similarity, which cannot exceed the ratio of their set
sizes: `likeness` prunes on that ratio, and `length_part` numbers the size classes such that sets
with a similarity of at least `LEAST` lie in the same or adjacent classes.

The next document is the one with the next smaller id, after the last the first. Documents are dealt
into cells of neighbouring ids, about `ROWS` each and at most about `CELLS` in number, by quantiles
of the ids, and each cell also gets the first document of the cell after it. So texts move once,
and the only table that is broadcast has a row per cell.

Null texts count as empty. Null ids come after all others. Rows with equal ids follow each other in
the order of a hash of their texts. An empty text has an empty fingerprint, and two empty
fingerprints have likeness 1. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platterflow.llm.common import id_and_text

CHAIN = 2
LEAST = 0.8
ROWS = 1024
CELLS = 65_536
KNOTS = 256
# Very common words of four languages.
ANCHORS = """a an and are as at be by for from in is it of on that the this to was with
    das dem den der des die ein eine für im ist mit nicht sich und von zu
    au avec dans de du est et la le les pour que qui sur un une
    al con del el en es las los para por se su y""".split()


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """An expression of a value that is computed once, however often `use` names it."""
    return F.get(F.transform(F.array(value), use), 0)


def signatures(text: Column) -> Column:
    """The sorted set of 32-bit signature hashes, in time linear in the text."""
    def chains(words: Column, content: Column) -> Column:
        places = F.filter(F.transform(words, lambda w, i: F.when(w.isin(*ANCHORS), i)), lambda i: i.isNotNull())
        # Before the j-th anchor, at place i, stand i - j content words, so the chain goes on with the one of that number.
        found = F.transform(places, lambda i, j: F.when(
            i - j < F.size(content), F.concat_ws(" ", F.get(words, i), *[F.get(content, i - j + k) for k in range(CHAIN)])))
        return F.filter(found, lambda s: s.isNotNull())

    def every(words: Column) -> Column:
        return F.transform(words, lambda w, i: F.concat_ws(" ", w, *[F.get(words, i + k + 1) for k in range(CHAIN)]))

    def of_words(words: Column) -> Column:
        spots = _let(F.filter(words, lambda w: ~w.isin(*ANCHORS)), lambda content: chains(words, content))
        return _let(spots, lambda found: F.when(F.size(found) > 0, found).otherwise(every(words)))

    split = F.filter(F.split(F.regexp_replace(F.lower(text), "[^\\p{L}\\p{N}]+", " "), " "), lambda w: w != "")
    chosen = _let(split, of_words)
    return F.array_sort(F.array_distinct(F.transform(chosen, lambda s: F.shiftrightunsigned(F.xxhash64(s), 32))))


def as_text(signature: Column) -> Column:
    return F.array_join(F.transform(signature, lambda s: F.lower(F.lpad(F.hex(s), 8, "0"))), "")


def length_part(signature: Column, least: float = LEAST) -> Column:
    """The size class of a set: similar sets are in the same or in adjacent classes."""
    return F.floor(F.log(1 / least, F.greatest(F.size(signature), F.lit(1)))).cast("int")


def likeness(left: Column, right: Column, least: float = 0.0) -> Column:
    """Jaccard similarity; 0 if the sizes alone rule out `least`."""
    small, large = F.least(F.size(left), F.size(right)), F.greatest(F.size(left), F.size(right))
    both = F.size(F.array_intersect(left, right))
    return F.when(large == 0, 1.0).when((small == 0) | (small < least * large), 0.0).otherwise(both / (small + large - both))


def _with_cell(texts: DataFrame) -> DataFrame:
    """Numbers the cells downwards along the ids, so that they follow the order of the documents."""
    shares = [i / KNOTS for i in range(KNOTS + 1)]
    found = texts.agg(F.count(F.lit(1)), F.percentile_approx("doc_id", shares, 10_000)).first()
    count, knots = found[0], sorted(set(found[1] or [0]))
    inner = max(1, min(CELLS, count // ROWS) // max(1, len(knots) - 1))
    cells = F.array(*[F.lit(k).cast("bigint") for k in knots])
    at = F.size(F.filter(cells, lambda k: k <= F.col("doc_id")))
    low, high = F.get(cells, at - 1), F.get(cells, at)
    share = (F.col("doc_id").cast("double") - low) / (high.cast("double") - low)
    fine = F.least(F.lit(inner - 1), F.floor(F.coalesce(share, F.lit(0.0)) * inner))
    # Null ids come last, in a cell of their own.
    last = F.lit(1).cast("bigint")
    return texts.withColumn("cell", F.when(F.col("doc_id").isNull(), last).otherwise(-(at * inner + fine)))


def _first_of_next(celled: DataFrame) -> DataFrame:
    """Per cell, its first id and the cell before it, which needs that document too."""
    heads = celled.groupBy("cell").agg(F.max("doc_id").alias("head"))
    # A row per cell, so at most about CELLS rows.
    order = Window.partitionBy(F.lit(0)).orderBy("cell")
    before = F.coalesce(F.lag("cell").over(order), F.max("cell").over(Window.partitionBy(F.lit(0))))
    return heads.select(F.col("cell").alias("head_cell"), "head", before.alias("before"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its fingerprint, that of the edited text, and their likeness."""
    texts = _with_cell(id_and_text(docs, id_col, text_col))
    heads = F.broadcast(_first_of_next(texts.select("doc_id", "cell")))
    places = F.filter(
        F.array(F.struct(F.col("cell").alias("at"), F.lit(False).alias("guest")), F.struct(F.col("before").alias("at"), F.lit(True).alias("guest"))),
        lambda p: p["at"].isNotNull())
    is_head = (F.col("cell") == F.col("head_cell")) & F.col("doc_id").eqNullSafe(F.col("head"))
    dealt = texts.join(heads, is_head, "left").select("doc_id", "text", F.explode(places).alias("p")).select(
        "doc_id", "text", F.col("p.at").alias("at"), F.col("p.guest").alias("guest")).repartition("at")
    order = Window.partitionBy("at").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    signed = dealt.withColumn("own", signatures(F.col("text")))
    paired = signed.select(
        "doc_id", "text", "own", "guest", F.lead("text").over(order).alias("next_text"), F.lead("own").over(order).alias("next"),
        F.char_length("text").cast("bigint").alias("n_chars")).filter(~F.col("guest"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("next_text", F.lit(1), half))
    ready = paired.withColumn("edited", edited).withColumn("edited_signatures", signatures(F.col("edited")))
    return ready.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("edited_signatures")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("edited_signatures")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"), length_part(F.col("own")).alias("length_part"))
