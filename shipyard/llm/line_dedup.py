"""Removal of repeated multi-line chunks, cut where the content says so.

A rolling hash over the hashes of two neighbouring lines chooses the chunk
boundaries, so they move along when lines are put in or taken out before them. A
line after which a chunk ends is never followed by another such line, and neither
the first line nor the one before the last ends a chunk: chunks have two lines or
more unless the text has only one. Chunks that are equal byte for byte anywhere in
the corpus stay in the first place by (id, chunk number) and go elsewhere.

The grouping key of the byte comparison is the chunk's text itself, combined in
every task before the shuffle, so a chunk that a third of the documents hold
costs one row a task. The verdict goes back under the text's SHA-256; only the
numbers of the chunks to remove, without text, go to their documents.

Only built-in functions, no Python. A null text stays null and takes no part, a
null id counts as larger than any other; a chunk of nothing but white space and a
text of one line stay; rows equal in id and text are one document: both keep or
lose the same. An empty table gives an empty table; all columns come back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One line in DIVISOR is a candidate for a boundary.
DIVISOR = 3
MULTIPLIER = 31
MODULUS = 1_000_003
LAST_ID = 2**63 - 1


def line_hash(line: Column) -> Column:
    """The first 28 bits of the line's MD5."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 7), 16, 10).cast("long")


def chunks(text: Column, divisor: int = DIVISOR) -> Column:
    """The text's chunks in order, as an array of strings; joined by a line feed they are the text."""
    lines = F.split(text, "\n", -1)

    def cut(lines: Column, hashes: Column) -> Column:
        n = F.size(lines)
        rolled = F.transform(hashes, lambda h, i: F.when(i == 0, F.lit(True)).otherwise(
            (F.get(hashes, i - 1) * MULTIPLIER + h) % MODULUS % divisor == 0))
        def ends(raw: Column) -> Column:
            found = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == n - 1) | ((i > 0) & (i < n - 2) & F.get(raw, i) & ~F.get(raw, i - 1)))
            return _with(found, lambda e: F.transform(e, lambda x, k: _joined(lines, F.when(k == 0, F.lit(0)).otherwise(F.get(e, k - 1) + 1), x)))
        return _with(rolled, ends)

    return _with(lines, lambda x: _with(F.transform(x, line_hash), lambda h: cut(x, h)))


def _with(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _joined(lines: Column, first: Column, last: Column) -> Column:
    return F.array_join(F.slice(lines, first + 1, last - first + 1), "\n")


def _place(id_col: str) -> Column:
    """(id, chunk number) as one number, ordered the same way."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).cast("decimal(28,0)") * F.lit(2**31).cast("decimal(10,0)") + F.col("number")


def repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", divisor: int = DIVISOR) -> DataFrame:
    """``k1``, ``k2`` (the hash of id and text) and ``numbers``: which chunks of the
    document (from 0) an earlier place of the corpus has."""
    id_, text = F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")
    plain = docs.select(id_, text).where("text IS NOT NULL")
    each = plain.select("id", *document_key(F.col("id"), F.col("text")), F.posexplode(chunks(F.col("text"), divisor)).alias("number", "chunk"))
    each = each.where(F.contains("chunk", F.lit("\n")) & (F.length(F.trim(F.translate("chunk", "\n\r\t", "   "))) > 0))
    each = each.withColumn("place", _place("id"))
    first = each.groupBy("chunk").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    first = first.where("first < last").select(F.sha2("chunk", 256).alias("digest"), "first")
    held = each.select("k1", "k2", "number", "place", F.sha2("chunk", 256).alias("digest"))
    again = held.join(first, "digest").where("place > first")
    return again.groupBy("k1", "k2").agg(F.collect_set("number").alias("numbers"))


def document_key(id_: Column, text: Column) -> list[Column]:
    """128 bits that name a document by id and text, never null."""
    return [F.xxhash64(id_, text).alias("k1"), F.xxhash64(F.lit("second"), text, id_, id_.isNull()).alias("k2")]


def remove_repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", divisor: int = DIVISOR) -> DataFrame:
    """All rows and columns of ``docs``, the text without repeated chunks, and
    ``n_chunks`` and ``n_removed_chunks`` (null for a null text); columns of these
    names that ``docs`` has are replaced."""
    numbers = repeated_chunks(docs, id_col, text_col, divisor)
    rows = docs.select(*document_key(F.col(id_col).cast("long"), F.col(text_col)), F.struct(*docs.columns).alias("row"))
    joined = rows.join(numbers, ["k1", "k2"], "left")
    text = F.col(f"row.{text_col}")
    cut = joined.withColumn("chunks", chunks(text, divisor))
    left = F.filter("chunks", lambda c, i: ~F.array_contains(F.col("numbers"), i))
    changed = F.when(F.col("numbers").isNull(), text).otherwise(F.array_join(left, "\n"))
    added = ("n_chunks", "n_removed_chunks")
    n_removed = F.when(F.col("numbers").isNull(), F.lit(0)).otherwise(F.size("numbers"))
    return cut.select(
        *[(changed if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns if c not in added],
        F.when(text.isNotNull(), F.size("chunks")).cast("long").alias("n_chunks"),
        F.when(text.isNotNull(), n_removed).cast("long").alias("n_removed_chunks"),
    )
