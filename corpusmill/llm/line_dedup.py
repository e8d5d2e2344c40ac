"""Removal of lines that many documents share, in DataFrame functions only.

Lines are exploded and normalised, and those long enough are hashed. An aggregation counts the
distinct documents of each hash; Spark deals it by (hash, document) first, so that a line
of a third of all documents is counted in many tasks. Hashes over the threshold are
written as a table. Lines that have one of them, but for those of the last document that holds it,
name the positions to drop, and a document is put together again from the stretches of lines
between these positions.

No line's text is shuffled: hashes go to the counts, positions to the documents. Joins with
the tables of hashes and of positions are left to Spark, which broadcasts small ones and
splits hot keys of large ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.text import bind
from corpusmill.llm.common import stash, table

SHORTEST = 40  # code points of a key
DOCUMENTS = 5  # that hold a key, at least

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BLANK = "\x20\x09\x0a\x0b\x0c\x0d"


def lines(text: Column) -> Column:
    """A null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def key(line: Column) -> Column:
    """The line without blanks at its ends and with A-Z in lower case; other letters stay."""
    ascii_lower = lambda x: F.when(F.length(x) == F.octet_length(x), F.lower(x)).otherwise(F.translate(x, _UPPER, _UPPER.lower()))
    return bind(F.btrim(line, F.lit(_BLANK)), ascii_lower)


def hashed_lines(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """(doc, text_id, at, line) of the lines whose key has `shortest` code points or more; line is the key's MD5."""
    long = lambda x: F.length(F.btrim(x, F.lit(_BLANK))) >= shortest
    return (
        docs.select("doc", "text_id", F.posexplode(lines(F.col("text"))).alias("at", "line"))
        .where(long(F.col("line")))
        .select("doc", "text_id", "at", F.unhex(F.md5(key(F.col("line")))).alias("line"))
    )


def shared_lines(found: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """(line, last) of lines that `documents` different documents hold; last is the largest id.

    Rows without an id are one document, which comes before all others.
    """
    return (
        found.groupBy("line")
        .agg(F.count_distinct("doc").alias("ids"), F.max(F.col("doc").isNull()).alias("nameless"), F.max("doc").alias("last"))
        .where(F.col("ids") + F.col("nameless").cast("int") >= documents)
        .select("line", "last")
    )


def kept_text(text: Column, dropped: Column) -> Column:
    """The lines of a text but for those at the positions `dropped` (ascending), joined by newlines."""

    def join(x: Column) -> Column:
        every, gone = x["lines"], x["gone"]
        # A stretch begins after each dropped line (the first at 0) and ends before the next.
        starts = F.concat(F.array(F.lit(0)), F.transform(gone, lambda i: i + 1))
        ends = F.concat(gone, F.array(F.size(every)))
        stretches = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda s: F.slice(every, s["a"] + 1, s["b"] - s["a"]))
        return F.array_join(F.flatten(stretches), "\n")

    return bind(F.struct(lines(text).alias("lines"), dropped.alias("gone")), join)


def drop_shared_lines(docs: DataFrame, shortest: int = SHORTEST, documents: int = DOCUMENTS) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept of each document.

    A line goes if its key has `shortest` code points and occurs in `documents` documents,
    unless this is the largest doc_id that holds it; there all its occurrences stay. Null and
    empty texts are one empty line, which is too short to go. Rows with the same id count as
    one document and all keep its lines; those without an id are one document before all others.
    A text all of whose lines go becomes empty. Texts are taken whole, however long; columns other
    than doc_id and text are not read, and no rows give no rows.
    """
    rows = docs.select(F.col("doc_id").alias("doc"), F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")))).alias("text_id"), "text")
    found = hashed_lines(rows, shortest)
    shared = stash(shared_lines(found, documents), "shared-lines")
    # Repeated rows have the same positions, which are a set.
    dropped = (
        found.join(shared, "line")
        .where(~F.col("doc").eqNullSafe(F.col("last")))
        .groupBy("doc", "text_id")
        .agg(F.sort_array(F.collect_set("at")).alias("gone"))
    )
    dropped = stash(dropped, "dropped-lines").withColumnsRenamed({"doc": "of", "text_id": "of_text"})
    both = rows.join(dropped, rows["doc"].eqNullSafe(dropped["of"]) & (rows["text_id"] == dropped["of_text"]), "left")
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    return both.select(
        F.col("doc").alias("doc_id"),
        F.size(lines(F.col("text"))).cast("long").alias("n_lines"),
        F.size(gone).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(kept_text(F.col("text"), gone)).alias("kept"),
    )


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_shared_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT id, doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM d),
k AS (SELECT id, doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM x),
s AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key
      HAVING count(DISTINCT doc_id) + max((doc_id IS NULL)::INT) >= 5),
m AS (SELECT id, k.doc_id, i, line, s.key IS NOT NULL AND k.doc_id IS DISTINCT FROM s.last AS gone FROM k LEFT JOIN s USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY id
"""
