"""Sentence-wise chunks with a metadata header and stable ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import bind, chunk_id, sentences, truthy

MAX_CHARS = 700
MAX_SENTENCES = 6


def document_fields(df: DataFrame) -> DataFrame:
    """doc_id, text, title, timestamp and event_date from whichever columns there are.

    Empty values count as missing, like nulls.
    """
    of = lambda default, *names: F.coalesce(*[truthy(F.col(n)) for n in names if n in df.columns], F.lit(default))
    return df.select(
        of("", "id", "doc_id").alias("doc_id"),
        of("", "text", "content").alias("text"),
        of("Untitled", "title").alias("title"),
        of("unknown", "timestamp").alias("timestamp"),
        of("unknown", "event_date").alias("event_date"),
    )


def chunk_starts(parts: Column, max_chars: int = MAX_CHARS, max_sentences: int = MAX_SENTENCES) -> Column:
    """Positions (from 1) of the sentences that begin a chunk.

    A fold over the sentences' lengths. A chunk ends before a sentence if it is full, or
    if the sentence would take its letters (without the spaces between) over the limit.
    """
    state = F.struct(
        F.array().cast("array<int>").alias("starts"), F.lit(0).alias("at"), F.lit(0).alias("n"), F.lit(0).alias("chars")
    )

    def step(s: Column, size: Column) -> Column:
        full = (s["n"] == 0) | (s["n"] >= max_sentences) | (s["chars"] + size > max_chars)
        return F.struct(
            F.when(full, F.array_append(s["starts"], s["at"] + 1)).otherwise(s["starts"]).alias("starts"),
            (s["at"] + 1).alias("at"),
            F.when(full, F.lit(1)).otherwise(s["n"] + 1).alias("n"),
            F.when(full, size).otherwise(s["chars"] + size).alias("chars"),
        )

    return F.aggregate(F.transform(parts, F.length), state, step, lambda s: s["starts"])


def chunk_texts(text: Column, parts: Column, starts: Column) -> Column:
    """The chunks' bodies; a text without sentences is one chunk as it stands."""
    ends = F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(F.size(parts) + 1))
    bodies = F.zip_with(starts, ends, lambda a, b: F.array_join(F.slice(parts, a, b - a), " "))
    return F.when(F.size(starts) == 0, F.array(text)).otherwise(bodies)


def chunk_documents(df: DataFrame, max_chars: int = MAX_CHARS, max_sentences: int = MAX_SENTENCES) -> DataFrame:
    """chunk_id, original_doc_id, text_chunk and metadata of every chunk of every document."""

    def chunks(parts: Column) -> Column:
        bodies = bind(chunk_starts(parts, max_chars, max_sentences), lambda starts: chunk_texts(F.col("text"), parts, starts))
        return bind(bodies, lambda b: F.transform(b, lambda x, i: F.struct(i.alias("i"), F.size(b).alias("n"), x.alias("body"))))

    docs = document_fields(df).withColumn("chunks", bind(sentences(F.col("text")), chunks)).drop("text")
    header = F.concat(
        F.lit("Title: "), "title", F.lit("\nTimestamp: "), "timestamp", F.lit("\nDocumentID: "), "doc_id", F.lit("\n\n")
    )
    rows = docs.select("doc_id", "title", "timestamp", "event_date", header.alias("header"), F.inline_outer("chunks"))  # every document has a chunk; `inline` would compute them again in a filter
    return rows.select(
        chunk_id(F.col("doc_id"), F.col("i"), F.col("timestamp")).alias("chunk_id"),
        F.col("doc_id").alias("original_doc_id"),
        F.concat("header", "body").alias("text_chunk"),
        F.struct("title", "timestamp", "event_date", F.col("i").alias("chunk_index"), F.col("n").alias("chunk_count")).alias("metadata"),
    )
