"""The pipeline's steps: bronze to silver, labels, embeddings and the quality report.

Every step reads what the one before has stored, takes the rows that its own table lacks
and appends them under their keys, so that it can be run again at any time. It returns a
status: DONE, or SKIPPED_NO_NEW_DATA.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from fractions import Fraction

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusmill.functions.lexicons import REVIEWS, Lexicon
from corpusmill.functions.models import FAILED, HashEmbedder, Model, StubJudge, StubLabeler, answer, embed
from corpusmill.functions.text import clean, content_hash, event_date, mask, text_map
from corpusmill.operators import chunking, dedup, evaluation, incremental, labeling, near_index
from corpusmill.plans.config import Config
from corpusmill.sources import readers, sinks
from corpusmill.streaming import streams

DONE, SKIPPED = "DONE", "SKIPPED_NO_NEW_DATA"
log = logging.getLogger(__name__)

LABEL_PROMPT = (
    "Read the review and answer with JSON only: sentiment (positive, neutral or negative), "
    "entities (at most 8, word for word from the text) and reason (one sentence).\n\nReview:\n"
)
JUDGE_PROMPT = (
    "Score the labels of this review from 1 to 5 and answer with JSON only: task_completion, "
    "hallucination, overall and reason.\n\n"
)


def status(step: str, rows: int) -> str:
    out = DONE if rows else SKIPPED
    log.info("PIPELINE_STEP_STATUS:%s=%s", step, out)
    return out


def judge_prompt(df: DataFrame) -> Column:
    parts = (evaluation.source_text(df), F.col("sentiment"), F.col("entities_json"), F.col("label_reason"))
    return F.concat(F.lit(JUDGE_PROMPT), F.concat_ws("\n", *parts))


def clean_reviews(df: DataFrame) -> DataFrame:
    return df.withColumn("text", mask(clean(F.col("text"))))


def _new(df: DataFrame, target: DataFrame | None, config: Config, mark=None) -> DataFrame:
    if config.incremental == "max_timestamp":
        return incremental.since(df, "timestamp", target, mark)
    return df


def silver(spark: SparkSession, config: Config, rows: DataFrame | None = None) -> str:
    """Parse, clean, mask and deduplicate bronze lines: all of them, or the parsed rows of a micro-batch."""
    stored = incremental.existing(spark, config.silver)
    rows = readers.read_bronze(spark, config.bronze) if rows is None else rows
    rows = clean_reviews(_new(rows, stored, config)).withColumn("content_hash", content_hash(F.col("text")))
    seen = None
    if config.dedup_mode == "silver_anti_join":
        rows = dedup.against_existing(rows, stored, "text", "id")
    elif config.dedup_mode == "near_index":
        limit = Fraction(str(config.dedup_threshold))
        rows = rows.withColumn("row_key", F.concat_ws("::", "id", "timestamp", "content_hash"))
        rows, seen = near_index.sift(rows, config.dedup_index, "row_key", "text", config.dedup_ngram, (limit.numerator, limit.denominator))
        rows = rows.drop("row_key")
    else:
        rows = dedup.minhash_survivors(rows, "id", "text", config.dedup_ngram, config.dedup_threshold)
    n = sinks.write_silver(rows.withColumn("event_date", event_date(F.col("timestamp"))), config.silver)
    if seen is not None:
        near_index.remember(seen, config.dedup_index, "row_key")
    return status("STEP1", n)


def label(spark: SparkSession, config: Config, labeler: Callable[[], Model] = StubLabeler, lexicon: Lexicon = REVIEWS) -> str:
    """Ask the model about unlabelled rows and correct its answers by rule."""
    stored = incremental.existing(spark, config.labeled)
    rows = _new(readers.read_table(spark, config.silver), stored, config)
    rows = incremental.unseen(rows, stored, ["id", "timestamp"])
    rows = rows.withColumn("prompt_used", F.concat(F.lit(LABEL_PROMPT), "text"))
    said = answer(rows, "prompt_used", "output", labeler, config.label_batch, FAILED)
    labeled = labeling.normalize(said, "text", "output", lexicon)
    labeled = labeled.withColumn("entities_json", F.to_json("entities")).drop("output", "entities")
    labeled = sinks.written(labeled)  # the model is asked once
    if config.labeled_csv:
        sinks.export_csv(labeled, config.labeled_csv)
    return status("STEP2", sinks.write_labels(labeled, config.labeled))


def embeddings(spark: SparkSession, config: Config, embedder: Callable[[], Model] = HashEmbedder) -> str:
    """Chunk and embed documents whose chunks aren't stored."""
    stored = incremental.existing(spark, config.embeddings)
    rows = _new(readers.read_table(spark, config.silver), stored, config, F.col("metadata")["timestamp"])
    chunks = chunking.chunk_documents(rows, config.chunk_max_chars, config.chunk_max_sentences)
    chunks = incremental.unseen(chunks, stored, ["chunk_id"])
    # Few documents can hold many chunks: spread these before the model.
    chunks = chunks.repartition(config.embed_partitions or 4 * spark.sparkContext.defaultParallelism)
    vectors = sinks.written(embed(chunks, "text_chunk", "vector", embedder, config.embed_batch))
    return status("STEP3", sinks.write_embeddings(vectors.withColumn("metadata", text_map(F.col("metadata"))), config.embeddings))


#: What a judge that can't be reached is taken to have said.
REQUEST_FAILED = '{"task_completion": 1, "hallucination": 1, "overall": 1.0, "reason": "judge_request_failed"}'


def evaluate(spark: SparkSession, config: Config, judge: Callable[[], Model] = StubJudge) -> dict:
    """Judge a seeded sample of labels and report. The export stands in for a missing table."""
    missing = config.labeled_csv and incremental.existing(spark, config.labeled) is None
    labeled = readers.read_csv(spark, config.labeled_csv) if missing else readers.read_table(spark, config.labeled)
    sample = incremental.seeded_sample(labeled, "id", config.sample_size, config.seed)
    said = answer(sample.withColumn("prompt", judge_prompt(sample)), "prompt", "said", judge, 16, REQUEST_FAILED, config.judge_tries, config.judge_wait, config.judge_at_once)
    judged = said.select(evaluation.source_id(sample).alias("doc_id"), evaluation.parse_judge(F.col("said")).alias("j")).select("doc_id", "j.*")
    return evaluation.report_json(judged, sample, config.quality_threshold)


def run_all(
    spark: SparkSession,
    config: Config,
    labeler: Callable[[], Model] = StubLabeler,
    embedder: Callable[[], Model] = HashEmbedder,
    judge: Callable[[], Model] = StubJudge,
    lexicon: Lexicon = REVIEWS,
    rows: DataFrame | None = None,
) -> dict:
    """One cycle, over all of bronze or the given rows: the statuses of the three steps and the report."""
    out: dict = {"STEP1": silver(spark, config, rows)}
    out["STEP2"] = label(spark, config, labeler, lexicon)
    out["STEP3"] = embeddings(spark, config, embedder)
    out["report"] = evaluate(spark, config, judge)
    return out


def start(spark: SparkSession, config: Config, done: Callable[[dict], object] = log.info, every: str | None = "10 seconds", files: int = 1000, **models) -> StreamingQuery:
    """A stream over bronze: each micro-batch of new lines is a cycle, which `done` gets.

    The stream's checkpoint knows which files have been read, so that bronze is neither read nor counted again. A batch
    that dies between its steps is run again as a whole by the next start; every step appends
    by key, so that what it had stored is neither lost nor stored twice. every=None takes what is there and ends.
    """

    def cycle(lines: DataFrame) -> None:
        rows = readers.parse_lines(sinks.written(lines))
        done(run_all(lines.sparkSession, config, rows=rows, **models))

    return streams.each_batch(readers.file_stream(spark, config.bronze, files), cycle, f"{config.checkpoints}/cycles", every)


def follow(spark: SparkSession, config: Config, arriving: Callable[[], bool], wait: float = 5.0, every: str = "0 seconds", **models) -> list[dict]:
    """Cycles while lines arrive in bronze, and for what is left then. A cycle that fails is raised."""
    cycles: list[dict] = []
    while not has_folder(spark, config.bronze):
        if not arriving():
            return cycles
        time.sleep(wait)
    query = start(spark, config, cycles.append, every, **models)
    try:
        query.processAllAvailable()
        while arriving():
            time.sleep(wait)
        query.processAllAvailable()
    finally:
        query.stop()
    return cycles


def has_folder(spark: SparkSession, path: str) -> bool:
    """Whether bronze has been written to: a stream needs its folder."""
    try:
        spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True
