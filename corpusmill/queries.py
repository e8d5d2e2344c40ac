"""One query for each operator over the given tables, and the DuckDB SQL for its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.lexicons import Lexicon
from corpusmill.functions.models import MOST_CHARS
from corpusmill.functions.text import as_vector, chunk_id, clean, content_hash, distinct_items, event_date, l2_normalize, mask, sentences, text_map
from corpusmill.operators import chunking, dedup, evaluation, incremental, labeling, near_index, similarity
from corpusmill.plans.steps import LABEL_PROMPT, judge_prompt
from corpusmill.sources import delivery, readers, sinks
from corpusmill.streaming import streams

#: Words that the tables have, in the place of the review lexicon.
WORDS = Lexicon(
    positive=("with", "from", "this", "pour", "para", "und", "reand", "thand"),
    negative=("trash", "scum", "idiot", "clown", "worthless", "moron", "pathetic", "loser", "stupid", "disgusting", "where", "ist"),
    positive_reason=("good", "fine"),
    negative_reason=("bad", "poor"),
    contrast=("though", "that", "que"),
    entities=("heed", "tion", "mente", "keit"),
    entity_patterns=("tionou", "eaux", "ver"),
    entity_regex="[A-Z][a-z]{5,9}",
)
KEY_TERMS = ("heed", "mente", "keit", "eaux")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").withColumn("text", clean(F.col("text")))


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir).select("doc_id", "text")


def clean_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", clean(F.col("html")).alias("text"))


def mask_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir).select("doc_id", mask(F.col("text")).alias("text"))


def clean_mask_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mask_pii(spark, sf_dir).select("doc_id", content_hash(F.col("text")).alias("content_hash"))


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact(mask_pii(spark, sf_dir), "text", "doc_id").select("doc_id", "content_hash")


def incremental_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against a store that holds those of source src0 already."""
    docs = cleaned(spark, sf_dir)
    return dedup.against_existing(docs, docs.where("source = 'src0'").select("text"), "text", "doc_id").select("doc_id", "content_hash")


def near_dup_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.near_pairs(cleaned(spark, sf_dir), "doc_id", "text")


def near_dup_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.near_survivors(cleaned(spark, sf_dir).select("doc_id", "text"), "doc_id", "text").select("doc_id")


def minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.minhash_survivors(cleaned(spark, sf_dir).select("doc_id", "text"), "doc_id", "text").select("doc_id")


def near_dup_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents in two batches, the lesser ids first; the second is compared with the index of the first."""
    docs = cleaned(spark, sf_dir).select("doc_id", "text")
    half = docs.agg((F.max("doc_id") / 2).alias("half")).first()["half"]
    path = sinks.scratch(spark)
    kept = []
    for batch in (docs.where(F.col("doc_id") <= half), docs.where(F.col("doc_id") > half)):
        rows, new = near_index.sift(batch, path, "doc_id", "text")
        kept.append(sinks.written(rows.select("doc_id")))
        near_index.remember(new, path, "doc_id")
    return kept[0].unionByName(kept[1])


def cosine_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every fiftieth vector the ten most similar ones of all."""
    vectors = read(spark, sf_dir, "embeddings")
    return similarity.cosine_topk(vectors.where("vec_id % 50 = 0"), vectors, "vec_id", "embedding")


def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events")
    return incremental.latest(events, ["user_id"], F.col("ts").desc_nulls_last(), F.col("event_id").desc()).select("user_id", "event_id", "event_type")


def latest_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations")
    return incremental.latest(turns, ["conv_id"], F.col("turn").desc_nulls_last(), F.col("text")).select("conv_id", "turn", "role")


def nonblank_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.nonblank(read(spark, sf_dir, "conversations"), "text").groupBy("role").agg(F.count(F.lit(1)).alias("n"))


def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = incremental.required(read(spark, sf_dir, "documents"), ["doc_id", "text", "source"])
    return docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


def max_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.watermark(read(spark, sf_dir, "orders"), F.col("o_orderdate"))


def map_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest timestamp inside a map column."""
    events = read(spark, sf_dir, "events").select(F.create_map(F.lit("timestamp"), F.col("ts").cast("string")).alias("metadata"))
    return incremental.watermark(events, F.col("metadata")["timestamp"])


def incremental_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events later than the last one of kind `error`, which is what the target holds."""
    events = read(spark, sf_dir, "events")
    return incremental.since(events, "ts", events.where("event_type = 'error'")).select("event_id", "event_type")


def new_data_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events")
    mark = events.where("event_type = 'purchase'").agg(F.max("ts").alias("mark"))
    return events.agg(F.max("ts").alias("last")).join(mark).select((F.col("last") > F.col("mark")).alias("has_new"))


def event_date_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    dirty = F.when(F.col("event_type") == "error", F.concat(F.lit("bad "), stamp)).otherwise(stamp)
    days = read(spark, sf_dir, "events").select(event_date(dirty).alias("event_date"))
    return days.groupBy("event_date").agg(F.count(F.lit(1)).alias("n"))


def json_parse_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events' properties as lenient JSON lines with the required key k."""
    lines = read(spark, sf_dir, "events").select(F.col("props").alias("value"))
    return readers.parse_lines(lines, ("k",)).groupBy("k").agg(F.count(F.lit(1)).alias("n"))


def bronze_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as JSON lines, parsed again; those without a language are rejected."""
    lang = F.when(F.col("lang") != "de", F.col("lang"))
    docs = read(spark, sf_dir, "documents").select(F.to_json(F.struct("doc_id", "text", lang.alias("lang"))).alias("value"))
    rows = readers.parse_lines(docs, ("doc_id", "text", "lang"))
    return rows.select("doc_id", "lang", content_hash(F.col("text")).alias("content_hash"))


def reject_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lang = F.when(F.col("lang") != "de", F.col("lang"))
    docs = read(spark, sf_dir, "documents").select(F.to_json(F.struct("doc_id", lang.alias("lang"))).alias("value"))
    return readers.rejects(docs, ("doc_id", "lang"))


def keep_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "conversations").select(
        F.when(F.col("role") == "system", F.lit("{broken")).otherwise(F.to_json(F.struct("conv_id", "role"))).alias("value")
    )
    return readers.parse_lines_keeping(lines, ("conv_id", "role")).groupBy("role").agg(F.count(F.lit(1)).alias("n"))


def prompt_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations")
    rows = turns.select("conv_id", "turn", F.when(F.col("role") == "user", F.col("text")).when(F.col("role") == "system", "").alias("prompt"), "text")
    return readers.prompts(rows).select("conv_id", "turn", F.length("prompt").alias("n_chars"))


def field_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as documents of another shape: content for text, url for a title that may be empty."""
    pages = read(spark, sf_dir, "pages").select(
        F.col("page_id").alias("doc_id"),
        F.lit("").alias("text"),
        F.col("html").alias("content"),
        F.when(F.startswith("url", F.lit("https")), F.col("url")).otherwise("").alias("title"),
    )
    rows = chunking.document_fields(pages)
    return rows.select("doc_id", "title", "timestamp", "event_date", F.md5("text").alias("text_md5"))


def null_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations")
    rows = turns.select(
        F.when(F.col("role") == "user", F.col("text")).when(F.col("role") == "system", "").alias("text"),
        F.col("text").alias("content"),
        F.when(F.col("turn") > 0, F.col("conv_id")).alias("id"),
    )
    return rows.select(evaluation.source_id(rows).alias("doc_id"), F.length(evaluation.source_text(rows)).alias("n_chars"))


def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(sentences(F.col("text"))).alias("i", "sentence"))
    return docs.select("doc_id", "i", F.md5("sentence").alias("sentence_md5"))


def chunk_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = chunking.chunk_documents(read(spark, sf_dir, "documents").drop("n_chars"))
    return chunks.select(
        "chunk_id", "original_doc_id", F.md5("text_chunk").alias("chunk_md5"), "metadata.chunk_index", "metadata.chunk_count"
    )


def chunk_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean, mask, hash and deduplicate, then count each document's chunks."""
    docs = dedup.exact(mask_pii(spark, sf_dir), "text", "doc_id")
    parts = docs.withColumn("parts", sentences(F.col("text")))
    starts = chunking.chunk_starts(F.col("parts"))
    return parts.select("doc_id", "content_hash", F.greatest(F.size(starts), F.lit(1)).alias("n_chunks"))


def chunk_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations")
    key = chunk_id(F.col("conv_id").cast("string"), F.col("turn"), F.coalesce("role", F.lit("unknown")))
    return turns.select("conv_id", "turn", key.alias("chunk_id"))


def sentiment_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", labeling.infer_sentiment(F.col("text"), WORDS).alias("sentiment"))


def sentiment_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.rlike("text", F.lit("trash|idiot|clown")), "negative").when(F.rlike("text", F.lit("with|avec|para")), "positive")
    docs = read(spark, sf_dir, "documents").select(kind.otherwise("neutral").alias("sentiment"))
    return docs.groupBy("sentiment").agg(F.count(F.lit(1)).alias("n"))


def entity_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", F.to_json(labeling.find_entities(F.col("text"), WORDS)).alias("entities_json"))


def item_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = distinct_items(F.split("text", r"\."))
    return read(spark, sf_dir, "documents").select("doc_id", F.size(items).alias("n"), F.md5(F.concat_ws("|", items)).alias("items_md5"))


def label_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompt = F.concat(F.lit(LABEL_PROMPT), "text")
    return cleaned(spark, sf_dir).select("doc_id", F.md5(prompt).alias("prompt_md5"))


def judge_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = labeled(spark, sf_dir)
    return rows.select("doc_id", F.md5(judge_prompt(rows)).alias("prompt_md5"))


def embedder_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the encoder gets of each text: its first 3 * 512 characters, as its context allows."""
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(F.substring("text", 1, MOST_CHARS)).alias("input_md5"))


def embedding_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors and metadata in the stored types; a missing vector is empty."""
    rows = read(spark, sf_dir, "embeddings").withColumn("embedding", F.when(F.col("label") != 0, F.col("embedding")))
    rows = rows.select("vec_id", as_vector(F.col("embedding")).alias("v"), text_map(F.struct("label", "vec_id")).alias("m"))
    return rows.select("vec_id", F.size("v").alias("dims"), F.col("m")["label"].alias("label"), F.col("m")["vec_id"].alias("vec_id_text"))


def _outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a model output made from their label, in well-formed and damaged shapes."""
    docs = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    said = F.when(F.col("quality") == 1, "positive").when(F.col("quality") == 0, "NEGATIVE").otherwise("neutral")
    body = lambda sentiment, entities, reason: F.concat(
        F.lit('{"sentiment": "'), sentiment, F.lit('", "entities": '), F.lit(entities), F.lit(', "reason": '), F.lit(reason), F.lit("}")
    )
    shape = F.col("doc_id") % 8
    out = (
        F.when(shape == 0, F.concat(F.lit("Answer: "), body(said, '["a", " b ", "a", ""]', '"good"'), F.lit(" ok")))
        .when(shape == 1, body(said, '["1","2","3","4","1","2","3","4","5"]', '"bad"'))
        .when(shape == 2, body(F.lit("happy"), '"text"', "null"))
        .when(shape == 3, body(said, "[]", '""'))
        .when(shape == 4, F.lit('{"sentiment": "positive", "entities": ['))
        .when(shape == 5, F.lit('["positive"]'))
        .when(shape == 6, F.lit(""))
        .otherwise(F.lit('{"sentiment": "negative"}'))
    )
    return docs.select("doc_id", "text", out.alias("output"))


def label_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _outputs(spark, sf_dir).select("doc_id", labeling.parse_label(F.col("output")).alias("p"))
    return rows.select("doc_id", "p.sentiment", F.to_json("p.entities").alias("entities_json"), "p.reason")


def labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = labeling.normalize(_outputs(spark, sf_dir), "text", "output", WORDS)
    return rows.withColumn("entities_json", F.to_json("entities"))


def label_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labeled(spark, sf_dir).select("doc_id", "sentiment", "entities_json", "label_reason", "postprocess_tag")


def topic_label_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = F.round(F.col("doc_id") % 100 / 40 - 0.5, 3).cast("string")
    shape = F.col("doc_id") % 4
    text = (
        F.when(shape == 0, F.concat(F.lit(' {"label": "'), "lang", F.lit('", "confidence": '), score, F.lit("} ")))
        .when(shape == 1, F.lit('{"label": "x", "confidence": "high"}'))
        .when(shape == 2, F.lit('{"confidence": 0.25}'))
        .otherwise(F.lit("no json"))
    )
    rows = read(spark, sf_dir, "documents").select("doc_id", labeling.parse_topic_label(text).alias("p"))
    return rows.select("doc_id", "p.*")


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge outputs made from labels: scores out of range, without overall, and damaged."""
    rows = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents"), "doc_id").select("doc_id", "quality", "toxic", "n_chars")
    task = (F.col("n_chars") % 8).cast("string")
    hall = (F.col("quality") * 4 + F.col("toxic")).cast("string")
    shape = F.col("doc_id") % 5
    head = F.concat(F.lit('Scores: {"task_completion": '), task, F.lit(', "hallucination": '), hall)
    text = (
        F.when(shape == 0, F.concat(head, F.lit(', "overall": '), (F.col("n_chars") % 70 / 10).cast("string"), F.lit(', "reason": "r"} end')))
        .when(shape == 1, F.concat(head, F.lit("}")))
        .when(shape == 2, F.lit("nothing"))
        .when(shape == 3, F.concat(head, F.lit(', "reason": "x"}')))
        .otherwise(F.concat(head, F.lit(', "overall": ')))
    )
    return rows.select("doc_id", evaluation.parse_judge(text).alias("j")).select("doc_id", "j.*")


def judge_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir)


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.report(_judged(spark, sf_dir))


def worst_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.worst(_judged(spark, sf_dir)).select("doc_id", "overall")


def below_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir).where(F.col("overall") < evaluation.THRESHOLD).select("doc_id", "overall")


def integrity_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.integrity(labeled(spark, sf_dir), "text", WORDS.positive_reason, WORDS.negative_reason, KEY_TERMS)


def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.seeded_sample(read(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", 100, 42)


def latency_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events").withColumn("error", F.when(F.col("event_type") == "error", F.concat(F.lit("Timeout "), "props")))
    return evaluation.latency_summary(events, "value", "error", 120.0, "event_type")


def l2_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = read(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(l2_normalize(F.col("embedding"))).alias("i", "x"))
    return unit.select("vec_id", "i", F.round("x", 6).alias("x"))



def idempotent_append_3key(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", content_hash(F.col("text")).alias("content_hash"))
    target = turns.where("role = 'system'").select("conv_id", "turn", "content_hash")
    return incremental.append_plan(turns.unionByName(turns), target, ["conv_id", "turn", "content_hash"])


def idempotent_append_2key(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return incremental.append_plan(turns.unionByName(turns), turns.where("role = 'user'"), ["conv_id", "turn"])


def idempotent_append_1key(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang")
    return incremental.append_plan(docs.unionByName(docs), docs.where("lang = 'fr'"), ["doc_id"])


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events through a file stream in append mode with a checkpoint, read back as a table."""
    at = sinks.scratch(spark)
    lines = read(spark, sf_dir, "events").select(F.to_json(F.struct("event_id", "ts", "event_type")).alias("value"))
    lines.write.text(f"{at}/in")
    stream = readers.file_stream(spark, f"{at}/in")
    streams.bronze(stream, f"{at}/bronze", f"{at}/checkpoint", None).awaitTermination()
    rows = readers.read_bronze(spark, f"{at}/bronze", ("event_id", "ts", "event_type"))
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("event_id").cast("long")).alias("last_id"))


def latest_events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time of each user's latest event, for users whose event is a day behind the last one of all; by keyed state."""
    at = sinks.scratch(spark)
    events = read(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    events.write.parquet(f"{at}/in")
    before = {k: spark.conf.get(k, None) for k in streams.STATE_STORE}
    for k, v in streams.STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        rows = streams.latest_and_late(spark.readStream.schema(events.schema).parquet(f"{at}/in"), ["user_id"], "ts", "1 day")
        write = streams.split_late(f"{at}/latest", f"{at}/late")
        for _ in range(2):  # the second run has no rows, and lets timers fire that the last batch has made due
            query = rows.writeStream.foreachBatch(write).option("checkpointLocation", f"{at}/checkpoint")
            query.trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    found = incremental.existing(spark, f"{at}/latest")
    return events.limit(0) if found is None else found.select("user_id", F.col("ts").cast("timestamp_ntz").alias("ts"))


class _Counting:
    """A transport that has no broker: it refuses keys that end in 7, and others that end in 3 at the first try."""

    def __init__(self):
        self.seen: set[str] = set()

    def send(self, key: str, value: str) -> None:
        if key.endswith("7") or key.endswith("3") and key not in self.seen:
            self.seen.add(key)
            raise BufferError("refused")

    def poll(self, seconds: float) -> None:
        pass

    def flush(self, seconds: float) -> None:
        pass


def delivered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through the keyed sink; how many it sent and dropped."""
    policy = delivery.Policy(tries=2, backoff=0.0, drain=0.0)
    counts = delivery.deliver(read(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", _Counting, policy)
    return spark.createDataFrame([(counts["sent"], counts["dropped"])], "sent long, dropped long")


def line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of JSON lines; each line's number against the order in which its file was written."""
    at = sinks.scratch(spark)
    docs = read(spark, sf_dir, "documents").select("lang", F.col("doc_id").alias("id"), "text")
    # A file for each language and task, its lines by id.
    docs.repartition("lang").sortWithinPartitions("lang", "id").select(
        "lang", F.to_json(F.struct("id", "text")).alias("value")
    ).write.partitionBy("lang").text(f"{at}/in")
    lines = readers.numbered_lines(spark, f"{at}/in")
    rows = lines.select(F.regexp_extract("file", "lang=([a-z]+)", 1).alias("lang"), "line", readers.parse(F.col("value"), ("id",))["id"].cast("long").alias("doc_id"))
    return rows.select("lang", "doc_id", "line")


NAMES = (
    "clean_text clean_pages mask_pii clean_mask_hash exact_dedup incremental_anti_join near_dup_pairs near_dup_survivors near_dup_batches minhash_dedup "
    "latest_per_key latest_turn nonblank_filter required_fields max_watermark map_watermark incremental_window new_data_gate event_date_partition "
    "json_parse_required bronze_round_trip reject_count keep_bad_rows prompt_fallback field_coalesce null_coalesce sentence_split chunk_documents "
    "chunk_counts chunk_ids sentiment_rule sentiment_distribution entity_extract item_dedup label_parse label_normalize topic_label_parse judge_parse "
    "label_prompts judge_prompts embedder_inputs embedding_rows quality_report worst_k below_threshold integrity_metrics seeded_sample latency_summary l2_normalized cosine_topk idempotent_append_3key "
    "idempotent_append_2key idempotent_append_1key stream_events latest_events_stream delivered_rows line_numbers"
).split()
QUERIES = {name: globals()[name] for name in NAMES}
