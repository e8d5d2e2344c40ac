"""Judge scores, integrity rates and the quality report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.lexicons import EMPTY_ENTITIES, EVAL_KEY_ENTITIES, EVAL_NEGATIVE_REASON, EVAL_POSITIVE_REASON
from corpusmill.functions.text import any_hit, bind, strip
from corpusmill.operators.labeling import reason_conflict
from corpusmill.operators.selection import ranked_values
from corpusmill.sources.sinks import written

THRESHOLD = 3.5
WORST = 10


def parse_judge(output: Column) -> Column:
    """Struct (task_completion, hallucination, overall, reason), scores cut to 1 .. 5.

    `overall` defaults to the mean of the two scores before they are cut. Whatever can't
    be read gives 1, 1, 1.0 and parse_failed.
    """
    output = F.coalesce(output, F.lit(""))
    body = bind(F.regexp_extract(output, r"(?s)\{.*\}", 0), lambda found: F.when(found != "", found).otherwise(output))
    options = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": "_bad"}
    schema = "task_completion string, hallucination string, overall string, reason string, _bad string"
    both = lambda b: F.struct(F.from_json(b, schema, options).alias("raw"), F.json_object_keys(b).alias("keys"))
    return bind(body, lambda b: bind(both(b), lambda x: _judge(x["raw"], x["keys"])))


def _judge(raw: Column, keys: Column) -> Column:
    given = lambda name: F.array_contains(keys, name)
    whole = lambda name: F.when(given(name), raw[name].try_cast("double").try_cast("int")).otherwise(F.lit(1))
    task, hall = whole("task_completion"), whole("hallucination")
    overall = F.when(given("overall"), raw["overall"].try_cast("double")).otherwise((task + hall) / 2)
    bad = raw.isNull() | raw["_bad"].isNotNull() | keys.isNull() | task.isNull() | hall.isNull() | overall.isNull()
    cut = lambda x, kind: F.greatest(F.lit(1).cast(kind), F.least(F.lit(5).cast(kind), x))
    return F.struct(
        F.when(bad, F.lit(1)).otherwise(cut(task, "int")).alias("task_completion"),
        F.when(bad, F.lit(1)).otherwise(cut(hall, "int")).alias("hallucination"),
        F.when(bad, F.lit(1.0)).otherwise(cut(overall, "double")).alias("overall"),
        F.when(bad, "parse_failed").otherwise(F.coalesce(raw["reason"], F.lit(""))).alias("reason"),
    )


def source_text(df: DataFrame) -> Column:
    """The first column that isn't null (empty counts as a value)."""
    return F.coalesce(*[F.col(c).cast("string") for c in ("text", "content", "text_chunk", "review_text") if c in df.columns], F.lit(""))


def source_id(df: DataFrame) -> Column:
    names = ("id", "doc_id", "original_doc_id", "chunk_id")
    return F.coalesce(*[F.col(c).cast("string") for c in names if c in df.columns], F.lit("unknown_doc_id"))


def no_entities(entities: Column) -> Column:
    """entities as text, a JSON list as a rule."""
    return strip(F.coalesce(entities, F.lit(""))).isin(*EMPTY_ENTITIES)


def coverage_miss(text: Column, entities: Column, terms: Sequence[str] = EVAL_KEY_ENTITIES) -> Column:
    """The text has key terms and none of those is among the entities."""
    text, entities = F.coalesce(text, F.lit("")), F.coalesce(entities, F.lit(""))
    named = F.lit(False)
    for w in terms:
        named = named | (F.contains(text, F.lit(w)) & F.contains(entities, F.lit(w)))
    return any_hit(text, terms) & ~named


def integrity(
    df: DataFrame,
    text: str = "text",
    positive: tuple[str, ...] = EVAL_POSITIVE_REASON,
    negative: tuple[str, ...] = EVAL_NEGATIVE_REASON,
    terms: Sequence[str] = EVAL_KEY_ENTITIES,
) -> DataFrame:
    """One row of rates over labelled rows, unrounded; 0 for no rows."""
    rate = lambda p: F.coalesce(F.try_divide(F.count_if(p), F.count(F.lit(1))), F.lit(0.0))
    tag = strip(F.coalesce(F.col("postprocess_tag"), F.lit("")))
    conflict = reason_conflict(F.lower("sentiment"), F.col("label_reason"), positive, negative)
    return df.agg(
        rate(conflict).alias("reason_sentiment_conflict_rate"),
        rate(no_entities(F.col("entities_json"))).alias("empty_entities_rate"),
        rate(coverage_miss(F.col(text), F.col("entities_json"), terms)).alias("entity_coverage_miss_rate"),
        rate(~tag.isin("", "model_output")).alias("postprocess_hit_rate"),
    )


def worst(judged: DataFrame, threshold: float = THRESHOLD, k: int = WORST) -> DataFrame:
    """The k lowest scores below the threshold, by the score to two places, then by id."""
    low = judged.where(F.col("overall") < threshold).withColumn("overall", F.round("overall", 2))
    return low.orderBy("overall", "doc_id").limit(k)


def report(judged: DataFrame, threshold: float = THRESHOLD, k: int = WORST) -> DataFrame:
    """One row of unrounded means. The gate compares the mean with the threshold.

    below_threshold_count is the true number; listed_count is what the list of the worst
    can show.
    """
    mean = lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    below = F.count_if(F.col("overall") < threshold)
    return judged.agg(
        F.count(F.lit(1)).alias("sample_count"),
        mean("task_completion").alias("task_completion_avg"),
        mean("hallucination").alias("hallucination_avg"),
        mean("overall").alias("overall_avg"),
        F.coalesce(F.stddev_pop("overall"), F.lit(0.0)).alias("overall_std"),
        (mean("overall") >= threshold).alias("pass"),
        F.lit(threshold).alias("threshold"),
        below.alias("below_threshold_count"),
        F.least(below, F.lit(k)).alias("listed_count"),
    )


def report_json(judged: DataFrame, labeled: DataFrame | None = None, threshold: float = THRESHOLD, k: int = WORST) -> dict:
    """The report as a dict with rounded numbers and the examples, for output."""
    row = report(judged, threshold, k).first().asDict()
    places = {"task_completion_avg": 3, "hallucination_avg": 3, "overall_avg": 3, "overall_std": 3}
    out = {key: round(v, places[key]) if key in places else v for key, v in row.items()}
    out["low_score_examples"] = [r.asDict() for r in worst(judged, threshold, k).collect()]
    if labeled is not None:
        out["functional_integrity"] = {key: round(v, 4) for key, v in integrity(labeled).first().asDict().items()}
    return out


def latency_summary(df: DataFrame, value: str, error: str, seconds: float, group: str) -> DataFrame:
    """Median, P99 (from ten values on), failures by kind and rate of each group.

    P99 is the value at index max(0, int(n * 0.99) - 1) of the sorted values; the median of an even number
    is the mean of the two in the middle. Both are found by selection over all tasks.
    """
    text = F.lower(F.coalesce(F.col(error), F.lit("")))
    base = written(
        df.groupBy(group).agg(
            F.count(value).alias("n"),
            F.count_if(F.contains(text, F.lit("out of memory")) | F.contains(text, F.lit("oom"))).alias("oom_count"),
            F.count_if(F.contains(text, F.lit("timeout"))).alias("timeout_count"),
            (F.count(F.lit(1)) / F.lit(float(seconds))).alias("qps"),
        )
    )
    n = F.col("n")
    targets = {"low": F.floor((n - 1) / 2), "high": F.floor(n / 2), "p99": F.when(n >= 10, F.greatest(F.lit(0), F.floor(n * 0.99) - 1))}
    wanted = F.explode(F.array(*(F.struct(F.lit(k).alias("target"), r.cast("long").alias("rank")) for k, r in targets.items())))
    ranks = base.where("n > 0").select(group, wanted.alias("t")).select(group, "t.*").where("rank IS NOT NULL")
    at = lambda k: F.max(F.when(F.col("target") == k, F.col("value")))
    found = ranked_values(df, group, value, ranks).groupBy(F.col(group).alias("of"))
    found = found.agg(((at("low") + at("high")) / 2).alias("p50"), at("p99").alias("p99"))
    both = base.join(found, F.col(group).eqNullSafe(F.col("of")), "left")
    return both.select(group, "n", "p50", "oom_count", "timeout_count", "qps", "p99")
