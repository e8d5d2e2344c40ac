"""Rules that correct model labels, and parsers of model outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.lexicons import Lexicon
from corpusmill.functions.text import any_hit, bind, distinct_items, hits, strip

SENTIMENTS = ("positive", "neutral", "negative")
MOST = 8
_STRICT = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": "_bad"}


def json_object(text: Column) -> Column:
    """From the first { to the last }; the stripped text if there is no such span."""
    found = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    return bind(found, lambda x: F.when(x != "", x).otherwise(strip(text)))


def parse_label(output: Column) -> Column:
    """Struct (sentiment, entities, reason) of a model output.

    Anything but a JSON object gives neutral, no entities and `parse_fallback`. Unknown
    sentiments are neutral; entities that are no list are none; at most MOST are read. A
    reason of JSON null is the text None. Nested objects among entities are out of scope.
    """
    schema = "sentiment string, entities string, reason string, _bad string"
    return bind(
        json_object(F.coalesce(output, F.lit(""))), lambda body: bind(F.from_json(body, schema, _STRICT), lambda raw: _label(body, raw))
    )


def _label(body: Column, raw: Column) -> Column:
    bad = raw.isNull() | raw["_bad"].isNotNull() | ~F.startswith(strip(body), F.lit("{"))
    keys = F.json_object_keys(body)
    low = F.lower(F.coalesce(raw["sentiment"], F.lit("neutral")))
    items = F.from_json(raw["entities"], "array<string>", _STRICT | {"columnNameOfCorruptRecord": "_none"})
    items = F.when(F.startswith(F.ltrim(raw["entities"]), F.lit("[")), items)
    reason = F.when(F.array_contains(keys, "reason"), F.coalesce(raw["reason"], F.lit("None"))).otherwise(F.lit(""))
    empty = F.array().cast("array<string>")
    return F.struct(
        F.when(bad, "neutral").otherwise(F.when(low.isin(*SENTIMENTS), low).otherwise("neutral")).alias("sentiment"),
        F.when(bad, empty).otherwise(F.coalesce(F.slice(items, 1, MOST), empty)).alias("entities"),
        F.when(bad, "parse_fallback").otherwise(reason).alias("reason"),
    )


def infer_sentiment(text: Column, lexicon: Lexicon) -> Column:
    """Majority of distinct hints, after the first contrast token (in the lexicon's order)."""
    text = F.coalesce(text, F.lit(""))
    tail = F.lit("")
    for token in reversed(lexicon.contrast):
        tail = F.when(F.contains(text, F.lit(token)), F.substr(text, F.locate(token, text) + F.lit(len(token)))).otherwise(tail)
    focus = bind(strip(tail), lambda t: F.when(t != "", t).otherwise(text))
    more = bind(focus, lambda f: F.size(hits(f, lexicon.positive)) - F.size(hits(f, lexicon.negative)))
    return bind(F.signum(more), lambda s: F.when(s < 0, "negative").when(s > 0, "positive").otherwise("neutral"))


def find_entities(text: Column, lexicon: Lexicon) -> Column:
    """Dictionary hits, pattern hits and matches of the expression; distinct, at most MOST."""
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(lexicon.entity_regex), 0)
    return F.slice(distinct_items(F.concat(hits(text, lexicon.entities), hits(text, lexicon.entity_patterns), words)), 1, MOST)


def reason_conflict(sentiment: Column, reason: Column, positive: tuple[str, ...], negative: tuple[str, ...]) -> Column:
    """The reason has hints of the opposite sentiment and none of its own."""
    has_positive, has_negative = any_hit(reason, positive), any_hit(reason, negative)
    return F.coalesce(
        ((sentiment == "positive") & has_negative & ~has_positive) | ((sentiment == "negative") & has_positive & ~has_negative),
        F.lit(False),
    )


def normalize(df: DataFrame, text: str, output: str, lexicon: Lexicon) -> DataFrame:
    """df with sentiment, entities, label_reason and postprocess_tag.

    Rules in this order: a neutral label yields to the text's own sentiment, and so does
    a contrary one; missing entities are found in the text; a reason that contradicts the
    sentiment is rewritten.
    """
    blank = lambda c: (c == "") | (c == "parse_fallback")
    df = df.withColumn("__p", parse_label(F.col(output))).withColumn("__inferred", infer_sentiment(F.col(text), lexicon))
    said, inferred = F.col("__p.sentiment"), F.col("__inferred")
    fill = (said == "neutral") & (inferred != "neutral")
    contrary = (said != "neutral") & (inferred != "neutral") & (inferred != said)
    df = df.withColumns(
        {
            "__fill": fill,
            "__contrary": contrary,
            "sentiment": F.when(fill | contrary, inferred).otherwise(said),
            "__reason": F.when(fill & blank(F.col("__p.reason")), "rule_sentiment_override").otherwise(F.col("__p.reason")),
            "__entities": F.slice(distinct_items(F.col("__p.entities")), 1, MOST),
        }
    )
    none = F.size("__entities") == 0
    df = df.withColumns(
        {
            "__none": none,
            "entities": F.when(none, find_entities(F.col(text), lexicon)).otherwise(F.col("__entities")),
            "__reason": F.when(none & blank(F.col("__reason")), "rule_entities_fill").otherwise(F.col("__reason")),
        }
    )
    conflict = reason_conflict(F.col("sentiment"), F.col("__reason"), lexicon.positive_reason, lexicon.negative_reason)
    df = df.withColumn("__conflict", conflict)
    reason = F.when(F.col("__conflict"), "reason_rewrite_for_sentiment_consistency").otherwise(F.col("__reason"))
    tag = F.concat_ws(
        "|",
        F.when(F.col("__fill"), "rule_sentiment_override"),
        F.when(F.col("__contrary"), "rule_sentiment_conflict_override"),
        F.when(F.col("__none"), "rule_entities_fill"),
        F.when(F.col("__conflict"), "reason_rewrite"),
    )
    df = df.withColumns(
        {
            "label_reason": F.when(reason == "", "model_output").otherwise(reason),
            "postprocess_tag": F.when(tag == "", "model_output").otherwise(tag),
        }
    )
    return df.drop(*[c for c in df.columns if c.startswith("__")])


def parse_topic_label(output: Column) -> Column:
    """Struct (label, confidence) of a plain JSON answer; general and 0.5 by default."""
    schema = "label string, confidence string, _bad string"
    return bind(
        strip(F.coalesce(output, F.lit(""))), lambda body: bind(F.from_json(body, schema, _STRICT), lambda raw: _topic_label(body, raw))
    )


def _topic_label(body: Column, raw: Column) -> Column:
    bad = raw.isNull() | raw["_bad"].isNotNull() | ~F.startswith(body, F.lit("{"))
    number = raw["confidence"].try_cast("double")
    given = F.array_contains(F.json_object_keys(body), "confidence")
    bad = bad | (given & number.isNull())
    return F.struct(
        F.when(bad, "general").otherwise(F.coalesce(raw["label"], F.lit("general"))).alias("label"),
        F.when(bad | ~given, F.lit(0.5)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), number))).alias("confidence"),
    )
