import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.functions.lexicons import REVIEWS
from corpusmill.operators import chunking, labeling


def one(spark, value, make):
    return spark.createDataFrame([(value,)], "t string").select(make(F.col("t")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "raw, want",
    [
        (None, ""),
        ("", ""),
        ("<p>", ""),
        ("a<b and c>d", "a d"),
        ("　x\x1cy\t", "x y"),
        ("<p>Hello <b>you</b></p>\n\nthere", "Hello you there"),
    ],
)
def test_clean(spark, raw, want):
    assert one(spark, raw, T.clean) == want


@pytest.mark.parametrize(
    "raw, want",
    [
        (None, ""),
        ("write to ab.c@d-e.org now", "write to [MASKED_EMAIL] now"),
        ("邮箱ab@c.com", "邮箱ab@c.com"),
        ("20260306", "[MASKED_PHONE]"),
        ("2026-03-06T10:00:00Z", "2026-03-06T10:00:00Z"),
        ("1234567890123456", "[MASKED_PHONE]6"),
        ("call 138-0013-8000", "call [MASKED_PHONE]"),
    ],
)
def test_mask(spark, raw, want):
    assert one(spark, raw, T.mask) == want


def test_strict_phone_leaves_plain_numbers(spark):
    assert one(spark, "20260306 and 010-1234-5678", lambda c: T.mask(c, T.STRICT_PHONE)) == "20260306 and [MASKED_PHONE]"


def test_event_date(spark):
    assert one(spark, "2026-03-06T10:00:00Z", T.event_date) == "2026-03-06"
    assert one(spark, "last week", T.event_date) == "unknown"
    assert one(spark, None, T.event_date) == "unknown"


def test_sentences(spark):
    assert one(spark, "一。 二！三", T.sentences) == ["一。", "二！三"]
    assert one(spark, "  ", T.sentences) == []
    assert one(spark, "A. B? C", T.sentences) == ["A.", "B?", "C"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab<> \t\n.　é", max_size=30), min_size=1, max_size=20))
def test_clean_as_python_does_and_idempotent(spark, raws):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, t string")
    rows = df.select("t", T.clean(F.col("t")).alias("c"), T.clean(T.clean(F.col("t"))).alias("cc")).collect()
    for r in rows:
        assert r["c"] == re.sub(r"\s+", " ", re.sub(r"<[^>]+>", " ", r["t"])).strip()
        assert r["cc"] == T_clean(r["c"])


def T_clean(text):
    return re.sub(r"\s+", " ", re.sub(r"<[^>]+>", " ", text)).strip()


def pack(parts, most_chars, most):
    out, cur, chars = [], [], 0
    for p in parts:
        if len(cur) >= most or (cur and chars + len(p) > most_chars):
            out.append(" ".join(cur))
            cur, chars = [], 0
        cur.append(p)
        chars += len(p)
    return out + ([" ".join(cur)] if cur else [])


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(1, 40), max_size=15), min_size=1, max_size=10))
def test_chunks_fold(spark, sizes):
    texts = [" ".join("x" * n + "." for n in s) for s in sizes]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = chunking.chunk_documents(df, 60, 3).collect()
    for i, t in enumerate(texts):
        header = f"Title: Untitled\nTimestamp: unknown\nDocumentID: {i}\n\n"
        mine = sorted((r["metadata"]["chunk_index"], r["text_chunk"]) for r in got if r["original_doc_id"] == str(i))
        assert [x for _, x in mine] == [header + b for b in (pack(t.split(" ") if t else [], 60, 3) or [""])]


@pytest.mark.parametrize(
    "text, want",
    [
        ("手机很好，但是续航很差，失望", "negative"),
        ("手机不错", "positive"),
        ("很差但", "negative"),
        ("很好 很差", "neutral"),
        (None, "neutral"),
        ("", "neutral"),
    ],
)
def test_sentiment(spark, text, want):
    assert one(spark, text, lambda c: labeling.infer_sentiment(c, REVIEWS)) == want


def test_entities(spark):
    got = one(spark, "华为手机续航好", lambda c: labeling.find_entities(c, REVIEWS))
    assert got == ["华为", "手机", "续航", "华为手机续航"]


@pytest.mark.parametrize(
    "output, want",
    [
        ('x {"sentiment": "POSITIVE", "entities": ["a"], "reason": "r"} y', ("positive", ["a"], "r")),
        ('{"sentiment": "odd"}', ("neutral", [], "")),
        ('{"sentiment": "negative", "entities": "text", "reason": null}', ("negative", [], "None")),
        ('{"entities": ["1","2","1","3","4","5","6","7","8"]}', ("neutral", ["1", "2", "1", "3", "4", "5", "6", "7"], "")),
        ('["positive"]', ("neutral", [], "parse_fallback")),
        ("", ("neutral", [], "parse_fallback")),
        (None, ("neutral", [], "parse_fallback")),
        ('{"sentiment": "positive", ', ("neutral", [], "parse_fallback")),
        ("{'sentiment': 'positive'}", ("neutral", [], "parse_fallback")),
    ],
)
def test_parse_label(spark, output, want):
    r = one(spark, output, labeling.parse_label)
    assert (r["sentiment"], r["entities"], r["reason"]) == want


@pytest.mark.parametrize(
    "text, output, want",
    [
        ("手机不错", '{"sentiment":"neutral","entities":["手机"],"reason":""}', ("positive", "rule_sentiment_override", "rule_sentiment_override")),
        ("手机很差", '{"sentiment":"positive","entities":["手机"],"reason":"很满意"}', ("negative", "reason_rewrite_for_sentiment_consistency", "rule_sentiment_conflict_override|reason_rewrite")),
        ("手机", '{"sentiment":"neutral","entities":[],"reason":"ok"}', ("neutral", "ok", "rule_entities_fill")),
        ("手机", '{"sentiment":"positive","entities":["手机"],"reason":""}', ("positive", "model_output", "model_output")),
        ("手机不错", "broken", ("positive", "rule_sentiment_override", "rule_sentiment_override|rule_entities_fill")),
    ],
)
def test_normalize(spark, text, output, want):
    df = spark.createDataFrame([(text, output)], "text string, output string")
    r = labeling.normalize(df, "text", "output", REVIEWS).first()
    assert (r["sentiment"], r["label_reason"], r["postprocess_tag"]) == want
