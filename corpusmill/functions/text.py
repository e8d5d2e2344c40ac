"""Text expressions: cleaning, masking, hashing, sentences. All are Catalyst expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Python's str.strip and re know it, and the patterns for
# e-mail addresses and telephone numbers.
SPACE = r"[\s\x1c-\x1f]"
TAG = r"<[^>]+>"
EMAIL = r"\b[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\b"
PHONE = r"(?:(?:\+?\d{1,3}[-.\s]?)?(?:\(?\d{2,4}\)?[-.\s]?)?\d{3,4}[-.\s]?\d{4})"
#: A stricter form, off by default: a separator is needed, so that plain numbers stay.
STRICT_PHONE = r"(?<!\d)(?:\+\d{1,3}[-.\s])?\(?\d{2,4}\)?[-.\s]\d{3,4}[-.\s]\d{4}(?!\d)"
SENTENCE_END = "。！？!?；;\\."


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once a row, however often the body names it.

    A column that is merely named twice is copied into each place by the optimizer, and again
    into lambdas, where it is evaluated for each element.
    """
    return F.transform(F.array(value), body)[0]


def clean(text: Column) -> Column:
    """Tags become spaces, runs of white space one space, none at the ends; null becomes ""."""
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), TAG, " ")
    return F.trim(F.regexp_replace(spaced, f"(?U){SPACE}+", " "))


def mask(text: Column, phone: str = PHONE) -> Column:
    """E-mail addresses first, then telephone numbers; null becomes ""."""
    mailed = F.regexp_replace(F.coalesce(text, F.lit("")), f"(?U){EMAIL}", "[MASKED_EMAIL]")
    return F.regexp_replace(mailed, f"(?U){phone}", "[MASKED_PHONE]")


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def truthy(*options: Column) -> Column:
    """The first option that is neither null nor empty."""
    return F.coalesce(*(F.nullif(x.cast("string"), F.lit("")) for x in options))


def event_date(timestamp: Column) -> Column:
    return F.coalesce(F.try_to_date(timestamp).cast("string"), F.lit("unknown"))


def distinct_items(items: Column) -> Column:
    """Trimmed, without blanks; the first of equal items stays."""
    trimmed = F.transform(items, lambda x: strip(x))
    return F.array_distinct(F.filter(trimmed, lambda x: x != ""))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"(?U)^{SPACE}+|{SPACE}+$", "")


def sentences(text: Column) -> Column:
    """Cleaned of surplus white space and split after a terminator that white space follows."""
    spaced = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), f"(?U){SPACE}+", " "))
    return F.filter(F.split(spaced, f"(?<=[{SENTENCE_END}]) "), lambda x: x != "")


def chunk_id(doc_id: Column, index: Column, timestamp: Column) -> Column:
    return F.md5(F.concat_ws("::", doc_id, index.cast("string"), timestamp))


def hits(text: Column, lexicon: Sequence[str]) -> Column:
    """Entries of the lexicon that occur in the text, in the lexicon's order."""
    return F.filter(F.array(*map(F.lit, lexicon)), lambda w: F.contains(text, w)) if lexicon else F.array().cast("array<string>")


def any_hit(text: Column, lexicon: Sequence[str]) -> Column:
    out = F.lit(False)
    for w in lexicon:
        out = out | F.contains(text, F.lit(w))
    return out


def l2_normalize(vector: Column) -> Column:
    """Doubles of length one; a zero vector is divided by 1e-9 at least."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(wide, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(wide, lambda x: x / F.greatest(norm, F.lit(1e-9)))


def mean_pool(states: Column, attention: Column) -> Column:
    """Mean of the token vectors whose attention is one; the divisor is 1e-9 at least. No tokens give an empty vector."""
    used = F.filter(F.arrays_zip(states.alias("v"), attention.alias("a")), lambda x: x["a"] > 0)
    zero = F.transform(F.coalesce(F.try_element_at(states, F.lit(1)), F.array().cast("array<double>")), lambda x: F.lit(0.0))
    total = F.aggregate(used, zero, lambda acc, x: F.zip_with(acc, x["v"], lambda a, b: a + b.cast("double")))
    return F.transform(total, lambda x: x / F.greatest(F.size(used).cast("double"), F.lit(1e-9)))


def as_vector(vector: Column) -> Column:
    """Floats; null is an empty vector and null elements are zero."""
    return F.coalesce(F.transform(vector, lambda x: F.coalesce(x.cast("float"), F.lit(0.0).cast("float"))), F.array().cast("array<float>"))


def text_map(fields: Column) -> Column:
    """A struct as a map of texts; null values become empty."""
    pairs = F.from_json(F.to_json(fields, {"ignoreNullFields": "false"}), "map<string,string>")
    return F.transform_values(pairs, lambda k, v: F.coalesce(v, F.lit("")))
