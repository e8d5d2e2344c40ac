"""Secret scans: fixed patterns, and a guess-cost estimate for values in credential contexts.

A value that stands where a credential stands ("password: ...", "pwd=...", "Authorization:
Bearer ...") is split into pieces at the least total cost by dynamic programming. A piece
is a common word, a word of the corpus, a run of letters at the price of its letter pairs,
a date, a repeat, a keyboard walk, a sequence or brute force; its cost is the log10 of the
guesses that a cracker needs. Values that are costly to guess are machine-made secrets and
become spans of kind `guess`; cheap ones ("password: monkey12") are prose or examples. Words
are counted over all documents, outside of such values.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusmill.llm.common import column, table

KINDS = ("assign", "access", "hex", "guess")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}

#: Further contexts: a credential's name, alone or within a longer name (AWS_SECRET_ACCESS_KEY,
#: dbPassword, x-api-key), a separator, and a value up to a space or quote. Short names must be
#: whole parts of a longer one ("author" and "opinion" aren't any). A run of name characters is
#: looked at once, from its start, so that the search stays linear.
CONTEXT = re.compile(
    r"""(?<![\w-])(?=[\w-]*?(?:passw(?:or)?d|pass[_-]?(?:phrase|code)|pwd|secret|token|(?:api|access|private)[_-]?key|credential|bearer|authorization"""
    r"""|(?:(?<![a-z])|(?-i:(?<=[a-z])(?=[A-Z])))(?:pass|pin|o?auth)(?:(?![a-z])|(?-i:(?<=[a-z])(?=[A-Z])))))"""
    r"""[\w-]++["']?(?:\x20*[:=]\x20*|\x20+is\x20+)(?:bearer\x20+|basic\x20+)?["']?([^\s"'<>,;|]{6,})""",
    re.ASCII | re.IGNORECASE,
)
HINTS = ("pass", "pwd", "pin", "secret", "token", "key", "credential", "bearer", "auth")
STRONG = 10.0  # log10 of guesses from which a value counts as a secret

#: Common password words by rank, and the rows of a keyboard.
WORDS = (
    "password admin welcome login master hello monkey dragon letmein sunshine princess football shadow secret "
    "summer winter spring autumn baseball superman batman trustno hunter killer soccer ranger jordan harley "
    "george charlie andrew michelle love sunday monday friday january example changeme default test user root "
    "guest server system access token pass word key your here none null true false value string sample demo "
    "foo bar baz xxx my the and for you with"
).split()
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")

RANK = {w: i + 1 for i, w in enumerate(WORDS)}
LONGEST = max(map(len, WORDS))
_LEET = str.maketrans("4@31!05$7", "aaeiiosst")
_DATE = re.compile(r"(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])(?:[-/._]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)?\d\d")


_KEY = {c: (r, i) for r, row in enumerate(ROWS) for i, c in enumerate(row)}
_DICTIONARY = math.log10(50_000)  # guesses for a run of letters of other scripts

MOST_WORDS = 100_000  # of the corpus, the commonest first, that every task gets
IN_DOCUMENTS = 3  # a word stands in so many documents, outside of credential contexts
LONGEST_WORD = 24

#: Cost of a letter (column) after another (row; the first row is a word's start), in quarters
#: of a bit as base-36 digits. Counted once in English prose (the docstrings of Python's library).
_BIGRAMS = (
    "gjdghinlhvsjhlkfugdhmolzvz zjfjzulzjzrbjdzjzcg9ppvtnz cqlscvwzdnz9tyeszhhodzzzlz czmzczzeizhizz8zzkrcizzzsz "
    "evuj6tsz9wzmzugzzlgpizzvsz iwgconnzszzikcxlqabhzotjvz ezzzcezz8zzgywayzgqkgzzzkz gzzz8vjedzzknghyzdgqfzzzxz "
    "azzz7zzzbzzoqtbzziqglzzznz kofiiljzzzvii7dnznhezkzrzl czzz8zzzfwqzxz9uzzhz8xzzxz ktzq5sozauyivltlzzcvnzizuz "
    "cvsk8wyzazydzzduzzjjjtzzez 9kzz8zzzczzriuebzzlxizzzsz fzgdenazhzqrxoiuzzdannzzwz pnjiurnzpzpgg8lizbjigliuzz "
    "bzzqazzpizzczxdgzbkgkzzzlz pzzzzzzzzzzmtzzzzprx0zzzzz cwnl7spzczprimeuzkggmrvzlz kziy9qziczopswhhuze9fzxzpz "
    "ezpw8zzg8zzowzgvzegkkzvzkz hjinhonzjzzefbqgzcddzzzzzz 9zzz3zzzbzzzzzjzzzzzzzzzzz ayzubzzcazwnzfdzzdgwzzzzzz "
    "gzduauzwbzzqpzz9zts9zzzwoz oqnlgtpzdzzhhgiazobeqslxmq czzu3vzzezzyyzfzzzmzzzzznr"
).split()
_AFTER = {
    (a, b): int(_BIGRAMS[i][j], 36) / 4 * math.log10(2)
    for i, a in enumerate("^abcdefghijklmnopqrstuvwxyz")
    for j, b in enumerate("abcdefghijklmnopqrstuvwxyz")
}


def _way(a: str, b: str) -> tuple[int, int] | None:
    """The step from a key to one beside it on the same or a touching row."""
    if a not in _KEY or b not in _KEY or a == b:
        return None
    (r, i), (q, j) = _KEY[a], _KEY[b]
    return (q - r, j - i) if abs(q - r) <= 1 and abs(j - i) <= 1 else None


def _letters(value: str, low: str, i: int, ranks: dict[str, int]) -> Iterator[tuple[int, float]]:
    """(end, cost) of runs from i that may be words: letters of one case (a capital may lead).

    A word of the corpus costs its rank, another run what its letters are worth after each
    other. Letters beyond ASCII cost brute force there; runs of nothing else cost a
    dictionary, as scripts without spaces have no words to count.
    """
    cost, before, plain = 0.0, "^", 0
    for j in range(i, min(len(value), i + LONGEST_WORD)):
        c = value[j]
        if not c.isalpha() or (j > i + 1 and c.isupper() != value[i + 1].isupper()) or (j == i + 1 and c.isupper() and not value[i].isupper()):
            return
        cost += _AFTER.get((before, low[j]), math.log10(26))
        before = low[j]
        plain += ord(c) < 128
        if j - i >= 2:
            rank = ranks.get(low[i : j + 1])
            known = math.log10(rank + len(WORDS)) if rank else math.inf
            yield j + 1, min(cost, known, math.inf if plain else _DICTIONARY)


def _alphabet(c: str) -> int:
    return 10 if c.isdigit() else 26 if c.isalpha() else 33


def _runs_on(n: int, same: Callable[[int], bool]) -> array:
    """How many places in a row, from each place on, `same` holds."""
    out = array("i", bytes(4 * (n + 1)))
    for i in range(n - 1, -1, -1):
        out[i] = out[i + 1] + 1 if same(i) else 0
    return out


def guess_cost(value: str, ranks: dict[str, int] = {}) -> float:  # noqa: B006
    """log10 of the guesses for a value: the least sum over its segmentations.

    ranks: words of the corpus, the commonest is 1.

    best[j] is the least cost of the first j characters. Each piece adds its own cost, and
    log10(2) for the choice of its kind. Lengths of repeats, sequences and walks are found
    before, from the end, so that the work is linear in the value's length.
    """
    n, low = len(value), value.lower()
    low = low if len(low) == n else value
    plain = low.translate(_LEET)
    best = [0.0] + [math.inf] * n
    again = {w: _runs_on(n - w, lambda i, w=w: low[i] == low[i + w]) for w in range(1, min(8, n // 2) + 1)}
    steps = [_runs_on(n - 1, lambda i, d=d: ord(low[i + 1]) - ord(low[i]) == d) for d in (1, -1)]
    ways = [_way(a, b) for a, b in zip(low[:-1], low[1:], strict=True)] + [None]
    walks = _runs_on(n - 1, lambda i: ways[i] is not None)
    turns = array("i", bytes(4 * (n + 1)))
    for i in range(n - 2, -1, -1):
        turns[i] = turns[i + 1] + (ways[i] != ways[i + 1]) if ways[i] is not None else 0
    for i in range(n):
        base = best[i] + math.log10(2) * (i > 0)

        def reach(j: int, cost: float, base: float = base) -> None:
            if base + cost < best[j]:
                best[j] = base + cost

        # Brute force of one character goes on from the piece before without a new choice.
        brute = best[i] + math.log10(_alphabet(value[i]))
        if brute < best[i + 1]:
            best[i + 1] = brute
        for j in range(i + 2, min(n, i + LONGEST) + 1):
            if rank := RANK.get(plain[i:j]):
                upper = sum(c.isupper() for c in value[i:j])
                leet = plain[i:j] != low[i:j]
                reach(j, math.log10(rank) + 0.3 + (0.3 if upper in (0, 1, j - i) else 0.3 * upper) * (upper > 0) + 0.6 * leet)
        if m := _DATE.match(value, i):
            reach(m.end(), math.log10(365 * 120) if m.end() - i > 4 else math.log10(120))
        for width in range(1, min(8, (n - i) // 2) + 1):
            times = again[width][i] // width + 1
            if times > 1:
                reach(i + times * width, sum(math.log10(_alphabet(c)) for c in low[i : i + width]) + math.log10(times))
        for run in steps:
            if run[i] >= 2:
                reach(i + run[i] + 1, 1.0 + math.log10(run[i] + 1))
        for j, cost in _letters(value, low, i, ranks):
            reach(j, cost)
        if walks[i] >= 2:
            reach(i + walks[i] + 1, math.log10(40 * (walks[i] + 1)) + 0.5 * turns[i])
    return best[n]


def _hex_run(raw: bytes) -> bool:
    """Whether 16 hex digits stand in a row; bytes of longer characters never are any."""
    return b"\1" * LEAST["hex"] in raw.translate(_HEX_MARK)


_HEX_MARK = bytes(1 if c in b"0123456789abcdef" else 0 for c in range(256))


def scan(text: str | None, ranks: dict[str, int] = {}) -> list[tuple[int, int, int, float | None]]:  # noqa: B006
    """(start, end, kind, cost) in code points, in order of start and kind.

    The fixed patterns come first and stay as they are. A value in a credential context
    becomes a span of kind `guess` if it costs STRONG or more and no span of a fixed
    pattern covers it.
    """
    if not text:
        return []
    spans: list[tuple[int, int, int, float | None]] = []
    low = text.lower()
    if "password" in low or "passwd" in low or "secret" in low or "token" in low or "api" in low:
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= LEAST["assign"]:
                spans.append((*m.span(), 0, guess_cost(m[2], ranks)))
    if "AKIA" in text:
        spans += [(*m.span(), 1, None) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    if _hex_run(text.encode()):
        spans += [(*m.span(), 2, None) for m in HEX.finditer(text) if len(m[0]) >= LEAST["hex"]]
    if any(x in low for x in HINTS):
        # Contexts ascend: one pass over the fixed spans by start tells how far those before a value reach.
        fixed, k, reach = sorted((s, e) for s, e, _, _ in spans), 0, -1
        for m in CONTEXT.finditer(text):
            a, b = m.span(1)
            while k < len(fixed) and fixed[k][0] <= a:
                reach = max(reach, fixed[k][1])
                k += 1
            if b <= reach:
                continue
            if (cost := guess_cost(m[1], ranks)) >= STRONG:
                spans.append((a, b, 3, cost))
    return sorted(spans, key=lambda x: (x[0], x[2], x[1]))


FOUND = "spans array<struct<kind:string,start:long,end:long,log10_guesses:double>>"
_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("log10_guesses", pa.float64())]))


_RUN_OF_LETTERS = re.compile(r"[^\W\d_]+")


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n): documents in which each word of 3 to LONGEST_WORD letters stands.

    Values in credential contexts don't count, so that a secret doesn't vouch for itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
            seen.clear()
            return rows

        for batch in batches:
            for text in batch.column("text"):
                text = text.as_py() or ""
                low = text.lower()
                if any(x in low for x in HINTS):
                    low = ASSIGN.sub(" ", CONTEXT.sub(" ", text)).lower()
                seen.update(w for w in set(_RUN_OF_LETTERS.findall(low)) if 3 <= len(w) <= LONGEST_WORD)
                if len(seen) > 200_000:
                    yield flush()
        yield flush()

    return docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def word_ranks(docs: DataFrame) -> dict[str, int]:
    """Ranks of the MOST_WORDS commonest words of IN_DOCUMENTS documents or more."""
    # Every partition sends its commonest to the driver: few partitions, however large the input.
    words = count_words(docs).where(F.col("n") >= IN_DOCUMENTS).repartition(8).orderBy(F.desc("n"), "word").limit(MOST_WORDS)
    return {r["word"]: i for i, r in enumerate(words.collect(), 1)}


def find(docs: DataFrame) -> DataFrame:
    """Columns of docs, of any names, with `spans` added (or replaced). A null or empty text has none.

    Spans are in order of start, then kind. Repeated rows are scanned each; texts are scanned whole, however
    long; no rows give no rows.
    """
    kept = [c for c in docs.columns if c not in ("spans", "text")]
    order = [c for c in docs.columns if c != "spans"]
    docs = docs.select(F.struct(F.lit(0).alias("0"), *map(column, kept)).alias("row"), "text")
    ranks = docs.sparkSession.sparkContext.broadcast(word_ranks(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                [{"kind": KINDS[k], "start": a, "end": b, "log10_guesses": c} for a, b, k, c in scan(text.as_py(), ranks.value)]
                for text in batch.column("text")
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, _FOUND)], [*batch.schema.names, "spans"])

    out = StructType([*docs.schema.fields, *StructType.fromDDL(FOUND).fields])
    named = [F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in order]
    return docs.mapInArrow(run, out).select(*named, "spans")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    joined = lambda spans: F.concat_ws(
        ",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
    )
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda x: x["kind"] != "guess")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.array_max(F.transform("spans", lambda x: x["log10_guesses"])).alias("max_log10_guesses"),
    )
