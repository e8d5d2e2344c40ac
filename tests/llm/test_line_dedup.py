import hashlib
import random

from pyspark.sql import functions as F

from corpusmill.llm import line_dedup as ld

BLANK = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, shortest=ld.SHORTEST, documents=ld.DOCUMENTS):
    key = lambda line: line.strip(BLANK).translate(LOWER)
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(i)
    order = lambda i: (i is not None, i or 0)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x
            for x in lines
            if len(key(x)) < shortest or len(holders[key(x)]) < documents or i == max(holders[key(x)], key=order)
        ]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def removed(df, **options):
    got = ld.drop_shared_lines(df, **options)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept"]
    return sorted(map(tuple, got.collect()), key=repr)


def test_equals_brute_force(spark, docs):
    rng = random.Random(5)
    pool = ["Licensed under the terms of this FILE, all rights reserved", "É" + "ab " * 14, "é" + "ab " * 14, "short", "", " ", "x" * 39, "x" * 40, "x" * 41]
    line = lambda: rng.choice(["", " ", "\t", "\x0b\r"]) + rng.choice(pool).swapcase() * rng.choice([0, 1, 1]) + rng.choice(["", "\x0c ", "\xa0"])
    rows = [(rng.choice([None, rng.randint(-20, 20)]), "\n".join(line() for _ in range(rng.randint(0, 12)))) for _ in range(80)]
    rows += [(1, None), (2, ""), (3, "\n"), *rows[:10]]
    assert removed(docs(*rows)) == brute(rows)
    assert removed(docs(*rows), shortest=1, documents=2) == brute(rows, 1, 2)


def test_a_key_of_all_documents_stays_in_the_last_only(spark, docs):
    shared = "this line stands in each and every document of the table"
    rows = [(i, f"{i}\n  {shared.upper()}\n{shared}\t\nend") for i in range(50)]
    got = removed(docs(*rows))
    assert got == brute(rows)
    assert sum(n for _, _, n, _ in got) == 98


def test_threshold_counts_documents_not_rows(spark, docs):
    text = "y" * 40
    assert sum(r[2] for r in removed(docs(*((i, text) for i in (1, 2, 3, 4, 4, 4))))) == 0
    assert sum(r[2] for r in removed(docs(*((i, text) for i in (1, 2, 3, 4, None, None))))) == 5
    assert removed(docs()) == []


def test_long_text_and_clashing_columns(spark, docs):
    line = "a line which is repeated in many of the documents here"
    rows = [(i, "\n".join(f"{line} {k % 7}" if k % 2 else f"{i} {k}" for k in range(40_000 if i == 0 else 20))) for i in range(6)]
    df = docs(*rows).withColumns({"doc": F.lit("x"), "a.b": F.lit(1), "gone": F.lit(2), "line": F.lit(3), "of": F.lit(4)})
    assert removed(df) == brute(rows)


def test_query_has_digests_of_what_is_kept(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = [(i, a, b, hashlib.sha256(t.encode()).hexdigest()) for i, a, b, t in brute(rows)]
    assert sorted(map(tuple, ld.op11_line_dedup(spark, sf_dir).collect()), key=repr) == sorted(want, key=repr)
