import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corpusmill.llm import common, lm_scoring, quality


def fold(i):
    return zlib.crc32(str(i).encode()) % 4


def test_tokens_equal_split():
    texts = ["", "a b", None, "  x\n\ty  ", "é è", "word" * 500, "a b"]
    raw, offs = common.utf8(pa.array(texts))
    h, starts, ends, rows = common.token_runs(raw, offs, common.SPACE)
    for i, t in enumerate(texts):
        mine = [bytes(raw[s:e]).decode() for s, e in zip(starts[rows[i] : rows[i + 1]], ends[rows[i] : rows[i + 1]], strict=True)]
        assert mine == (t or "").split()
    assert (h[rows[1] : rows[2]] == h[rows[6] : rows[7]]).all() and len(set(h.tolist())) == len({w for t in texts if t for w in t.split()})
    sliced, offs = common.utf8(pa.array(["no", None, "yes"]).slice(1))
    assert bytes(sliced) == b"yes" and offs.tolist() == [0, 0, 3]


def test_chunks_cover_all_rows():
    offs = np.cumsum([0, 5, 0, 100, 3, 3])
    assert list(common.chunks(offs, 8)) == [(0, 2), (2, 3), (3, 5)]


def test_quality_on_held_out_rows(spark, sf_dir):
    docs = spark.read.parquet(sf_dir.replace("0.001", "0.01") + "/documents.parquet")
    labels = spark.read.parquet(sf_dir.replace("0.001", "0.01") + "/labels.parquet")
    model = quality.train(docs, labels)
    scored = quality.score(docs, model).join(labels, "doc_id").where(quality.fold(F.col("doc_id")) == 2)
    rows = scored.select("score", "predicted", "quality").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert np.mean(np.array(good)[:, None] > np.array(bad)) > 0.97
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95
    assert all((r["score"] >= 0.7) == r["predicted"] for r in rows)


def test_held_out_labels_are_not_used(spark, docs):
    d = docs(*((i, f"good words here {i}" if i % 2 else "### $$$ !!") for i in range(60)))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    flipped = labels.withColumn("quality", F.when(quality.fold(F.col("doc_id")) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(r["score"] for r in quality.score(d, quality.train(d, x)).collect()) for x in (labels, flipped))
    assert a == b
    for r in d.select("doc_id", quality.fold(F.col("doc_id")).alias("f")).collect():
        assert r["f"] == fold(r["doc_id"])


def test_quality_edges(spark, docs):
    d = docs((1, None), (2, ""), (3, " \n"), (4, "word " * 50_000), (5, "same"), (5, "same"), (None, "x")).withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (None, 1, 0), (5, None, 0), (5, 0, 0)], "doc_id long, quality int, toxic int")
    rows = quality.score(d, quality.train(d, labels)).collect()
    s = {r["doc_id"]: r["score"] for r in rows}
    assert len(rows) == 7 and s[1] == s[2] == s[3] and all(0 <= r["score"] <= 1 for r in rows)
    none = quality.train(d, labels.limit(0))
    assert {r["score"] for r in quality.score(d, none).collect()} == {0.5}
    assert quality.score(d.limit(0), quality.train(d.limit(0), labels)).collect() == []


def test_sample_is_bounded(spark, docs):
    d = docs(*((i, f"w{i}") for i in range(40)))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    assert quality.train(d, labels, most=3).mean.shape == (quality.FEATURES,)


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = (rng.random(3000) < 1 / (1 + np.exp(-x[:, 0]))).astype(int)
    m = quality.fit(np.zeros((1, 1), np.float32), x, y, np.arange(3000) % 3 == 0)
    p = m.scores(x)
    assert abs(p.mean() - y.mean()) < 0.05 and m.temperature > 0


def slow_scores(model, texts):
    """Scores of all texts, word by word, with counts from dictionaries."""
    split = []
    for text in texts:
        h = common.token_runs(*common.utf8(pa.array([text], pa.string())), lm_scoring._KIND)[0] >> np.uint64(16)
        bucket = lm_scoring._bucket(h)
        split.append((h.tolist(), model.vocabulary.of_bucket[bucket].tolist(), bucket.tolist()))
    between, words, classes = Counter(), Counter(), Counter()
    for h, c, bucket in split:
        full = [None, *h, None]
        between.update(zip(full, full[1:], full[2:], strict=False))
        words.update(bucket)
        classes.update(c)
    around = Counter()
    for (a, _, b), n in between.items():
        around[a, b] += n
    buckets = Counter(model.vocabulary.of_bucket.tolist())  # each counts a half more than it holds
    w, out = [x.astype(float) for x in model.weights], []
    for h, c, bucket in split:
        full, padded, total = [None, *h, None], [lm_scoring.EDGE] * 2 + c + [lm_scoring.EDGE] * 2, 0.0
        for i, y in enumerate(c):
            x = w[0][[padded[i], padded[i + 1], padded[i + 3], padded[i + 4]]].ravel()
            z = np.tanh(x @ w[1] + w[2]) @ w[3]
            p = (words[bucket[i]] + 0.5) / (classes[y] + 0.5 * buckets[y])
            for level, (bias, digit) in enumerate(((w[4][0], y >> 8), (w[5][y >> 8], y >> 4 & 15), (w[6][y >> 4], y & 15))):
                e = np.exp(z[16 * level : 16 * level + 16] + bias)
                p *= e[digit] / e.sum()
            n, seen = between[tuple(full[i : i + 3])] - 1, around[full[i], full[i + 2]] - 1
            total += np.log((lm_scoring.EVIDENCE * p + n) / (lm_scoring.EVIDENCE + seen))
        out.append((len(c), total))
    return out


def test_lm_scores_equal_brute_force(spark, docs, monkeypatch):
    monkeypatch.setattr(lm_scoring, "PART_BYTES", 100)
    rng = np.random.default_rng(4)
    rows = [(i, "the cat sat on the mat . " * 30) for i in range(8)] + [(90, None), (91, ""), (92, "mat the on sat"), (93, "the cat sat on the mat ."), (93, "the cat sat on the mat .")]
    rows += [(100 + i, " ".join(f"w{k}" for k in rng.integers(0, 60, 50))) for i in range(12)] + [(99, "x y " * 90_000)]
    d = docs(*rows).withColumn("log_prob", F.lit("x")).withColumn("tokens", F.lit("kept")).withColumn("rows", F.lit(1)).withColumn("chunk", F.lit("c"))
    models = []
    real = lm_scoring.train
    monkeypatch.setattr(lm_scoring, "train", lambda *x: models.append(real(*x)) or models[-1])
    got = lm_scoring.score(d, own=9).collect()
    assert len(got) == len(rows) and all((r["tokens"], r["rows"], r["chunk"], r["lang"]) == ("kept", 1, "c", "en") for r in got)
    by_id = {r["doc_id"]: r for r in got}
    for (i, _), (n, total) in zip(rows, slow_scores(models[0], [t for _, t in rows]), strict=True):
        assert by_id[i]["n_tokens"] == n and abs(by_id[i]["log_prob"] - total) < 2e-3 * (1 + abs(total))
        assert (by_id[i]["mean_log_prob"] is None) == (n == 0)
    assert by_id[93]["mean_log_prob"] > by_id[92]["mean_log_prob"]
    lm_scoring.score(d, own=9).collect()
    assert all((a == b).all() for a, b in zip(models[0].weights, models[1].weights, strict=True))
    assert lm_scoring.score(d.limit(0)).collect() == []


def test_chunks_are_joined_where_they_lie(spark, docs, monkeypatch):
    """Only keys and counts are shuffled, not the chunks; tasks learn from as much as the tasks wrote; no table stays."""
    learn, real = [], lm_scoring.count_words
    monkeypatch.setattr(lm_scoring, "count_words", lambda tokens: learn.append(tokens.rdd.getNumPartitions()) or real(tokens))
    tables = spark.catalog.listTables()
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.execution.arrow.maxRecordsPerBatch": "5"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        scored = lm_scoring.score(docs(*((i, f"a b{i % 7} c") for i in range(80))).coalesce(1))
        plan = scored._jdf.queryExecution().executedPlan().toString()
        got = {r["doc_id"]: r for r in scored.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert plan.count("Exchange hashpartitioning(chunk#") == 1 and learn == [1] and spark.catalog.listTables() == tables
    assert len(got) == 80 and all(r["n_tokens"] == 3 and abs(r["log_prob"] - got[i % 7]["log_prob"]) < 1e-3 for i, r in got.items())


def test_class_distribution_sums_to_one():
    rng = np.random.default_rng(1)
    v = lm_scoring.Vocabulary(np.zeros(0, np.uint16), np.zeros(0, np.float32), rng.integers(0, 50, lm_scoring.CLASSES))
    model = lm_scoring.Model(v, [x + rng.normal(0, 0.1, x.shape).astype(np.float32) for x in lm_scoring.start_weights(v)])
    ends = np.array([0, 3])
    total = sum(np.exp(model.log_probs(np.array([5, y, 700], np.uint16), ends)[1]) for y in range(lm_scoring.CLASSES))
    assert abs(total - 1) < 1e-4
    model = lm_scoring.Model(v, lm_scoring.start_weights(v))
    share = np.exp(model.log_probs(np.array([5, 8, 700], np.uint16), ends)[1])
    assert abs(share / ((v.counts[8] + 1e-3) / (v.counts + 1e-3).sum()) - 1) < 0.5


def test_gradients_equal_differences():
    rng = np.random.default_rng(3)
    v = lm_scoring.Vocabulary(np.zeros(0, np.uint16), np.zeros(0, np.float32), rng.integers(0, 50, lm_scoring.CLASSES))
    w = [x.astype(np.float64) for x in lm_scoring.start_weights(v)]
    ctx, y = rng.integers(0, lm_scoring.CLASSES, (6, 4)).astype(np.uint16), rng.integers(0, lm_scoring.CLASSES, 6)

    def loss(w):
        _, _, p, place = lm_scoring._forward(w, ctx, y)
        return -np.log(p.ravel()[place]).sum(axis=1).mean()

    net = lm_scoring.Adagrad(w)
    for k, (rows, g) in enumerate(net.gradients(ctx, y)):
        full = np.zeros(lm_scoring._SHAPES[k])
        full[rows] = g
        spot = np.unravel_index(np.abs(full).argmax(), full.shape)
        up = [x.copy() for x in w]
        up[k][spot] += 1e-5
        assert abs((loss(up) - loss(w)) / 1e-5 - full[spot]) < 1e-4


def test_shares_of_a_class_sum_to_one():
    v = lm_scoring.Vocabulary.of(np.random.default_rng(1).integers(0, 50, 1 << lm_scoring.BUCKET_BITS))
    assert np.allclose(np.bincount(v.of_bucket, np.exp(v.share.astype(float))), 1, atol=1e-4)


def test_training_learns(spark, docs):
    rng = np.random.default_rng(2)
    cycle = [" ".join(f"t{(i + j) % 7}" for j in range(600)) for i in range(120)]
    tokens = lm_scoring.tokenize(docs(*enumerate(cycle)).coalesce(1), ["doc_id"])
    model = lm_scoring.train(tokens)
    first = lm_scoring.Model(model.vocabulary, lm_scoring.start_weights(model.vocabulary))

    def mean(m, texts):
        h, _, _, ends = common.token_runs(*common.utf8(pa.array(texts)), lm_scoring._KIND)
        return m.log_probs(m.vocabulary.of_bucket[lm_scoring._bucket(h >> np.uint64(16))], ends).mean()

    assert mean(model, cycle) > mean(first, cycle) + 0.5
    assert mean(model, cycle) > mean(model, [" ".join(rng.permutation(t.split())) for t in cycle])


def test_documents_that_occur_twice_score_apart(spark, docs):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{k}" for k in rng.zipf(1.3, 200) % 500) for _ in range(60)]
    got = {r["doc_id"]: r["mean_log_prob"] for r in lm_scoring.score(docs(*enumerate(texts), (100, texts[7]), (101, texts[31]))).collect()}
    twice = [got[i] for i in (7, 31, 100, 101)]
    assert min(twice) > max(v for i, v in got.items() if i not in (7, 31, 100, 101)) + 0.5


def test_quality_word_by_word(spark, docs):
    """Contexts, pooled features and scores, one token after the other."""
    texts = ["one two two -- three", "a b c d e f g", "Größe, größer; 12.5 %%%", "", None, "x", " \t\n", "two " * 50, "one two\n\nthree one two three ..."]
    rng = random.Random(4)
    texts += [" ".join(rng.choice(["one", "two", "three", "é", "--", "a", "b"]) for _ in range(rng.randint(2, 40))) for _ in range(20)]
    token = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\t-\r ]+")
    bucket = lambda w: int(quality.buckets(np.frombuffer(w, np.uint8), np.array([0, len(w)]))[0][0])
    seqs = [[bucket(w) for w in token.findall((t or "").encode())] for t in texts]
    context = np.zeros((quality.BUCKETS, quality.DIMS), np.int64)
    for seq in seqs:
        for i, w in enumerate(seq):
            for j in range(max(0, i - quality.BESIDE), min(len(seq), i + quality.BESIDE + 1)):
                for z in range(quality.NONZERO * (i != j)):
                    context[w, quality._PLACE[z][seq[j]]] += quality._SIGN[z][seq[j]]
    df = docs(*enumerate(texts)).repartition(3)
    assert (quality.context_vectors(df) == context).all()
    unit = {w: context[w] / n for w in {x for s in seqs for x in s} if (n := math.sqrt(sum(int(v) ** 2 for v in context[w])))}
    mean = sum(unit.values()) / len(unit)
    unit = {w: (v - mean) / np.linalg.norm(v - mean) for w, v in unit.items()}
    zero = np.zeros(quality.DIMS)
    want = []
    for seq in seqs:
        v = [unit.get(w, zero) for w in seq]
        n = len(v) + quality.SHRINK
        both = [a * b for a, b in zip(v[:-1], v[1:], strict=True)] if v else []
        want.append(np.concatenate([sum(v, zero) / n, sum(both, zero) / n, [math.log(len(v))]]) if v else np.zeros(quality.FEATURES))
    vectors = quality.word_vectors(context)
    got = quality.pool(pa.array(texts, pa.string()), vectors)
    np.testing.assert_allclose(got, np.array(want), atol=1e-5)
    rng = np.random.default_rng(2)
    model = quality.Model(
        vectors, rng.normal(size=quality.FEATURES), rng.uniform(0.5, 2, quality.FEATURES), rng.normal(size=(quality.FEATURES, 16)), rng.normal(size=16), rng.normal(size=16), 0.3, 1.7
    )
    scores = {}
    for i, x in enumerate(want):
        hidden = [math.tanh(sum((x[d] - model.mean[d]) / model.scale[d] * model.w1[d, h] for d in range(len(x))) + model.b1[h]) for h in range(16)]
        logit = sum(a * b for a, b in zip(hidden, model.w2, strict=True)) + model.b2
        scores[i] = 1 / (1 + math.exp(-logit / model.temperature))
    for r in quality.score(df, model).collect():
        assert abs(r["score"] - scores[r["doc_id"]]) < 1e-3 and r["predicted"] == (r["score"] >= quality.ACCEPT)
