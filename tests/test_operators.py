import pytest
from pyspark.sql import functions as F

from corpusmill.functions import models
from corpusmill.operators import dedup, evaluation, incremental
from corpusmill.plans import steps
from corpusmill.plans.config import Config
from corpusmill.sources import generator, readers, sinks
from corpusmill.streaming import streams


def texts(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, text string")


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_threshold_is_strict(spark):
    # abcdef has 4 trigrams, abcdefg has 5 with 4 shared: exactly 0.8.
    df = texts(spark, ("1", "abcdef"), ("2", "abcdefg"), ("3", "ABCDEF"), ("4", "ab"), ("5", "ab"))
    assert dedup.near_pairs(df, "id", "text").count() == 0
    assert ids(dedup.near_survivors(df, "id", "text")) == ["1", "2", "4", "5"]
    assert ids(dedup.near_survivors(df, "id", "text", drop_short=True)) == ["1", "2"]


def test_all_short_texts_stay(spark):
    assert ids(dedup.near_survivors(texts(spark, ("1", "a"), ("2", "")), "id", "text", drop_short=True)) == ["1", "2"]


def test_a_dropped_row_drops_others_too(spark):
    base = "abcdefghijklmnopqrstuvwxyz"
    df = texts(spark, ("1", base), ("2", base + "01"), ("3", base + "0123"))
    pairs = {(r["id_a"], r["id_b"]) for r in dedup.near_pairs(df, "id", "text").collect()}
    assert ("1", "2") in pairs and ("2", "3") in pairs
    assert ids(dedup.near_survivors(df, "id", "text")) == ["1"]


def test_against_existing_hashes_old_tables(spark):
    df = texts(spark, ("1", "a"), ("2", "b"), ("3", "b"))
    assert ids(dedup.against_existing(df, texts(spark, ("9", "a")), "text", "id")) == ["2"]
    assert ids(dedup.against_existing(df, None, "text", "id")) == ["1", "2"]


def test_append_twice_is_append_once(spark, tmp_path):
    df = texts(spark, ("1", "a"), ("1", "b"), ("2", "c"))
    path = str(tmp_path / "t")
    assert incremental.append_idempotent(df, path, ["id"]) == 2
    assert incremental.append_idempotent(df, path, ["id"]) == 0
    assert spark.read.parquet(path).count() == 2


def test_null_keys_equal_nothing(spark, tmp_path):
    df = spark.createDataFrame([(None, "a"), ("1", "b")], "id string, text string")
    path = str(tmp_path / "t")
    assert incremental.append_idempotent(df, path, ["id"]) == 2
    assert incremental.append_idempotent(df, path, ["id"]) == 1


def test_late_rows_by_mode(spark):
    df = spark.createDataFrame([("1", "2026-01-01"), ("2", "2026-01-03")], "id string, timestamp string")
    target = spark.createDataFrame([("2026-01-02",)], "timestamp string")
    assert ids(incremental.since(df, "timestamp", target)) == ["2"]
    assert ids(incremental.since(df, "timestamp", target.limit(0))) == ["1", "2"]
    assert ids(incremental.since(df, "timestamp", None)) == ["1", "2"]


def test_sample(spark):
    df = spark.range(50).select(F.col("id").cast("string"))
    a, b = (ids(incremental.seeded_sample(df, "id", 10, 7)) for _ in range(2))
    assert a == b and len(a) == 10
    assert len(ids(incremental.seeded_sample(df, "id", 99, 7))) == 50


@pytest.mark.parametrize(
    "text, want",
    [
        ('a {"task_completion": 9, "hallucination": 0} b', (5, 1, 4.5)),
        ('{"task_completion": 3, "hallucination": 4, "overall": 9}', (3, 4, 5.0)),
        ("no braces", (1, 1, 1.0)),
        (None, (1, 1, 1.0)),
        ('{"task_completion": "x"}', (1, 1, 1.0)),
        ("{}", (1, 1, 1.0)),
    ],
)
def test_judge(spark, text, want):
    r = spark.createDataFrame([(text,)], "t string").select(evaluation.parse_judge(F.col("t")).alias("j")).first()["j"]
    assert (r["task_completion"], r["hallucination"], r["overall"]) == want


def test_report_counts_beyond_the_list(spark):
    df = spark.createDataFrame([(str(i), 1, 1, 1.0 + i / 10) for i in range(15)], "doc_id string, task_completion int, hallucination int, overall double")
    r = evaluation.report(df).first()
    assert (r["below_threshold_count"], r["listed_count"], r["pass"]) == (15, 10, False)
    assert [x["doc_id"] for x in evaluation.worst(df).collect()] == [str(i) for i in range(10)]
    assert evaluation.report(df.limit(0)).first()["overall_avg"] == 0.0


def test_p99_needs_ten_values(spark):
    rows = [("a", float(i)) for i in range(9)] + [("b", float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, v double").withColumn("e", F.lit(None).cast("string"))
    got = {r["k"]: (r["p50"], r["p99"]) for r in evaluation.latency_summary(df, "v", "e", 1.0, "k").collect()}
    assert got == {"a": (4.0, None), "b": (99.5, float(int(200 * 0.99) - 1))}


def test_strict_reader_raises(spark, tmp_path):
    good = '{"id": 1, "text": "a", "timestamp": "t", "more": 2}'
    (tmp_path / "ok").write_text(f"{good}\n\n")
    assert readers.read_strict(spark, str(tmp_path / "ok")).collect()[0]["id"] == "1"
    (tmp_path / "bad").write_text(f'{good}\n{{"id": 1}}\n')
    with pytest.raises(Exception, match="not a JSON object"):
        readers.read_strict(spark, str(tmp_path / "bad")).collect()
    assert readers.read_bronze(spark, str(tmp_path / "bad")).count() == 1
    assert tuple(readers.rejects(spark.read.text(str(tmp_path / "bad"))).first()) == (2, 1)


def test_prompt_falls_through_when_empty(spark, tmp_path):
    (tmp_path / "p").write_text('{"prompt": "", "text": "t"}\n{"prompt": "p", "text": "t"}\nbad\n')
    assert sorted(r["prompt"] for r in readers.read_prompts(spark, str(tmp_path / "p")).collect()) == ["", "p", "t"]


def test_read_first_and_csv(spark, tmp_path):
    sinks.overwrite(texts(spark, ("1", "a")), str(tmp_path / "raw"))
    assert ids(readers.read_first(spark, str(tmp_path / "processed"), str(tmp_path / "raw"))) == ["1"]
    sinks.export_csv(texts(spark, ("1", None), ("2", 'q"x\ny')), str(tmp_path / "csv"))
    assert {r["id"]: r["text"] for r in readers.read_csv(spark, str(tmp_path / "csv")).collect()} == {"1": "", "2": 'q"x\ny'}


def test_models(spark):
    class Broken:
        def __call__(self, texts):
            raise RuntimeError("no")

    class Small:
        def __call__(self, texts):
            if len(texts) > 16:
                raise MemoryError
            return models.HashEmbedder(4)(texts)

    df = texts(spark, *((str(i), f"text {i}") for i in range(40))).coalesce(1)
    assert {r["a"] for r in models.answer(df, "text", "a", Broken, failed="f").collect()} == {"f"}
    assert all(len(r["v"]) == 4 for r in models.embed(df, "text", "v", Small).collect())


def test_stream_equals_batch(spark, tmp_path):
    rows = generator.reviews(spark, 60)
    rows.select(F.to_json(F.struct("*")).alias("value")).write.text(str(tmp_path / "in"))
    for _ in range(2):
        q = streams.bronze(readers.file_stream(spark, str(tmp_path / "in")), str(tmp_path / "bronze"), str(tmp_path / "ck"), None)
        q.awaitTermination()
    assert sorted(map(tuple, readers.read_bronze(spark, str(tmp_path / "bronze")).collect())) == sorted(map(tuple, rows.collect()))


def test_each_batch_is_idempotent(spark, tmp_path):
    rows = generator.reviews(spark, 20)
    for name in ("a", "b"):
        rows.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.text(str(tmp_path / "in" / name))
    lines = readers.file_stream(spark, str(tmp_path / "in" / "*"))
    parsed = readers.parse_lines_keeping(lines, readers.REVIEW)
    write = lambda df: incremental.append_idempotent(df, str(tmp_path / "out"), ["id"])
    streams.each_batch(parsed, write, str(tmp_path / "ck"), None).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20


def test_supervise_restarts(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x").write_text("line\n")
    tries = []

    def start(s):
        tries.append(1)

        def write(df):
            df.count()
            if len(tries) < 3:
                raise ValueError("broken")

        return streams.each_batch(readers.file_stream(s, str(tmp_path / "in")), write, str(tmp_path / "ck"), None)

    assert streams.supervise(start, lambda: spark, backoff=0.0) == 3


def test_windows_and_stream_dedup(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.unionByName(events).coalesce(1).write.parquet(str(tmp_path / "ev"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "ev"))
    once = streams.distinct_within(stream, ["event_id"], "ts", "1 hour")
    q = once.writeStream.format("memory").queryName("once").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("once").count() == events.count()
    q = streams.tumbling_counts(stream, "ts", "1 day", "1 hour", "event_type").writeStream.outputMode("complete")
    q.format("memory").queryName("days").trigger(availableNow=True).start().awaitTermination()
    assert spark.table("days").agg(F.sum("n")).first()[0] == 2 * events.count()


@pytest.mark.parametrize("mode", ["minhash", "silver_anti_join"])
def test_pipeline_runs_and_reruns(spark, tmp_path, mode):
    generator.reviews(spark, 80).select(F.to_json(F.struct("*")).alias("value")).write.text(str(tmp_path / "bronze"))
    config = Config(
        **{k: str(tmp_path / k) for k in ("bronze", "silver", "labeled", "embeddings")}, dedup_mode=mode, sample_size=20
    )
    first = steps.run_all(spark, config)
    assert [first[f"STEP{i}"] for i in (1, 2, 3)] == ["DONE"] * 3
    assert first["report"]["sample_count"] == min(20, spark.read.parquet(config.labeled).count())
    again = steps.run_all(spark, config)
    assert [again[f"STEP{i}"] for i in (1, 2, 3)] == ["SKIPPED_NO_NEW_DATA"] * 3


def test_config():
    c = Config.of({"CORPUSMILL_CHUNK_MAX_CHARS": "9", "CORPUSMILL_SILVER": "s3"})
    assert (c.chunk_max_chars, c.silver, c.seed) == (9, "s3", 42)
    with pytest.raises(ValueError):
        Config.of({"CORPUSMILL_SEED": "x"})


def test_generator_is_seeded(spark):
    a, b = (generator.reviews(spark, 30, seed=3).collect() for _ in range(2))
    assert a == b and len({r["text"] for r in a}) > 5


def test_values_are_bound_once(spark, sf_dir):
    """A bound value's expression stands once in the plan, however often it is used."""
    from corpusmill import queries

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    assert plan(queries.chunk_documents(spark, sf_dir)).count("split(") == 1
    assert plan(queries.chunk_documents(spark, sf_dir)).count("aggregate(") == 1
    assert plan(queries.sentiment_rule(spark, sf_dir)).count("regexp_replace(") == 1
    assert plan(queries.label_normalize(spark, sf_dir)).count("from_json(") <= 2


def test_mean_pool_uses_attended_tokens(spark):
    from corpusmill.functions.text import mean_pool

    rows = [([[1.0, 2.0], [3.0, 4.0], [90.0, 90.0]], [1, 1, 0]), ([[5.0, 5.0]], [0])]
    df = spark.createDataFrame(rows, "states array<array<double>>, attention array<int>")
    got = [r[0] for r in df.select(mean_pool(F.col("states"), F.col("attention"))).collect()]
    assert got == [[2.0, 3.0], [0.0, 0.0]]


def test_models_wait_and_answer_each_prompt(spark):
    from corpusmill.functions.models import answer

    class Short:
        def __call__(self, texts):
            return ["x"] * (len(texts) - 1)

    df = spark.createDataFrame([("a",), ("b",)], "p string").coalesce(1)
    assert {r["o"] for r in answer(df, "p", "o", Short, failed="no", tries=2, wait=0.01).collect()} == {"no"}


def test_read_first_raises_on_a_broken_table(spark, tmp_path):
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "x.parquet").write_text("no parquet")
    sinks.overwrite(texts(spark, ("1", "a")), str(tmp_path / "raw"))
    with pytest.raises(Exception):  # noqa: B017
        readers.read_first(spark, str(tmp_path / "broken"), str(tmp_path / "raw")).collect()


def test_read_table_leaves_the_session_as_it_is(spark, tmp_path):
    name = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(name)
    spark.createDataFrame([("1", "2026-03-01")], "id string, day string").write.partitionBy("day").parquet(str(tmp_path / "t"))
    assert readers.read_table(spark, str(tmp_path / "t")).dtypes == [("id", "string"), ("day", "string")]
    assert spark.conf.get(name) == before


def test_labels_reach_table_and_topic(spark, tmp_path):
    rows = generator.reviews(spark, 20)
    rows.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.text(str(tmp_path / "in"))
    sent = []
    write = sinks.labels_to_both(str(tmp_path / "out"), lambda df: sent.extend(r["id"] for r in df.collect()))
    for ck in ("a", "b"):  # the second run replays everything
        parsed = readers.parse_lines_keeping(readers.file_stream(spark, str(tmp_path / "in")), readers.REVIEW)
        streams.each_batch(parsed, write, str(tmp_path / ck), None).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20
    assert len(sent) == 40 and len(set(sent)) == 20


def test_documents_stream_to_parquet(spark, tmp_path):
    (tmp_path / "in").mkdir()
    doc = '{"doc_id": "d1", "title": "t", "content": "c", "source": "s", "timestamp": "2026-01-01"}'
    (tmp_path / "in" / "x").write_text(doc + "\nbad\n")
    docs = readers.parse_lines_keeping(readers.file_stream(spark, str(tmp_path / "in")))
    streams.parquet(docs, str(tmp_path / "out"), str(tmp_path / "ck"), None).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.columns == list(readers.DOCUMENT)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("d1", "t", "c", "s", "2026-01-01"), (None,) * 5], key=str)


@pytest.mark.parametrize("passed", [True, False])
def test_printed_report(capsys, passed):
    assert sinks.print_report({"pass": passed, "mean": 3.5}) is passed
    assert ("gate passed" if passed else "gate failed") in capsys.readouterr().out


@pytest.mark.parametrize("step", ["label", "evaluate"])
def test_a_cycle_that_dies_between_steps_is_resumed(spark, tmp_path, monkeypatch, step):
    paths = {k: str(tmp_path / k) for k in ("bronze", "silver", "labeled", "embeddings")}
    config = Config(**paths, checkpoints=str(tmp_path / "ck"), dedup_mode="silver_anti_join", sample_size=5)
    generator.reviews(spark, 30).select(F.to_json(F.struct("*")).alias("value")).write.text(config.bronze)
    cycles = []
    with monkeypatch.context() as broken:
        broken.setattr(steps, step, lambda *a, **b: 1 / 0)
        with pytest.raises(Exception, match="ZeroDivisionError"):
            steps.start(spark, config, cycles.append, None).awaitTermination()
    assert cycles == []
    silver = spark.read.parquet(config.silver).count()
    steps.start(spark, config, cycles.append, None).awaitTermination()
    assert len(cycles) == 1 and cycles[0]["report"]["sample_count"] == 5
    assert [spark.read.parquet(p).count() for p in (config.silver, config.labeled)] == [silver, silver]
    chunks = spark.read.parquet(config.embeddings)
    assert chunks.count() == chunks.select("chunk_id").distinct().count() >= silver > 0


def test_follow_catches_up_and_csv_stands_in(spark, tmp_path):
    paths = {k: str(tmp_path / k) for k in ("bronze", "silver", "labeled", "embeddings", "labeled_csv")}
    config = Config(**paths, checkpoints=str(tmp_path / "ck"), dedup_mode="silver_anti_join", sample_size=20)
    left = [60, 5]

    def arriving():
        if not left:
            return False
        part = generator.reviews(spark, n := left.pop(0), seed=n).withColumn("id", F.concat("id", F.lit(f"-{n}")))
        part.select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(config.bronze)
        return True

    cycles = steps.follow(spark, config, arriving, wait=0.0)
    assert {c["STEP1"] for c in cycles} == {"DONE"}
    kept = spark.read.parquet(config.silver).select("id").distinct().count()
    again = steps.start(spark, config, cycles.append, None)
    again.awaitTermination()
    assert again.lastProgress is None or again.lastProgress["numInputRows"] == 0  # bronze isn't read again
    assert spark.read.parquet(config.silver).select("id").distinct().count() == kept
    exported = readers.read_csv(spark, config.labeled_csv).count()
    report = steps.evaluate(spark, Config(**paths | {"labeled": str(tmp_path / "none")}, sample_size=20))
    assert report["sample_count"] == min(20, exported) > 0
