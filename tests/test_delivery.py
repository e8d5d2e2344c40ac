import json
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from corpusmill.functions import models, text
from corpusmill.sources import delivery, generator, paced, readers
from corpusmill.streaming import streams

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers don't see this module


class Stub:
    """Fails twice for keys that end in 2, always for those in 3, with a full queue for those in 4 once; logs to a folder."""

    def __init__(self, folder):
        self.folder, self.seen = folder, {}

    def send(self, key, value):
        self.seen[key] = self.seen.get(key, 0) + 1
        if key.endswith("2") and self.seen[key] < 3 or key.endswith("3"):
            raise RuntimeError("no broker")
        if key.endswith("4") and self.seen[key] < 2:
            raise BufferError("full")
        with open(f"{self.folder}/sent", "a") as f:
            f.write(json.dumps([key, value]) + "\n")

    def poll(self, seconds):
        pass

    def flush(self, seconds):
        with open(f"{self.folder}/flushed", "a") as f:
            f.write("x")


def test_rows_are_sent_retried_and_dropped(spark, tmp_path):
    folder = str(tmp_path)
    df = spark.range(40).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("text "), "id").alias("text"), F.lit(1).alias("a.b")).repartition(3)
    policy = delivery.Policy(tries=3, backoff=0.0, drain=0.0)
    assert delivery.deliver(df, "id", lambda: Stub(folder), policy) == {"sent": 36, "dropped": 4}
    sent = [json.loads(x) for x in (tmp_path / "sent").read_text().splitlines()]
    assert sorted(int(k) for k, _ in sent) == [i for i in range(40) if i % 10 != 3]
    assert all(json.loads(v) == {"id": k, "text": f"text {k}", "a.b": 1} for k, v in sent)
    assert (tmp_path / "flushed").read_text() == "xxx"
    assert delivery.deliver(df.limit(0), "id", lambda: Stub(folder), policy) == {"sent": 0, "dropped": 0}


def test_pauses_grow_and_a_full_queue_is_drained():
    class Full(Stub):
        def __init__(self):
            self.polled = []

        def send(self, key, value):
            raise BufferError

        def poll(self, seconds):
            self.polled.append(seconds)

    full, slept = Full(), []
    assert not delivery.delivered(full, "k", "v", delivery.Policy(3, 2.0), slept.append)
    assert slept == [2.0, 4.0, 6.0] and full.polled == [0.5] * 3


def test_counts_are_those_of_the_attempts_that_count(tmp_path):
    """A task that ran twice has two messages, of which Spark hands one to the commit; a task without one counts nothing."""
    writer = delivery._Writer(lambda: Stub(str(tmp_path)), delivery.Policy(1, 0.0), str(tmp_path / "report"))
    rows = [{"key": k, "value": ""} for k in ("1", "3", "5")]
    _lost, kept = (writer.write(iter(rows)) for _ in range(2))
    writer.commit([kept, None, delivery.Delivered(10, 0)])
    assert json.loads((tmp_path / "report" / "totals.json").read_text()) == {"sent": 12, "dropped": 1}


@pytest.fixture
def clock():
    now = [1000.0]

    def read():
        return now[0]

    read.now = now
    return read


def reader(folder, clock, rate, burst=10.0, part=64 << 20):
    return paced.PacedReader(str(folder), rate, burst, part, clock)


def lines_of(r, start, end):
    return [x[0] for p in r.partitions(start, end) for x in r.read(p)]


@pytest.mark.parametrize("part", [1, 7, 64 << 20])
def test_pace_by_a_fake_clock(tmp_path, clock, part):
    want = [f"line {i} {'é' * (i % 5)}" for i in range(30)] + [""]
    (tmp_path / "a").write_text("\n".join(want[:12]) + "\n")
    (tmp_path / "b").write_text("\n".join(want[12:20]))
    (tmp_path / "c").write_text("\n".join(want[20:]) + "\n")
    (tmp_path / "_hidden").write_text("no\n")
    r, got = reader(tmp_path, clock, 2, part=part), []
    start = r.initialOffset()
    assert r.latestOffset() == start
    for seconds, total in ((0.25, 0), (0.25, 1), (0.5, 2), (1.5, 5), (0.0, 5), (100, 25), (2.5, 30), (0.5, 31), (5, 31)):
        clock.now[0] += seconds
        end = r.latestOffset()
        got += lines_of(r, start, end)
        assert len(got) == total and got == want[:total]
        start = end
    (tmp_path / "d").write_text("more\n" * 40)
    clock.now[0] += 2
    end = r.latestOffset()
    assert len(lines_of(r, start, end)) <= 14  # of the seconds since the last line came out


def test_pace_goes_on_from_its_offsets(tmp_path, clock):
    (tmp_path / "a").write_text("".join(f"{i}\n" for i in range(100)))
    r = reader(tmp_path, clock, 10)
    start = r.initialOffset()
    r.latestOffset()
    clock.now[0] += 1
    middle = r.latestOffset()
    again = reader(tmp_path, clock, 10)
    assert again.partitions(middle, middle) == []
    clock.now[0] += 0.5
    end = again.latestOffset()
    assert lines_of(r, start, middle) + lines_of(again, middle, end) == [str(i) for i in range(15)]


def test_paced_stream_resumes(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_text("".join(f"{i}\n" for i in range(60)))
    counts = []

    def run():
        """Until there are new lines, and a batch is under way."""
        rows = paced.paced_stream(spark, f"file://{tmp_path}/in", 5)
        q = streams.bronze(rows, str(tmp_path / "out"), str(tmp_path / "ck"), "1 second")
        end = time.time() + 60
        while time.time() < end and q.isActive and not any(p["numInputRows"] for p in q.recentProgress):
            time.sleep(0.2)
        q.stop()
        counts.append(spark.read.text(str(tmp_path / "out")).count())

    began = time.time()
    while not counts or counts[-1] < 60 and len(counts) < 20:
        run()
        assert 0 < counts[-1] <= 5 * (time.time() - began)
    got = [int(r[0]) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(got) == list(range(60)) and len(counts) > 1


def test_an_error_names_file_and_line(spark, tmp_path):
    good = '{"id": 1, "text": "é", "timestamp": "t"}'
    (tmp_path / "in").mkdir()
    for name, n in (("a", 40), ("b", 300), ("c", 3)):
        (tmp_path / "in" / name).write_text(f"{good}\n\n" * n)
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    try:
        for size in ("700b", "128m"):
            spark.conf.set(name, size)
            rows = readers.numbered_lines(spark, str(tmp_path / "in"))
            found = sorted((r["file"][-1], r["line"]) for r in rows.collect())
            assert found == [(f, i) for f, n in (("a", 40), ("b", 300), ("c", 3)) for i in range(1, 2 * n + 1)]
            assert rows.rdd.getNumPartitions() > 10 or size == "128m"
            (tmp_path / "in" / "b2").write_text(f"{good}\n" * 50 + f'\n{{"id": 5}}\n{good}\n')
            with pytest.raises(Exception, match=r"lacks text, timestamp at line 52 of file:.*/b2: \{"):
                readers.read_strict(spark, str(tmp_path / "in")).collect()
            (tmp_path / "in" / "b2").write_text(f"{good}\n")
            assert readers.read_strict(spark, str(tmp_path / "in")).count() == 344
            (tmp_path / "in" / "b2").unlink()
    finally:
        spark.conf.set(name, before)


class Slow:
    """Answers late, the later prompts first; 'bad' always fails, 'odd' at the first try."""

    def __init__(self, folder):
        self.folder, self.tries = folder, {}

    def __call__(self, texts):
        (t,) = texts
        with open(f"{self.folder}/log", "a") as f:
            f.write(f"{time.time()} begin\n")
        time.sleep(0.3)
        with open(f"{self.folder}/log", "a") as f:
            f.write(f"{time.time()} end\n")
        self.tries[t] = self.tries.get(t, 0) + 1
        if t == "bad" or t == "odd" and self.tries[t] == 1:
            raise RuntimeError(t)
        return [t.upper()]


def test_calls_at_once_keep_order_and_fail_alone(spark, tmp_path):
    folder = str(tmp_path)
    prompts = [*(f"p{i}" for i in range(14)), "bad", "odd"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(prompts)], "id int, p string").coalesce(1)
    got = models.answer(df, "p", "a", lambda: Slow(folder), 16, "failed", 2, 0.01, at_once=8).collect()
    assert [(r["id"], r["a"]) for r in got] == [(i, "failed" if p == "bad" else p.upper()) for i, p in enumerate(prompts)]
    now = most = 0
    for line in sorted((tmp_path / "log").read_text().splitlines(), key=lambda x: (float(x.split()[0]), x)):
        now += 1 if line.endswith("begin") else -1
        most = max(most, now)
    assert 5 <= most <= 8


class Sizes:
    """The length of each prompt, and the batch's size in the place of the answer."""

    def __init__(self, folder):
        self.folder = folder

    def __call__(self, texts):
        with open(f"{self.folder}/sizes", "a") as f:
            f.write(f"{len(texts)} {min(map(len, texts))} {max(map(len, texts))}\n")
        return [str(len(t)) for t in texts]


def test_batches_go_on_across_frames(spark, tmp_path):
    folder, name = str(tmp_path), "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, 10)
        df = spark.range(0, 530, 1, 1).select("id", F.expr("if(id % 50 = 0, null, repeat('x', cast(id * 7 % 97 as int)))").alias("p"))
        got = models.answer(df, "p", "a", lambda: Sizes(folder), 32).collect()
    finally:
        spark.conf.set(name, before)
    assert [(r["id"], r["a"]) for r in got] == [(i, "0" if i % 50 == 0 else str(i * 7 % 97)) for i in range(530)]
    sizes = [tuple(map(int, x.split())) for x in (tmp_path / "sizes").read_text().splitlines()]
    assert [n for n, _, _ in sizes] == [32] * 16 + [18]
    assert max(high - low for _, low, high in sizes[:16]) < 20  # like lengths together


def test_memory_errors_are_told_by_a_predicate(spark):
    class Device:
        def __call__(self, texts):
            if len(texts) > 16:
                raise RuntimeError("CUDA out of memory")
            if "x" in texts:
                raise RuntimeError("other")
            return models.HashEmbedder(4)(texts)

    df = spark.range(40).select(F.col("id").cast("string").alias("t")).coalesce(1)
    assert [len(r["v"]) for r in models.embed(df, "t", "v", Device).collect()] == [4] * 40
    with pytest.raises(Exception, match="other"):
        models.embed(df.limit(3).withColumn("t", F.lit("x")), "t", "v", Device).collect()
    with pytest.raises(Exception, match="CUDA"):
        models.embed(df, "t", "v", Device, out_of_memory=lambda e: isinstance(e, MemoryError)).collect()


def test_pooling_of_no_tokens(spark):
    df = spark.createDataFrame([([], []), ([[1.0, 3.0]], [1])], "s array<array<double>>, a array<int>")
    assert [r[0] for r in df.select(text.mean_pool(F.col("s"), F.col("a"))).collect()] == [[], [1.0, 3.0]]


def test_generator_has_ten_templates_and_eleven_slots(spark):
    assert {k: len(v) for k, v in generator.TEMPLATES.items()} == {"positive": 10, "negative": 10, "neutral": 10}
    assert len(generator.SLOTS) == 11
    used = "".join(t for v in generator.TEMPLATES.values() for t in v)
    assert all(f"{{{s}}}" in used for s in generator.SLOTS)
    texts = [r["text"] for r in generator.reviews(spark, 500).collect()]
    assert not any("{" in t for t in texts) and len(set(texts)) > 300
    df = spark.createDataFrame([(t,) for t in ("不好", "很差", "推荐", "", None, "卡顿")], "text string")
    assert {r["kind"]: r["n"] for r in generator.class_counts(df).collect()} == {"positive": 2, "negative": 2, "neutral": 2}
    assert {r["n"] for r in generator.class_counts(df.limit(0)).collect()} == {0}


def test_latest_and_late_rows_add_up_after_a_restart(spark, tmp_path):
    for k, v in streams.STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        (tmp_path / "in").mkdir()
        parts = [
            [("a", "2026-01-01 00:00:00", 1), ("a", "2026-01-01 00:05:00", 2), ("b", "2026-01-01 00:01:00", 3)],
            [("c", "2026-01-01 02:00:00", 4), ("a", "2026-01-01 00:04:00", 5)],
            [("a", "2026-01-01 00:06:00", 6), ("b", "2026-01-01 00:00:30", 7), ("c", "2026-01-01 02:10:00", 8)],
            [("d", "2026-01-02 00:00:00", 9)],
            [("e", "2026-01-03 00:00:00", 10)],
        ]
        for i, part in enumerate(parts):
            df = spark.createDataFrame(part, "k string, ts string, n int").withColumn("ts", F.col("ts").cast("timestamp"))
            df.coalesce(1).write.parquet(str(tmp_path / "in" / f"part={i}"))
            source = spark.readStream.schema("k string, ts timestamp, n int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
            rows = streams.latest_and_late(source, ["k"], "ts", "10 minutes")
            write = streams.split_late(str(tmp_path / "latest"), str(tmp_path / "late"))
            q = rows.writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "ck"))
            q.trigger(availableNow=True).start().awaitTermination()  # a restart for each part
        latest = sorted((r["k"], r["n"]) for r in spark.read.parquet(str(tmp_path / "latest")).collect())
        late = sorted((r["k"], r["n"]) for r in spark.read.parquet(str(tmp_path / "late")).collect())
        assert late == [("a", 6), ("b", 7)]
        assert latest == [("a", 2), ("b", 3), ("c", 8), ("d", 9)]
    finally:
        for k in streams.STATE_STORE:
            spark.conf.unset(k)
