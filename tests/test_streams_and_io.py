"""Streams over several micro-batches, sinks and readers."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyfold import schemas
from tallyfold.operators.contracts import ContractError
from tallyfold.operators.extraction import failure_breaker
from tallyfold.sources import readers, writers
from tallyfold.streaming import monitor


def feed(spark, tmp_path, batches, schema):
    src = tmp_path / "in"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(src / f"b{i:02d}"))
    for i, d in enumerate(sorted(src.iterdir())):  # file order is by modification time
        for f in d.glob("*.parquet"):
            import os

            os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*.parquet").parquet(str(src))


def at(seconds):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


def drain(df, path):
    q = df.writeStream.format("parquet").option("checkpointLocation", f"{path}/ck").trigger(availableNow=True).start(f"{path}/out")
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/out").collect()


def test_breaker_counts_attempts_in_their_order_over_batches(spark, tmp_path):
    schema = "run string, attempt long, rejected boolean, ts timestamp"
    rng = random.Random(3)
    rows = [("a", i, i % 3 == 0, at(i)) for i in range(40)] + [("b", i, i == 5, at(i)) for i in range(40)] + [("c", i, i > 20, at(i)) for i in range(40)]
    rows += [("d", i, i in (0, 1, 3), at(10)) for i in range(12)]  # one time: the attempt decides
    batches = [[] for _ in range(7)]
    for r in rows:
        batches[min(6, max(0, r[1] // 7 + rng.choice([-1, 0, 0, 1])))].append(r)
    batches[3].append(rows[0])  # an attempt that comes twice
    assert any(batches[k][i][1] > batches[k][i + 1][1] for k in range(6) for i in range(len(batches[k]) - 1))
    batches.append([("z", 1000, False, at(1000))])
    out = drain(monitor.breaker(feed(spark, tmp_path, batches, schema), ["run"], "ts", "attempt", lateness="30 seconds"), tmp_path / "o")
    whole = failure_breaker(spark.createDataFrame(rows, schema), ["run"], "attempt", "rejected").collect()
    assert sorted(tuple(r) for r in out) == sorted((r.run, r.stopped_at, r.attempted, r.rejected) for r in whole)
    assert {r.run for r in out} == {"a", "c", "d"}


def test_breaker_trips_once_and_keeps_its_state(spark, tmp_path):
    schema = "run string, attempt long, rejected boolean, ts timestamp"
    batches = [[("a", 100 * k + i, True, at(1000 * k + i)) for i in range(6)] for k in range(6)] + [[("z", 1, False, at(90_000))]]
    out = drain(monitor.breaker(feed(spark, tmp_path, batches, schema), ["run"], "ts", "attempt", lateness="10 seconds"), tmp_path / "o")
    assert [tuple(r) for r in out] == [("a", 103, 10, 10)]  # six attempts of the first batch, four of the second


def test_stale_heartbeat_and_late_rows(spark, tmp_path):
    schema = "job string, ts timestamp"
    batches = [[("a", at(0)), ("a", at(100)), ("b", at(0))], [("a", at(300)), ("c", at(400))], [("z", at(2000))], [("z", at(2010))], [("b", at(10))]]
    out = drain(monitor.stale_heartbeats(feed(spark, tmp_path, batches, schema), ["job"]), tmp_path / "o")
    got = {(r.job, r.last_beat, r.stale_at) for r in out}
    assert ("a", at(100), at(220)) in got and ("b", at(0), at(120)) in got and ("a", at(300), at(420)) in got
    assert sum(j == "b" for j, *_ in got) == 1  # the row far behind the watermark adds nothing
    jobs = spark.createDataFrame([("a",), ("never",)], "job string")
    beats = spark.createDataFrame([("a", at(0))], schema)
    for now, want in ((50, {"a": False, "never": True}), (120, {"a": False, "never": True}), (121, {"a": True, "never": True})):
        st = monitor.heartbeat_state(jobs, beats, ["job"], F.lit(at(now)))
        assert {r.job: r.stale for r in st.collect()} == want


def test_fenced_results(spark):
    jobs = spark.createDataFrame([("j", "t1", True), ("k", "t2", False), ("l", "t3", True)], "job string, expected_token string, stale boolean")
    res = spark.createDataFrame([("j", "t1", "ok"), ("j", "t0", "ok"), ("k", "t2", "oom")], "job string, token string, exit_reason string")
    got = [(r.job, r.token, r.status, r.accepted) for r in monitor.fenced_results(res, jobs).orderBy("job", "token").collect()]
    assert got == [("j", "t0", "token_mismatch", False), ("j", "t1", "ingested", True), ("k", "t2", "rejected_exit", False)]
    assert [(r.job, r.status) for r in monitor.missing_results(jobs, res).collect()] == [("l", "heartbeat_stale")]


def test_first_write_and_terminal_once(spark, tmp_path):
    schema = "kernel string, status string, ts timestamp, id long"
    batches = [[("k", "RUNNING", at(0), 0), ("k", "ERROR", at(50), 2), ("k", "COMPLETE", at(5), 1)], [("k", "ERROR", at(1), 3), ("m", "ERROR", at(9), 4)], [("m", "COMPLETE", at(8), 5), ("m", "ERROR", at(8), 6)],
               [(None, "ERROR", at(3), 9), (None, "COMPLETE", at(3), 8)], [("q", "COMPLETE", at(5000), 7)]]
    out = drain(monitor.terminal_states(feed(spark, tmp_path / "1", batches, schema), "kernel", ["ts", "id"]), tmp_path / "o1")
    assert {(r.kernel, r.status, r.id) for r in out} == {("k", "COMPLETE", 1), ("m", "ERROR", 4), (None, "COMPLETE", 8), ("q", "COMPLETE", 7)} and len(out) == 4
    # with lateness an earlier status of a later batch is the first; what the watermark has not passed is still open
    out = drain(monitor.terminal_states(feed(spark, tmp_path / "2", batches, schema), "kernel", ["ts", "id"], "60 seconds"), tmp_path / "o2")
    assert sorted((str(r.kernel), r.status, r.id) for r in out) == [("None", "COMPLETE", 8), ("k", "ERROR", 3), ("m", "COMPLETE", 5)]


def test_last_write_wins_across_batches(spark, tmp_path):
    schema = "k string, ts timestamp, v int, n int"
    stream = feed(spark, tmp_path, [[("a", at(1), 1, None), ("b", at(1), 2, 5)], [("a", at(3), 3, 7), ("c", None, 1, 1)], [("a", at(2), 9, 9), ("b", at(2), 4, None), ("c", at(0), 2, 2)]], schema)
    changes = drain(monitor.last_writes(stream, ["k"], ["ts"]), tmp_path / "o")
    assert len(changes) == 6  # the row that came too late is no change
    last = monitor.last_write_wins(spark.createDataFrame(changes, schema), ["k"], ["ts"])
    assert {(r.k, r.v, r.n) for r in last.collect()} == {("a", 3, 7), ("b", 4, None), ("c", 2, 2)}


def test_a_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    schema = "kernel string, status string, ts timestamp, id long"
    batches = [[("k", "ERROR", at(50), 1)], [("k", "COMPLETE", at(5), 2)], [("q", "COMPLETE", at(900), 3)]]
    source = feed(spark, tmp_path, batches[:1], schema)
    first = drain(monitor.terminal_states(source, "kernel", ["ts", "id"], "100 seconds"), tmp_path / "o")
    assert first == []
    for i, rows in enumerate(batches[1:], 1):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"b{i:02d}"))
    again = drain(monitor.terminal_states(source, "kernel", ["ts", "id"], "100 seconds"), tmp_path / "o")
    assert [(r.kernel, r.status, r.id) for r in again] == [("k", "COMPLETE", 2)]


def test_sinks_and_readers(spark, tmp_path):
    df = spark.createDataFrame([("b", 'say "hi"\nline', .25), ("a", "x,y", None)], "uid string, report string, Baker's double".replace("Baker's", "`Baker's`"))
    writers.write_json_lines(df, str(tmp_path / "j"), "uid", ["uid", "Baker's"])
    lines = [r.value for r in spark.read.text(str(tmp_path / "j")).collect()]
    assert sorted(lines) == ['{"Baker\'s":0.25,"uid":"b"}', '{"Baker\'s":null,"uid":"a"}']
    (tmp_path / "c.csv").write_text('uid,report,ACL__label\nb,"say ""hi""\nline",0.5\na,z,nan\n')
    back = readers.csv_strings(spark, str(tmp_path / "c.csv"), ["uid", "report", "ACL__label"])
    assert {(r.uid, r.report) for r in back.collect()} == {("b", 'say "hi"\nline'), ("a", "z")}
    assert {(r.uid, r.ACL) for r in readers.score_table(back, "uid", ["ACL"], "__label").collect()} == {("b", .5), ("a", None)}
    with pytest.raises(ContractError):
        readers.series_table(back, ["uid", "plane"], ["uid"])
    with pytest.raises(ContractError):
        readers.series_table(back.withColumn("uid", F.lit("../x")), ["uid"], ["uid"])
    (tmp_path / "s.jsonl").write_text('{"StudyInstanceUID": "u", "soft_targets": {"ACL": 0.5}}\n\n{broken\n')
    rows = readers.json_lines(spark, str(tmp_path / "s.jsonl"), schemas.SOFT_LABELS).collect()
    assert [r.StudyInstanceUID for r in rows if r._corrupt_record is None] == ["u"] and sum(r._corrupt_record is not None for r in rows) == 1
    files = readers.file_hashes(spark, str(tmp_path), "c.csv").collect()
    import hashlib

    assert files[0].sha256 == hashlib.sha256((tmp_path / "c.csv").read_bytes()).hexdigest()
    with pytest.raises(ContractError):
        from tallyfold.operators.contracts import numeric_export

        numeric_export(df, ["uid", "report"])


def test_csv_records_over_many_blocks(spark, tmp_path):
    import csv
    import io

    rng = random.Random(8)
    cells = ["", "plain", 'say "hi"', "a,b", "two\nlines", "crlf\r\nin quotes\r\n\r\nand\rmore", '"', '""\n"', "é日本\n" * 40, "x" * 300, " padded "]
    (tmp_path / "f").mkdir()
    want = []
    for name, end in (("a", "\n"), ("b", "\r\n")):
        rows = [[f"{name}{i}", rng.choice(cells), rng.choice(cells)] for i in range(60)]
        out = io.StringIO(newline="")
        csv.writer(out, lineterminator=end, quoting=csv.QUOTE_ALL).writerows([["uid", "report", "odd name"], *rows])
        (tmp_path / "f" / f"{name}.csv").write_text(out.getvalue() + end, newline="")
        want += rows
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("60", "700", "1000000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            back = readers.csv_strings(spark, str(tmp_path / "f"), ["uid", "odd name", "report"])
            got = [(r[0], r[1] or "", r[2] or "") for r in back.collect()]
            assert sorted(got) == sorted((u, b, a) for u, a, b in want)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    (tmp_path / "f" / "c.csv").write_text("uid,other,odd name\n1,2,3\n")
    with pytest.raises(Exception, match="another header"):
        readers.csv_strings(spark, str(tmp_path / "f"), ["uid"]).collect()
    with pytest.raises(ContractError):
        readers.csv_strings(spark, str(tmp_path / "f"), ["absent"])


def test_keys_are_never_forgotten(spark, tmp_path):
    schema = "kernel string, status string, ts timestamp"
    days = [dt.datetime(2024, 1, d, 12) for d in range(1, 8)]
    batches = [[("k", "COMPLETE" if i == 0 else "ERROR", t), (f"other{i}", "RUNNING", t)] for i, t in enumerate(days)]
    for lateness in (None, "1 hour"):
        source = feed(spark, tmp_path / str(lateness), batches, schema)
        done = drain(monitor.terminal_states(source, "kernel", ["ts"], lateness), tmp_path / f"o1{lateness}")
        assert [(r.kernel, r.status) for r in done] == [("k", "COMPLETE")]
    first = drain(monitor.first_write_wins(source, ["kernel"], ["ts"]), tmp_path / "o2")
    assert sorted(r.kernel for r in first) == sorted(["k", *[f"other{i}" for i in range(7)]])


def test_state_is_called_by_bucket_not_by_key(spark, tmp_path, monkeypatch):
    """Many keys in few buckets: the same rows as by key, integers beside nulls stay integers, and no call per key."""
    from tallyfold.streaming import keyed

    monkeypatch.setattr(keyed, "BUCKETS", 3)
    schema, rng = "k long, ts timestamp, v int", random.Random(7)
    batches = [[(rng.choice([None, *range(200)]), at(100 * b + rng.randint(-60, 60)), rng.choice([None, 1, 2])) for _ in range(300)] for b in range(4)] + [[(-1, at(9000), 0)]]
    rows = [r for b in batches for r in b]
    source = feed(spark, tmp_path, batches, schema)
    calls = spark.sparkContext.accumulator(0)
    real = keyed.LastRow.handleInputRows

    def counted(self, *args):
        calls.add(1)
        return real(self, *args)

    monkeypatch.setattr(keyed.LastRow, "handleInputRows", counted)
    last = {}
    for r in drain(monitor.last_writes(source, ["k"], ["ts", "v"]), tmp_path / "o1"):
        last[r.k] = max(last.get(r.k, (at(-99), -1)), (r.ts, -1 if r.v is None else r.v))
    want = {}
    for k, ts, v in rows:
        want[k] = max(want.get(k, (at(-99), -1)), (ts, -1 if v is None else v))
    assert last == want and 0 < calls.value <= 3 * len(batches)
    first = drain(monitor.first_write_wins(source, ["k"], ["ts", "v"], "130 seconds"), tmp_path / "o2")
    least = {}
    for k, ts, v in rows[:-1]:
        least[k] = min(least.get(k, (at(9999), 9)), (ts, 9 if v is None else v))
    assert {r.k: (r.ts, 9 if r.v is None else r.v) for r in first} == least and len(first) == len(least)
