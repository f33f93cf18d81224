import json

import pytest
from pyspark.sql import functions as F

from pairloom.config import SMOKE_REQUEST, Generation, Request
from pairloom.operators import generation as G
from pairloom.operators import runs

FAST = dict(retry_delay=0.0, concurrency=3)
SMOKE_PROMPTS = ["How do I start with the piano?", "Tell me a joke.", "What is a tree?", "Plan a lunch."]


def body(text):
    return json.dumps({"choices": [{"message": {"content": text}}]})


def stub(opened=None):
    """Outcome by the prompt's name; every call is noted in a file, as tasks share no memory."""
    import os
    import uuid

    def body(text):  # an inner copy: what the generator uses must travel with it
        return json.dumps({"choices": [{"message": {"content": text}}]})

    class HTTPError(Exception):
        pass

    class ReadTimeout(TimeoutError):
        pass

    def make_generator(timeout):
        calls = {}

        def note(name, text):
            if opened:
                with open(os.path.join(opened, f"{name}-{uuid.uuid4().hex}"), "w") as f:
                    f.write(text)

        note("open", str(timeout))

        def send(request):
            name = json.loads(request)["messages"][-1]["content"]
            calls[name] = calls.get(name, 0) + 1
            note("call", name)
            errors = {"http": HTTPError, "timeout": ReadTimeout, "connection": ConnectionError, "key": KeyError, "other": RuntimeError}
            if name in errors:
                raise errors[name]
            if name.startswith("late"):
                if calls[name] < int(name[4:]):
                    raise ReadTimeout
                return body("  at last ")
            bodies = {
                "nothing": '{"choices": []}', "nokey": '{"error": 1}', "null": body(None), "text": "<html>", "list": "[]",
                "empty": body(" \n "),
            }
            return bodies.get(name) or body(f" re: {name} ")

        return send

    return make_generator


def prompts(spark, names):
    return spark.createDataFrame(list(enumerate(names)), "id bigint, prompt string")


def log_of(df, names):
    log = {}
    for r in df.orderBy("id", "attempt").collect():
        log.setdefault(names[r.id], []).append((r.attempt, r.content, r.status))
    return log


NAMES = ["good", "empty", "late2", "late3", "late4", "http", "timeout", "connection", "key", "other", "nothing", "nokey", "null", "text", "list"]


def test_attempts_and_statuses(spark):
    log = log_of(G.generate(prompts(spark, NAMES), stub(), Generation(**FAST)), NAMES)
    assert log["good"] == [(0, "re: good", "ok")]
    assert log["empty"] == [(0, "", "ok")]  # an empty reply is a reply
    assert log["late2"] == [(0, None, "timeout"), (1, "at last", "ok")]
    assert log["late3"][-1] == (2, "at last", "ok")
    for name, status in [
        ("late4", "timeout"), ("http", "http"), ("timeout", "timeout"), ("connection", "connection"), ("key", "bad_format"),
        ("other", "error"), ("nothing", "bad_format"), ("nokey", "bad_format"), ("null", "bad_format"),
        ("text", "bad_format"), ("list", "bad_format"),
    ]:
        assert log[name] == [(i, None, status) for i in range(3)], name


def test_no_attempt_allowed(spark):
    assert G.generate(prompts(spark, ["good"]), stub(), Generation(max_retries=0, **FAST)).count() == 0


def test_one_generator_per_task_and_pause_between_attempts(spark, tmp_path):
    import time

    cfg = Generation(max_retries=3, retry_delay=0.3, concurrency=1, request_timeout=7)
    started = time.time()
    assert G.generate(prompts(spark, ["timeout"]), stub(str(tmp_path)), cfg).count() == 3
    assert time.time() - started >= 0.6
    assert [p.read_text() for p in tmp_path.glob("open-*")] == ["7"]
    assert len(list(tmp_path.glob("call-*"))) == 3


def test_concurrency_is_the_number_of_tasks(spark):
    df = G.generate(prompts(spark, NAMES), stub(), Generation(concurrency=5))
    assert df.rdd.getNumPartitions() == 5


def test_offline_log_gives_the_same(spark):
    log = G.generate(prompts(spark, NAMES), stub(), Generation(**FAST))
    found = {NAMES[r.id]: r.rejected for r in G.first_success(log).collect()}
    assert found == {"good": "re: good", "empty": "", "late2": "at last", "late3": "at last"}
    joined = G.attach(prompts(spark, NAMES), log).collect()
    assert len(joined) == len(NAMES) and sum(r.rejected is None for r in joined) == 11
    counts = {r.status: r.n for r in G.status_counts(log).collect()}
    assert counts == {"ok": 4, "timeout": 9, "http": 3, "connection": 3, "bad_format": 18, "error": 3}


def test_first_success_respects_the_cap_and_order(spark):
    rows = [(1, 3, "too late"), (2, 1, "second"), (2, 0, None), (2, 2, "third"), (3, 0, ""), (3, 1, "x")]
    log = spark.createDataFrame(rows, "id int, attempt int, content string")
    assert {r.id: r.rejected for r in G.first_success(log, 3).collect()} == {2: "second", 3: ""}


def test_first_success_combines_before_the_shuffle(spark):
    log = spark.range(1000).select((F.col("id") % 3).alias("id"), F.lit(0).alias("attempt"), F.lit("c").alias("content"))
    assert "partial_min_by" in G.first_success(log)._jdf.queryExecution().executedPlan().toString()


def test_generation_in_waves_and_resuming(spark, tmp_path):
    names = [f"n{i}" for i in range(40)]
    notes, out = tmp_path / "notes", str(tmp_path / "out")
    notes.mkdir()
    cfg = Generation(waves=4, **FAST)

    def run(**kw):
        before = len(list(notes.glob("call-*")))
        log = G.generate_to_table(spark, prompts(spark, names), stub(str(notes)), out, cfg, **kw)
        assert {r.content for r in log.collect()} <= {f"re: {n}" for n in names}
        return len(list(notes.glob("call-*"))) - before, log.count()

    assert run() == (40, 40)
    assert run(resume=True) == (0, 40)
    assert run() == (40, 40)
    # A call may end early; the next one goes on where it ended.
    sent, held = run(max_waves=1)
    assert 0 < sent == held < 40
    assert run(resume=True) == (40 - sent, 40)
    # A manifest without its commit mark does not count: the wave it would have added is done again.
    last = max((tmp_path / "out" / "manifests").iterdir())
    (last / "_SUCCESS").rename(last / "_LOST")
    sent, held = run(resume=True)
    assert 0 < sent < 40 and held == 40
    # Fewer waves than were laid down lose nothing, other prompts or settings are refused.
    fewer = G.generate_to_table(spark, prompts(spark, names), stub(str(notes)), out, Generation(waves=2, **FAST), resume=True)
    assert fewer.count() == 40
    for asked, other in ((names + ["more"], cfg), (names, Generation(waves=4, **{**FAST, "max_retries": 7}))):
        with pytest.raises(ValueError, match="other prompts"):
            G.generate_to_table(spark, prompts(spark, asked), stub(str(notes)), out, other, resume=True)


def test_a_broken_run_takes_nothing_from_the_one_before(spark, tmp_path):
    names, out = [f"n{i}" for i in range(40)], str(tmp_path / "out")
    cfg = Generation(waves=4, **FAST)

    def replying(word, stops=""):
        def make_generator(timeout):
            def send(request):
                name = json.loads(request)["messages"][-1]["content"]
                if stops and name == stops:
                    raise SystemExit  # ends the worker, and so the job
                return json.dumps({"choices": [{"message": {"content": f"{word} {name}"}}]})

            return send

        return make_generator

    def contents(**kw):
        return {r.content for r in G.generate_to_table(spark, prompts(spark, asked), path=out, cfg=cfg, **kw).collect()}

    asked = names
    assert contents(make_generator=replying("A")) == {f"A {n}" for n in names}
    asked = [n.upper() for n in names]
    last = max(runs.newest(spark, out).planned)
    stops = next(asked[r.id] for r in prompts(spark, asked).where(F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(4)) == last).collect())
    with pytest.raises(Exception, match="(?i)exit|crash|worker"):
        contents(make_generator=replying("B", stops))
    kept = runs.newest(spark, out)
    assert 0 < len(kept.done) < 4 and kept.open_parts
    assert {r.content[0] for r in G.attempts_of(spark, out, "id bigint, attempt int, content string, status string").collect()} == {"B"}
    assert contents(make_generator=replying("C"), resume=True) <= {f"{w} {n}" for w in "BC" for n in asked}
    done = runs.state(spark, out).collect()
    assert sum(r.rows for r in done) == sum(r.inputs for r in done) == 40
    # The run before is still there until it is told to go.
    assert len(list((tmp_path / "out").glob("run-*"))) == 2
    runs.forget_other_runs(spark, out)
    assert [p.name for p in (tmp_path / "out").glob("run-*")] == [kept.run] and len(contents(make_generator=replying("D"), resume=True)) == 40


def test_progress_counts_committed_waves(spark, tmp_path):
    names, out = [f"n{i}" for i in range(40)], str(tmp_path / "out")
    assert G.progress(spark, out).count() == 0
    cfg = Generation(waves=4, **FAST)
    G.generate_to_table(spark, prompts(spark, names), stub(), out, cfg, max_waves=3)
    rows = G.progress(spark, out).orderBy("wave").collect()
    assert len(rows) == 3 and [r.attempts for r in rows] == [r.prompts for r in rows]
    assert [r.prompts_so_far for r in rows] == [sum(x.prompts for x in rows[: i + 1]) for i in range(3)]
    G.generate_to_table(spark, prompts(spark, names), stub(), out, cfg, resume=True)
    last = G.progress(spark, out).orderBy(F.desc("wave")).first()
    assert (last.prompts_so_far, last.attempts_so_far) == (40, 40)


def test_responses_by_prompt(spark):
    records = spark.createDataFrame([(1, "ask"), (2, "ask"), (3, "other"), (4, None)], "id int, prompt string")
    log = spark.createDataFrame([(" ask\n", 1, " late "), ("ask", 0, None), ("nobody", 0, "x"), (None, 0, "y")], "prompt string, attempt int, content string")
    found = {r.id: r.rejected for r in G.attach_by_prompt(records, log).collect()}
    assert found == {1: "late", 2: "late", 3: None, 4: None}


def test_two_runs_in_one_folder(spark, tmp_path):
    out = str(tmp_path / "out")
    first = runs.begin(spark, out, "job-a")
    second = runs.commit(spark, out, runs.begin(spark, out, "job-b"))
    with pytest.raises(RuntimeError, match="Another run"):
        runs.commit(spark, out, first)
    assert runs.newest(spark, out) == second and runs.state(spark, out).count() == 0


def test_generation_of_nothing(spark, tmp_path):
    none = prompts(spark, ["x"]).limit(0)
    assert G.generate_to_table(spark, none, stub(), str(tmp_path / "none"), Generation(waves=2)).count() == 0


def test_request_body(spark):
    row = prompts(spark, ["hi \"you\""]).select(F.to_json(G.request(F.col("prompt"), Request(model="m"))).alias("b")).first()
    assert list(json.loads(row.b).items()) == [
        ("model", "m"),
        ("messages", [{"role": "system", "content": "You are a helpful assistant."}, {"role": "user", "content": 'hi "you"'}]),
        ("temperature", 1.1), ("max_tokens", 4000), ("top_p", 0.95),
    ]


def test_smoke_prompts_have_no_system_message(spark, tmp_path):
    cfg = Generation(request=SMOKE_REQUEST, **FAST)
    log = G.generate(prompts(spark, SMOKE_PROMPTS), stub(), cfg)
    assert {r.content for r in log.collect()} == {f"re: {p}" for p in SMOKE_PROMPTS}
    sent = prompts(spark, SMOKE_PROMPTS).select(G.request(F.col("prompt"), SMOKE_REQUEST).alias("r")).first().r
    assert [m.role for m in sent.messages] == ["user"]
    assert (sent.temperature, sent.max_tokens, sent.top_p) == (0.7, 256, 0.9)


def test_extract_content(spark):
    bodies = [body(" a "), '{"choices":[]}', '{"error":1}', body(None), "not json", None, body(chr(0xA0) + "b")]
    df = spark.createDataFrame(list(enumerate(bodies)), "i int, b string")
    got = [r.c for r in df.select("i", G.extract_content(F.col("b")).alias("c")).orderBy("i").collect()]
    assert got == ["a", None, None, None, None, None, "b"]


@pytest.mark.parametrize("bad", [dict(max_retries=-1), dict(retry_delay=-1), dict(concurrency=0), dict(waves=0)])
def test_bad_settings(bad):
    with pytest.raises(ValueError):
        Generation(**bad)
