"""Responses for prompts: live batch generation with retry, or an attempt log made elsewhere.

Generation is costly and cannot be repeated, so its result is written to a table before anything
reads it; ``generate_to_table`` does so and can be taken up again after a failure.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import replace

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.config import Generation, Request
from pairloom.functions.text import strip
from pairloom.operators.quality import outcome_counts
from pairloom.operators.runs import begin, commit, newest

# make_generator(timeout) is called once per task and returns send(request_json) -> body_text.
MakeGenerator = Callable[[float], Callable[[str], str]]

# The wire names of the chat call and its reply, here and in ``messages`` and ``request``.
_BODY = "choices array<struct<message: struct<content: string>>>"
_LOG = T.StructType(
    [
        T.StructField("attempt", T.IntegerType()),
        T.StructField("content", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)


def messages(prompt: Column, system: str | None) -> Column:
    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    user = message("user", prompt)
    return F.array(user) if system is None else F.array(message("system", F.lit(system)), user)


def request(prompt: Column, cfg: Request = Request()) -> Column:
    """The chat call as a struct; ``to_json`` of it is the wire body, fields in this order."""
    return F.struct(
        F.lit(cfg.model).alias("model"),
        messages(prompt, cfg.system).alias("messages"),
        F.lit(cfg.temperature).alias("temperature"),
        F.lit(cfg.max_tokens).alias("max_tokens"),
        F.lit(cfg.top_p).alias("top_p"),
    )


def extract_content(body: Column) -> Column:
    """First choice's message content, stripped; null if the body has none or is not JSON."""
    return strip(F.get(F.from_json(body, _BODY)["choices"], F.lit(0))["message"]["content"])


def _attempts(make_generator: MakeGenerator, cfg: Generation, key: str):
    """The per-task function. All it needs is inside, so it travels without this package."""
    max_retries, delay, timeout, flush_at = cfg.max_retries, cfg.retry_delay, cfg.request_timeout, 500

    def status_of(error: Exception) -> str:
        # By class name along the inheritance, so that any HTTP client's errors are understood.
        names = {c.__name__ for c in type(error).__mro__}
        if names & {"HTTPError"}:
            return "http"
        if names & {"ConnectTimeout", "ConnectionError", "URLError"}:
            return "connection"
        if names & {"Timeout", "TimeoutError"}:
            return "timeout"
        if names & {"KeyError", "IndexError"}:
            return "bad_format"
        return "error"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json
        import time

        send = make_generator(timeout)

        def attempt_once(body: str) -> tuple[str | None, str]:
            try:
                reply = send(body)
            except Exception as e:
                return None, status_of(e)
            try:
                return json.loads(reply)["choices"][0]["message"]["content"].strip(), "ok"
            except (ValueError, LookupError, TypeError, AttributeError):
                return None, "bad_format"

        def log_frame(log: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(log, columns=[key, "attempt", "content", "status"])

        for batch in batches:
            log: list[tuple] = []
            for k, body in zip(batch[key], batch["request"]):
                for attempt in range(max_retries):
                    content, status = attempt_once(body)
                    log.append((k, attempt, content, status))
                    if content is not None:
                        break
                    if attempt + 1 < max_retries:
                        time.sleep(delay)
                if len(log) >= flush_at:  # long replies must not pile up
                    yield log_frame(log)
                    log = []
            yield log_frame(log)

    return run


def generate(
    prompts: DataFrame, make_generator: MakeGenerator, cfg: Generation = Generation(), key: str = "id"
) -> DataFrame:
    """The attempt log ``(key, attempt, content, status)``, one row per attempt made.

    Attempts stop at the first reply with content (the empty string is one) or at ``max_retries``.
    Each task opens one generator and calls it for one prompt at a time, so as many calls run as
    there are tasks: ``cfg.concurrency``. Rows are placed by the hash of their key, so a task that
    is run again meets the same prompts. Keep speculative execution off here.
    """
    requests = prompts.select(key, F.to_json(request(F.col("prompt"), cfg.request)).alias("request"))
    # A stated number, as adaptive execution would merge tasks by bytes, and here calls count.
    tasks = cfg.concurrency or int(prompts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([prompts.schema[key], *_LOG.fields])
    return requests.repartition(tasks, key).mapInPandas(_attempts(make_generator, cfg, key), schema)


def fingerprint(df: DataFrame) -> tuple:
    """Number of rows and sum of their hashes: the same for the same rows in any order."""
    hashes = F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)"))
    row = df.agg(F.count("*").alias("rows"), F.coalesce(hashes, F.lit(0).cast("decimal(38,0)")).alias("hashes")).first()
    return row["rows"], row["hashes"]


def _job(prompts: DataFrame, cfg: Generation, key: str) -> str:
    """What replies depend on, in short: the prompts in any order, the request settings, the retries."""
    own = fingerprint(prompts.select(key, "prompt")) + (cfg.request, cfg.max_retries)
    return hashlib.sha256(repr(own).encode()).hexdigest()


def generate_to_table(
    spark: SparkSession,
    prompts: DataFrame,
    make_generator: MakeGenerator,
    path: str,
    cfg: Generation = Generation(),
    key: str = "id",
    resume: bool = False,
    max_waves: int | None = None,
) -> DataFrame:
    """``generate`` into the folder ``path``, in ``cfg.waves`` jobs, and the log read back.

    A run lays down its prompts in a folder of its own, one folder per wave, and commits each wave to a
    manifest once it is written, so every wave, and a resumed run, sees the same prompts, and attempts of
    different runs or jobs never mix. With ``resume`` the newest run of the folder goes on: its committed waves
    are kept and not sent again, whatever ``cfg.waves`` says; if it is of other prompts or request settings,
    that is an error. ``max_waves`` ends the call after so many waves, to go on later; the log then
    holds the waves done. What a lost executor can cost is the running tasks of one wave. Folders of earlier
    runs stay until ``forget_other_runs``.
    """
    path = path.rstrip("/")
    job, held = _job(prompts, cfg, key), newest(spark, path) if resume else None
    if held is not None and held.job != job:
        raise ValueError(f"{path} holds the attempts of other prompts or settings; resume only the same job")
    if held is None:
        held = begin(spark, path, job)
        wave = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(cfg.waves)).cast("int").alias("wave")
        staged = f"{path}/{held.run}/prompts"
        prompts.select(key, "prompt", wave).write.mode("errorifexists").partitionBy("wave").parquet(staged)
        schema = T.StructType([prompts.schema[key], T.StructField("prompt", T.StringType()), T.StructField("wave", T.IntegerType())])
        sizes = spark.read.schema(schema).parquet(staged).groupBy("wave").count().collect()
        held = commit(spark, path, replace(held, planned={r["wave"]: r["count"] for r in sizes}))
    schema = T.StructType([prompts.schema[key], T.StructField("prompt", T.StringType())])
    for wave in held.open_parts[:max_waves]:
        target = f"{path}/{held.run}/attempts/wave={wave}"
        rows = spark.read.schema(schema).parquet(f"{path}/{held.run}/prompts/wave={wave}")
        generate(rows, make_generator, cfg, key).write.mode("overwrite").parquet(target)
        held = commit(spark, path, replace(held, done=held.done | {wave: spark.read.parquet(target).count()}))
    return attempts_of(spark, path, T.StructType([prompts.schema[key], *_LOG.fields]))


def attempts_of(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The attempts that the newest run in ``path`` has committed; none if there is no run."""
    path = path.rstrip("/")
    held = newest(spark, path)
    if held is None or not held.done:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{held.run}/attempts/wave={w}" for w in sorted(held.done)])


def first_success(
    responses: DataFrame, max_retries: int = Generation.max_retries, key: str = "id"
) -> DataFrame:
    """The content of each key's first attempt that has one, among the first ``max_retries``.

    Combines before the shuffle, so a key with very many attempts arrives as one row per task.
    """
    usable = responses.where((F.col("attempt") < max_retries) & F.col("content").isNotNull())
    return usable.groupBy(key).agg(F.min_by("content", "attempt").alias("rejected"))


def attach(
    records: DataFrame,
    responses: DataFrame,
    max_retries: int = Generation.max_retries,
    key: str = "id",
) -> DataFrame:
    """Records with their ``rejected`` response, stripped; null where no attempt gave one."""
    found = first_success(responses, max_retries, key)
    return records.join(found, key, "left").withColumn("rejected", strip("rejected"))


def attach_by_prompt(records: DataFrame, responses: DataFrame, max_retries: int = Generation.max_retries) -> DataFrame:
    """``attach`` for an attempt log that names prompts instead of keys: records with the same prompt get the same response.
    Prompts are compared by their digests, stripped."""
    digest = F.md5(strip("prompt")).alias("_prompt")
    found = first_success(responses.select(digest, "attempt", "content"), max_retries, "_prompt")
    joined = records.withColumn("_prompt", F.md5(strip("prompt"))).join(found, "_prompt", "left")
    return joined.drop("_prompt").withColumn("rejected", strip("rejected"))


def status_counts(responses: DataFrame) -> DataFrame:
    return responses.groupBy("status").agg(F.count("*").alias("n"))


def observe_counts(classified: DataFrame, name: str = "outcomes") -> tuple[DataFrame, Observation]:
    """The same rows with the run counters collected on the side by whatever job runs them. Let that
    job's last stage do the observing: only there is a task that runs twice counted once."""
    observation = Observation(name)
    return classified.observe(observation, *outcome_counts()), observation


def progress(spark: SparkSession, path: str) -> DataFrame:
    """What the newest run in ``path`` has done so far, a row per committed wave in the order of waves: its prompts and attempts, and
    those of all waves up to it. Attempts of a wave that is tried again are not counted twice, as only its commit counts."""
    held, rows, prompts, attempts = newest(spark, path.rstrip("/")), [], 0, 0
    for wave in sorted(held.done) if held else ():
        prompts, attempts = prompts + held.planned[wave], attempts + held.done[wave]
        rows.append((wave, held.planned[wave], held.done[wave], prompts, attempts))
    return spark.createDataFrame(rows, "wave int, prompts bigint, attempts bigint, prompts_so_far bigint, attempts_so_far bigint")
