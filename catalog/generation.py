"""Requests, attempts and responses."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import sql as S
from catalog.registry import query
from catalog.tables import responses, sft_conv, table
from pairloom.config import SMOKE_REQUEST, Generation
from pairloom.operators import generation as G
from pairloom.sources.paths import scratch_path

def _scripted_generator():
    """A deterministic generator for checks, as an inner function so that it travels by value.

    The number that leads each prompt is its script; number % 5 means: 0 good at once, 1 good after
    one timeout, 2 never reached, 3 always an empty body, 4 good with the empty string.
    """

    def make_generator(timeout):
        import json

        last, times = None, 0  # calls for one prompt follow each other

        def send(body: str) -> str:
            chat = json.loads(body)["messages"]
            prompt = chat[-1]["content"]
            nonlocal last, times
            last, times = prompt, times + 1 if prompt == last else 1
            kind = int(prompt.split("|", 1)[0]) % 5
            if kind == 1 and times == 1:
                raise TimeoutError
            if kind == 2:
                raise ConnectionError
            if kind == 3:
                return '{"choices": []}'
            text = "" if kind == 4 else f" {len(chat)}:{prompt} "
            return json.dumps({"choices": [{"message": {"content": text}}]})

        return send

    return make_generator


def _numbered_prompts(spark, sf_dir):
    part = F.split("id", "-")
    number = F.get(part, F.lit(0)).cast("bigint") + F.get(part, F.lit(1)).cast("bigint")
    prompt = F.concat(number.cast("string"), F.lit("|"), "id", F.lit(" "), "instruction")
    return sft_conv(spark, sf_dir).select("id", prompt.alias("prompt"))


def _attempt_sql(n_messages: int) -> str:
    return f"""numbered AS (
  SELECT id, n, n || '|' || id || ' ' || instruction AS prompt
  FROM (SELECT *, CAST(split_part(id, '-', 1) AS BIGINT) + CAST(split_part(id, '-', 2) AS BIGINT) AS n FROM sft_conv)),
attempts AS (
  SELECT id, CAST(a AS INTEGER) AS attempt,
    CASE WHEN n % 5 = 4 THEN '' WHEN n % 5 IN (0, 1) AND a = n % 5
         THEN trim('{n_messages}:' || prompt, {S.SPACES}) END AS content,
    CASE WHEN n % 5 = 1 AND a = 0 THEN 'timeout' WHEN n % 5 = 2 THEN 'connection'
         WHEN n % 5 = 3 THEN 'bad_format' ELSE 'ok' END AS status
  FROM numbered, range(3) AS r(a)
  WHERE a < CASE n % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 4 THEN 1 ELSE 3 END)"""


@query(
    "chat_messages",
    S.with_(S.SFT_CONV)
    + """SELECT id, CAST(pos AS INTEGER) AS pos, CASE pos WHEN 0 THEN 'system' ELSE 'user' END AS role,
      CASE pos WHEN 0 THEN 'You are a helpful assistant.' ELSE instruction END AS content
      FROM sft_conv, range(2) AS r(pos)""",
)
def chat_messages(spark, sf_dir):
    chat = G.messages(F.col("instruction"), Generation().request.system)
    rows = sft_conv(spark, sf_dir).select("id", F.posexplode(chat).alias("pos", "m"))
    return rows.select("id", "pos", "m.role", "m.content")


@query(
    "generation_requests",
    S.with_(S.SFT_CONV)
    + """SELECT id, 'llama-3.2-1b-instruct' AS model, 1.1::DOUBLE AS temperature, 4000 AS max_tokens,
      0.95::DOUBLE AS top_p, instruction AS asked FROM sft_conv""",
)
def generation_requests(spark, sf_dir):
    sent = sft_conv(spark, sf_dir).select("id", G.request(F.col("instruction")).alias("r"))
    return sent.select(
        "id", "r.model", "r.temperature", "r.max_tokens", "r.top_p", F.col("r.messages")[1]["content"].alias("asked")
    )


@query(
    "request_bodies",
    S.with_(S.SFT_CONV)
    + """SELECT id, '{"model":"llama-3.2-1b-instruct","messages":[{"role":"user","content":' || CAST(to_json(instruction) AS VARCHAR)
      || '}],"temperature":0.7,"max_tokens":256,"top_p":0.9}' AS body FROM sft_conv""",
)
def request_bodies(spark, sf_dir):
    body = F.to_json(G.request(F.col("instruction"), SMOKE_REQUEST))
    return sft_conv(spark, sf_dir).select("id", body.alias("body"))


@query(
    "generation_attempts",
    S.with_(S.SFT_CONV, _attempt_sql(2)) + "SELECT id, attempt, content, status FROM attempts",
)
def generation_attempts(spark, sf_dir):
    cfg = Generation(retry_delay=0)
    return G.generate(_numbered_prompts(spark, sf_dir), _scripted_generator(), cfg)


@query(
    "resumed_generation",
    S.with_(S.SFT_CONV, _attempt_sql(2)) + "SELECT id, attempt, content, status FROM attempts",
)
def resumed_generation(spark, sf_dir):
    """A run over other prompts ends, a second one stops after its first wave, and goes on in a third call: all
    attempts are the second run's."""
    path, cfg = scratch_path(spark, "generation"), Generation(retry_delay=0, waves=3)
    prompts = _numbered_prompts(spark, sf_dir)
    others = prompts.withColumn("prompt", F.concat("prompt", F.lit(" (asked before)")))
    G.generate_to_table(spark, others, _scripted_generator(), path, cfg)
    G.generate_to_table(spark, prompts, _scripted_generator(), path, cfg, max_waves=1)
    return G.generate_to_table(spark, prompts, _scripted_generator(), path, cfg, resume=True)


@query(
    "user_only_generation",
    S.with_(S.SFT_CONV, _attempt_sql(1)) + "SELECT id, content FROM attempts WHERE status = 'ok'",
)
def user_only_generation(spark, sf_dir):
    cfg = Generation(request=SMOKE_REQUEST, retry_delay=0)
    log = G.generate(_numbered_prompts(spark, sf_dir), _scripted_generator(), cfg)
    return log.where(F.col("status") == "ok").select("id", "content")


@query(
    "attempt_status_counts",
    S.with_(S.SFT_CONV, _attempt_sql(2)) + "SELECT status, count(*) AS n FROM attempts GROUP BY status",
)
def attempt_status_counts(spark, sf_dir):
    cfg = Generation(retry_delay=0)
    return G.status_counts(G.generate(_numbered_prompts(spark, sf_dir), _scripted_generator(), cfg))


@query(
    "response_contents",
    f"""SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN trim(text, {S.SPACES}) END AS content FROM documents""",
)
def response_contents(spark, sf_dir):
    message = F.struct(F.struct(F.concat(F.lit("\n "), "text", F.lit(" ")).alias("content")).alias("message"))
    good = F.to_json(F.struct(F.array(message).alias("choices")))
    kind = F.col("doc_id") % 5
    body = (
        F.when(kind == 0, good)
        .when(kind == 1, '{"choices": []}')
        .when(kind == 2, F.concat(F.lit('{"error": '), F.col("doc_id").cast("string"), F.lit("}")))
        .when(kind == 3, '{"choices": [{"message": {"content": null}}]}')
        .otherwise(F.concat(F.lit("not json "), F.col("source")))
    )
    return table(spark, sf_dir, "documents").select("doc_id", G.extract_content(body).alias("content"))


@query(
    "first_successes",
    S.with_(S.RESPONSES, S.FIRST_SUCCESS) + "SELECT id, rejected FROM first_success",
)
def first_successes(spark, sf_dir):
    return G.first_success(responses(spark, sf_dir))
