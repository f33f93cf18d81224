"""The same views and the cascade as common table expressions, for the comparison engine."""

from __future__ import annotations

from pairloom.functions.text import WHITESPACE

SPACES = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)

WEAK_TEXT = """CASE doc_id % 6
    WHEN 1 THEN '   '
    WHEN 2 THEN substr(text, 1, 12)
    WHEN 3 THEN substr(text, 1, length(text) // 20)
    WHEN 4 THEN text || ' zzz'
    WHEN 5 THEN substr(text, 1, length(text) // 2) END"""

SFT_DOCS = "sft_docs AS (SELECT doc_id AS id, 'Retell: ' || text AS instruction, text AS output FROM documents)"

WEAK_DOCS = f"""weak_docs AS (
  SELECT doc_id AS id, source, 'Retell: ' || text AS prompt, text AS chosen, {WEAK_TEXT} AS rejected
  FROM documents)"""

RESPONSES = f"""responses AS (
  SELECT doc_id AS id, CAST(a AS INTEGER) AS attempt,
         CASE WHEN a >= doc_id % 5 THEN {WEAK_TEXT} END AS content
  FROM documents, range(5) AS r(a))"""

FIRST_SUCCESS = """first_success AS (
  SELECT id, arg_min(content, attempt) AS rejected FROM responses
  WHERE attempt < 3 AND content IS NOT NULL GROUP BY id)"""

PAIRS_DOCS = f"""pairs_docs AS (
  SELECT s.id, trim(s.instruction, {SPACES}) AS prompt, trim(s.output, {SPACES}) AS chosen,
         trim(f.rejected, {SPACES}) AS rejected
  FROM sft_docs s LEFT JOIN first_success f ON s.id = f.id)"""

SFT_CONV = """sft_conv AS (
  SELECT conv_id || '-' || turn AS id, text AS instruction, next_text AS output
  FROM (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
        FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'user' AND next_role = 'assistant')"""

LOGPS = """logps AS (
  SELECT doc_id AS id, -((7 * doc_id) % 101) / 8.0::DOUBLE AS pc, -((11 * doc_id) % 103) / 8.0::DOUBLE AS pr,
         -((5 * doc_id) % 97) / 8.0::DOUBLE AS rc, -((3 * doc_id) % 89) / 8.0::DOUBLE AS rr
  FROM documents)"""


def words(column: str) -> str:
    """Word list. The comparison tables hold no white space beyond these four characters."""
    return f"list_filter(regexp_split_to_array(lower({column}), '[ \\t\\n\\r]+'), lambda w: w <> '')"


def cascade(source: str, min_chars: int | None = 20, min_ratio: float | None = 0.1,
            threshold: float | None = 0.85, missing: str = "failed") -> str:
    """CTEs ending in ``judged``: every row of ``source`` with evidence and outcome."""
    rules = [f"WHEN rejected IS NULL THEN '{missing}'", "WHEN n_chars = 0 THEN 'empty'"]
    if min_chars:
        rules.append(f"WHEN n_chars < {min_chars} THEN 'too_short'")
    if min_ratio:
        rules.append(f"WHEN length_ratio < {min_ratio}::DOUBLE THEN 'ratio'")
    if threshold is not None:
        rules.append(f"WHEN jaccard > {threshold}::DOUBLE THEN 'similar'")
    return f"""measured AS (
  SELECT *, CAST(length(trim(rejected, {SPACES})) AS INTEGER) AS n_chars,
         length(rejected)::DOUBLE / greatest(length(chosen), 1) AS length_ratio,
         list_distinct({words('chosen')}) AS cw, list_distinct({words('rejected')}) AS rw
  FROM {source}),
compared AS (
  SELECT *, CASE WHEN rejected IS NULL THEN NULL WHEN len(cw) = 0 OR len(rw) = 0 THEN 0.0::DOUBLE
       ELSE len(list_intersect(cw, rw))::DOUBLE / (len(cw) + len(rw) - len(list_intersect(cw, rw))) END AS jaccard
  FROM measured),
judged AS (SELECT *, CASE {' '.join(rules)} ELSE 'ok' END AS outcome FROM compared)"""


REASON = """CASE outcome
      WHEN 'empty' THEN 'empty response'
      WHEN 'too_short' THEN 'too short (' || n_chars || ' chars)'
      WHEN 'ratio' THEN 'length ratio too low (' || printf('%.2f', length_ratio) || ')'
      WHEN 'similar' THEN 'too similar to chosen (Jaccard=' || printf('%.2f', jaccard) || ')'
      ELSE '' END"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


WEAK_JUDGED = with_(WEAK_DOCS, cascade("weak_docs"))
PAIRS_JUDGED = with_(SFT_DOCS, RESPONSES, FIRST_SUCCESS, PAIRS_DOCS, cascade("pairs_docs"))


def seeded(key: str, seed: int) -> str:
    return f"md5('{seed}:' || CAST({key} AS VARCHAR))"
