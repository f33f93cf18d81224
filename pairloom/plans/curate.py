"""From instruction records to preference pairs, written and counted."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.config import Fields, Generation, Quality, Selection
from pairloom.functions.order import seeded_hash
from pairloom.functions.text import strip
from pairloom.operators.generation import MakeGenerator, attach, attach_by_prompt, fingerprint, generate_to_table
from pairloom.operators.keys import with_content_key
from pairloom.operators.quality import accepted, classify, outcome_counts, readiness, skipped
from pairloom.operators.sampling import head_n, sample_n
from pairloom.operators.validate import complete, drop_blank, drop_blank_stats, require_columns, to_pairs
from pairloom.sources.paths import path_exists, written_once
from pairloom.sources.records import (
    POSITION,
    is_parquet,
    read_accounted,
    read_records,
    read_table,
    record_schema,
    require_fields,
)
from pairloom.sources.sinks import write_counted, write_pairs, write_skipped


@dataclass(frozen=True)
class Curation:
    fields: Fields = Fields()
    selection: Selection = field(default_factory=Selection)
    generation: Generation = field(default_factory=Generation)
    quality: Quality = field(default_factory=Quality)
    log_skipped: bool = True
    # Is the source a JSON file or folder? None: if its name ends in .json or .jsonl, or its files do not begin as parquet.
    json_source: bool | None = None


def _is_json(spark: SparkSession, source: str, json_source: bool | None) -> bool:
    if json_source is not None:
        return json_source
    return source.endswith((".json", ".jsonl")) or (path_exists(spark, source) and not is_parquet(spark, source))


def load_records(
    spark: SparkSession,
    source: str,
    fields: Fields,
    split: str | None = "train",
    json_source: bool | None = None,
) -> DataFrame:
    """Records of a JSON file or folder, or of one split of a named table or parquet path, with the mapped
    fields checked. Malformed lines are left out."""
    if _is_json(spark, source, json_source):
        require_fields(spark, source, fields.names)
        names = fields.names + ([fields.key] if fields.key else [])
        return read_records(spark, source, record_schema(names), with_position=True)[0]
    return require_columns(read_table(spark, source, split), fields.names)


def load_accounted(
    spark: SparkSession, source: str, fields: Fields, out: str, split: str | None = "train", json_source: bool | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """The valid records, and how many rows were read, malformed, blank and valid. A JSON source is parsed once, into
    ``out/read`` by kind; all else is read from there. Rows read, counted while they were parsed, must be as many as
    those of the three kinds, counted in what was written."""
    blank = ~complete(fields.prompt, fields.chosen)
    if not _is_json(spark, source, json_source):
        df = require_columns(read_table(spark, source, split), fields.names)
        counts = drop_blank_stats(df, fields.prompt, fields.chosen).first()
        return df.where(~blank), {"read": counts.records, "malformed": 0, "blank": counts.dropped, "valid": counts.kept}
    require_fields(spark, source, fields.names)
    names = fields.names + ([fields.key] if fields.key else [])
    rows = read_accounted(spark, source, record_schema(names), blank)
    path = f"{out}/read"
    counts = write_counted(rows, [F.count(F.lit(1)).alias("read")], lambda df: df.write.mode("overwrite").partitionBy("kind").parquet(path))
    table = spark.read.schema(rows.schema).parquet(path)
    counts |= dict.fromkeys(("malformed", "blank", "valid"), 0) | {r["kind"]: r["count"] for r in table.groupBy("kind").count().collect()}
    if counts["read"] != counts["malformed"] + counts["blank"] + counts["valid"]:
        raise RuntimeError(f"The account of {source} does not balance: {counts}")
    table.where("kind = 'malformed'").select(F.col(POSITION)["file"].alias("file"), "line").write.mode("overwrite").json(f"{out}/malformed")
    return table.where("kind = 'valid'").drop("kind", "line"), counts


def select_records(df: DataFrame, fields: Fields, selection: Selection) -> DataFrame:
    """Valid records as ``(id, prompt, chosen)``, stripped, keyed, and cut to the sample.

    Unshuffled, the first rows in input order are taken; that order is the position in the file, or
    the key of a table.
    """
    order = POSITION if POSITION in df.columns else fields.key
    cut_by_order = selection.max_samples is not None and not selection.shuffle
    if cut_by_order:
        if order is None:
            raise ValueError("Taking the first rows of a table needs a key column that orders them")
        df = head_n(drop_blank(df, fields.prompt, fields.chosen), selection.max_samples, order)
        if order == POSITION:
            # A place in a file is only what it is as long as the file is read in the same splits: the rows chosen are kept.
            df = written_once(df, "first-records")
    keep = (F.col(fields.key).alias("id"),) if fields.key else ()
    pairs = drop_blank(to_pairs(df, Fields(fields.prompt, fields.chosen), keep))
    pairs = pairs.withColumns({"prompt": strip("prompt"), "chosen": strip("chosen")})
    if not fields.key:
        pairs = with_content_key(pairs)
    if cut_by_order or not selection.shuffle:
        return pairs
    if selection.max_samples and (not fields.key or POSITION in df.columns):
        pairs = written_once(pairs, "keyed-records")  # the cut is searched for in several passes
    return sample_n(pairs, selection.max_samples, selection.seed, "id")


def judge(records: DataFrame, responses: DataFrame, cfg: Curation = Curation()) -> DataFrame:
    """Records classified against an attempt log by ``id``, or by ``prompt`` if it has no ids: every record gets an outcome."""
    by_key = "id" in responses.columns
    return classify((attach if by_key else attach_by_prompt)(records, responses, cfg.generation.max_retries), cfg.quality)


def build_pairs(
    spark: SparkSession,
    source: str,
    out: str,
    cfg: Curation = Curation(),
    make_generator: MakeGenerator | None = None,
    responses: DataFrame | None = None,
    split: str | None = "train",
    resume: bool = False,
) -> DataFrame:
    """Run the whole job into the folder ``out`` and return its summary with readiness band.

    Responses come from ``make_generator`` or from an attempt log. What is costly or not repeatable
    is written once and read back: the selected records, the attempts, and the classified rows by
    outcome. The pair file, the skip log and the counts all come from that last table, so they
    agree, and the join and the word overlap are not done three times. With ``resume`` a run that
    broke off goes on with the records and attempts it had committed; it must be of the same records.

    The summary also counts the rows ``read``, the ``malformed`` lines, which are written to ``out/malformed``, and the
    ``blank`` records: read = malformed + blank + valid, and valid = total unless a limit was set. The counters of outcomes
    are taken by the job that writes the classified rows. With ``selection.shuffle`` the pair file is in the seeded order.
    """
    if (make_generator is None) == (responses is None):
        raise ValueError("Give either a generator or an attempt log")
    out = out.rstrip("/")
    loaded, counts = load_accounted(spark, source, cfg.fields, out, split, cfg.json_source)
    records = select_records(loaded, cfg.fields, cfg.selection)
    if make_generator is not None:
        kept = f"{out}/records"
        if not (resume and path_exists(spark, f"{kept}/_SUCCESS")):
            records.write.mode("overwrite").parquet(kept)
        elif fingerprint(records) != fingerprint(spark.read.parquet(kept)):
            raise ValueError(f"{kept} holds other records than {source}; resume only the same job")
        records = spark.read.parquet(kept)
        responses = generate_to_table(
            spark, records, make_generator, f"{out}/generation", cfg.generation, resume=resume
        )
    judged = judge(records, responses, cfg)
    classify_to = f"{out}/classified"
    outcomes = write_counted(judged, outcome_counts(), lambda df: df.write.mode("overwrite").partitionBy("outcome").parquet(classify_to))
    classified = spark.read.schema(judged.schema).parquet(classify_to)
    order = [seeded_hash("id", cfg.selection.seed), F.col("id")] if cfg.selection.shuffle else None
    write_pairs(accepted(classified), f"{out}/pairs.jsonl", order)
    if cfg.log_skipped:
        write_skipped(skipped(classified), f"{out}/skipped.jsonl")
    names = ("total", "written", "skipped", "failed")
    row = [outcomes[n] for n in names] + [counts[n] for n in ("malformed", "blank", "read")]
    schema = ", ".join(f"{n} bigint" for n in (*names, "malformed", "blank", "read"))
    return readiness(spark.createDataFrame([row], schema))
