"""Ticket flow: scenarios, events, staged history, task texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import jsonops
from ..functions.scalars import bound, col, hours_before, join_text, pick, seeded_integer, short_sha1
from ..operators import columns, generate, predicates, sampling

# Fixed values of the flow: copies per scenario, seed range in hours, sample size and seed.
COPIES = 100
SEED_HOURS = 36_000
SAMPLE_ROWS = 5_000
SAMPLE_SEED = 1337

# Writing styles an event asks of each role stage, picked by event seed.
STYLES = {
    "000_style": (
        "concise and precise",
        "not fully fluent (words workarounds)",
        "elusive (missing details)",
        "verbose (too much details)",
        "skills limits (concepts approximations)",
    ),
    "100_style": (
        "verbose (too much details)",
        "elusive (missing details)",
        "concise and precise",
        "not fully fluent (words workarounds)",
        "skills limits (concepts approximations)",
    ),
    "200_style": ("not fully fluent", "concise and precise"),
    "300_style": (
        "concise and precise",
        "elusive (missing details)",
        "verbose (too much details)",
        "not fully fluent (words workarounds)",
        "skills limits (concepts approximations)",
    ),
    "400_style": ("concise and precise", "not fully fluent"),
    "500_style": ("concise and precise",),
}

# Task codes of the six role stages and the fields of a task record.
TASKS = ("000", "100", "200", "300", "400", "500")
TASK_FIELDS = ("date", "name", "role", "label", "description")
TASK = T.StructType([T.StructField(f, T.StringType()) for f in TASK_FIELDS])

# The ordered ticket statuses (status, kind, recurrence).
STATUS_STEPS = (
    ("Non Conformity Creation", "mandatory", "once"),
    ("Design Office - Technical Analysis", "mandatory", "once"),
    ("Design Office - Technical Analysis - Expertise", "optional", "many"),
    ("Design Office - Technical Analysis - Manager validation", "mandatory", "once"),
    ("Stress Office - Calculation Analysis", "mandatory", "once"),
    ("Stress Office - Calculation Analysis - Expertise", "optional", "many"),
    ("Stress Office - Calculation Analysis - Manager validation", "mandatory", "once"),
    ("Analysis & Calculation - workpackage validation", "mandatory", "once"),
    ("Root-cause analysis", "mandatory", "once"),
    ("Classification: Impact assessment (minor, major, critical)", "mandatory", "once"),
    ("Decision of corrective actions required", "mandatory", "once"),
    ("Correction Action Plan Definition", "mandatory", "once"),
    ("Correction Action Plan Execution - per action", "mandatory", "many"),
    ("Validation of corrective actions", "mandatory", "many"),
    ("Closure", "mandatory", "once"),
)
# Days between the per-action rows of a status.
ACTION_DAYS = {
    "Correction Action Plan Execution - per action": (5, 15),
    "Validation of corrective actions": (1, 5),
}


def scenarios(answers: DataFrame, scenario_schema: T.DataType | str, code: str = "ATA_code") -> DataFrame:
    """Valid model answers ``{"scenarios": [...]}`` to one row per scenario.

    Each scenario gets an id from the category code and the hash of its JSON text; its keys
    become columns.
    """
    valid = predicates.keep_values(answers, "llm_validation_status", ["VALID"])
    listed = F.transform(
        F.from_json("llm_output", "struct<scenarios:array<variant>>")["scenarios"], lambda s: F.to_json(s)
    )
    rows = generate.fold_array(valid.withColumn("nc_scenario", listed), "nc_scenario")
    named = rows.withColumn(
        "nc_scenario_id", F.replace(join_text(code, F.lit(" "), short_sha1("nc_scenario", 16)), F.lit(" "), F.lit("-"))
    )
    return jsonops.flatten(columns.drop_matching(named, "llm_.*"), "nc_scenario", scenario_schema, prefix=False)


def expand_events(scenario_rows: DataFrame, key: str, as_of: Column, copies: int = COPIES, seed: int = SAMPLE_SEED) -> DataFrame:
    """Every scenario ``copies`` times, each copy with a seeded event time, id and styles.

    (key, copy) identifies a row. The short event id can repeat, so it is a label, not a key.
    """
    rows = generate.multiply(scenario_rows, copies)
    seeded = rows.withColumn("nc_event_seed", seeded_integer(seed, key, "copy", low=0, high=SEED_HOURS))
    return seeded.withColumns({
        "nc_event_id": F.concat(col(key).cast("string"), F.lit("-"), short_sha1("nc_event_seed", 4)),
        "nc_event_date": hours_before(as_of, "nc_event_seed"),
        **{name: pick(values, "nc_event_seed") for name, values in STYLES.items()},
    })


def sample_events(events: DataFrame, key: str, n: int = SAMPLE_ROWS, seed: int = SAMPLE_SEED) -> DataFrame:
    return sampling.exact_sample(events, n, seed, key, "copy")


def structure_stage(df: DataFrame, stage: str, check_valid: bool = True) -> DataFrame:
    """A model stage's answer as an array of task records named ``stage``; call columns dropped."""
    kept = predicates.keep_values(df, "llm_validation_status", ["VALID"]) if check_valid else df
    tasks = jsonops.task_array("llm_output", TASK)
    return columns.drop_matching(kept.withColumn(stage, tasks), "llm_.*")


def history(df: DataFrame, stages: dict[str, str], output: str = "analysis_history") -> DataFrame:
    """Task arrays of all stages as one array of records that carry their task code.

    ``stages`` maps task code to column. Built on structs, so brackets, quotes or the word
    date inside a description cannot damage it.
    """
    record = T.StructType([T.StructField("task", T.StringType()), *TASK.fields])

    def coded(code: str, tasks: Column) -> Column:
        rows = F.transform(tasks, lambda x: F.struct(F.lit(code).alias("task"), *[x[f].alias(f) for f in TASK_FIELDS]))
        return F.coalesce(rows.cast(T.ArrayType(record)), F.array().cast(T.ArrayType(record)))

    return df.withColumn(output, F.concat(*[coded(code, col(c)) for code, c in stages.items()]))


def history_text(df: DataFrame, stages: dict[str, str], output: str = "analysis_history") -> DataFrame:
    """The same history as JSON text keyed by task code."""
    return df.withColumn(output, F.to_json(F.struct(*[col(c).alias(code) for code, c in stages.items()])))


def _task_texts(code: str, category: str, event: str, date: Column | str) -> Column:
    """Array of (chunk_id, chunk): one markdown text for each task in the history of a ticket."""
    def text(t: Column) -> Column:
        # fixed format: heading, ticket and task lines, blank line, description
        return join_text(
            F.lit("##"), code, F.lit(" ("), category, F.lit(") - "), t["task"], F.lit(": "), t["label"],
            F.lit("\n\nnc_event_id: "), event, F.lit("\nnc_event_date: "), date,
            F.lit("\ntask_date:"), t["date"], F.lit("\nauthor:"), t["name"],
            F.lit("\nrole:"), t["role"], F.lit("\n\n"), t["description"],
        )

    coded = F.filter("analysis_history", lambda t: t["task"].isNotNull())
    return F.transform(coded, lambda t: F.struct(join_text(event, F.lit("-"), t["task"], F.lit("-"), t["date"]).alias("chunk_id"), text(t).alias("chunk")))


def task_chunks(df: DataFrame, code: str = "ATA_code", category: str = "ATA_category", event: str = "nc_event_id",
                date: Column | str = "nc_event_date", keys: tuple[str, ...] = ()) -> DataFrame:
    """One markdown text per task of each ticket: key columns, doc, chunk, chunk_id."""
    rows = df.select(*map(col, keys), col(event).cast("string").alias("doc"), F.explode_outer(_task_texts(code, category, event, date)).alias("t"))
    return rows.filter(F.col("t").isNotNull()).select(*map(col, keys), "doc", "t.chunk", "t.chunk_id")


def ticket_documents(df: DataFrame, keys: tuple[str, ...] = ("nc_scenario_id", "copy"), code: str = "ATA_code", category: str = "ATA_category",
                     event: str = "nc_event_id", date: Column | str = "nc_event_date") -> DataFrame:
    """One document per ticket: its task texts joined in chunk-id order.

    ``keys`` identify a ticket and give the document's ``name``; ``doc`` is the event id, a label
    that tickets may share. All of a ticket is in its row, so nothing is shuffled.
    """
    ordered = F.transform(F.array_sort(_task_texts(code, category, event, date)), lambda t: t["chunk"])
    text = bound(ordered, lambda ts: F.when(F.size(ts) > 0, F.array_join(ts, "\n\n")))
    # the outer explode keeps the filter from computing the whole history a second time
    rows = df.select(F.concat_ws("-", *[col(k).cast("string") for k in keys]).alias("name"), col(event).cast("string").alias("doc"), F.explode_outer(F.array(text)).alias("chunk_concat"))
    return rows.filter(F.col("chunk_concat").isNotNull())
