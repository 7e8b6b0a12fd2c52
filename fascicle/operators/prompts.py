"""Template-driven model calls: render, call, validate, retry.

The model is any function from (system text, user text) to text. The stand-in answers offline
and always the same way, so every job here can be tested without a service.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsonops
from ..functions.scalars import bound, col, text_or_empty
from ..session import materialise, scratch_path
from ..sources.files import save_table
from .chunking import CHUNK_OVERLAP, CHUNK_SIZE, fixed_chunks

Model = Callable[[str, str], str]
# A whole list of (system, user) prompts to their answers, an exception for one that failed.
BatchModel = Callable[[list[tuple[str, str]]], list[str | Exception]]

OUTPUT_COLUMNS = ("llm_output", "llm_validation_status", "llm_raw_response", "llm_error_message", "llm_raw_query")
VALID, INVALID = "VALID", "INVALID"


def render(template: str | Column, inputs: Mapping[str, Column | str]) -> Column:
    """Replace every ``{{name}}`` by its column, in the order given; a missing value is empty.

    Names may hold spaces. Replacement is plain text, so values need no escaping.
    """
    out = F.lit(template) if isinstance(template, str) else template
    for name, value in inputs.items():
        out = F.replace(out, F.lit("{{" + name + "}}"), text_or_empty(value))
    return out


def structured_prompt(instruction: str, inputs: Mapping[str, Column | str], outputs: Sequence[str] = ()) -> Column:
    """A fixed instruction followed by one ``name: value`` line per input."""
    lines = [F.lit(instruction)]
    lines += [F.concat(F.lit(f"{name}: "), text_or_empty(value)) for name, value in inputs.items()]
    if outputs:
        lines.append(F.lit("Answer with: " + ", ".join(outputs)))
    return F.concat_ws("\n", *lines)


def joined_comments(instruction: Column | str, comments: Column, rule: str = "-" * 20) -> Column:
    """Instruction, then earlier comments one per line between two rules."""
    return F.concat_ws("\n", F.lit(instruction) if isinstance(instruction, str) else instruction,
                       F.lit(rule), F.array_join(comments, "\n"), F.lit(rule))


def validation(text: Column | str, expected: str = "NONE", required: Sequence[str] = (),
               forbidden: Sequence[str] = ()) -> tuple[Column, Column]:
    """(status, message) of a model answer.

    Checks, in order: an answer exists, it is a JSON object if one is expected, every required
    key has a value, no forbidden term occurs.
    """
    t = col(text)

    def message(v: Column) -> Column:
        checks = [(t.isNull(), F.lit("no answer"))]
        if expected == "JSON_OBJECT":
            checks.append((~F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)), F.lit("not a JSON object")))
        checks += [(F.try_variant_get(v, f"$['{k}']", "string").isNull(), F.lit(f"missing key: {k}")) for k in required]
        checks += [(F.lower(t).contains(f.lower()), F.lit(f"forbidden term: {f}")) for f in forbidden]
        return F.coalesce(*[F.when(bad, why) for bad, why in checks])

    # the answer is parsed once, however many keys are asked for
    found = bound(jsonops.parse(t), message) if expected == "JSON_OBJECT" or required else message(F.lit(None))
    return F.when(found.isNull(), VALID).otherwise(INVALID), found


def offline_model(system: str, user: str) -> str:
    """Stand-in model: a JSON object made from the SHA-1 of the prompt."""
    digest = hashlib.sha1(f"{system}|{user}".encode("utf-8")).hexdigest()
    return json.dumps({"label": digest[:8], "description": digest[8:16], "comment": digest[16:24]}, separators=(",", ":"))


def in_threads(model: Model, concurrency: int = 8) -> BatchModel:
    """A one-prompt model as a batch model with ``concurrency`` calls at once."""

    def one(prompt: tuple[str, str]) -> str | Exception:
        try:
            return model(*prompt)
        except Exception as e:  # any provider error belongs to the row
            return e

    def run(prompts: list[tuple[str, str]]) -> list[str | Exception]:
        with ThreadPoolExecutor(concurrency) as pool:
            return list(pool.map(one, prompts))

    return run


def call_model(df: DataFrame, user: Column, model: Model | None = offline_model, system: Column | None = None,
               retries: int = 0, delay: float = 0.0, output: str = "_answer", batch: BatchModel | None = None,
               concurrency: int = 8) -> DataFrame:
    """One model answer per row; adds a struct (response, error).

    Only the two prompt texts go to Python, an Arrow batch at a time. ``batch`` answers a list of
    prompts itself; a plain ``model`` is called for ``concurrency`` prompts at once in each task.
    Prompts that fail are tried again together and then carry their error; they never fail the
    job. The call is marked non-deterministic, so the optimizer neither repeats nor moves it.
    """
    answer_all = batch or in_threads(model, concurrency)

    @F.pandas_udf("struct<response:string,error:string>")
    def run(systems: pd.Series, users: pd.Series) -> pd.DataFrame:
        prompts = [(s or "", u or "") for s, u in zip(systems, users)]
        answers: list[str | Exception | None] = [None] * len(prompts)
        todo = list(range(len(prompts)))
        for attempt in range(retries + 1):
            try:
                got = answer_all([prompts[i] for i in todo]) if todo else []
            except Exception as e:  # a provider that refuses the whole list
                got = [e] * len(todo)
            for i, answer in zip(todo, got):
                answers[i] = answer
            todo = [i for i in todo if isinstance(answers[i], Exception)]
            if todo and attempt < retries and delay:
                time.sleep(delay)
        rows = [(None, f"{type(a).__name__}: {a}") if isinstance(a, Exception) else (a, None) for a in answers]
        return pd.DataFrame(rows, columns=["response", "error"])

    call = run.asNondeterministic()
    return df.withColumn("_user", user).withColumn("_system", system if system is not None else F.lit("")).withColumn(
        output, call(F.col("_system"), F.col("_user"))
    )


def complete(df: DataFrame, user: Column, model: Model = offline_model, system: Column | None = None,
             expected: str = "NONE", required: Sequence[str] = (), forbidden: Sequence[str] = (),
             retries: int = 0, delay: float = 0.0, suffix: str = "") -> DataFrame:
    """Model call with the five output columns; ``suffix`` tells repeated calls apart."""
    called = call_model(df, user, model, system, retries, delay)
    response, error = F.col("_answer.response"), F.col("_answer.error")
    shown = F.coalesce(jsonops.json_part(response), response) if expected == "JSON_OBJECT" else response
    raw_query = F.to_json(F.struct(F.col("_system").alias("system"), F.col("_user").alias("user")))
    staged = called.withColumn("_shown", shown)
    _, message = validation("_shown", expected, required, forbidden)
    staged = staged.withColumn("_message", message)
    message = F.col("_message")
    status = F.when(message.isNull(), VALID).otherwise(INVALID)
    values = (F.col("_shown"), status, response, F.coalesce(error, message), raw_query)
    named = dict(zip([c + suffix for c in OUTPUT_COLUMNS], values))
    return staged.withColumns(named).drop("_user", "_system", "_answer", "_shown", "_message")


def extract_keys(df: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """Keys of a JSON object answer as text columns; rows without a valid one keep NULLs."""
    parsed = df.withColumn("_json", jsonops.parse(column))
    return parsed.withColumns({k: F.try_variant_get("_json", f"$['{k}']", "string") for k in keys}).drop("_json")


def with_context(requests: DataFrame, contexts: DataFrame, on: str, query_id: str = "query_id") -> DataFrame:
    """Attach retrieved context to requests; an empty list where nothing was found."""
    side = contexts.withColumnRenamed(query_id, on)
    return requests.join(side, on, "left").withColumn("context", F.coalesce("context", F.lit("[]")))


def run_stages(df: DataFrame, stages: Sequence[tuple[str, Callable[[DataFrame], DataFrame]]]) -> DataFrame:
    """Stages in order, each stored before the next reads it.

    Stored results mean that a lost executor or a later failure never repeats model calls of a
    finished stage.
    """
    for _, stage in stages:
        df = materialise(stage(df))
    return df


def summarise(df: DataFrame, text: str, levels: int = 1, sentences: int = 3, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
              model: Model = offline_model, output: str = "summary") -> DataFrame:
    """Summaries of texts of any length, level by level.

    A level cuts the text into overlapping chunks, has each summarised and joins the answers by
    line; the next level does the same to the result. Each level's answers are stored before the
    next reads them. The chunks of a row come back together by the row's number, never by a key
    of the table. An empty text has an empty summary.
    """
    instruction = F.lit(f"Summarise in {sentences} sentences: ")
    rows = materialise(df.withColumn("_row", F.monotonically_increasing_id()).withColumn(output, text_or_empty(text)))
    for _ in range(levels):
        chunks = fixed_chunks(rows.select("_row", col(output).alias("_text")), "_text", "_chunk", "_at", size, overlap)
        answered = materialise(complete(chunks, F.concat(instruction, "_chunk"), model).select("_row", "_at", "llm_output"))
        # a row's answers are as many as the chunks of one text
        parts = F.array_sort(F.collect_list(F.struct("_at", F.coalesce("llm_output", F.lit("")).alias("t"))))
        joined = answered.groupBy("_row").agg(F.array_join(F.transform(parts, lambda p: p["t"]), "\n").alias("_joined"))
        rows = rows.join(joined, "_row", "left").withColumn(output, F.coalesce("_joined", F.lit(""))).drop("_joined")
    return rows.drop("_row")


def retry_rounds(df: DataFrame, attempt: Callable[[DataFrame, int], DataFrame], error: str = "error",
                 rounds: int = 10, delay: float = 0.0) -> DataFrame:
    """Repeat a failing step over the rows that failed, up to ``rounds`` times.

    ``attempt(rows, round)`` returns its rows with an error column and the ``_row`` number they
    came with; NULL and repeated keys are rows like any other. Every round is written to
    shared storage; the next takes only rows without a success. Since a round only sees rows
    that failed before, the failed set is the same as before exactly when its size is, and
    then the loop stops. The driver handles one count per round, never rows.
    """
    spark = df.sparkSession
    # the rows are numbered and stored, so a failed row is found again whatever its key is
    source = save_table(df.withColumn("_row", F.monotonically_increasing_id()), scratch_path(spark, "rows"))
    done, todo, before = [], source, None
    for n in range(rounds):
        stored = save_table(attempt(todo, n), scratch_path(spark, "round"))
        failed = stored.filter(col(error).isNotNull())
        count = failed.count()
        done.append(stored.filter(col(error).isNull()))
        if count == 0:
            break
        if count == before or n == rounds - 1:
            done.append(failed)
            break
        todo, before = source.join(failed.select("_row"), "_row", "left_semi"), count
        if delay:
            time.sleep(delay * (n + 1))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.drop("_row")
