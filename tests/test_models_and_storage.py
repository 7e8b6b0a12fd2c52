"""Model-call jobs, sources, sinks, incremental runs and checks on hand-made data."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fascicle.functions.scalars import col
from fascicle.operators import prompts, quality
from fascicle.plans import tickets
from fascicle.session import scratch_path, shared_dir
from fascicle.sources import delimited, files, jdbc
from fascicle.streaming.incremental import process_new_files


def test_render_in_order(spark):
    df = spark.createDataFrame([("{{b}} $1 \\", None)], "a string, b string")
    out = df.select(prompts.render("<{{a}}|{{ b c }}|{{x}}>", {"a": "a", "b": "b", " b c ": F.lit("z")}).alias("p")).first()["p"]
    assert out == "< $1 \\|z|{{x}}>"


def test_failures_stay_in_their_row(spark):
    def model(system, user):
        if "bad" in user:
            raise TimeoutError("slow")
        return "not json" if "plain" in user else '```json\n{"label": "' + system + '"}\n```'

    df = spark.createDataFrame([(1, "good"), (2, "bad"), (3, "plain"), (4, None)], "i int, t string")
    out = {r["i"]: r for r in prompts.complete(df, F.col("t"), model, F.lit("s"), "JSON_OBJECT", ["label"], retries=1, suffix="_1").collect()}
    assert out[1]["llm_validation_status_1"] == "VALID" and json.loads(out[1]["llm_output_1"]) == {"label": "s"}
    assert out[2]["llm_validation_status_1"] == "INVALID" and out[2]["llm_error_message_1"] == "TimeoutError: slow" and out[2]["llm_output_1"] is None
    assert out[3]["llm_error_message_1"] == "not a JSON object" and out[3]["llm_raw_response_1"] == "not json"
    assert out[4]["llm_validation_status_1"] == "VALID"
    assert [f"{c}_1" for c in prompts.OUTPUT_COLUMNS] == prompts.complete(df, F.col("t"), model, suffix="_1").columns[2:]


def test_in_task_retry(spark, tmp_path):
    marks = str(tmp_path)

    def flaky(system, user):
        path = os.path.join(marks, user)
        with open(path, "a") as f:
            f.write("x")
        if os.path.getsize(path) < 3:
            raise RuntimeError("again")
        return "done"

    df = spark.createDataFrame([("a",), ("b",)], "t string").coalesce(1)
    assert {r["llm_output"] for r in prompts.complete(df, F.col("t"), flaky, retries=2).collect()} == {"done"}


@pytest.mark.parametrize("text, expected", [
    ('{"a": 1, "b": "x"}', None), ('{"a": 1}', "missing key: b"), ('{"a": 1, "b": null}', "missing key: b"), ("[1]", "not a JSON object"),
    ('{"a": 1, "b": "Secret"}', "forbidden term: secret"), (None, "no answer"), ('{"a": ', "not a JSON object")])
def test_validation(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    status, message = prompts.validation("t", "JSON_OBJECT", ["a", "b"], ["secret"])
    row = df.select(status.alias("s"), message.alias("m")).first()
    assert row["m"] == expected and row["s"] == ("VALID" if expected is None else "INVALID")


def test_retry_rounds_stop(spark):
    calls = []

    def attempt(rows, n):
        calls.append(rows.count())
        return rows.withColumn("error", F.when((F.col("id") % 5 > n) | (F.col("id") % 5 == 4), "e"))

    out = prompts.retry_rounds(spark.range(50), attempt)
    rows = out.collect()
    assert len(rows) == 50 and sorted(r["id"] for r in rows if r["error"]) == list(range(4, 50, 5))
    assert calls == [50, 40, 30, 20, 10]
    assert prompts.retry_rounds(spark.range(50), attempt, rounds=1).filter("error is not null").count() == 40


def test_retry_rounds_keep_rows_of_missing_and_repeated_keys(spark):
    rows = [(None, 0), (None, 1), ("a", 0), ("a", 2), ("b", 4)]

    def attempt(rows, n):
        return rows.withColumn("error", F.when((F.col("luck") > n) | (F.col("luck") == 4), "e"))

    out = prompts.retry_rounds(spark.createDataFrame(rows, "k string, luck int"), attempt)
    assert sorted(((r["k"], r["luck"]) for r in out.collect()), key=str) == sorted(rows, key=str)


def test_retry_rounds_of_model_calls(spark):
    def attempt(rows, n):
        def model(system, user):
            if len(user) > n + 1:
                raise ConnectionError("busy")
            return user.upper()

        return prompts.complete(rows, F.col("t"), model)

    df = spark.createDataFrame([("a",), ("bb",), ("ccc",), ("dddd",)], "t string")
    out = prompts.retry_rounds(df, attempt, error="llm_error_message", rounds=3)
    assert {r["t"]: r["llm_output"] for r in out.collect()} == {"a": "A", "bb": "BB", "ccc": "CCC", "dddd": None}


def test_scenarios_skip_broken_answers(spark):
    rows = [("52", '{"scenarios": [{"nc_label": "x, [y]", "parts": ["p"]}, {"nc_label": null}]}', "VALID"), ("53", "{broken", "VALID"), ("54", '{"scenarios": [{}]}', "INVALID")]
    df = spark.createDataFrame(rows, "ATA_code string, llm_output string, llm_validation_status string")
    out = tickets.scenarios(df, "struct<nc_label:string,parts:array<string>>").orderBy(F.desc("nc_label")).collect()
    assert [(r["ATA_code"], r["nc_label"], r["parts"]) for r in out] == [("52", "x, [y]", ["p"]), ("52", "", None)]
    assert out[0]["nc_scenario_id"].startswith("52-") and len(out[0]["nc_scenario_id"]) == 19


EDGE = [(1, None, 1.5, ["x", "y"]), (2, "", None, []), (3, "  ", 2.0, None), (4, 'q"uo\\te\ttab', 3.0, ['"', "[", "]"]), (5, "line\nbreak é ß", -0.5, ["a\nb"])]


def test_managed_table_edge_rows(spark):
    df = spark.createDataFrame(EDGE, "i int, s string, d double, a array<string>")
    path = scratch_path(spark, "edge")
    delimited.write_managed(df, path)
    got = {r["i"]: r for r in delimited.read_managed(spark, path, df.schema).collect()}
    for i, s, d, a in EDGE:
        assert (got[i]["s"] or "") == (s or "") and got[i]["d"] == d and got[i]["a"] == a


def test_bad_values_are_discarded_not_fatal(spark, tmp_path):
    (tmp_path / "t.csv").write_text('"1"\t"x"\t"7"\n"no"\t"y"\t"8"\t"extra"\n"3"\n')
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType()), T.StructField("c", T.IntegerType())])
    rows = delimited.read_managed(spark, str(tmp_path), schema).collect()
    assert sorted(map(tuple, rows), key=str) == sorted([(1, "x", 7), (None, "y", 8), (3, None, None)], key=str)


def test_inline_tables(spark, tmp_path):
    schema = T.StructType([T.StructField("code", T.StringType()), T.StructField("n", T.IntegerType())])
    text = '{"data": [["A", "1"], ["é", "x"],\n ["C", null]]}'
    (tmp_path / "t.data").write_text(text)
    want = [("A", 1), ("C", None), ("é", None)]
    assert sorted(map(tuple, delimited.read_inline(spark, str(tmp_path), schema).collect())) == want
    assert sorted(map(tuple, delimited.inline_literal(spark, text, schema).collect())) == want


def test_files_per_row_are_replaced_whole(spark):
    folder = scratch_path(spark, "md")
    df = spark.createDataFrame([("a", "un\nété"), ("b", None)], "doc string, t string")
    for _ in range(2):
        written = files.write_one_file_per_row(df, folder, "doc", "t").collect()
    assert {(r["path"], r["size"]) for r in written} == {("a.md", 8), ("b.md", 0)}
    listing = files.list_folder(spark, folder)
    assert {(r["basename"], r["size"]) for r in listing.collect()} == {("a.md", 8), ("b.md", 0)}
    assert {r["text"] for r in files.read_texts(spark, folder).collect()} == {"un\nété", ""}


def test_listing_and_texts_of_subfolders(spark):
    folder = scratch_path(spark, "deep")
    for sub in ("", "/a b", "/c/d+e"):
        files.write_one_file_per_row(spark.createDataFrame([("x", sub), ("none", "")], "d string, t string"), folder + sub, "d", "t").collect()
    listed = {r["path"]: r["size"] for r in files.list_folder(spark, folder).collect()}
    assert listed == {"/x.md": 0, "/none.md": 0, "/a b/x.md": 4, "/a b/none.md": 0, "/c/d+e/x.md": 6, "/c/d+e/none.md": 0}
    texts = {r["path"]: r["text"] for r in files.read_texts(spark, folder, "x*").collect()}
    assert texts == {"/x.md": "", "/a b/x.md": "/a b", "/c/d+e/x.md": "/c/d+e"}
    names = [r["path"] for r in files.with_extension(files.list_folder(spark, folder), ".MD", "NONE").collect()]
    assert names == ["/a b/none.md", "/c/d+e/none.md", "/none.md"]


def test_saved_table_file_sizes(spark):
    path = scratch_path(spark, "t")
    back = files.save_table(spark.range(1000).coalesce(1), path, rows_per_file=300)
    assert back.count() == 1000
    metrics = quality.storage_metrics(back, files.list_folder(spark, path)).first()
    assert metrics["files"] == 4 and metrics["records"] == 1000 and metrics["columns"] == 1 and metrics["bytes"] > 0


def test_streaming_takes_only_new_files(spark):
    source, out, log = scratch_path(spark, "src"), scratch_path(spark, "out"), scratch_path(spark, "log")
    spark.range(10).write.parquet(source)
    schema = T.StructType([T.StructField("id", T.LongType())])
    run = lambda: process_new_files(spark, source, schema, out, log, lambda d: d.select((F.col("id") * 2).alias("v")))
    assert run() == 10 and run() == 0
    spark.range(10, 15).write.mode("append").parquet(source)
    assert run() == 5
    assert sorted(r["v"] for r in spark.read.parquet(out).collect()) == [2 * i for i in range(15)]


def test_jdbc_options():
    o = jdbc.jdbc_options("jdbc:postgresql://h/db", "answers", "u", "p")
    assert o["batchsize"] == "10000" and o["dbtable"] == "answers" and o["user"] == "u"
    assert jdbc.read_options() == {} and jdbc.read_options("id", 0, 9, 4)["numPartitions"] == "4"


def test_quality(spark):
    df = spark.createDataFrame([("INVALID", 0), ("VALID", 1), ("VALID", 2), (None, 3)], "s string, o int")
    assert quality.values_in_set(df, "s", ["VALID"]).first()["outcome"] == "ERROR"
    assert quality.values_in_set(df, "s", ["VALID", "INVALID"]).first()["violations"] == 0
    assert quality.mode_in_set(df, "s", ["VALID"], F.col("o")).first()["outcome"] == "OK"
    same = quality.same_keys(df, df, ["s"]).first()
    assert quality.same_keys(df.filter("s is not null"), df.filter("s is not null"), ["s"]).first()["same"] and same["only_left"] >= 0


def test_label_review(spark):
    rows = [("a", "ok", "fine"), ("a", "ok", "fine"), ("a", "", "note"), ("b", "ok", ""), ("b", "ko", None), ("c", "", "")]
    out = {r["id"]: r for r in quality.consolidate_labels(spark.createDataFrame(rows, "id string, l string, c string"), "id", "l", "c").collect()}
    assert out["a"]["verified"] and out["a"]["label"] == "ok" and out["a"]["comments"] == "fine\nnote" and out["a"]["n_labels"] == 2
    assert not out["b"]["verified"] and out["b"]["label"] is None and not out["c"]["verified"]


def test_history_survives_brackets(spark):
    task = {"date": "2024-01-02", "name": "N", "role": "R", "label": 'a ] [ "date"', "description": "x]"}
    df = spark.createDataFrame([("E-1", "52", "Doors", "2024-01-01", json.dumps({"tasks": [task, task]}), json.dumps(task), "oops")],
                               "nc_event_id string, ATA_code string, ATA_category string, nc_event_date string, s0 string, s1 string, s2 string")
    for c in ("s0", "s1", "s2"):
        df = tickets.structure_stage(df.withColumns({"llm_output": col(c), "llm_validation_status": F.lit("VALID")}), f"t_{c}")
    rows = tickets.task_chunks(tickets.history(df, {"000": "t_s0", "100": "t_s1", "200": "t_s2"})).orderBy("chunk_id").collect()
    assert [r["chunk_id"] for r in rows] == ["E-1-000-2024-01-02"] * 2 + ["E-1-100-2024-01-02"]
    assert rows[0]["chunk"] == ('##52 (Doors) - 000: a ] [ "date"\n\nnc_event_id: E-1\nnc_event_date: 2024-01-01\ntask_date:2024-01-02\n'
                                "author:N\nrole:R\n\nx]")


def test_events_are_repeatable(spark):
    as_of = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    make = lambda: tickets.expand_events(spark.range(3), "id", as_of)
    a, b = make().toPandas(), make().toPandas()
    assert a.equals(b) and len(a) == 300 and a["nc_event_seed"].between(0, 35_999).all()
    assert a[["id", "copy"]].drop_duplicates().shape[0] == 300
    for name, values_ in tickets.STYLES.items():
        assert (a[name] == [values_[s % len(values_)] for s in a["nc_event_seed"]]).all()


def test_shared_dir(spark):
    assert shared_dir(spark) and scratch_path(spark, "x") != scratch_path(spark, "x")


def test_repeated_file_names_are_refused(spark, tmp_path):
    df = spark.createDataFrame([("a", "1"), ("b", "2"), ("a", "3")], "d string, t string")
    with pytest.raises(ValueError, match="'a'"):
        files.write_one_file_per_row(df, str(tmp_path), "d", "t")


def test_bytes_that_are_not_utf8_are_reported(spark, tmp_path):
    (tmp_path / "good.txt").write_bytes("été".encode())
    (tmp_path / "bad.txt").write_bytes(b"a\xff\xfeb")
    rows = {r["path"]: (r["text"], r["error"]) for r in files.read_texts(spark, str(tmp_path)).collect()}
    assert rows["/good.txt"] == ("été", None) and rows["/bad.txt"][1] == "not UTF-8" and rows["/bad.txt"][0].startswith("a")


def test_batch_models_get_whole_lists(spark):
    def model(prompts):
        return [ValueError("no") if user == "c" else f"{user}/{len(prompts)}" for _, user in prompts]

    df = spark.createDataFrame([("a",), ("b",), ("c",)], "t string").coalesce(1)
    out = prompts.call_model(df, F.col("t"), batch=model, retries=1).collect()
    assert {r["t"]: (r["_answer"]["response"], r["_answer"]["error"]) for r in out} == {"a": ("a/3", None), "b": ("b/3", None), "c": (None, "ValueError: no")}


def test_plain_models_run_at_once(spark):
    import time

    def model(system, user):
        time.sleep(0.2)
        return user

    started = time.time()
    assert prompts.call_model(spark.range(32).coalesce(1), F.col("id").cast("string"), model, concurrency=16).filter("_answer.response is not null").count() == 32
    assert time.time() - started < 5


def test_summaries_of_several_levels(spark):
    def model(system, user):
        return user.split(": ", 1)[1][::4]

    df = spark.createDataFrame([(1, "abcd" * 100), (1, "short"), (2, None)], "k int, t string")
    out = sorted((r["k"], r["summary"]) for r in prompts.summarise(df, "t", levels=2, size=50, overlap=10, model=model).collect())
    assert [k for k, _ in out] == [1, 1, 2] and out[2][1] == "" and {"so"[:1]} >= {out[1][1][:1]} and len(out[0][1]) < 60


def test_stage_chain_materialises(spark):
    out = prompts.run_stages(spark.range(4), [("a", lambda d: d.withColumn("x", F.lit(1))), ("b", lambda d: d.withColumn("y", F.col("x") + 1))])
    assert "ExistingRDD" in out._jdf.queryExecution().executedPlan().toString() and out.agg(F.sum("y")).first()[0] == 8


@pytest.mark.parametrize("name", [None, "", "..", "a/b"])
def test_names_that_leave_the_folder_are_refused(spark, tmp_path, name):
    rows = spark.createDataFrame([("good", "x"), (name, "y")], "n string, t string")
    with pytest.raises(ValueError, match="not file names"):
        files.write_one_file_per_row(rows, str(tmp_path / "out"), "n", "t").collect()
    assert not (tmp_path / "out").exists()


def test_an_empty_id_is_an_id(spark):
    rows = spark.createDataFrame([("", 1), ("a", 2)], "id string, o int")
    assert [tuple(r) for r in files.fetch_record(rows, "id", "o", "").collect()] == [("", 1)]


def test_end_of_another_stream_is_not_the_end():
    import threading
    from types import SimpleNamespace

    from fascicle.streaming.incremental import _InputRows

    counter = _InputRows()
    counter.onQueryTerminated(SimpleNamespace(runId="other"))
    timer = threading.Timer(0.3, counter.onQueryTerminated, [SimpleNamespace(runId="mine")])
    timer.start()
    counter.wait_for_end("mine", 20)
    assert counter.ended == {"other", "mine"}
