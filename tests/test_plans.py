"""What the optimizer makes of the operators."""

import pytest

from fascicle.catalog import cases

CASES = cases()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["left_join_five_keys", "vocabulary_semi_join", "similarity_top_k", "corpus_pareto", "most_frequent_value",
                                  "multiply_rows", "expanded_events", "binned_quantity_by_flag", "class_balanced_sample", "closest_key_lookup"])
def test_no_cross_joins(spark, small, name):
    plan = plan_of(CASES[name].run(spark, small))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filters_and_columns_reach_the_scan(spark, small):
    plan = plan_of(CASES["conjunctive_rules"].run(spark, small))
    assert "GreaterThan(n_chars,200)" in plan and "text" not in plan.split("ReadSchema")[1]
    from fascicle.operators.retrieval import metadata_filter
    from fascicle.session import load

    plan = plan_of(metadata_filter(load(spark, small, "embeddings"), label=[1, 3, 5]).select("vec_id"))
    assert "PushedFilters: [In(label, [1,3,5])]" in plan


def test_row_local_jobs_have_no_shuffle(spark, small):
    from fascicle.functions.text import alt_text
    from fascicle.operators import chunking, corpus, generate
    from fascicle.session import load

    docs = load(spark, small, "documents")
    for df in (corpus.document_profile(docs, "doc_id", "text"), generate.multiply(docs.select("doc_id"), 100),
               docs.select(alt_text("text")), chunking.fixed_chunks(docs.select("doc_id", "text"), "text"),
               chunking.recursive_chunks(docs.select("doc_id", "text"), "text"), CASES["flatten_json_with_schema"].run(spark, small)):
        assert "Exchange" not in plan_of(df)


def test_only_the_last_hash_range_of_a_class_is_ranked(spark, small):
    plan = plan_of(CASES["class_balanced_sample"].run(spark, small))
    whole, ranked = plan[:plan.index("Window [")], plan[plan.index("Window ["):]
    assert plan.count("Window [") == 1 and "hashpartitioning" not in whole and "_area" in ranked


def test_row_local_documents(spark, small):
    for name in ("chunk_filter_and_fold", "ticket_documents", "document_term_matrix", "letter_term_matrix", "words_per_document", "term_document_matrix", "recursive_chunks"):
        assert "Exchange" not in plan_of(CASES[name].run(spark, small)), name


def test_pareto_window_over_terms_is_partitioned(spark, small):
    plan = plan_of(CASES["part_name_pareto"].run(spark, small))
    over_terms = [line for line in plan.splitlines() if "Window [sum(_v0" in line]
    assert over_terms and all("_pid" in line for line in over_terms)


def test_explode_does_not_repeat_its_input(spark, small):
    plan = plan_of(CASES["ticket_task_chunks"].run(spark, small))
    assert "Filter (size(" not in plan


@pytest.mark.parametrize("name, calls", [("document_ingest", 1), ("recursive_chunks", 1), ("stable_nouns", 1), ("row_wise_completion", 1), ("entity_table", 0)])
def test_python_runs_once_per_row(spark, small, name, calls):
    plan = plan_of(CASES[name].run(spark, small))
    assert plan.count("ArrowEvalPython") == calls and "BatchEvalPython" not in plan


def test_json_text_is_parsed_once(spark, small):
    plan = plan_of(CASES["flatten_json_with_schema"].run(spark, small))
    assert plan.count("from_json") == 1


def test_folded_documents_are_computed_once(spark, small):
    from fascicle.catalog import cases

    for name, part in (("chunk_filter_and_fold", "sequence"), ("ticket_documents", "analysis_history")):
        found = cases()[name].run(spark, small)
        lines = found._jdf.queryExecution().executedPlan().toString().splitlines()
        assert not [line for line in lines if "Filter" in line and part in line], name
