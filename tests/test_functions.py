"""Column functions on hand-made edge cases."""

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fascicle.functions import jsonops, paths, scalars
from fascicle.functions import text as X


def values(spark, data, expr, kind="string"):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(data)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", expr.alias("y")).orderBy("i").collect()]


def test_blank(spark):
    assert values(spark, [None, "", " \n\t", "a", " a "], scalars.is_blank("x")) == [True, True, True, False, False]
    assert values(spark, [None, " ", "a"], scalars.blank_to("x", "z")) == ["z", "z", "a"]


def test_join_text_treats_missing_as_empty(spark):
    assert values(spark, [None, "b"], scalars.join_text(F.lit("a"), "x", F.lit("c"))) == ["ac", "abc"]


def test_seeded_integers_stay_in_range_and_repeat(spark):
    df = spark.range(2000).select(scalars.seeded_integer(1, "id", low=6, high=37).alias("a"), scalars.seeded_integer(1, "id", low=6, high=37).alias("b"))
    rows = df.collect()
    assert all(r["a"] == r["b"] and 6 <= r["a"] < 37 for r in rows) and len({r["a"] for r in rows}) == 31


def test_pick_wraps(spark):
    assert values(spark, [0, 1, 2, 3, -1], scalars.pick(["p", "q", "r"], "x"), "int") == ["p", "q", "r", "p", "r"]


def test_clamp(spark):
    got = values(spark, ["2", " 3 ", "9", "x", None], scalars.clamp_or_seeded("x", 1, 3, 1, "i"))
    assert got[:2] == [2, 3] and all(1 <= g <= 3 for g in got)


def test_parse_day(spark):
    got = values(spark, ["2024-02-29", "2023-02-29", "", None], scalars.parse_day("x"))
    assert str(got[0]) == "2024-02-29 00:00:00" and got[1:] == [None, None, None]


def test_data_url(spark):
    got = values(spark, ["data:image/png;base64,aGk=", "data:,"], F.decode(scalars.data_url_bytes("x"), "UTF-8"))
    assert got == ["hi", ""]


def test_bound_evaluates_once(spark):
    assert values(spark, [2, 3], scalars.bound(F.col("x"), lambda v: v * v + v), "int") == [6, 12]


NAMES = ["a/x.pdf", "x.PDF", "x_page_0001.md", "x_page_0001-img-3.jpeg", "x_page_0001-img-12.jpeg", "noext"]


def test_paths(spark):
    assert values(spark, NAMES, paths.extension("x")) == ["pdf", "PDF", "md", "jpeg", "jpeg", ""]
    assert values(spark, NAMES, paths.image_number("x")) == [None, None, None, 3, 12, None]
    assert values(spark, NAMES, paths.doc_root("x"))[:3] == ["a/x.pdf", "x.pdf", "x.pdf"]
    assert values(spark, NAMES, paths.has_extension("x", ".pdf")) == [True, True, False, False, False, False]
    assert values(spark, [7, 12345], paths.page_name(F.lit("d"), "x"), "int") == ["d_page_0007.pdf", "d_page_1234.pdf"]


TEXTS = ["", " a  b\na\tb c ", "Ünë ß straße ¡x2!", "one", None, "b a b a"]


def test_words_and_counts(spark):
    assert values(spark, TEXTS, X.words("x")) == [[], ["a", "b", "a", "b", "c"], ["Ünë", "ß", "straße", "¡x2!"], ["one"], None, ["b", "a", "b", "a"]]
    assert values(spark, TEXTS, X.most_common(X.words("x"))) == ["", "a", "Ünë", "one", "", "b"]
    assert values(spark, TEXTS, X.first_by(X.words("x"), True)) == ["", "a", "straße", "one", "", "b"]
    assert values(spark, TEXTS, X.first_by(X.words("x"), False)) == ["", "a", "ß", "one", "", "b"]
    assert values(spark, TEXTS, X.count_chars("x", r"\p{Lu}"))[2] == 1
    assert values(spark, ["", "a.b", "a...!b? ", "."], X.count_runs("x", ".!?")) == [0, 1, 2, 1]
    assert values(spark, ["", "a\nb\n"], X.count_lines("x")) == [1, 3]


def test_most_common_of_one_repeated_word(spark):
    df = spark.range(1).select(F.repeat(F.lit("word "), 300_000).alias("x"))
    assert df.select(X.most_common(X.words("x")).alias("y")).first()["y"] == "word"


def test_letter_tokens_need_word_boundaries(spark):
    assert values(spark, ["Ab a1 été cd_ x-y"], X.letter_tokens("x")) == [["ab", "x", "y"]]


def test_punctuation(spark):
    assert len(X.PUNCTUATION) == 32
    assert values(spark, ["a" + X.PUNCTUATION + "b«c»"], X.strip_punctuation("x")) == ["ab«c»"]


def test_unwrap(spark):
    assert values(spark, ["a\nb\n\nc\fd"], X.unwrap_lines("x")) == ["a b\n\nc\nd"]


def test_alt_text(spark):
    got = values(spark, ["## Title\n* **bold** [link](http://u) | x | --- ```code``` `y`  ", "", None], X.alt_text("x"))
    assert got[0] == "Title bold link x code y" and got[1:] == [X.NO_DESCRIPTION] * 2


def test_describe_images_quotes_ids_and_text(spark):
    images = F.array(F.struct(F.lit("i(1).png").alias("id"), F.lit(r"a $1 \ b").alias("alt")))
    got = values(spark, ["![](i(1).png) ![old](i(1).png) ![](#image-i(1).png) ![](i2.png)"], X.describe_images("x", images))
    assert got == [r"![a $1 \ b](i(1).png) ![a $1 \ b](i(1).png) ![a $1 \ b](#image-i(1).png) ![](i2.png)"]


JSON = ['{"a": 1, "b": {"c": [1, {"d": null}]}}', "[1, 2]", '{"tasks": [{"label": "x]["}]}', '{"a": ', 'text ```json\n{"a": "}"}\n``` end', None, "7", '{"label": "\\"date\\""}']


def test_json_part(spark):
    got = values(spark, JSON, jsonops.json_part("x"))
    assert got[0] == JSON[0] and got[3] is None and got[5] is None and got[6] == "7"
    assert values(spark, JSON, jsonops.is_object("x")) == [True, False, True, False, False, False, False, True]
    assert values(spark, ["Sure ```\n{\"k\": 2}``` x ```{}```"], jsonops.result_or_text("x")) == ['{"k": 2}']


def test_task_array(spark):
    got = values(spark, JSON + ['[{"label": "p"}, {"label": "q"}]'], F.transform(jsonops.task_array("x", T.StructType([T.StructField("label", T.StringType())])), lambda t: t["label"]))
    assert got[2] == ["x]["] and got[3] is None and got[7] == ['"date"'] and got[8] == ["p", "q"]


def test_flatten_discovers_and_indexes(spark):
    df = spark.createDataFrame([(JSON[0],), ('{"a": 2, "b": {"c": [5]}, "e": "t"}',), ("not json",)], "j string")
    out = jsonops.flatten(df, "j", flatten_arrays=False)
    assert {"j_a", "j_b_c", "j_e"} <= set(out.columns)
    assert sorted(r["j_e"] for r in out.collect()) == ["", "", "t"]
    tags = spark.createDataFrame([('["x", "y"]',), ("[]",), (None,)], "t string")
    rows = jsonops.flatten(tags, "t", "array<string>", flatten_arrays=True)
    assert rows.columns == ["t", "t_0", "t_1"] and [tuple(r)[1:] for r in rows.collect()] == [("x", "y"), ("", ""), ("", "")]


def test_flatten_depth_and_names(spark):
    df = spark.createDataFrame([('{"p": {"q": {"r": 1}}}',)], "j string")
    assert jsonops.flatten(df, "j", max_depth=2).columns == ["j", "j_p_q"]
    assert jsonops.flatten(df, "j", prefix=False).columns == ["j", "p_q_r"]
    nested = jsonops.flatten(spark.createDataFrame([('[{"a": [1, 2]}, {"a": [3]}]',)], "j string"), "j", flatten_arrays=True)
    assert nested.columns == ["j", "j_0_a_0", "j_0_a_1", "j_1_a_0"]


def test_descriptions_keep_other_fields(spark):
    df = spark.createDataFrame([([("m ![](i)", [("i", "k")], 9)],)], "p array<struct<markdown:string,images:array<struct<id:string,kind:string>>,no:int>>")
    row = df.select(jsonops.with_image_descriptions("p", F.create_map(F.lit("i"), F.lit("# d"))).alias("p")).first()["p"][0]
    assert row["no"] == 9 and row["images"][0]["description"] == "# d" and row["markdown_alt"] == "m ![d](i)"


@pytest.mark.parametrize("mapping, pattern, want", [([("a", "b"), ("b", "c")], False, "cc.c"), ([("^/", None), (".", "-")], True, "----")])
def test_replace_all_is_ordered(spark, mapping, pattern, want):
    assert values(spark, ["ab.a"], scalars.replace_all("x", mapping, pattern)) == [want]


def test_rules_are_python_patterns_too():
    for pattern, _ in X.ALT_TEXT_RULES:
        re.compile(pattern)


def test_flatten_loses_nothing_where_names_clash(spark):
    df = spark.createDataFrame([('{"a":{"b":1},"a_b":2,"OBJECT":{"x":"y"}}', "kept")], "j string, j_a_b string")
    row = jsonops.flatten(df, "j").first().asDict()
    assert row["j_a_b"] == "kept" and {row["j_a_b_2"], row["j_a_b_3"]} == {1, 2} and row["j_OBJECT_x"] == "y"


def test_flatten_keys_that_differ_in_case(spark):
    df = spark.createDataFrame([('{"a":1,"A":{"b":"x"},"l":[{"k":5}]}',), ("broken",)], "j string")
    rows = [r.asDict() for r in jsonops.flatten(df, "j", flatten_arrays=True).collect()]
    assert rows[0]["j_a"] == 1 and rows[0]["j_A_b"] == "x" and rows[0]["j_l_0_k"] == 5 and rows[1]["j_a"] is None
    clash = spark.createDataFrame([('{"a":1,"A":2}',)], "j string")
    row = jsonops.flatten(clash, "j").first()
    assert sorted(v for k, v in zip(row.__fields__, row) if k != "j") == [1, 2]


def test_flatten_without_valid_json(spark):
    df = spark.createDataFrame([("broken",), (None,)], "j string")
    assert jsonops.flatten(df, "j").columns == ["j"]


def test_second_fenced_block_counts_if_the_first_is_broken(spark):
    text = "see ```json\n{broken}\n``` and ```\n{\"a\": 1}\n```"
    assert spark.createDataFrame([(text,)], "t string").select(jsonops.json_part("t")).first()[0] == '{"a": 1}'


def test_white_space_is_unicode_white_space(spark):
    spaces = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2003\u200a\u2028\u2029\u202f\u205f\u3000"
    texts = ["un\u00a0mot", "a\u2003b  c", spaces, spaces.join("xyz"), "\u200bx", f"{spaces}q{spaces}"]
    for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", X.words("t").alias("w"), scalars.strip("t").alias("s"), scalars.is_blank("t").alias("b")).collect():
        assert (r["w"], r["s"], r["b"]) == (r["t"].split(), r["t"].strip(), not r["t"].strip())


def test_token_runs_count_tokens(spark):
    rows = spark.createDataFrame([(["b", "a", "b", None, "c"],), ([],), (None,)], "t array<string>").select(X.token_runs("t").alias("r")).collect()
    assert [(x["token"], x["n"]) for x in rows[0]["r"]] == [("a", 1), ("b", 2), ("c", 1)] and not rows[1]["r"] and not rows[2]["r"]
