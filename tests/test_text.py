from __future__ import annotations

import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexloom.functions import (
    clean_tokens,
    join_tokens,
    parse_date,
    parse_year,
    period_number,
    rule_tokenise,
    shrink,
    split_tokens,
    token_rules,
    tokenise,
    without_words,
)
from lexloom.operators.rows import (
    among,
    complete_rows,
    exact_length,
    group_counts,
    null_profile,
    with_tokens,
)

QUICK = settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_clean_tokens_drops_null_empty_and_short_and_keeps_commas(spark):
    df = spark.createDataFrame(
        [(0, None), (1, []), (2, ["A,b", "C"]), (3, [None, "x"]), (4, ["", "only"])],
        "id int, t array<string>",
    ).orderBy("id")
    assert values(df, clean_tokens("t")) == [None, [], ["a,b", "c"], ["x"], ["only"]]
    assert values(df, clean_tokens("t", 3)) == [None, [], ["a,b"], [], ["only"]]


def test_rows_with_fewer_than_two_tokens_go(spark):
    df = spark.createDataFrame(
        [(0, None), (1, []), (2, ["A", "b"]), (3, ["only"]), (4, ["b", "stop", "c"])],
        "id int, t array<string>",
    )
    made = with_tokens(df, clean_tokens("t"), stop_words=["STOP"]).orderBy("id")
    assert [(r.id, r.tokens) for r in made.collect()] == [(2, ["a", "b"]), (4, ["b", "c"])]


def test_tokens_are_made_once(spark):
    df = spark.createDataFrame([("one two three",)], "text string")
    plan = with_tokens(df, tokenise("text", 3))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_stop_words_ignore_case_and_keep_repetition(spark):
    df = spark.createDataFrame([(["The", "a", "the", "a", None],)], "t array<string>")
    assert values(df, without_words("t", ["THE"])) == [["a", "a", None]]
    assert values(df, without_words("t", ["the"], case_sensitive=True)) == [
        ["The", "a", "a", None]
    ]
    assert values(df, without_words("t", [])) == [["The", "a", "the", "a", None]]


@QUICK
@given(st.lists(st.text(alphabet="aBß é1.,\n\tÉ漢", max_size=30), min_size=1, max_size=10))
def test_tokenise_equals_splitting(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    split = F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda t: F.length(t) >= 2)
    assert values(df, tokenise("text", 2)) == values(df, split)


def test_join_and_split(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],), (None,)], "t array<string>")
    assert values(df, join_tokens("t")) == ["a,b", "", ""]
    assert values(df, split_tokens(join_tokens("t"))) == [["a", "b"], [], []]


def test_shrink(spark):
    df = spark.createDataFrame([("  a \n\t b  ",)], "t string")
    assert values(df, shrink("t")) == ["a b"]


def test_dates_and_periods(spark):
    df = spark.createDataFrame(
        [(0, "03/07/1989", "period 9"), (1, "2012-03-01", "period review 9"), (2, None, None)],
        "id int, d string, p string",
    ).orderBy("id")
    assert values(df, parse_date("d")) == [datetime.date(1989, 7, 3), None, None]
    assert values(df, parse_year("d")) == [1989, None, None]
    assert values(df, period_number("p")) == [9, None, None]


def test_null_profile(spark):
    df = spark.createDataFrame(
        [(None, 1), ("NULLABLE", None), ("nullify", 3), ("", 4)], "t string, n int"
    )
    assert null_profile(df).first().asDict() == {"t": 3, "n": 1}


def test_complete_rows_looks_at_kept_columns_only(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "y", None)], "a int, b string, c string")
    assert [r.a for r in complete_rows(df, ["b", "absent"]).collect()] == [1]
    assert complete_rows(df).count() == 0


def test_group_counts_of_a_null_key(spark):
    df = spark.createDataFrame([("x",), ("x",), (None,)], "k string")
    assert {r.k: r.n for r in group_counts(df, ["k"], "k").collect()} == {"x": 2, None: 0}
    assert among(df, "k", ["x", None]).count() == 2


def test_exact_length(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0],), (None,)], "v array<double>")
    assert exact_length(df, "v", 2).count() == 1


RULE_CASES = [
    (None, None),
    ("", []),
    (" \n\t ", []),
    ("Well-known, isn't it?", ["Well-known", ",", "isn't", "it", "?"]),
    ("(He said: \"no.\")", ["(", "He", "said", ":", '"', "no", ".", '"', ")"]),
    ("L'eau qu’il n'aime", ["L'", "eau", "qu’", "il", "n'", "aime"]),
    ("aujourd'hui and/or AT&T", ["aujourd'hui", "and/or", "AT&T"]),
    ("in the U.S.A. today.", ["in", "the", "U.S.A.", "today", "."]),
    ("3.14 1.000.000 10%", ["3.14", "1.000.000", "10", "%"]),
    ("z.B. Dr. No, e.g.", ["z.B.", "Dr.", "No", ",", "e.g."]),
    ("-- 'a' b--c", ["-", "-", "'", "a", "'", "b", "-", "-", "c"]),
    ("Straße e\u0301t\u00e9 日本語。", ["Straße", "e\u0301t\u00e9", "日本語", "。"]),
    ("x\u00a0y\u3000z 😀!", ["x", "y", "z", "😀", "!"]),
    ("a.b. a..b", ["a.b", ".", "a", ".", ".", "b"]),
]


def test_tokens_by_rules(spark):
    rules = token_rules(["e.g.", "z.B.", "Dr."])
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(RULE_CASES)], "i int, t string")
    found = df.select("i", rule_tokenise("t", rules).alias("x")).orderBy("i").collect()
    assert [r.x for r in found] == [tokens for _, tokens in RULE_CASES]
    (plain,) = df.filter("i = 5").select(rule_tokenise("t", token_rules(joiners="", elided=()))).first()
    assert plain == ["L", "'", "eau", "qu", "’", "il", "n", "'", "aime"]
    with pytest.raises(ValueError, match="end in a symbol"):
        token_rules(["etc"])
