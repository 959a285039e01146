import math

import pytest

from urbanlens.operators import sentiment as S

LEX = {"good": 1.9, "bad": -2.5, "great": 3.1}


def score(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    lex = spark.createDataFrame(list(LEX.items()), "token string, valence double")
    out = S.sentiment_score(df, "id", "t", lex)
    return {r.id: r.compound for r in out.collect()}


def norm(x):
    return round(x / math.sqrt(x * x + 15), 4)


@pytest.mark.parametrize("text,raw", [
    ("good", 1.9),
    ("very good", 1.9 + 0.293),
    ("very nice good", 1.9 + 0.293 * 0.95),
    ("very nice day good", 1.9 + 0.293 * 0.9),
    ("not good", 1.9 * -0.74),
    ("not nice good", 1.9 * -0.74),
    ("not nice day good", 1.9 * -0.74),
    ("good but bad", 1.9 * 0.5 - 2.5 * 1.5),
    ("GOOD day", 1.9 + 0.733),
    ("at least good", 1.9),
    ("least good", 1.9 * -0.74),
    ("no word here", 0.0),
])
def test_rules(spark, text, raw):
    assert score(spark, [text])[0] == pytest.approx(norm(raw), abs=1e-4)


def test_empty_and_null(spark):
    got = score(spark, ["", None])
    assert got[0] == 0.0 and got[1] is None


def test_all_caps_text_has_no_emphasis(spark):
    assert score(spark, ["GOOD DAY"])[0] == pytest.approx(norm(1.9), abs=1e-4)


def test_no_python_udf_in_plan(spark):
    df = spark.createDataFrame([(1, "good")], "id long, t string")
    lex = spark.createDataFrame(list(LEX.items()), "token string, valence double")
    plan = S.sentiment_score(df, "id", "t", lex)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
