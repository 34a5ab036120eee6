from pyspark.sql import functions as F

from comarca.operators import questions
from tests.conftest import as_rows, as_set


def test_routing(spark):
    asked = [
        ("Which sectors have the most EMPLOYMENT?", "sectors", 2),
        ("industrial sectors", "industry", 3),
        ("what is the population growth", "growth", 2),
        ("people in town", "population_province", 1),
        ("population growth and increase", "growth", 3),
        ("unemployment", "unemployment", 2),
        ("hello", None, 0),
        ("", None, 0),
        (None, None, 0),
    ]
    df = spark.createDataFrame(asked, "text string, wanted string, points int")
    for row in questions.route_questions(df).collect():
        assert (row.template, row.score) == (row.wanted, row.points), row.text
        assert row.report == questions.TEMPLATE_REPORTS.get(row.wanted), row.text
        assert row.description == questions.TEMPLATE_DESCRIPTIONS.get(row.wanted, questions.no_answer()), row.text


def test_every_template_has_a_registered_report():
    import __spark_entry__ as contract

    assert set(questions.TEMPLATE_REPORTS) == set(questions.TEMPLATE_KEYWORDS) == set(questions.TEMPLATE_DESCRIPTIONS)
    assert set(questions.TEMPLATE_REPORTS.values()) <= set(contract.queries())


def test_fenced_sql(spark):
    cases = [
        ("a ```sql\nSELECT 1\n``` b ```sql SELECT 2```", "SELECT 1"),
        ("```\nselect x\nfrom t\n```", "select x\nfrom t"),
        ("```python\nprint()\n``` ```\nSELECT 3```", "SELECT 3"),
        ("```SQL\n\n```", ""),
        ("```SELECT 4``` then ```sql SELECT 5 ```", "SELECT 5"),
        ("no code", None),
        ("```python\nx\n```", None),
        (None, None),
    ]
    df = spark.createDataFrame(cases, "t string, wanted string")
    for row in df.select("t", "wanted", questions.fenced_sql(F.col("t")).alias("found")).collect():
        assert row.found == row.wanted, row.t


def test_last_messages_are_cut_before_roles_are_picked(spark):
    rows = [(1, t, r, "x" * 600) for t, r in enumerate(["user", "system", "assistant", "user", "system"])]
    df = spark.createDataFrame([*rows, (2, 0, "user", "hi")], "conv_id long, turn long, role string, text string")
    found = questions.last_messages(df)
    assert as_set(found, "conv_id", "turn") == {(1, 2), (1, 3), (2, 0)}
    assert {len(r.content) for r in found.where("conv_id = 1").collect()} == {500}


def test_a_long_conversation_is_cut_before_the_shuffle(spark):
    df = spark.range(100_000).select(
        F.floor(F.col("id") / 1_000_000).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.lit("t").alias("text")
    )
    found = questions.last_messages(df)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert sorted(as_rows(found.select("turn"))) == [(99_996,), (99_997,), (99_998,), (99_999,)]
