import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from comarca import schemas
from comarca.operators import combine, duplicates, keys, missing, ordered, sketches
from comarca.sinks.bucketed import bucketed
from tests.conftest import as_rows, as_set


def test_duplicates_over_all_columns(spark):
    df = spark.createDataFrame([(1, 3), (1, 3), (2, 4)], "a long, b long")
    assert as_set(duplicates.drop_duplicates(df)) == {(1, 3), (2, 4)}
    assert as_rows(duplicates.duplicate_counts(df)) == [(3, 1)]


def test_first_of_each_key_is_kept(spark):
    rows = [(None, 5, "x"), (None, 2, "y"), ("k", 9, "z"), ("k", 1, None)]
    df = spark.createDataFrame(rows, "k string, at long, v string")
    kept = duplicates.drop_duplicates(df, ["k"], ["at"])
    assert kept.columns == ["k", "at", "v"]
    assert as_set(kept) == {(None, 2, "y"), ("k", 1, None)}


def test_duplicates_with_a_hot_key(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    kept = duplicates.drop_duplicates(df, ["k"], ["id"])
    assert kept.count() == 20_001
    assert as_rows(kept.where("k = 'hot'")) == [("hot", 0)]


@pytest.fixture
def gaps(spark):
    rows = [(1, 1.0, "a", 4), (2, None, None, None), (3, float("nan"), "b", 6), (4, 3.0, "c", 8)]
    return spark.createDataFrame(rows, "id long, x double, t string, n long")


def test_drop_takes_nan_as_missing(gaps):
    assert as_set(missing.handle_missing(gaps, "drop"), "id") == {(1,), (4,)}
    assert as_set(missing.drop_missing(gaps, ["t"]), "id") == {(1,), (3,), (4,)}


def test_fill_zero_reaches_text(gaps):
    row = missing.handle_missing(gaps, "fill_zero").where("id = 2").first()
    assert tuple(row) == (2, 0.0, "0", 0)
    assert missing.handle_missing(gaps, "fill_zero").where("id = 3").first().x == 0.0


def test_fill_mean(gaps):
    filled = {r.id: (r.x, r.t, r.n) for r in missing.handle_missing(gaps, "fill_mean").collect()}
    assert filled == {1: (1.0, "a", 4.0), 2: (2.0, None, 6.0), 3: (2.0, "b", 6.0), 4: (3.0, "c", 8.0)}


def test_fill_mean_of_an_empty_column_stays_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert as_rows(missing.fill_mean(df)) == [(None,), (None,)]


def test_fill_forward_needs_an_order(gaps):
    with pytest.raises(ValueError):
        missing.handle_missing(gaps, "fill_forward")
    with pytest.raises(ValueError):
        missing.handle_missing(gaps, "guess")


def test_report_counts_removed_rows_or_remaining_cells(gaps):
    after = missing.handle_missing(gaps, "drop")
    assert as_rows(missing.missing_report(gaps, after, "drop")) == [("drop", 4, 2, 4, 0, 2)]
    after = missing.handle_missing(gaps, "fill_mean")
    assert as_rows(missing.missing_report(gaps, after, "fill_mean")) == [("fill_mean", 4, 4, 4, 1, 1)]


def _random_frame(seed, keys, rows):
    draw = random.Random(seed)
    return pd.DataFrame(
        {
            "k": [draw.choice(keys) for _ in range(rows)],
            "at": draw.sample(range(rows * 10), rows),
            "x": [draw.random() if draw.random() < 0.2 else None for _ in range(rows)],
            "t": [draw.choice("abc") if draw.random() < 0.1 else None for _ in range(rows)],
        }
    )


@pytest.mark.parametrize("blocks", [1, 3, 40])
def test_forward_fill_of_the_whole_table(spark, blocks):
    pdf = _random_frame(blocks, ["k"], 500)
    expected = pdf.sort_values("at").set_index("at")[["x", "t"]].ffill()
    df = spark.createDataFrame(pdf, "k string, at long, x double, t string")
    filled = ordered.forward_fill(df, ["x", "t"], ["at"], blocks=blocks)
    found = filled.toPandas().sort_values("at").set_index("at")[["x", "t"]]
    pd.testing.assert_frame_equal(found, expected, check_dtype=False)


@pytest.mark.parametrize("blocks", [None, 1, 2, 25])
def test_forward_fill_within_keys_one_of_them_hot(spark, blocks):
    keys = ["hot"] * 5 + [None, "b", "c", *[f"r{i}" for i in range(8)]]
    pdf = _random_frame(7, keys, 800)
    expected = pdf.sort_values("at").copy()
    expected[["x", "t"]] = expected.groupby("k", dropna=False)[["x", "t"]].ffill()
    df = spark.createDataFrame(pdf, "k string, at long, x double, t string")
    filled = ordered.forward_fill(df, ["x", "t"], ["at"], ["k"], blocks=blocks)
    found = filled.toPandas().sort_values("at")
    pd.testing.assert_frame_equal(
        found.set_index("at")[["x", "t"]], expected.set_index("at")[["x", "t"]], check_dtype=False
    )


def test_forward_fill_of_structs_and_leading_gaps(spark):
    df = spark.createDataFrame([(1, None), (2, [1, 2]), (3, None)], "at long, v array<long>")
    assert as_set(ordered.forward_fill(df, ["v"], ["at"]).select("at", F.to_json("v"))) == {
        (1, None),
        (2, "[1,2]"),
        (3, "[1,2]"),
    }


@pytest.mark.parametrize("blocks", [None, 1, 30])
def test_row_numbers_are_consecutive(spark, blocks):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    numbered = ordered.number_rows(df, ["v"], "n", blocks)
    assert sorted(as_rows(numbered)) == [(i + 1, i) for i in range(1000)]


def test_blocks_of_a_hot_order_key_stay_even(spark):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 10 > 0, F.lit(1)).otherwise(F.col("id")).alias("k"))
    rows = ordered.in_order(df, ["k"], 8)
    sizes = [r["count"] for r in rows.groupBy("_block").count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 2 * 20_000 / 8


def test_ties_fill_alike_in_any_blocks(spark):
    df = spark.range(300).select("id", F.lit(1).alias("at"), F.when(F.col("id") % 7 == 0, F.col("id")).alias("v"))
    filled = [as_set(ordered.forward_fill(df, ["v"], ["at"], blocks=blocks), "id", "v") for blocks in (1, 5, 40)]
    assert filled[0] == filled[1] == filled[2]


def test_running_total(spark):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("n"))
    expected, total = set(), 0
    for i in range(100):
        total += i % 3
        expected.add((i, total))
    assert as_set(ordered.running_total(df, ["id"], "n", "upto", 7), "id", "upto") == expected


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "a long, b string")
    b = spark.createDataFrame([("y", 2.0)], "b string, c double")
    assert as_set(combine.union_by_name([a, b]), "a", "b", "c") == {(1, "x", None), (None, "y", 2.0)}


def test_lookup(spark):
    df = spark.createDataFrame([("Coruña",), ("Lugo",), ("Ceuta",), (None,)], "provincia string")
    assert as_set(combine.lookup_codes(df)) == {("Coruña", 15), ("Lugo", 27), ("Ceuta", None), (None, None)}


def test_dimensions_and_their_join(spark):
    rows = [(1, "A", "01001", "m1", 5), (1, "A", "01001", "m1", 6), (2, "B", "02020", "m2", 7), (None, None, None, None, 8)]
    facts = spark.createDataFrame(
        rows, "codigo_provincia long, nombre_provincia string, codigo_municipio string, nombre_municipio string, n long"
    )
    assert as_set(combine.province_dimension(facts).drop("created_at")) == {(1, "A"), (2, "B")}
    dim = combine.municipality_dimension(facts)
    assert as_set(dim.drop("created_at")) == {(1001, "01001", "m1", 1), (2020, "02020", "m2", 2)}
    assert dict(dim.dtypes)["id_municipio"] == "int"
    joined = combine.attach_dimension(facts.select("codigo_municipio", "n"), dim, "codigo_municipio", ["id_municipio"])
    assert as_set(joined, "n", "id_municipio") == {(5, 1001), (6, 1001), (7, 2020), (8, None)}


def test_municipality_keys_stay_when_codes_are_added(spark, tmp_path):
    codes = ["x1", "01001", "12", "1234567890", "001001", "1001", None]
    rows = [(1, code, "m") for code in codes]
    layout = "codigo_provincia int, codigo_municipio string, nombre_municipio string"
    table = keys.KeyTable(spark, str(tmp_path / "keys"))
    few = as_set(combine.municipality_dimension(spark.createDataFrame(rows[:2], layout), keys=table), "codigo_municipio", "id_municipio")
    assert few == {("01001", 1001), ("x1", -1)}
    every = as_set(combine.municipality_dimension(spark.createDataFrame(rows, layout), keys=table), "codigo_municipio", "id_municipio")
    # 001001 came after 01001, which has their number; 1001 has too few digits for one.
    assert every == few | {("001001", -2), ("1001", -3), ("12", -4), ("1234567890", -5)}
    assert as_set(table.keys()) == every
    again = combine.municipality_dimension(spark.createDataFrame(rows[2:5], layout), keys=table)
    assert as_set(again, "codigo_municipio", "id_municipio") == {r for r in every if r[0] in codes[2:5]}
    # Without a table of earlier keys the shorter of two codes with one number has it.
    alone = combine.municipality_dimension(spark.createDataFrame(rows[1:5:3], layout))
    assert as_set(alone, "codigo_municipio", "id_municipio") == {("01001", 1001), ("001001", -1)}


def test_codes_of_any_form_get_keys_of_their_own(spark, tmp_path):
    some = spark.range(200_000).select(F.concat(F.lit("code "), F.col("id") * 7).alias("code"))
    more = spark.range(150_000).select(F.when(F.col("id") % 3 == 0, F.lpad("id", 6, "0")).otherwise(F.concat(F.lit("code "), F.col("id"))).alias("code"))
    table = keys.KeyTable(spark, str(tmp_path / "keys"))
    first = table.extend(some.union(some.limit(1000)))
    assert dict(first.dtypes)["key"] == "int"
    assert tuple(first.agg(F.count("*"), F.countDistinct("code"), F.countDistinct("key"), F.min("key"), F.max("key")).first()) == (200_000,) * 3 + (-200_000, -1)
    # What an extension that broke left is no part of the keys, and is written over.
    first.limit(5).write.parquet(f"{tmp_path}/keys/000001")
    (tmp_path / "keys/000001/_SUCCESS").unlink()
    assert table.keys().count() == 200_000
    both = table.extend(more)
    known = some.union(more).distinct().count()
    assert tuple(both.agg(F.count("*"), F.countDistinct("code"), F.countDistinct("key")).first()) == (known,) * 3
    assert first.exceptAll(both).isEmpty() and both.where("key >= 0 AND int(code) <> key").isEmpty()
    assert table.extend(some).count() == known


def test_declared_columns_and_types(spark):
    facts = spark.sql("SELECT 7L AS id, '01001' AS codigo_municipio, 'Total' AS sexo, 2023L AS periodo, 5.0D AS total_poblacion, 1 AS other")
    found = combine.conform(facts, "fact_poblacion_municipio")
    assert found.columns == schemas.STAR_SCHEMA["fact_poblacion_municipio"].names
    assert tuple(found.first()) == (7, None, "01001", "Total", 2023, 5, None)
    long = facts.withColumn("sexo", F.lit("x" * 21))
    with pytest.raises(Exception, match="sexo is longer than 20"):
        combine.conform(long, "fact_poblacion_municipio").collect()


def test_bucketed_facts_are_joined_where_they_lie(spark):
    facts = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("n"))
    dim = spark.range(15_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = combine.join_bucketed(bucketed(facts, "k", 4), bucketed(dim, "k", 4), "k")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert joined.count() == 20_000 and joined.where("k < 15000 AND v <> 2 * k").isEmpty()
    assert joined.where("v IS NULL").count() == facts.where("k >= 15000").count()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


def test_sketches_merge_to_counts_of_whole_spans(spark):
    rows = spark.range(60_000).select((F.col("id") % 5 + 2000).alias("y"), (F.col("id") * 7 % 30_011).alias("m"), (F.col("id") % 3).alias("p"))
    rows = rows.union(spark.createDataFrame([(2000, None, 0)], rows.schema))
    stored = sketches.distinct_sketches(rows, "m", ["p", "y"])
    merged = {r.p: r.estimate for r in sketches.merged_counts(stored.where("y >= 2002"), ["p"]).collect()}
    exact = {r.p: r.n for r in rows.where("y >= 2002").groupBy("p").agg(F.countDistinct("m").alias("n")).collect()}
    assert merged.keys() == exact.keys()
    for p, n in exact.items():
        assert abs(merged[p] - n) <= spark.range(1).select(sketches.largest_error(F.lit(n))).first()[0]


def test_dimension_join_without_broadcast(spark):
    facts = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("n")
    )
    dim = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = combine.attach_dimension(facts, dim, "k", ["v"])
        assert joined.count() == 20_000
        assert joined.where("v != 2 * k OR v IS NULL").isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_equal_rows_fill_several_blocks(spark):
    rows = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("v")
    )
    placed = ordered.in_order(rows, ["k"], blocks=8)
    sizes = [r["count"] for r in placed.groupBy("_block").count().collect()]
    assert sum(sizes) == 90_000 and max(sizes) <= 2 * 90_000 / 8
    numbered = ordered.number_rows(rows, ["k"], blocks=8)
    assert tuple(numbered.agg(F.count("*"), F.countDistinct("id"), F.min("id"), F.max("id")).first()) == (90_000, 90_000, 1, 90_000)
    assert numbered.where("k = -1").agg(F.max("id")).first()[0] == 30_000
    filled = ordered.forward_fill(rows.withColumn("k", F.col("k") % 2), ["v"], ["k"], blocks=8)
    assert filled.count() == 90_000
