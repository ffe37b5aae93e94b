"""Parsing, one-hot, z-score and scaler micro-cases (FIXTURES.md §4)."""

import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vigil.functions.text import jvm_split, words
from vigil.operators import features, parsing


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value STRING")


def test_drop_parse(spark):
    out = parsing.parse_numeric(lines(spark, "1,tcp,http,SF,2,3,normal")).collect()
    assert out[0]["label"] == "normal"
    assert out[0]["features"] == [1.0, 2.0, 3.0]


def test_label_of_and_histogram(spark):
    from vigil.operators.evaluation import label_histogram

    df = lines(spark, "1,a,b,c,2,x", "1,a,b,c,2,y", "1,a,b,c,2,y")
    assert [tuple(r) for r in label_histogram(df).collect()] == [("y", 2), ("x", 1)]


def test_one_hot_order(spark):
    df = lines(spark, "1,tcp,http,SF,2,a", "5,udp,dns,S0,6,b")
    d = features.Dictionary.fit(df)
    assert d.categories == {1: ("tcp", "udp"), 2: ("dns", "http"), 3: ("S0", "SF")}
    out = {r["label"]: r["features"] for r in features.one_hot_features(df, d).collect()}
    assert out["a"] == [1, 1, 0, 0, 1, 0, 1, 2]
    assert out["b"] == [5, 0, 1, 1, 0, 1, 0, 6]


def test_category_dictionary_table(spark):
    df = lines(spark, "1,tcp,http,SF,2,a", "5,udp,dns,S0,6,b", "5,udp,dns,S0,6,b")
    rows = sorted(tuple(r) for r in features.category_dictionary(df).collect())
    assert rows == [(1, "tcp", 0), (1, "udp", 1), (2, "dns", 0), (2, "http", 1),
                    (3, "S0", 0), (3, "SF", 1)]


def test_split_semantics(spark):
    df = spark.createDataFrame([("a,b,,",), ("a,,b",), (",,,",), ("",)], "v STRING")
    got = [r[0] for r in df.select(jvm_split("v", ",")).collect()]
    assert got == [["a", "b"], ["a", "", "b"], [], [""]]
    df = spark.createDataFrame([("a b  c ",), ("   ",)], "v STRING")
    got = [r[0] for r in df.select(words("v")).collect()]
    assert got == [["a", "b", "", "c"], []]


def test_multichar_separator(spark):
    df = spark.createDataFrame([("a::b::::",)], "v STRING")
    assert df.select(jvm_split("v", "::")).first()[0] == ["a", "b"]


def test_bad_number_strict_and_permissive(spark):
    df = lines(spark, "x,tcp,http,SF,2,normal")
    with pytest.raises(PySparkException):
        parsing.parse_numeric(df).collect()
    out = parsing.parse_numeric(df, mode="permissive").first()
    assert out["features"][0] is None and out["features"][1] == 2.0


def test_unseen_category(spark):
    train = lines(spark, "1,tcp,http,SF,2,a")
    d = features.Dictionary.fit(train)
    new = lines(spark, "1,udp,http,SF,2,a")
    with pytest.raises(PySparkException):
        features.one_hot_features(new, d).collect()
    kept = features.one_hot_features(new, d, handle_invalid="keep").first()["features"]
    assert kept == [1.0, 0.0, 1.0, 1.0, 2.0]
    assert features.one_hot_features(new, d, handle_invalid="skip").count() == 0


def vec(spark, *rows):
    return spark.createDataFrame([([float(x) for x in r],) for r in rows], "features ARRAY<DOUBLE>")


def test_zscore_population(spark):
    df = vec(spark, [1, 5], [2, 5], [4, 5])
    st = features.Stats.fit(df)
    assert st.mean[0] == pytest.approx(2.333333, abs=1e-6)
    assert st.sd[0] == pytest.approx(1.247219, abs=1e-6)
    assert st.sd[1] == 0.0
    z = [r[0] for r in features.zscore(df, st).collect()]
    assert [round(v[0], 4) for v in z] == [round((x - 7 / 3) / st.sd[0], 4) for x in (1, 2, 4)]
    assert all(v[1] == 0.0 for v in z)


def test_standard_scaler_sample_sd(spark):
    df = vec(spark, [1, 5], [2, 5], [4, 5])
    out = [r[0] for r in features.standard_scale(df).collect()]
    assert [round(v[0], 4) for v in out] == [-0.8729, -0.2182, 1.0911]
    assert all(v[1] == 0.0 for v in out)


def test_column_stats_table(spark):
    df = vec(spark, [1, 5], [2, 5], [4, 5])
    rows = {r["dim"]: r for r in features.column_stats(df).collect()}
    assert rows[0]["n"] == 3 and rows[0]["mean"] == pytest.approx(7 / 3)
    assert rows[0]["sd_pop"] == pytest.approx(math.sqrt(14 / 9))


def test_random_projection_rows_unit_norm(spark):
    m = features.projection_matrix(4, 3, seed=7)
    assert [round(float((r * r).sum()), 12) for r in m] == [1.0] * 4
    df = vec(spark, [1, 0, 0, 0], [0, 2, 0, 0])
    out = features.random_projection(df, m).collect()
    assert [out[0]["x"], out[0]["y"], out[0]["z"]] == pytest.approx(list(m[0]))
    assert [out[1]["x"], out[1]["y"], out[1]["z"]] == pytest.approx(list(2 * m[1]))


def test_assignment_export_round_trip(spark, scratch):
    from vigil.sources.records import read_assignments, write_assignments

    df = spark.createDataFrame([(1, [1.5, 1e7]), (0, [0.25, -3.0])],
                               "cluster INT, features ARRAY<DOUBLE>")
    write_assignments(df, f"{scratch}/out")
    back = sorted(tuple((r[0], tuple(r[1]))) for r in read_assignments(spark, f"{scratch}/out").collect())
    assert back == [(0, (0.25, -3.0)), (1, (1.5, 1e7))]
    assert F is not None


def test_spread_runs_no_job(spark):
    from pyspark.sql import functions as F

    from conftest import SF0001
    from vigil.session import spread

    li = spark.read.parquet(f"{SF0001}/lineitem.parquet")
    emb = spark.read.parquet(f"{SF0001}/embeddings.parquet")
    txt = spark.read.text(f"{SF0001}/lineitem.parquet")
    sc = spark.sparkContext
    sc.setJobGroup("spread-probe", "spread must not run jobs")
    try:
        spread(li.select("l_orderkey", "l_quantity"))
        spread(emb.select("vec_id", F.col("embedding").cast("array<double>")))
        spread(txt)
        assert sc.statusTracker().getJobIdsForGroup("spread-probe") == []
    finally:
        sc.setJobGroup("", "")


def test_valid_rows_after_permissive_parse(spark):
    df = lines(spark, "x,tcp,http,SF,2,a", "1,tcp,http,SF,2,b")
    parsed = parsing.valid_rows(parsing.parse_numeric(df, mode="permissive"))
    assert [r["label"] for r in parsed.collect()] == ["b"]


def test_custom_positions_and_separator(spark):
    df = lines(spark, "7|8|red|9|yes||", "1|2|blue|3|no")
    parsed = parsing.parse_numeric(df, categorical=(2,), sep="|").collect()
    assert [(r["label"], r["features"]) for r in parsed] == [("yes", [7.0, 8.0, 9.0]),
                                                              ("no", [1.0, 2.0, 3.0])]
    d = features.Dictionary.fit(df, categorical=(2,), sep="|")
    assert d.categories == {2: ("blue", "red")}
    enc = features.one_hot_features(df, d, sep="|").collect()
    assert [r["features"] for r in enc] == [[7, 8, 0, 1, 9], [1, 2, 1, 0, 3]]


def test_no_caps_and_length_checks(spark):
    df = lines(spark, *[f"1,c{i},x,p,2,l" for i in range(12_000)])
    assert features.category_dictionary(df).filter("field = 1").count() == 12_000
    assert len(features.Dictionary.fit(df).categories[1]) == 12_000
    wide = vec(spark, [float(i) for i in range(5000)], [float(i + 1) for i in range(5000)])
    stats = features.Stats.fit(wide)
    assert [sorted({round(x, 6) for x in r[0]}) for r in features.zscore(wide, stats).collect()] == [[-1.0], [1.0]]
    projected = features.random_projection(wide, features.projection_matrix(5000, 3, seed=1))
    assert projected.columns == ["x", "y", "z"] and projected.count() == 2
    with pytest.raises(ValueError):
        features.Stats.fit(vec(spark, [1, 2], [1, 2, 3, 4]))
    with pytest.raises(PySparkException):
        features.zscore(vec(spark, [1, 2, 3]), features.Stats((0.0, 0.0), (1.0, 1.0), 1)).collect()


def test_field_count(spark):
    for short in ("1,tcp", "1,a,b,c"):
        with pytest.raises(PySparkException):
            parsing.parse_numeric(lines(spark, short)).collect()
    assert parsing.parse_numeric(lines(spark, ",,,,"), mode="permissive").first()["label"] is None
