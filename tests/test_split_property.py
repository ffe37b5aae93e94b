"""Property: jvm_split agrees with Java's String.split(sep) (limit 0)."""

from hypothesis import given, settings
from hypothesis import strategies as st

from vigil.functions.text import jvm_split, words


def java_split(s: str, sep: str) -> list[str]:
    if s == "":
        return [""]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text(alphabet="ab ,\n", max_size=12), min_size=1, max_size=60))
def test_jvm_split_matches_java(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "v STRING")
    got = df.select("v", jvm_split("v", ",").alias("c"), words("v").alias("w")).collect()
    for r in got:
        assert r["c"] == java_split(r["v"], ","), r["v"]
        assert r["w"] == java_split(r["v"], " "), r["v"]
