import pytest

TEXT = "doc_id long, text string"


@pytest.fixture()
def frame(spark):
    """frame(rows): a documents table with an extra column that clashes."""
    def make(rows, schema=TEXT):
        df = spark.createDataFrame(rows, schema)
        for c in ("key", "component_id", "pos"):
            df = df.selectExpr("*", f"'x' AS {c}")
        return df.repartition(3)
    return make
