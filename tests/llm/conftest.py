import pytest


@pytest.fixture
def frame(spark):
    """frame(rows, ddl) as a DataFrame of a few partitions, with columns of clashing names if asked."""

    def make(rows, ddl, clash=True, parts=3):
        df = spark.createDataFrame(rows, ddl).repartition(parts)
        if clash:
            for name in ("did", "th", "h", "w", "n", "fp", "rep", "length", "piece", "share", "toxic_", "_text", "_found", "block", "v"):
                if name not in df.columns:
                    df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return make
