import pytest


@pytest.fixture(scope="session")
def rows(spark):
    """Build a table with clashing extra columns: names that the operators use inside."""
    from pyspark.sql import functions as F

    def make(data, schema):
        return spark.createDataFrame(data, schema).withColumns({c: F.lit("extra") for c in (
            "code", "root", "hash", "id", "next_text", "verdict", "piece", "_first", "_last", "cut_first", "span_id", "span_hash", "_bad_id", "bad_id", "bad_hash", "_kept_id", "kept_id",
            "own_code", "place", "_own_0", "s", "x", "key", "block", "side", "windows", "rep", "edge", "spans", "label_pred") if c not in schema.replace(",", " ").split()})
    return make
