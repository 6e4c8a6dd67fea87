"""Numbering in a stated order sorts short rows."""

from pyspark.sql import functions as F

from dimweave.operators import keys
from dimweave.sources.scratch import materialize


def test_rows_are_sorted_without_their_path(spark, monkeypatch):
    sorted_rows = []
    monkeypatch.setattr(keys, "materialize", lambda df, label: sorted_rows.append(df) or materialize(df, label))
    written = materialize(spark.range(0, 4000, 1, 5).select((F.col("id") % 3).alias("k"), F.col("id").alias("v")), "copies")
    numbered = keys.number_in_order(written, "sk", 10, ["k"])
    node = sorted_rows[0]._jdf.queryExecution().optimizedPlan()
    while node.getClass().getSimpleName() != "Sort":
        node = node.children().apply(0)
    kinds = [node.output().apply(i).dataType().typeName() for i in range(node.output().length())]
    assert "string" not in kinds
    # Rows that are equal in the order keep the order of their files and of the rows within.
    found = [(r["k"], r["v"]) for r in numbered.orderBy("sk").collect()]
    assert found == sorted(found)
    assert [r["sk"] for r in numbered.orderBy("sk").collect()] == list(range(11, 4011))
