"""What a Python worker holds while it cuts texts."""

from staylytics import constants as C
from staylytics.operators import chunking


def test_pieces_are_cut_row_by_row(spark):
    df = spark.createDataFrame([("a b " * 600,), ("",), (None,)], "text string")
    out = chunking.by_separators(df, "text")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan  # Arrow batches are 10,000 texts, however long
    found = [r["chunks"] for r in out.collect()]
    assert "".join("".join(c.split()) for c in found[0]) == "ab" * 600 and max(map(len, found[0])) <= C.CHUNK_SIZE
    assert found[1:] == [[], []]
