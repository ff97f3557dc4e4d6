"""Correlations where a column does not vary, as the capped occupancy of large tables."""

import duckdb

from staylytics.operators import features


def test_constant_columns_are_as_in_sql(spark):
    rows = [(float(i), float(i % 3), 100.0, None if i % 2 else float(i), 7.0 if i % 2 else float(i)) for i in range(20)]
    names = ["a", "b", "c", "d", "e"]
    got = [tuple(r) for r in features.top_correlations(spark.createDataFrame(rows, "a double, b double, c double, d double, e double"), names, 10).collect()]
    table = ", ".join(str(tuple("NULL" if x is None else x for x in r)).replace("'", "") for r in rows)
    pairs = " UNION ALL ".join(f"SELECT '{x}' AS x, '{y}' AS y, round(abs(corr({x}, {y})), 6) AS v FROM t" for i, x in enumerate(names) for y in names[i + 1:])
    sql = f"WITH t(a, b, c, d, e) AS (SELECT a::DOUBLE, b::DOUBLE, c::DOUBLE, d::DOUBLE, e::DOUBLE FROM (VALUES {table}) v(a, b, c, d, e)) SELECT * FROM ({pairs}) ORDER BY v DESC, x, y"
    assert str(got) == str(duckdb.sql(sql).fetchall()) and sum(v != v for _, _, v in got) == 4


def test_no_rows_have_none(spark):
    assert features.top_correlations(spark.createDataFrame([], "a double, b double"), ["a", "b"]).collect() == []
