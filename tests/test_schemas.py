"""C1-C8."""

import pytest
from pyspark.sql import functions as F, types as T

from changeflow.operators import changelog as C, schemas as S
from changeflow.operators.routing import qualified_patterns, select_tables
from conftest import rows


def ddl(text):
    return T.StructType.fromDDL(text)


def test_schema_string():
    got = S.parse_schema_string("user_id:string, score:INT,timestamp:long,amount:decimal(10, 2),x:float,y:blob")
    assert got == ddl("user_id STRING, score INT, timestamp BIGINT, amount DECIMAL(10,2), x DOUBLE, y STRING")
    for bad in ("a", "a:int,,b:int", ":int"):
        with pytest.raises(ValueError):
            S.parse_schema_string(bad)


def test_evolve_allows_and_refuses():
    old = T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("f", T.FloatType())])
    got = S.evolve(old, ddl("id BIGINT, g STRING"))
    assert got == T.StructType([T.StructField("id", T.LongType(), True), T.StructField("f", T.FloatType(), True),
                                T.StructField("g", T.StringType(), True)])
    assert S.evolve(ddl("a BIGINT"), ddl("a INT")) == ddl("a BIGINT")
    assert S.evolve(ddl("a INT"), ddl("a DOUBLE")) == S.evolve(ddl("a DOUBLE"), ddl("a INT")) == ddl("a DOUBLE")
    with pytest.raises(ValueError):
        S.evolve(ddl("a STRING"), ddl("a INT"))


@pytest.mark.parametrize("values,want", [
    (["1", "2"], "int"), (["1", "3000000000"], "bigint"), (["1", "1.5"], "double"), (["true", "false"], "boolean"),
    (["true", "1"], "string"), (["null", "null"], "string"), (["null", "7"], "int"), (['"x"', "1"], "string"),
    (["{}", "1"], "string"), (["[1]"], "string"), (["1e3", "2"], "double"), (["123456789012345678901"], "string"),
])
def test_inference_is_independent_of_order(spark, values, want):
    for order in (values, values[::-1]):
        df = spark.createDataFrame([("t", f'{{"a":{v}}}') for v in order], "_table STRING, value STRING")
        assert rows(S.infer_schema(df).select("column_name", "data_type")) == [("a", want)]


def test_versions_include_a_return_to_an_old_schema(spark):
    for width in (1, 3, 50):
        data = [("t", i, "AB"[(i // width) % 2]) for i in range(300)] + [("u", 5, "A"), ("u", 9, "A")]
        df = spark.createDataFrame(data, "_table STRING, _order INT, schema STRING").repartition(5)
        got = rows(S.schema_versions(df).orderBy("_table", "_order"))
        want, last = [], {}
        for t, o, s in sorted(data):
            if last.get(t) != s:
                want.append((t, o, s))
            last[t] = s
        assert got == want


def test_not_null_heuristic_can_keep_a_stale_row(spark):
    """A NOT NULL column that is no key makes a second row of an updated one."""
    data = [(1, "a", "+I", 1), (1, "b", "+U", 2)]
    changes = spark.createDataFrame(data, "id INT, name STRING, _kind STRING, _order INT") \
        .withColumn("_table", F.lit("t")).withColumn("_ts_ms", F.lit(0))
    specs = [S.ColumnSpec("id", "int32", optional=False), S.ColumnSpec("name", optional=False)]
    assert C.current_state(changes, ["id"]).count() == 1
    assert C.current_state(changes, S.key_columns(specs)).count() == 2


def test_table_selection_patterns(spark):
    assert qualified_patterns("db", "orders, db2.items|user_.*") == ["db\\.orders", "db2\\.items", "db\\.user_.*"]
    df = spark.createDataFrame([("db", "orders"), ("db", "user_a"), ("x", "orders"), ("db2", "items"), ("db", "orders2")],
                               "db STRING, table STRING")
    got = sorted(rows(select_tables(df, "db", "orders,db2.items|user_(a|b)")))
    assert got == [("db", "orders"), ("db", "user_a"), ("db2", "items")]
    assert select_tables(df, "db", ".*").count() == 3


def test_hour_partition_only_for_timestamps():
    assert S.partition_column(ddl("tm TIMESTAMP_NTZ")) == "tm"
    assert S.partition_column(ddl("tm STRING")) is None
