import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill import schemas
from tidemill.sources import files, tables
from tidemill.sources.shared import run_dir, shared_root


def write_lines(spark, path, *lines):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)


def test_shared_root_is_the_sessions(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert run_dir(spark, "a") != run_dir(spark, "a")


def test_csv_with_schema_glob_and_separator(spark, root):
    write_lines(spark, f"{root}/csv", "book_id;title;author;category;price", "b1;A, B;ada;x;1.5", "b2;C;bob;y;bad")
    rows = files.scan_csv(spark, f"{root}/csv/part-*", schemas.BOOKS_DDL, sep=";").orderBy("book_id").collect()
    assert [(r.title, r.price) for r in rows] == [("A, B", 1.5), ("C", None)]
    strings = files.scan_csv(spark, f"{root}/csv", sep=";")
    assert {f.dataType for f in strings.schema} == {T.StringType()}
    inferred = files.scan_csv(spark, f"{root}/csv", sep=";", infer=True)
    assert inferred.schema["price"].dataType == T.StringType()  # "bad" is no number


def test_json_scan_and_query_in_place(spark, root):
    write_lines(spark, f"{root}/json", '{"a": 1, "b": {"c": "x"}}', '{"a": 2, "d": true}')
    assert files.scan_json(spark, f"{root}/json").orderBy("a").collect()[0].b.c == "x"
    assert files.scan_json(spark, f"{root}/json", "a long, zz string").where("zz IS NULL").count() == 2
    assert files.query_files(spark, "json", f"{root}/json").count() == 2


def test_rescue(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("price", T.DoubleType())])
    lines = ['{"id": 1, "price": 2.5}', '{"id": 2, "price": "cheap", "extra": "x"}', "broken", '{"id": 3, "price": null}']
    raw = spark.createDataFrame(list(enumerate(lines)), "n long, line string")
    rows = {r.n: r for r in files.rescue_json(raw, "line", schema).collect()}
    assert (rows[0].id, rows[0].price, rows[0]._rescued_data) == (1, 2.5, None)
    assert (rows[1].id, rows[1].price) == (2, None)
    assert rows[1]._rescued_data == '{"price":"cheap","extra":"x"}'
    assert (rows[2].id, rows[2]._rescued_data) == (None, "broken")
    assert (rows[3].id, rows[3].price, rows[3]._rescued_data) == (3, None, None)


def test_jdbc_options_split_the_scan():
    got = files.jdbc_options("jdbc:x:y", "customer", "id", 0, 100, 8, user="u")
    assert got["partitionColumn"] == "id" and got["numPartitions"] == "8" and got["user"] == "u"
    with pytest.raises(ValueError):
        files.jdbc_options("jdbc:x:y", "customer", "id", 10, 0, 8)


def test_table_ddl(spark, database):
    empty = f"{database}.orders"
    tables.create_empty(spark, empty, schemas.ORDERS_BRONZE)
    assert spark.table(empty).count() == 0
    assert spark.table(empty).schema["books"].dataType.elementType["subtotal"].dataType == T.LongType()

    plain = f"{database}.plain"
    tables.create_table(spark, plain, "id INT, name STRING")
    tables.create_table(spark, plain, "id INT, name STRING")
    spark.sql(f"INSERT INTO {plain} VALUES (1, 'a'), (2, 'b')")
    wider = tables.add_columns(spark, plain, note="STRING", n="INT")
    assert wider.where("note IS NULL AND n IS NULL").count() == 2

    described = {(r.table_name, r.col_name): r.data_type for r in tables.describe_tables(spark, [empty, plain]).collect()}
    assert described[plain, "n"] == "int" and described[empty, "order_timestamp"] == "bigint"
    assert {r.tableName for r in tables.list_tables(spark, database).collect()} == {"orders", "plain"}

    tables.empty_table(spark, plain)
    assert spark.table(plain).count() == 0 and len(spark.table(plain).columns) == 4
    tables.drop_table(spark, plain)
    tables.drop_table(spark, plain)
    assert not spark.catalog.tableExists(plain)


def test_ctas_keeps_an_existing_table(spark, database):
    first = tables.ctas_view(spark.range(3), "some_ids", f"{database}.ids")
    assert first.count() == 3
    assert tables.ctas_view(spark.range(9), "some_ids", f"{database}.ids").count() == 3


def test_delete_where_keeps_nulls(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert {r.x for r in tables.delete_where(df, F.col("x") > 1).collect()} == {1, None}


def test_databases_of_runs_are_dropped_on_request(spark, root):
    from tidemill.sources import tables

    for name in ("run_gone1", "run_gone2", "kept_db"):
        tables.create_database(spark, name, f"{root}/{name}")
        tables.save_table(spark.range(3), f"{name}.numbers")
    assert {"run_gone1", "run_gone2"} <= set(tables.drop_run_databases(spark))
    assert not spark.catalog.databaseExists("run_gone1") and spark.table("kept_db.numbers").count() == 3
    assert tables.drop_run_databases(spark) == []
