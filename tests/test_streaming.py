"""The order feed as streams: batches, restarts, replaced totals, refusals."""

import pytest

from tests.test_medallion import BOOKS, CUSTOMERS, ORDERS
from tidemill import schemas
from tidemill.plans import medallion as batch
from tidemill.sources.files import stream_files
from tidemill.streaming import medallion, replay, runner


@pytest.fixture
def feed(spark, database):
    orders = spark.createDataFrame(ORDERS, schemas.ORDERS_RAW)
    customers = spark.createDataFrame(CUSTOMERS, "customer_id string, profile string")
    books = spark.createDataFrame(BOOKS, schemas.BOOKS_DDL)
    layers = medallion.Layers(f"{database}.orders", f"{database}.orders_facts", f"{database}.sales_by_author")
    return orders, customers, books, layers


def totals(df):
    return sorted(map(tuple, df.select("author", "total_sales_amount", "total_sales_quantity").collect()))


def test_two_landings_and_a_restart(spark, root, feed):
    orders, customers, books, layers = feed
    replay.stage(orders, "order_id", 2, f"{root}/staged")
    landing = f"{root}/landing"

    def drain():
        return medallion.run(spark, layers, root, landing, schemas.ORDERS_RAW, customers, books, files_per_batch=1)

    assert replay.land_next(spark, f"{root}/staged", landing) == [1]
    drain()
    part = spark.read.parquet(f"{landing}/01.parquet")
    facts = batch.order_facts(part, customers)
    assert spark.table(layers.bronze).count() == part.count()
    assert totals(spark.table(layers.gold)) == totals(batch.sales_by_author(facts, books))

    assert replay.land_next(spark, f"{root}/staged", landing, everything=True) == [2]
    assert replay.land_next(spark, f"{root}/staged", landing) == []
    drain()
    whole = totals(batch.sales_by_author(batch.order_facts(orders, customers), books))
    assert totals(spark.table(layers.gold)) == whole
    assert spark.table(layers.silver).count() == 5

    drain()  # nothing new
    assert spark.table(layers.bronze).count() == len(ORDERS)
    assert totals(spark.table(layers.gold)) == whole
    names = {r.file_name.split("/")[-2] for r in spark.table(layers.bronze).collect()}
    assert names == {"01.parquet", "02.parquet"}


def test_a_second_checkpoint_is_refused(spark, root, database):
    source = spark.range(5)
    source.write.parquet(f"{root}/in")
    table = f"{database}.numbers"

    def stream():
        return stream_files(spark, "parquet", f"{root}/in", source.schema)

    for _ in range(2):
        assert runner.finish(runner.append_stream(stream(), table, root), spark, table).count() == 5
    with pytest.raises(ValueError, match="doubled"):
        runner.append_stream(stream(), table, f"{root}/elsewhere")
    with pytest.raises(ValueError, match="doubled"):
        runner.replace_stream(stream().groupBy().count(), table, f"{root}/elsewhere")


def test_replaying_a_micro_batch_changes_nothing(spark, root, database):
    table = f"{database}.totals"
    for _ in range(2):
        runner.publish(spark.range(3), table, f"{root}/versions/0")
    assert spark.table(table).count() == 3
    runner.publish(spark.range(7), table, f"{root}/versions/1")
    assert spark.table(table).count() == 7


def test_csv_landing(spark, root, database):
    header = "Road ID,Road Category Id,Road Category,Region ID,Region Name,Total Link Length Km,Total Link Length Miles,All Motor Vehicles"
    lines = [header, "1,1,TM,1,South,10.5,6.5,100.0", "2,1,TM,1,South,bad,6.5,100.0", "3,1,TM"]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(f"{root}/in")
    landed = medallion.land_csv(spark, f"{root}/in", schemas.ROADS, f"{database}.roads", root)
    rows = {r.Road_ID: r for r in landed.collect()}
    assert set(rows) == {1, 2, 3}
    assert rows[2].Total_Link_Length_Km is None and rows[2].All_Motor_Vehicles == 100.0
    assert rows[3].Region_Name is None
    assert all(r.Extract_Time is not None for r in rows.values())
    again = medallion.land_csv(spark, f"{root}/in", schemas.ROADS, f"{database}.roads", root)
    assert again.count() == 3


def test_interval_trigger_and_reset(spark, root, database):
    source = spark.range(10)
    source.write.parquet(f"{root}/in")
    table = f"{database}.live"
    query = runner.append_stream(stream_files(spark, "parquet", f"{root}/in", source.schema), table, root, interval="1 second")
    query.processAllAvailable()
    spark.catalog.refreshTable(table)
    assert query.isActive and spark.table(table).count() == 10
    fresh = runner.reset(spark, [table])
    assert not spark.streams.active and not spark.catalog.tableExists(table)
    assert fresh != root


def test_replay_is_complete_and_repeatable(spark, root):
    replay.stage(spark.range(100), "id", 9, f"{root}/a")
    replay.stage(spark.range(100), "id", 9, f"{root}/b")
    assert replay.land_next(spark, f"{root}/a", f"{root}/landing") == [1]
    assert replay.land_next(spark, f"{root}/a", f"{root}/landing", everything=True) == list(range(2, 10))
    landed = spark.read.option("recursiveFileLookup", True).parquet(f"{root}/landing")
    assert sorted(r.id for r in landed.collect()) == list(range(100))
    for n in range(1, 10):
        a, b = (spark.read.parquet(f"{root}/{x}/batch={n:02d}") for x in "ab")
        assert a.exceptAll(b).count() == 0


def test_gold_has_one_row_per_author(spark, root, feed):
    orders, customers, books, layers = feed
    replay.stage(orders, "order_id", 1, f"{root}/staged")
    replay.land_next(spark, f"{root}/staged", f"{root}/landing")
    medallion.run(spark, layers, root, f"{root}/landing", schemas.ORDERS_RAW, customers, books)
    query = runner.replace_stream(medallion.gold(spark, layers.silver, books), layers.gold, root)
    assert runner.finish(query, spark, layers.gold).count() == 2


def test_a_run_that_broke_off_is_resumed(spark, root, database):
    source = spark.range(5)
    source.write.parquet(f"{root}/in")
    table = f"{database}.broken"

    def stream():
        return stream_files(spark, "parquet", f"{root}/in", source.schema)

    assert runner.finish(runner.append_stream(stream(), table, root), spark, table).count() == 5
    # As after a crash between making the table and marking it, in a run of an older version.
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES ('{runner.WRITER}')")
    spark.range(5, 8).write.mode("append").parquet(f"{root}/in")
    assert sorted(r.id for r in runner.finish(runner.append_stream(stream(), table, root), spark, table).collect()) == list(range(8))
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES ('{runner.WRITER}')")
    with pytest.raises(ValueError, match="doubled"):
        runner.append_stream(stream(), table, f"{root}/elsewhere")


def test_a_table_has_its_owner_before_the_query_starts(spark, root, database, monkeypatch):
    source = spark.range(5)
    source.write.parquet(f"{root}/in")
    table = f"{database}.owned"
    stream = stream_files(spark, "parquet", f"{root}/in", source.schema)

    def crash(*_, **__):
        raise RuntimeError("crash")

    with monkeypatch.context() as patched, pytest.raises(RuntimeError):
        patched.setattr("pyspark.sql.streaming.DataStreamWriter.toTable", crash)
        runner.append_stream(stream, table, root)
    assert spark.catalog.tableExists(table)
    assert runner.finish(runner.append_stream(stream, table, root), spark, table).count() == 5


def test_old_versions_are_retired(spark, root, database):
    versions = f"{root}/versions"
    for n in range(5):
        runner.publish(spark.range(n), f"{database}.v", f"{versions}/{n:010d}")
        runner.retire(spark, versions, n)
    fs, path = runner._files(spark, versions)
    assert sorted(int(s.getPath().getName()) for s in fs.listStatus(path)) == [3, 4]
    assert spark.table(f"{database}.v").count() == 4


def test_more_than_99_batches(spark, root):
    replay.stage(spark.range(2000), "id", 120, f"{root}/staged")
    landed = replay.land_next(spark, f"{root}/staged", f"{root}/landing", everything=True)
    assert landed == list(range(1, 121))
    assert spark.read.option("recursiveFileLookup", True).parquet(f"{root}/landing").distinct().count() == 2000


def test_a_hot_book_is_one_row_of_state_and_of_the_join(spark, root, feed):
    """5000 lines of one book in two landings: the gold stream keeps and joins one row for it."""
    orders, customers, books, layers = feed
    hot = [(f"h{i}", 0, "c1", 1, 1, [{"book_id": "b1", "quantity": 1, "subtotal": 2}] * 5) for i in range(1000)]
    many = orders.unionByName(spark.createDataFrame(hot, schemas.ORDERS_RAW))
    replay.stage(many, "order_id", 2, f"{root}/staged")
    replay.land_next(spark, f"{root}/staged", f"{root}/landing", everything=True)
    runner.finish(runner.append_stream(medallion.bronze(spark, f"{root}/landing", schemas.ORDERS_RAW, 1), layers.bronze, root), spark, layers.bronze)
    runner.finish(runner.append_stream(medallion.silver(spark, layers.bronze, customers), layers.silver, root), spark, layers.silver)

    def shape(sums):
        assert sums.columns == ["book_id", "subtotal", "quantity"]
        return batch.author_totals(sums, books)

    query = runner.replace_stream(medallion.gold_by_book(spark, layers.silver), layers.gold, root, shape)
    runner.finish(query, spark, layers.gold)
    # The state holds a row for each of the four books, whatever was sold of them.
    assert sum(p["numRowsTotal"] for p in query.lastProgress["stateOperators"]) == 4
    assert totals(spark.table(layers.gold)) == totals(batch.sales_by_author(batch.order_facts(many, customers), books))
