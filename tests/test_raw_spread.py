import os
from datetime import date

from checks import trips


def test_raw_layer_spreads_one_row_group_by_rows(spark, tmp_path, monkeypatch):
    """All rows of one partition are written by a number of tasks that grows with the rows."""
    rows = [(n, 1 + n % 50, 1, 1 + n % 7, date(1996, 1, 1), 5.0, 1000.0, "O", 0.05) for n in range(200)]
    names = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_quantity",
             "l_extendedprice", "l_linestatus", "l_tax"]
    folder = str(tmp_path / "sf")
    spark.createDataFrame(rows, names).coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    monkeypatch.setattr(trips, "ROWS_PER_TASK", 10)
    path = trips.raw_path(spark, folder)
    files = [name for name in os.listdir(f"{path}/fleet=yellow") if name.endswith(".parquet")]
    assert len(files) == 20
    assert spark.read.parquet(path).count() == 200
