import pytest
from conftest import rows

from tillroll.plans.loads import batch_load
from tillroll.sources.tables import read_ledger, read_rejects, read_table
from tillroll.streaming.pickup import start_pickup

A = "1,x,2,1.5,01/05/19 10:00,home"
B = "1,x,5,1.5,02/05/19 10:00,home"
C = "2,x,1,1.5,02/06/19 10:00,home"


def pick_up(spark, source, target, tmp_path, **options):
    table, ledger = target
    start_pickup(
        spark, source.folder, table, ledger, checkpoint=str(tmp_path / "checkpoint"), **options
    ).awaitTermination()
    return rows(read_table(spark, table), "Order_ID", "Quantity_Ordered", "month")


def test_files_are_picked_up_once_as_they_arrive(spark, source, target, tmp_path):
    source("jan.csv", A, A, ",,,,,")
    assert pick_up(spark, source, target, tmp_path) == [(1, 2, 1)]
    assert pick_up(spark, source, target, tmp_path) == [(1, 2, 1)]
    source("feb [1].csv", B, C)
    assert pick_up(spark, source, target, tmp_path) == [(1, 5, 2), (2, 1, 2)]
    assert read_ledger(spark, target[1]).count() == 2


def test_micro_batches_of_one_file_give_the_same_table(spark, source, target, tmp_path):
    for i, line in enumerate((B, A, C)):
        source(f"{i}.csv", line)
    assert pick_up(spark, source, target, tmp_path, max_files_per_trigger=1) == [(1, 5, 2), (2, 1, 2)]


def test_append_mode_and_rejected_files(spark, source, target, tmp_path):
    source("jan.csv", A)
    source("drifted.csv", "x,1", header="Product,Order ID")
    pick_up(spark, source, target, tmp_path, mode="append")
    source("feb.csv", B)
    found = pick_up(spark, source, target, tmp_path, mode="append")
    assert found == [(1, 2, 1), (1, 5, 2)]
    assert rows(read_rejects(spark, target[1], "files"), "reason") == [("header differs",)]


@pytest.mark.parametrize("mode", ["append", "upsert"])
def test_files_of_a_batch_load_or_a_lost_checkpoint_are_not_loaded_again(
    spark, source, target, tmp_path, mode
):
    source("jan.csv", A, "2,y,2.0,1,01/05/19 10:00,home")
    batch_load(spark, source.folder, *target)
    assert pick_up(spark, source, target, tmp_path, mode=mode) == [(1, 2, 1)]
    source("feb.csv", C, "2,y,two,1,01/05/19 10:00,home")
    for name in ("one", "two"):  # the second checkpoint sees all files anew
        (tmp_path / name).mkdir()
        found = pick_up(spark, source, target, tmp_path / name, mode=mode)
        assert found == [(1, 2, 1), (2, 1, 2)]
    assert read_ledger(spark, target[1]).count() == 2
    assert rows(read_rejects(spark, target[1], "rows"), "reason") == [("wrong value type",)] * 2
