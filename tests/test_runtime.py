import os
import uuid

from vinework.runtime import cut_lineage, discard_tables, folder_exists, scratch, shared_dir


def test_cut_tables_live_in_the_shared_folder(spark):
    table = cut_lineage(spark.range(5), f"t{uuid.uuid4().hex}")
    path = table.inputFiles()[0]
    assert shared_dir(spark) in path
    assert sorted(r.id for r in table.collect()) == [0, 1, 2, 3, 4]


def test_discard(spark, monkeypatch, tmp_path):
    monkeypatch.setattr("vinework.runtime.shared_dir", lambda _: str(tmp_path))
    cut_lineage(spark.range(3), "t")
    assert os.listdir(tmp_path / "vinework")
    discard_tables(spark)
    assert not folder_exists(spark, str(tmp_path / "vinework" / spark.sparkContext.applicationId))


def test_scratch_tables_go_at_the_end(spark):
    with scratch(spark):
        inside = cut_lineage(spark.range(4), "inside").inputFiles()[0]
        assert folder_exists(spark, inside)
    outside = cut_lineage(spark.range(4), "outside").inputFiles()[0]
    assert not folder_exists(spark, inside) and folder_exists(spark, outside)
