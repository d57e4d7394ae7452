import shutil

from issuelens.fixtures import _LANDED, landed_once


def test_a_landed_table_is_written_once_and_again_when_its_folder_is_gone(spark):
    calls = []

    def write(path):
        calls.append(path)
        spark.range(3).write.parquet(path)

    for _ in range(2):
        assert landed_once(spark, "probe", "sf", write).count() == 3
    assert len(calls) == 1
    shutil.rmtree(calls[0])
    assert landed_once(spark, "probe", "sf", write).count() == 3 and len(calls) == 2
    assert calls[-1] in _LANDED.values()
