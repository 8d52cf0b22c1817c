import os

from quernflow import scratch


def test_tables_are_written_and_paths_are_fresh(spark):
    df = scratch.materialize(spark.range(5), "five")
    assert df.count() == 5 and scratch.materialize(spark.range(0), "none").count() == 0
    folder = scratch.shared_dir(spark).removeprefix("file://")
    assert os.path.isdir(f"{folder}/quernflow/{scratch._RUN}")
    path = scratch.fresh_path(spark, "gone")
    scratch.drop(spark, path)
    assert path != scratch.fresh_path(spark, "gone")


def test_a_cluster_must_name_its_folder(spark, monkeypatch):
    import pytest

    monkeypatch.setattr(scratch, "setting", lambda *a: None)

    class Elsewhere:
        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.shared_dir(Elsewhere)
    assert scratch.shared_dir(spark).startswith("file:///tmp/checkpoints/")


def test_what_only_led_to_a_table_is_removed(spark):
    def files():
        folder = f"{scratch.shared_dir(spark).removeprefix('file://')}/quernflow/{scratch._RUN}"
        return {x.rpartition("-")[0] for x in os.listdir(folder)}

    kept = scratch.materialize(spark.range(3), "outside")

    def make():
        left = scratch.materialize(spark.range(5), "inner")
        return scratch.settled(lambda: left.join(scratch.materialize(spark.range(2, 9), "innermost"), "id"), "middle").join(kept, "id")

    out = scratch.settled(make, "outcome")
    assert sorted(r["id"] for r in out.collect()) == [2] and kept.count() == 3
    assert {"outside", "outcome"} <= files() and not {"inner", "innermost", "middle"} & files()


def test_shuffle_files_go_with_the_write(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(scratch, "fresh_path", lambda *a, own=scratch.fresh_path: seen.append(spark.conf.get(scratch._CLEANUP)) or own(*a))
    before = spark.conf.get(scratch._CLEANUP)

    class Watched:
        sparkSession, schema = spark, spark.range(1).schema

        class write:
            parquet = staticmethod(lambda path: (seen.append(spark.conf.get(scratch._CLEANUP)), spark.range(1).write.parquet(path)))

    assert scratch.materialize(Watched, "watched").count() == 1
    assert seen == [before, "true"] and spark.conf.get(scratch._CLEANUP) == before
