"""Stored tables: a failed build changes nothing, guards stop a version, targets are built in order of need."""

import threading

import pytest
from pyspark.sql import functions as F

from matchwright.sources import store as ST


def failing(spark, after=50):
    """Rows of which the later ones raise while they are written."""
    return spark.range(0, 100, 1, 4).withColumn("x", F.when(F.col("id") >= after, F.raise_error(F.lit("broken row"))).otherwise(F.col("id")))


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_failed_replacement_keeps_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        ST.read_stored(spark, path)
    ST.write_replace(spark.range(5).withColumn("x", F.col("id")), path)
    reader = ST.read_stored(spark, path)
    with pytest.raises(Exception, match="broken row"):
        ST.write_replace(failing(spark), path)
    assert ids(ST.read_stored(spark, path)) == list(range(5))
    new = ST.write_replace(spark.range(7, 9).withColumn("x", F.col("id")), path)
    assert ids(new) == ids(ST.read_stored(spark, path)) == [7, 8]
    assert ids(reader) == list(range(5))  # begun before, still whole
    assert len(ST.versions(spark, path)) == 2 and ST.expire(spark, path, keep=1) and ids(ST.read_stored(spark, path)) == [7, 8]


def test_reads_itself_while_it_is_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    ST.write_replace(spark.range(4), path)
    ST.write_replace(ST.read_stored(spark, path).select((F.col("id") + 1).alias("id")), path)
    assert ids(ST.read_stored(spark, path)) == [1, 2, 3, 4]


def test_rules_are_seen_while_writing(spark, tmp_path):
    path = str(tmp_path / "t")
    rules = {"positive": F.col("id") > 0, "known": F.col("x").isNotNull()}
    good = spark.range(1, 4).withColumn("x", F.lit("a"))
    ST.write_replace(good, path, rules)
    for bad, what in ((good.withColumn("id", F.col("id") - 1), "'positive': 1"), (good.withColumn("x", F.lit(None).cast("string")), "'known': 3"), (good.limit(0), "no rows")):
        with pytest.raises(ValueError, match=what):
            ST.write_replace(bad, path, rules)
        assert ids(ST.read_stored(spark, path)) == [1, 2, 3]


def test_materialize_builds_once(spark, tmp_path):
    path, built = str(tmp_path / "t"), []

    def build():
        built.append(1)
        return spark.range(3)

    assert ids(ST.materialize(spark, path, build)) == ids(ST.materialize(spark, path, build)) == [0, 1, 2] and len(built) == 1
    ST.materialize(spark, path, build, force=True)
    assert len(built) == 2


def test_targets_in_order_of_need(spark, tmp_path):
    root = str(tmp_path)
    both = threading.Barrier(2, timeout=60)

    def alone(n):
        def build(done):
            both.wait()  # passes only if the two independent targets run at the same time
            return spark.range(n)

        return build

    registry = {
        "sum": ST.Target(lambda done: done["a"].unionByName(done["b"]), ("a", "b")),
        "a": ST.Target(alone(2)),
        "b": ST.Target(alone(3)),
    }
    out = ST.bake_targets(spark, registry, root)
    assert list(out) == ["sum", "a", "b"] and ids(out["sum"]) == [0, 0, 1, 1, 2]
    again = ST.bake_targets(spark, registry, root, ["sum"])  # its inputs come from the store
    assert ids(again["sum"]) == [0, 0, 1, 1, 2]


def test_missing_input_unknown_name_and_circle(spark, tmp_path):
    root = str(tmp_path)
    registry = {"a": ST.Target(lambda done: spark.range(1)), "b": ST.Target(lambda done: done["a"], ("a",))}
    with pytest.raises(FileNotFoundError, match="b reads a, which is neither asked for nor stored"):
        ST.bake_targets(spark, registry, root, ["b"])
    with pytest.raises(KeyError, match="nothing"):
        ST.bake_targets(spark, registry, root, ["nothing"])
    with pytest.raises(KeyError, match="ghost"):
        ST.bake_targets(spark, {"a": ST.Target(lambda done: spark.range(1), ("ghost",))}, root)
    circle = {"a": ST.Target(lambda done: done["b"], ("b",)), "b": ST.Target(lambda done: done["a"], ("a",))}
    with pytest.raises(ValueError, match="circle"):
        ST.bake_targets(spark, circle, root)


def test_failed_target_keeps_the_stored_one(spark, tmp_path):
    root = str(tmp_path)
    good = {"a": ST.Target(lambda done: spark.range(2)), "b": ST.Target(lambda done: done["a"], ("a",))}
    ST.bake_targets(spark, good, root)
    bad = {"a": ST.Target(lambda done: failing(spark).select("x")), "b": good["b"]}
    with pytest.raises(Exception, match="broken row"):
        ST.bake_targets(spark, bad, root)
    assert ids(ST.read_stored(spark, f"{root}/a")) == ids(ST.read_stored(spark, f"{root}/b")) == [0, 1]
