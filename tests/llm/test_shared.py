import types
from pathlib import Path

import pytest

from driftglass.llm import shared


def fake(master, folder=None):
    conf = types.SimpleNamespace(get=lambda key, other=None: folder if key == "spark.checkpoint.dir" else other)
    return types.SimpleNamespace(conf=conf, sparkContext=types.SimpleNamespace(master=master))


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[3,2,1000]", "k8s://x"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared.shared_dir(fake(master))
    assert shared.shared_dir(fake(master, "hdfs:///work/")).startswith("hdfs:///work/driftglass-")


def test_one_host_may_use_its_own():
    for master in ("local", "local[8]", "local[*]"):
        assert shared.shared_dir(fake(master)).startswith("file://")


def test_stage_tables(spark, tmp_path):
    before = {k: spark.conf.get(k, None) for k in shared.WRITE_CONF}
    folder = f"file://{tmp_path}"
    rows = spark.range(100).withColumnRenamed("id", "k")
    plain, dealt = shared.keep(rows.repartition(3, "k"), f"{folder}/plain"), shared.keep_bucketed(rows, f"{folder}/dealt", "k")
    assert plain.count() == dealt.count() == 100 and {k: spark.conf.get(k, None) for k in shared.WRITE_CONF} == before
    joined = dealt.join(plain.groupBy("k").count(), "k")
    assert joined._jdf.queryExecution().toString().count("Exchange hashpartitioning") <= 2 and joined.count() == 100
    name = shared._table_name(f"{folder}/dealt")
    assert spark.catalog.tableExists(name)
    shared.drop_folder(spark, f"{folder}/plain", f"{folder}/dealt", f"{folder}/never")
    assert not spark.catalog.tableExists(name) and not [p for p in Path(tmp_path).iterdir() if not p.name.startswith(".")]


def test_unused_names(spark):
    df = spark.range(1).selectExpr("id", "id as _MARK", "id as _mark_")
    assert shared.unused(df, "mark") == "_mark__" and shared.unused(df, "name") == "_name"
