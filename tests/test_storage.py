from types import SimpleNamespace

import pytest

from topicstream import storage


def session(master, sql=None, core=None, warehouse=None):
    settings = {"spark.checkpoint.dir": sql, "spark.sql.warehouse.dir": warehouse}
    conf = SimpleNamespace(get=lambda key, default=None: settings[key] or default)
    context = SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=lambda key: core))
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_scratch_is_new_each_time_and_under_the_shared_folder(spark):
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    first, second = storage.scratch_dir(spark, "x"), storage.scratch_dir(spark, "x")
    assert first != second
    assert first.startswith(shared) and second.startswith(shared)
    assert not storage.exists(spark, first) and storage.exists(spark, first.rsplit("/", 1)[0])


def test_a_cluster_must_name_its_shared_folder():
    assert storage.scratch_base(session("yarn", core="hdfs:///ck")) == "hdfs:///ck"
    assert storage.scratch_base(session("yarn", sql="s3a://b/ck/")) == "s3a://b/ck/"
    for master in ("yarn", "local-cluster[3,2,1024]", "spark://host:7077"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            storage.scratch_base(session(master))


def test_a_local_session_falls_back_to_its_warehouse(spark):
    found = storage.scratch_base(session("local[2]", warehouse="file:/w"))
    assert found == "file:/w/_scratch"


def test_paths(spark, tmp_path):
    root = str(tmp_path)
    assert storage.join("hdfs:///a/", "/b/", "c") == "hdfs:///a/b/c"
    path = storage.join(root, "new")
    assert not storage.exists(spark, path) and storage.is_empty(spark, path)
    storage.make_dir(spark, path)
    assert storage.exists(spark, path) and storage.is_empty(spark, path)
    (tmp_path / "new" / "_SUCCESS").touch()
    assert storage.is_empty(spark, path)
    (tmp_path / "new" / "data").touch()
    assert not storage.is_empty(spark, path)
