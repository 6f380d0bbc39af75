from cityscan.session import checkpoint_dir, ensure_parallelism, materialize


def test_checkpoint_dir_reuses_the_configured_folder(spark):
    first = checkpoint_dir(spark)
    assert first and checkpoint_dir(spark, fallback="/nonexistent/should-not-be-used") == first


def test_ensure_parallelism_only_spreads_few_files(spark, tmp_path):
    want = spark.sparkContext.defaultParallelism
    spark.range(100, numPartitions=1).write.parquet(str(tmp_path / "one"))
    one = spark.read.parquet(str(tmp_path / "one"))
    assert ensure_parallelism(one).rdd.getNumPartitions() == want
    spark.range(100, numPartitions=want * 2).write.parquet(str(tmp_path / "many"))
    many = spark.read.parquet(str(tmp_path / "many"))
    assert ensure_parallelism(many) is many
    made = spark.range(100, numPartitions=1)
    assert ensure_parallelism(made) is made


def test_materialize_keeps_rows_and_cuts_lineage(spark):
    df = spark.range(50).selectExpr("id", "id * 2 AS v").where("id % 3 = 0")
    m = materialize(df)
    assert sorted(tuple(r) for r in m.collect()) == sorted(tuple(r) for r in df.collect())
    assert "ExistingRDD" in m._jdf.queryExecution().executedPlan().toString()


class _FakeConf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _FakeContext:
    def __init__(self, master, ckpt=None):
        self.master, self._ckpt = master, ckpt

    def getCheckpointDir(self):
        return self._ckpt

    def setCheckpointDir(self, path):
        self._ckpt = path


class _FakeSession:
    def __init__(self, master, conf=None, ckpt=None):
        self.sparkContext = _FakeContext(master, ckpt)
        self.conf = _FakeConf(conf or {})


def test_checkpoint_dir_never_invents_a_local_folder_on_a_cluster():
    import pytest

    with pytest.raises(ValueError):
        checkpoint_dir(_FakeSession("yarn"))
    # the cluster's shared folder is read from the session and used as is
    s = _FakeSession("yarn", conf={"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert checkpoint_dir(s) == "hdfs:///shared/ckpt"
    assert s.sparkContext.getCheckpointDir() == "hdfs:///shared/ckpt"
