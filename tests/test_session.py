from cellforge.session import ensure_checkpoint_dir, shared_path


def test_checkpoint_dir_comes_from_the_session(spark):
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir")
    current = ensure_checkpoint_dir(spark)
    assert current == sc.getCheckpointDir()
    if configured:
        assert configured.rstrip("/").split(":")[-1] in current
    a, b = shared_path(spark, "x"), shared_path(spark, "x")
    assert a != b and a.startswith(current)
