from barspan import session


def test_scratch_below_checkpoint_folder(spark, monkeypatch):
    monkeypatch.setattr(session, "CHECKPOINT_DIR", "spark.barspan.test.dir")
    spark.conf.set("spark.barspan.test.dir", "/shared/checkpoints/")
    assert session.scratch_dir(spark, "x").startswith("/shared/checkpoints/x-")
    spark.conf.unset("spark.barspan.test.dir")
    local = session.scratch_dir(spark, "x")
    assert local.rsplit("/", 1)[0] == session.scratch_dir(spark, "y").rsplit("/", 1)[0]
    assert "barspan-" in local
