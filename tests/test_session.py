"""The checkpoint root comes from the session; ours is used only when unset."""

from ticklake.session import checkpoint_root, scratch_path


def test_checkpoint_root_from_session(spark):
    root = checkpoint_root(spark)
    configured = spark.conf.get("spark.checkpoint.dir")
    assert configured.rstrip("/").split(":")[-1] in root
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root.replace("file:", ""))

