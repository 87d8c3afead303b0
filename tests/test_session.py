from cohortlens.session import cluster_conf


def test_cluster_conf_sizes_partitions():
    c = cluster_conf(100 * 2**40, executors=1000, cores_per_executor=4)
    assert int(c["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 << 20)
    assert c["spark.sql.autoBroadcastJoinThreshold"] == "-1"
    small = cluster_conf(10 << 20, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 120


def test_session_has_ui_off(spark):
    assert spark.conf.get("spark.ui.enabled") == "false"


def test_checkpoint_keys_run_without_the_setting(tmp_path):
    """A session that has no spark.checkpoint.dir and an explicit folder."""
    import os
    import subprocess
    import sys
    from conftest import ROOT, SF_SMALL
    code = f"""
from pyspark.sql import SparkSession
import __spark_entry__ as E
from cohortlens.session import checkpoint_dir
s = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
     .config("spark.sql.shuffle.partitions", "4").config("spark.sql.warehouse.dir", {str(tmp_path / "wh")!r}).getOrCreate())
assert s.conf.get("spark.checkpoint.dir", None) is None
assert checkpoint_dir(s, {str(tmp_path / "ckpt")!r}).endswith("ckpt") or "ckpt" in checkpoint_dir(s)
for k in ("metric_auc", "key_insights", "median_fill", "enrollment_stats", "metric_avg_precision", "roc_points",
          "roc_points_thinned"):
    assert E.queries()[k](s, {SF_SMALL!r}).count() > 0
"""
    (tmp_path / "conf").mkdir()
    env = dict(os.environ, PYTHONPATH=str(ROOT), SPARK_CONF_DIR=str(tmp_path / "conf"))
    r = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600, env=env,
                       cwd=str(tmp_path))
    assert r.returncode == 0, r.stderr[-3000:]


def test_cluster_without_a_shared_folder_is_an_error():
    import pytest
    from cohortlens.session import checkpoint_dir

    class Context:
        master = "spark://host:7077"
        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())
