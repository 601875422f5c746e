"""Tables in the shared folder, in a session that names one and in one that doesn't."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

from trackloom import session


class Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class Bare:
    """What ``scratch_dir`` asks of a session."""

    class sparkContext:
        applicationId = "app-1"

    def __init__(self, **conf):
        self.conf = Conf({k.replace("_", "."): v for k, v in conf.items()})


BARE_RUN = """
from trackloom.session import build_session, cut_lineage, scratch_dir
spark = build_session("bare", "2")
assert spark.conf.get("spark.checkpoint.dir", None) is None
assert cut_lineage(spark.range(7)).count() == 7 and scratch_dir(spark) == scratch_dir(spark)
print("folder", scratch_dir(spark))
"""


def test_local_session_without_the_setting(tmp_path):
    root = Path(__file__).resolve().parent.parent
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": str(root), "TRACKLOOM_DRIVER_MEMORY": "1g"}
    ran = subprocess.run([sys.executable, "-c", BARE_RUN], env=env, capture_output=True, text=True, timeout=120)
    assert ran.returncode == 0, ran.stderr[-2000:]
    folder = Path(next(line.split()[1] for line in ran.stdout.splitlines() if line.startswith("folder ")))
    assert folder.parent == Path("/tmp") and not folder.exists()


def test_cluster_must_name_a_folder():
    assert session.scratch_dir(Bare(spark_master="yarn", spark_checkpoint_dir="hdfs:///x/")) == "hdfs:///x"
    for master in ("yarn", "spark://h:1", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            session.scratch_dir(Bare(spark_master=master))
