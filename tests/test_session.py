"""The shared folder comes from the session; a folder is registered only where none is set."""

from __future__ import annotations

import os
import subprocess
import sys
import textwrap

import pytest

from conftest import ROOT
from hearth.session import shared_dir

SCRIPT = textwrap.dedent("""
    import sys
    sys.path.insert(0, {root!r})
    from pyspark.sql import SparkSession
    b = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
    if {configured!r}:
        b = b.config("spark.checkpoint.dir", {configured!r})
    spark = b.getOrCreate()
    from hearth.session import shared_dir
    d = shared_dir(spark)
    assert spark.range(3).checkpoint().count() == 3        # reliable checkpoint works
    print("DIR=" + d)
    print("CTX=" + str(spark.sparkContext.getCheckpointDir()))
    spark.stop()
""")


def _run(tmp_path, configured: str | None) -> dict:
    conf_dir = tmp_path / "empty-conf"          # no spark-defaults.conf: nothing preset
    conf_dir.mkdir(exist_ok=True)
    env = dict(os.environ, SPARK_CONF_DIR=str(conf_dir))
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT, configured=configured)], env=env,
                         capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    return dict(line.split("=", 1) for line in out.stdout.splitlines() if line[:4] in ("DIR=", "CTX="))


def test_configured_folder_is_used(tmp_path):
    shared = str(tmp_path / "shared")
    got = _run(tmp_path, shared)
    assert got["DIR"] == shared
    assert got["CTX"].startswith("file:" + shared)


@pytest.mark.parametrize("master,local", [("local", True), ("local[4]", True), ("local[*, 3]", True),
                                          ("local-cluster[2,1,512]", False), ("spark://host:7077", False), ("yarn", False)])
def test_a_cluster_without_a_shared_folder_is_an_error(master, local, monkeypatch):
    made = []

    class Context:
        def getCheckpointDir(self):
            return made[0] if made else None

        def setCheckpointDir(self, d):
            made.append(d)

    context = Context()
    context.master = master

    class Session:
        sparkContext = context

        class conf:
            get = staticmethod(lambda key, default=None: default)

    if local:
        assert shared_dir(Session) == made[0]
    else:
        with pytest.raises(RuntimeError, match="share"):
            shared_dir(Session)


def test_folder_is_registered_only_when_unset(tmp_path):
    got = _run(tmp_path, None)
    assert "hearth-ckpt-" in got["DIR"]
    assert got["DIR"] in got["CTX"]
