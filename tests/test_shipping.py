"""The package reaches executors that do not have it."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys, importlib.util
spec = importlib.util.spec_from_file_location("candlelake", sys.argv[1] + "/candlelake/__init__.py",
                                              submodule_search_locations=[sys.argv[1] + "/candlelake"])
module = importlib.util.module_from_spec(spec)
sys.modules["candlelake"] = module
spec.loader.exec_module(module)
from candlelake.session import build_session, ship_package
from candlelake.sources.archives import read_archives
spark = build_session("shipping", **{"spark.master": "local[2]", "spark.ui.enabled": "false"})
ship_package(spark)
print("LINES", read_archives(spark, sys.argv[2]).count())
"""


def test_archives_are_read_from_another_folder(tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "AUSDT-1m-2024-01.zip", "w") as z:
        z.writestr("AUSDT-1m-2024-01.csv", "1704067200000,1,2,1,1,1,1704067259999,1,1,1,1,0\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    repo = str(Path(__file__).resolve().parents[1])
    done = subprocess.run([sys.executable, "-c", SCRIPT, repo, str(tmp_path)], cwd=tmp_path, env=env,
                          capture_output=True, text=True, timeout=200)
    assert "LINES 1" in done.stdout, done.stderr[-1500:]
