"""Python workers find the package when it is shipped as an archive, whatever the working directory."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CODE = """
import sys
archive, ckpt = sys.argv[1:]
sys.path.insert(0, archive)
from folio.session import local_session
from folio.operators import ruling as R
spark = local_session(2, extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "2g"})
spark.sparkContext.addPyFile(archive)
rows = [(1, 0, "h", y, 10.0, 110.0) for y in (20.0, 40.0)] + [(1, 0, "v", x, 20.0, 40.0) for x in (10.0, 60.0, 110.0)]
edges = spark.createDataFrame(rows, "doc_id long, page int, orient string, pos double, lo double, hi double")
print("CELLS", R.group_cells(R.find_cells(edges)).count())
"""


def test_workers_import_the_package_from_an_archive(tmp_path):
    (tmp_path / "src").mkdir()
    shutil.copytree(f"{ROOT}/folio", tmp_path / "src" / "folio", ignore=shutil.ignore_patterns("__pycache__"))
    archive = shutil.make_archive(str(tmp_path / "folio"), "zip", tmp_path / "src")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", CODE, archive, str(tmp_path / "ckpt")], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "CELLS 2" in out.stdout, out.stderr[-2000:]
