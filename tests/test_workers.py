"""The package on workers that have no copy of it, from another working folder."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from kerbline.session import local_session
from kerbline.operators.blocks import knn_classify
from kerbline.operators.evaluate import silhouettes
from kerbline.operators.fits import huber_lines

spark = local_session("2", "elsewhere")
days = spark.range(10).selectExpr("1 AS key", "date_add(date'2020-01-01', int(id)) AS t", "double(id * 2) AS v")
line = huber_lines(days, ("2020-01-01", "2020-12-31"), "2020-01-01", key="key", time="t", value="v").first()
points = spark.range(6).selectExpr("id", "int(id % 2) AS label", "array(double(id % 2 * 9 + id), 1.0) AS x")
near = knn_classify(points, points, 1, key="id", vector="x", label="label").count()
print("DONE", round(line["slope"], 6), line["converged"], near, silhouettes(points, key="id", vector="x", cluster="label").count())
"""


def test_package_travels_with_the_functions(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=REPO)],
        cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240,
    )
    assert "DONE 2.0 True 6 6" in run.stdout, run.stderr[-1500:]
