"""Code that runs in tasks travels with the job: executors need not have the package."""

import subprocess
import sys

import pytest
from pyspark import cloudpickle

import recipes
from dustline.sources import csv_split, workbooks

LOAD = "import pickle, sys; pickle.loads(sys.stdin.buffer.read())"


@pytest.mark.parametrize(
    "function",
    [
        workbooks._workbook_batches,
        csv_split._edges,
        csv_split._records,
        recipes.workbook_bytes,
    ],
)
def test_loads_without_the_package(function, tmp_path):
    shipped = cloudpickle.dumps(function)
    done = subprocess.run(
        [sys.executable, "-I", "-c", LOAD], input=shipped, cwd=tmp_path, capture_output=True
    )
    assert done.returncode == 0, done.stderr.decode()
