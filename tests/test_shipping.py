"""Task functions must run where the package is not installed."""

import subprocess
import sys

import numpy as np
from pyspark import cloudpickle

from tallyforge.functions import draws
from tallyforge.operators import clustering

RUN = """
import pickle, sys
nearest, race = pickle.load(sys.stdin.buffer)
import numpy as np
print(nearest(np.zeros((2, 2)), np.ones((3, 2, 2))).tolist(), len(race(np.arange(3), np.arange(3), 1, 0, 0, np.ones(3))))
print("tallyforge" in sys.modules)
"""


def test_functions_travel_whole(tmp_path):
    sent = cloudpickle.dumps((clustering.nearest, draws.race))
    out = subprocess.run(
        [sys.executable, "-c", RUN], input=sent, capture_output=True, cwd=tmp_path, check=True
    ).stdout.decode()
    assert out.split("\n")[:2] == ["[[0, 0, 0], [0, 0, 0]] 3", "False"]
    assert np.isfinite(draws.race(np.arange(3), np.arange(3), 1, 0, 0, np.ones(3))).all()
