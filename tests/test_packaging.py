import os
import subprocess
import sys

from pyspark import cloudpickle

from tabmine.operators.cluster import silhouettes

WORKER = """
import pickle, sys
import numpy as np
f = pickle.load(sys.stdin.buffer)
s = f(np.array([0, 1]), np.array([[1.0, 4.0], [3.0, 1.0]]), np.array([2, 2]))
assert not any(m.split('.')[0] == 'tabmine' for m in sys.modules)
print(s.round(3).tolist())
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run([sys.executable, "-c", WORKER], input=cloudpickle.dumps(silhouettes), capture_output=True, cwd=tmp_path, env=env)
    assert r.returncode == 0, r.stderr.decode()
    assert r.stdout.decode().strip() == "[0.5, 0.333]"
