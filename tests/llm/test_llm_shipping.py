"""What is broadcast must be readable where the package is not installed."""

import pickle
import subprocess
import sys

from pyspark import cloudpickle

from tallyforge.llm import alignment, common, toxicity

RUN = """
import pickle, sys
model, vocabularies = pickle.load(sys.stdin.buffer)()
print(round(model.score([0.0]), 3), vocabularies.pair_bound, "tallyforge" in sys.modules)
"""


def test_classes_travel_along(spark, tmp_path):
    model = toxicity.ToxicityModel(toxicity.Dictionaries(b"x" * 8, b"y" * 8), [1.0], 0.0)
    small = alignment.Vocabularies("", b"", [b"ab"], [b"a"], True)
    get = common.sent(spark, (model, small))
    assert get()[0] == model
    packed = get.__closure__[[c for c in get.__code__.co_freevars].index("packed")].cell_contents.value
    run = subprocess.run(
        [sys.executable, "-c", RUN.replace("pickle.load(sys.stdin.buffer)()", "pickle.load(sys.stdin.buffer)")],
        input=packed, capture_output=True, cwd=tmp_path, check=True,
    )
    assert run.stdout.decode().split() == ["0.5", "5", "False"]
    assert pickle.loads(cloudpickle.dumps(model)) is not None
