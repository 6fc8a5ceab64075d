import subprocess
import sys

# 96 MB in arrays too small for mappings of their own, below one that stays.
SCRIPT = """
import numpy as np
import pyarrow as pa
from tillroll.llm.textarrays import runs

def held():
    (line,) = (x for x in open("/proc/self/status") if x.startswith("RssAnon"))
    return int(line.split()[1]) >> 10

for run in runs(pa.record_batch([pa.array(["a"])], names=["text"])):
    made = [np.ones(12_000) for _ in range(1000)]
    stays = made.pop()
    made.clear()
    within = held()
print(within - held())
"""


def test_memory_of_a_batch_goes_back_to_the_system():
    out = subprocess.run([sys.executable, "-c", SCRIPT], capture_output=True, text=True, check=True).stdout
    assert int(out) > 60
