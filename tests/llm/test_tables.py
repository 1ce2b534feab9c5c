"""Workers that hand memory back."""

import subprocess
import sys

PROBE = """
import psutil
from farelens.llm.tables import lean

def run(batches):
    for batch in batches:
        held = [bytes(1000) for _ in range(batch)]
        last = bytes(1000)  # keeps the end of the heap in use
        del held
        yield last

rss = lambda: psutil.Process().memory_info().rss >> 20
before = rss()
kept = list(lean(run)(iter([100_000])))
print(rss() - before)
"""


def test_freed_memory_is_handed_back():
    out = subprocess.run([sys.executable, "-c", PROBE], capture_output=True, text=True, check=True)
    assert int(out.stdout) < 40
