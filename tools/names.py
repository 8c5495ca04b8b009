"""Print the query names of one plan module, for `tools/check.py --only`."""
import importlib
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
print(",".join(importlib.import_module(f"lettera.plans.{sys.argv[1]}").QUERIES))
