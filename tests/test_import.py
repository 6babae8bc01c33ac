import os
import subprocess
import sys

from support import ROOT


def test_entry_imports_without_a_session():
    code = "import __spark_entry__ as e; assert set(e.queries()) - set(e.LLM_QUERIES) == set(e.QUERIES)"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_entry_without_a_library_of_the_texts():
    """Only the queries of texts go with a library that only they need."""
    code = (
        "import sys; sys.modules['sentencepiece'] = None\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) == len(e.QUERIES) > 100 and not e.LLM_QUERIES"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_package_reaches_workers_that_lack_it(tmp_path):
    """Another working folder, no PYTHONPATH: Python workers get the package from the driver."""
    code = f"""
import sys; sys.path.insert(0, {str(ROOT)!r})
from wellspark.functions import scalars
from wellspark.session import build_session, ship_package
spark = build_session("ship", **{{"spark.master": "local[1]", "spark.ui.enabled": "false"}})
for _ in range(2):
    ship_package(spark)

def here(batches):
    import wellspark.functions.scalars
    yield from batches

assert spark.range(3).mapInArrow(here, "id long").count() == 3
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True, timeout=180)
