"""The entry without the packages that the operators on texts need."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names(setup):
    code = f"import sys; {setup}; import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    return [set(line.split()) for line in done.stdout.splitlines()[-2:]]


def test_a_missing_package_takes_only_its_own_queries():
    everything, _ = names("pass")
    for blocked in ("public_tokenizers", "starq.llm", "corpus_pipeline"):
        queries, oracles = names(f"sys.modules[{blocked!r}] = None")
        left_out = everything - queries
        assert all(n == "pipeline" or n.startswith("op") for n in left_out)
        assert len(queries) >= 150 and oracles == queries - {n for n in queries if n.startswith("op")}
