"""The driver contract where the training-data operators, or what they need, are missing."""

import subprocess
import sys

import __spark_entry__ as E
from anchorwise.plans import registry

BLOCKED = """
import sys
sys.modules[{name!r}] = None
import __spark_entry__ as E
from anchorwise.plans import registry
assert E.queries().keys() == registry.queries().keys() and E.oracle_sql().keys() == registry.oracle_sql().keys()
"""


def test_other_queries_stay_without_a_library_or_the_subpackage():
    for name in ("public_tokenizers", "anchorwise.llm", "corpus_pipeline"):
        subprocess.run([sys.executable, "-c", BLOCKED.format(name=name)], check=True, timeout=120)


def test_every_oracle_has_its_query():
    assert E.oracle_sql().keys() <= E.queries().keys()
    assert registry.queries().keys() <= E.queries().keys()
