"""Operators for preparing large text corpora.

One module per operator.  Nothing outside this subpackage imports it (the
driver entry point adds its queries when it is there).  Functions that run in
Python workers are shipped by value, so executors need no copy of the package.
"""

import importlib

from pyspark import cloudpickle

for _name in ("words", "decision_rules", "warc", "substring", "shard", "near_dup", "packing", "prefix_free", "prefix_trie"):
    cloudpickle.register_pickle_by_value(importlib.import_module(f"{__name__}.{_name}"))
