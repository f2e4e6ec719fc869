"""Source-level guards for the scale rules of the library."""

import os
import re

ROOT = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "portolan")


def _sources():
    for dirpath, dirs, files in os.walk(ROOT):
        dirs[:] = [d for d in dirs if d != "llm"]  # has its own rules and tests
        for f in files:
            if f.endswith(".py"):
                path = os.path.join(dirpath, f)
                yield os.path.relpath(path, ROOT), open(path).read()


def test_no_python_udfs_cross_joins_or_local_checkpoints():
    banned = [r"\budf\(", r"pandas_udf", r"crossJoin", r"localCheckpoint", r"\.toPandas\(",
              r"sparkContext\.parallelize"]
    for name, src in _sources():
        for pat in banned:
            assert not re.search(pat, src), f"{pat} in {name}"


def test_driver_collection_only_where_bounded():
    for name, src in _sources():
        assert not re.search(r"\.collect\(\)|\.take\(", src), f"driver collection in {name}"


def test_no_machine_local_temp_outside_local_sessions():
    for name, src in _sources():
        if "tempfile" in src:
            assert name == "session.py", name
            assert "_is_local(spark)" in src
