"""Source-level guards: nothing data-sized reaches the driver, no row-at-a-time UDFs."""

from __future__ import annotations

import pathlib
import re

PKG = pathlib.Path(__file__).resolve().parents[1] / "starmart"

# Every driver pull in the library, each bounded independently of the data:
ALLOWED_PULLS = {
    ("plans/publish.py", "collect"),   # one row per written directory (month or bucket), changed bucket, or batch that may hold a key
    ("plans/publish.py", "first"),     # one-row key profile of a written version
    # (plans/publish.py also collects at most 3 offending keys for a failed check)
    ("operators/merge.py", "first"),   # one-row count/min/max of the batch keys
    ("operators/joins.py", "first"),   # one-row (rows, bytes) size of a broadcast candidate
    ("plans/stages.py", "collect"),    # reject report: one row per table and set of null key columns
    ("plans/queries_store.py", "first"),  # one row: the largest key
    ("sources/readers.py", "collect"),  # one header line per CSV file (the driver lists the files of a read anyway)
    ("sources/labels.py", "take"),     # one row: does any code-list file hold the block
    ("operators/quality.py", "collect"),  # limit(1) sample row for an error message
    ("__main__.py", "collect"),        # check report: two rows per table
}


def _sources():
    """The library without its optional llm subpackage (``tests/llm`` has its own guards)."""
    for path in PKG.rglob("*.py"):
        rel = path.relative_to(PKG)
        if rel.parts[0] != "llm":
            yield str(rel), path.read_text()


def test_driver_pulls_are_the_bounded_ones():
    found = set()
    for rel, text in _sources():
        for m in re.finditer(r"\.(collect|first|toPandas|take|head|toLocalIterator)\(", text):
            found.add((rel, m.group(1)))
    assert found == ALLOWED_PULLS


def test_no_row_udfs_rdds_or_local_checkpoints():
    for rel, text in _sources():
        assert "@udf" not in text and "F.udf(" not in text, rel
        assert ".rdd" not in text, rel
        assert "localCheckpoint" not in text, rel
        assert "crossJoin" not in text, rel
        # an average's state has at most 59 rows a key, whatever the data
        assert rel == "operators/exact.py" or ("collect_list" not in text and "collect_set" not in text), rel


def test_python_batch_code_is_where_it_is_said_to_be():
    users = {rel for rel, text in _sources() if re.search("mapInPandas|applyInPandas|mapInArrow|applyInArrow", text)}
    assert users == {"sources/derived.py", "operators/exact.py"}
