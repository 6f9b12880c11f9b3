"""Plan checks: no nested-loop join, no Python evaluation, and every single-partition
exchange sits on one-row-per-task data (a partial aggregate), a stored table of proven
size (the category names) or a per-range offsets table, never on document-sized rows."""

import re

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

QUERIES = entry.queries()
CHECKED = ["word_count", "classify_url", "dedupe_title", "vocabulary", "tfidf_vectors", "chi_square",
           "top_features", "libsvm_text", "active_days", "key_join", "path_rules", "reindexed_vectors", "nb_theta", "identity"]
ALLOWED_BELOW_SINGLE = re.compile(r"HashAggregate\(keys=\[\], functions=\[partial_|dense-ids|FileScan parquet \[name#|_pid|"
                                  r"HashAggregate\(keys=\[_pid")


def _lines(df):
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


@pytest.mark.parametrize("name", CHECKED)
def test_plan_shape(spark, name):
    lines = _lines(QUERIES[name](spark, SF_SMALL))
    text = "\n".join(lines)
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|PythonUDF", text)
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = "\n".join(lines[i + 1:i + 6])
            assert ALLOWED_BELOW_SINGLE.search(below), f"{name}: single-partition exchange over\n{below}"
