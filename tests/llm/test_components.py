"""Components whose texts share one label."""

from __future__ import annotations

import pytest

from ark.llm import simhash


@pytest.mark.parametrize("ids", [[simhash.NO_ID] * 5, [7] * 5, [3, 9, 3, 9, 3]])
def test_chain_of_equal_labels_has_one_root(spark, ids):
    nodes = spark.createDataFrame(list(zip(range(5), ids, strict=True)), "fp long, label long")
    edges = spark.createDataFrame([(k, k + 1) for k in range(4)], "a long, b long")
    rows = simhash.components(nodes, edges).collect()
    assert len(rows) == 5 and {(r.label, r.root) for r in rows} == {(min(ids), 0)}
