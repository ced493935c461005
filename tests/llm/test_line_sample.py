"""What the line labelling learns from."""

from __future__ import annotations

import numpy as np
import pytest

from tiermill.llm import line_crf


@pytest.fixture
def fitted(monkeypatch):
    held = []
    monkeypatch.setattr(line_crf, "fit", lambda seen, owner, labels: held.append((seen, owner, labels)))
    return held


def taught(spark):
    rows = [(1, "\n".join(f"Line {i} of text." for i in range(120))), (2, "menu | bar\n\n" * 60), (3, "a\nb"), (4, None), (5, "c\n" * 49)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0), (5, 0)], "doc_id long, quality int")


def test_all_lines_of_a_sampled_document_are_learned_from(spark, fitted):
    line_crf.learn(*taught(spark))
    seen, owner, labels = fitted[0]
    assert np.bincount(owner).tolist() == [120, 60, 2, 49]
    assert [set(labels[owner == i]) for i in range(4)] == [{1}, {0}, {1}, {0}]
    assert seen.shape == (231, len(line_crf.OBSERVATIONS)) and set(np.unique(seen)) == {0.0, 1.0}
    bar = seen[:, line_crf.OBSERVATIONS.index("a_bar")]
    assert bar[owner == 1].all() and not bar[owner != 1].any()


def test_the_budget_of_lines_leaves_out_whole_documents(spark, fitted, monkeypatch):
    monkeypatch.setattr(line_crf, "SAMPLED_LINES", 125)
    line_crf.learn(*taught(spark))
    sizes = np.bincount(fitted[0][1]).tolist()
    assert 0 < sum(sizes) <= 125 and set(sizes) <= {120, 60, 2, 49}
