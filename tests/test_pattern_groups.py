"""Rows of a pattern: every group as the pattern has it, and the span between the markers."""

import pytest

from ledgerlark.sources import text


@pytest.mark.parametrize(
    "body, want",
    [
        ("go\nx\u0001y 5\nz 6", [("x\u0001y", "5"), ("z", "6")]),  # no character of a group parts it
        ("a 1\ngo\nb 2\nend\nc 3\ngo\nd 4", [("b", "2")]),
        ("a 1\nend\ngo\nb 2\n\nb 2 2\nc\t3", [("b", "2"), ("c", "3")]),
        ("é 1 go e 2\nü 3\nñ 4end\n5 5", [("ü", "3"), ("ñ", "4")]),
        ("goend\na 1", []),
        ("a 1", []),
        (None, []),
    ],
)
def test_groups_of_pattern_rows(spark, body, want):
    docs = spark.createDataFrame([(1, body)], "id int, text string")
    got = text.extract_pattern_rows(docs, "text", "go", "end", {"a": r"[^ \t]+", "b": r"[0-9]+"}).collect()
    assert [(r.a, r.b) for r in got] == want
