"""Helpers of the tests."""

import os

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, (list, tuple)):
        return str([plain(x) for x in value])
    return str(value)


def same_rows(columns, rows, other_columns, other_rows):
    assert sorted(columns) == sorted(other_columns)

    def ordered(names, values):
        at = sorted(range(len(names)), key=lambda i: names[i])
        return sorted(tuple(plain(r[i]) for i in at) for r in values)

    assert ordered(columns, rows) == ordered(other_columns, other_rows)
