"""Contract guards for the driver entry module."""

import re

import __spark_entry__ as entry


def test_query_names_are_descriptive():
    for name in entry.QUERIES:
        assert re.fullmatch(r"[a-z][a-z0-9_]*", name)
        assert "pipeline" not in name and not re.match(r"op\d+_", name)


def test_every_query_has_equivalent_sql():
    assert set(entry.QUERIES) == set(entry.ORACLE)
    for name, sql in entry.ORACLE.items():
        assert sql.lstrip().upper().startswith(("SELECT", "WITH")), name
