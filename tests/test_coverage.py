"""Every inventory id has a registered query, or a test where a query cannot show it."""

from meterline.catalog import load_all

COUNTS = {"S": 18, "K": 14, "M": 9, "P": 18, "F": 14, "J": 8, "A": 30, "W": 10, "O": 4, "E": 2, "X": 19,
          "T": 16, "N": 3, "Q": 15, "C": 16}

TESTED_ELSEWHERE = {
    "S13": "test_sources: topic options; no broker may be started here",
    "S14": "test_sources: topic options; no broker may be started here",
    "T11": "test_streaming: a stream under a processing-time trigger",
    "T12": "test_sources: topic options; no broker may be started here",
    "T16": "test_streaming: upsert of every batch",
    "S15": "test_sources: topic options, start latest",
    "K08": "test_sources: database options (no database may be started here)",
    "K12": "test_streaming: appending every batch to a database table",
    "C16": "a placeholder table; the monthly mart C09 takes its place",
}


def test_inventory_is_covered():
    shown = {i for q in load_all().values() for i in q.covers.split()}
    wanted = {f"{kind}{n:02d}" for kind, count in COUNTS.items() for n in range(1, count + 1)}
    assert shown <= wanted
    assert wanted - shown == set(TESTED_ELSEWHERE)


def test_driver_contract():
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(load_all()) <= set(entry.queries())  # the text queries come on top where they are installed
