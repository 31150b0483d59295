"""Guards on the library source: the execution rules the design depends on."""

import pathlib
import re

ROOT = pathlib.Path(__file__).resolve().parents[1] / "tidecast"
SOURCES = {p: p.read_text() for p in ROOT.rglob("*.py")}


def _hits(pattern):
    rx = re.compile(pattern)
    return [f"{p.relative_to(ROOT)}:{i + 1}" for p, src in SOURCES.items()
            for i, line in enumerate(src.splitlines()) if rx.search(line) and not line.lstrip().startswith("#")]


def test_no_local_checkpoint_or_cross_join():
    assert not _hits(r"localCheckpoint\(|crossJoin\(")


def test_no_row_at_a_time_python_udfs_or_rdds():
    assert not _hits(r"\bF\.udf\(|@udf\b|\.rdd\b|mapPartitions\(|\.foreach\(")


def test_nothing_whole_through_the_driver():
    # only single-row results may come back: .first() on aggregates / metadata
    assert not _hits(r"\.collect\(\)|\.toPandas\(\)|\.take\(")


def test_no_machine_local_paths():
    assert not _hits(r"[\"']/tmp|tempfile|gettempdir")
