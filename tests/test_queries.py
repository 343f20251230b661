"""Registered queries against their SQL on the given tables.

By default one query of each part runs; ``QUADRILLE_QUERIES=all`` runs every one, or name some of them. The folder of
tables is ``QUADRILLE_TABLES``.
"""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from compare import connect, difference  # noqa: E402

from quadrille.plans import load  # noqa: E402

FOLDER = os.environ.get("QUADRILLE_TABLES", "/root/testdata/sf0.001")
QUERIES, SQL = load()
SOME = [
    "avg_group_by", "json_scan", "results_tsv_sink", "filter_boolean_ops", "optional_left_join", "minmax_group_concat", "violation_limit_per_shape",
    "limit_offset", "commit_counts", "nested_list_field", "direct_mapping", "type_inference", "violations", "iri_resolve", "doc_upsert",
]
CHOSEN = os.environ.get("QUADRILLE_QUERIES", " ".join(SOME)).split()
if CHOSEN == ["all"]:
    CHOSEN = list(QUERIES)


@pytest.fixture(scope="module")
def duck():
    if not Path(FOLDER).exists():
        pytest.skip(f"no tables in {FOLDER}")
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(SQL) == set(QUERIES) and len(QUERIES) > 100


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_its_sql(spark, duck, name):
    found = difference(QUERIES[name](spark, FOLDER), duck, SQL[name])
    assert found is None, found
