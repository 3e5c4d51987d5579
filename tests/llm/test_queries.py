import os

import pytest

from quireflow.llm.queries import QUERIES

from ..test_contract import FOLDER, check


#: Queries without SQL, and the tests that hold them to brute force, planted cases or held-out texts.
WITHOUT_SQL = {"p1_found": "test_lookalikes", "p1_classes": "test_lookalikes", "p4_found": "test_scans", "p4_repaired": "test_scans", "p5_found": "test_pairs", "p6_found": "test_leaks", "p7_mix": "test_mixing", "p7_shares": "test_mixing", "p8_found": "test_quality"}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")
@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    check(spark, name, WITHOUT_SQL)
