"""Every query with check SQL against DuckDB; the others must give rows.

The queries are mostly driver time on small data, so they run from a few
threads at once.
"""

from concurrent.futures import ThreadPoolExecutor

import pytest

from millrace.catalog import ORACLE, QUERIES
from tests.oracle import compare, connect

# long model runs: one of each kind is enough here, all run in the driver check
SLOW = {"full_run", "ml_grid_search", "ml_mlp", "ml_gbt_cls", "ml_gbt_reg", "ml_forest_cls", "ml_forest_reg", "ml_svc", "ml_lasso", "ml_elasticnet", "ml_ridge", "leaderboard", "ml_predict"}
NAMES = [n for n in QUERIES if n not in SLOW]


@pytest.fixture(scope="module")
def outcomes(spark, sf):
    def one(name):
        try:
            return name, compare(spark, connect(sf), sf, name, QUERIES[name], ORACLE.get(name))
        except Exception as e:
            return name, f"{type(e).__name__}: {str(e)[:500]}"

    with ThreadPoolExecutor(6) as pool:
        return dict(pool.map(one, NAMES))


@pytest.mark.parametrize("name", NAMES)
def test_query(outcomes, name):
    assert outcomes[name] is None, outcomes[name]


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
