import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from tools.check import keyed

SF = "/root/testdata/sf0.001"

SAMPLE = [
    "w01_densify_interpolate", "w03_extract_series", "w06_risk_labels", "w08_split_with_means",
    "w10_percentile_cells", "a06_sector_shares", "a08_hit_ratios", "a14_fit_lines", "a21_cell_counts",
    "b02_profile_features", "b06_spend_features", "c07_clean_hex_daily", "v08_violation_report_msoa_monthly",
    "s10_reconcile", "j04_full_outer_merge", "m05_adjusted_rand", "m26_class_scores", "u02_stack_day_kinds",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def test_contract_keys():
    queries, sql = contract.queries(), contract.oracle_sql()
    assert set(sql) <= set(queries) and len(sql) > 120


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_entry(spark):
    assert contract.entry(spark).count() == 13


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", SAMPLE)
def test_sample_matches_sql(spark, con, name):
    df = contract.queries()[name](spark, SF)
    cur = con.execute(contract.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert keyed([tuple(r) for r in df.collect()], df.columns) == keyed(cur.fetchall(), names)


def test_a_shuffle_is_measured_against_chance(spark, tmp_path):
    """Many rows a price: nearly every size is met at every price by chance."""
    from kerbline.workload import REGISTRY

    rows = spark.range(3000).selectExpr(
        "id AS p_partkey", "CAST(pmod(xxhash64(id, 1), 50) AS INT) AS p_size", "CAST(pmod(id, 20) AS DOUBLE) AS p_retailprice"
    )
    rows.write.parquet(str(tmp_path / "part.parquet"))
    assert REGISTRY["m07_rows_apart"].run(spark, str(tmp_path)).collect()[0][:] == (3000, 0)
