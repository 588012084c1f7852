import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_needs_no_optional_part():
    from callweave.plans import core

    assert set(core.QUERIES) <= set(entry.queries()) and "p3_found" in core.QUERIES


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", ["p3_found", "ref_p1_p2_o3_viewer_listing", "ref_a5_a6_facet_counts_facets", "ref_a1_collapsed", "ref_j2_upsert", "ref_l1_t16_ids", "ref_m1_j5_j6_domain_scores", "ref_r6_breakers"])
def test_queries_give_the_rows_of_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"create view {file.removesuffix('.parquet')} as select * from '{SF}/{file}'")
    text = lambda df: sorted(df[sorted(df.columns)].astype(str).replace({"None": "", "nan": "", "<NA>": "", "NaT": ""}).itertuples(index=False, name=None))
    assert text(entry.queries()[name](spark, SF).toPandas()) == text(con.sql(entry.oracle_sql()[name]).df())
