import glob
import os

import duckdb
import pandas as pd
import pytest

from eventide.llm.queries import ORACLE, QUERIES
from llm_helpers import SF_SMALL
from tools.oracle_check import canon


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF_SMALL}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    df = QUERIES[name](spark, SF_SMALL)
    got = pd.DataFrame([r.asDict() for r in df.collect()], columns=df.columns)
    assert canon(got) == canon(con.execute(ORACLE[name]).df())


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
