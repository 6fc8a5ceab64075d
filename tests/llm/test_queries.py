import duckdb
import pytest
from helpers import SF

import __spark_entry__ as driver
from tillroll.llm.oracles import ORACLES
from tillroll.llm.queries import QUERIES

# The contract's first columns of each query; op4 has none.
COLUMNS = {
    "op1_": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op2_": ["vec_id", "n_links", "component_id", "kept"],
    "op3_": ["doc_id", "held_out", "score", "predicted"],
    "op4_": ["doc_id", "item_id"],
    "op5_": ["doc_id", "n_shingles", "component_id", "kept"],
    "op6_": ["doc_id", "held_out", "score", "predicted"],
    "op7_": ["page_id", "url", "text", "n_chars"],
    "op8_": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op9_": ["doc_id", "held_out", "lang_pred", "score"],
    "op10_": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op11_": [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256",
    ],
    "op12_": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op13_": ["lang", "source", "part", "item", "value", "rank"],
}
TABLE = {"op2_": "embeddings", "op7_": "pages"}


@pytest.mark.parametrize("name", QUERIES)
def test_a_query_returns_a_row_per_row_of_its_table(spark, name):
    prefix = name[: name.index("_") + 1]
    df = QUERIES[name](spark, SF)
    assert df.columns[: len(COLUMNS[prefix])] == COLUMNS[prefix]
    rows = df.collect()
    if prefix not in ("op4_", "op11_", "op13_"):
        table = spark.read.parquet(f"{SF}/{TABLE.get(prefix, 'documents')}.parquet")
        key = COLUMNS[prefix][0]
        assert sorted(r[key] for r in rows) == sorted(r[key] for r in table.select(key).collect())
    if name in ORACLES:
        duck = duckdb.connect()
        for t in ("documents", "embeddings", "conversations"):
            duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        result = duck.execute(ORACLES[name])
        assert [c[0] for c in result.description] == df.columns
        assert sorted(result.fetchall(), key=repr) == sorted(map(tuple, rows), key=repr)


def test_every_operator_and_the_pipeline_are_registered():
    assert {p for p in COLUMNS} == {n[: n.index("_") + 1] for n in QUERIES}
    assert {*QUERIES, "pipeline"} <= set(driver.queries())
    assert ORACLES.items() <= driver.oracle_sql().items()
