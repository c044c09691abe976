"""Every registered query: its columns, and its SQL where there is some."""

import duckdb
import pytest

import __spark_entry__ as entry
from bureauframe.llm import queries

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "query_id bigint, rank int, vec_id bigint, score double",
    "op2": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op3": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op4": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op5": "doc_id bigint, fingerprint string, component_id bigint",
    "op6": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op7": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op8": "page_id bigint, url string, text string, n_chars bigint",
    "op9": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op10": "doc_id bigint, other_doc_id bigint, start_word int, end_word int",
    "op11": "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "cost bigint, audit string, repaired_sha256 string",
    "op12": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op13": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
}
FOUND = queries.queries()


def test_registered():
    assert sorted(n.split("_")[0] for n in FOUND) == sorted(COLUMNS)
    assert set(FOUND) | {"pipeline"} <= set(entry.queries())
    assert set(queries.oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", FOUND)
def test_columns(spark, name):
    frame = FOUND[name](spark, SF)
    kinds = dict(frame.dtypes)
    for item in COLUMNS[name.split("_")[0]].split(", "):
        column, kind = item.split()
        assert kinds[column] == kind
    assert frame.count() > 0


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.sql(queries.oracle_sql()[name])
    got = FOUND[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    order = sorted(got.columns)
    assert sorted(map(tuple, got.select(order).collect())) == sorted(want.select(*order).fetchall())
