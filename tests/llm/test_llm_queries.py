"""The registered queries of the text operators over whole tables, against their SQL or brute force."""

import hashlib

import duckdb
import pytest
from test_llm_scans import brute_personal, brute_quality
from llm_cases import plain

from silverline.llm import pii, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "embeddings", "conversations"):
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, con, name):
    want = con.execute(queries.SQL[name])
    names = [c[0] for c in want.description]
    ours = queries.QUERIES[name](spark, SF)
    assert sorted(ours.columns) == sorted(names)
    assert plain(ours.select(*names).collect()) == plain(want.fetchall())


def test_personal_data_counts(spark, con):
    want = []
    for doc_id, text in con.execute("select doc_id, text from documents").fetchall():
        spans = brute_personal(text) if len(text or "") < 2000 else pii.find_base(text)
        listing = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in spans)
        want.append((doc_id, *(sum(k == kind for k, _, _ in spans) for kind in range(4)), hashlib.sha256(listing.encode()).hexdigest()))
    got = queries.QUERIES["op1_contextual_pii"](spark, SF).drop("spans").collect()
    assert plain(got) == plain(want)


def test_quality_over_the_table(spark, con):
    want = [(doc_id, *brute_quality(text)) for doc_id, text in con.execute("select doc_id, text from documents").fetchall()]
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert plain(queries.QUERIES["op7_compression_quality"](spark, SF).select(*names).collect()) == plain(want)


def test_every_operator_is_registered_once():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
