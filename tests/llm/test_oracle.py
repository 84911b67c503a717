"""Queries of the subpackage against their DuckDB SQL, and brute force where there is none, on whole small tables."""

import hashlib

import duckdb
import pytest

from tidemark.llm.oracle import ORACLE
from tidemark.llm.queries import QUERIES, vocabulary
from tidemark.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    rel = con.sql(ORACLE[name])
    assert sorted(rel.columns) == cols
    at = {c: i for i, c in enumerate(rel.columns)}
    assert got == sorted((tuple(r[at[c]] for c in cols) for r in rel.fetchall()), key=repr)


def texts(con):
    return dict(con.sql("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


def test_op4_against_brute_force(spark, con):
    from test_jaccard import brute

    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op4_jaccard"](spark, SF).collect()}
    assert got == brute(list(texts(con).items()), 4, 85)


def test_op5_against_library(spark, con):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op5_bpe"](spark, SF).collect()}
    for d, text in texts(con).items():
        ids = t.encode(text, add_special_tokens=False).ids
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        back = t.decode(ids, skip_special_tokens=False)
        assert got[d] == (len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode()).hexdigest())


def test_op3_contract(spark, con):
    rows = {r.doc_id: r for r in QUERIES["op3_fingerprint"](spark, SF).collect()}
    docs = sorted(texts(con).items())
    assert len(rows) == len(docs)
    for (d, a), (_, b) in zip(docs, docs[1:] + docs[:1]):
        q = len(a) // 4
        edited = a[:len(a) - q] + b[:q]
        assert rows[d].n_chars == len(a) and rows[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= rows[d].near_next <= 1 and 0 <= rows[d].near_edited <= 1
    long = [rows[d].near_edited for d, a in docs if len(a) > 1500]
    assert sum(x > 0.3 for x in long) > 0.9 * len(long)


def test_op2_articles(spark):
    rows = QUERIES["op2_html"](spark, SF).collect()
    assert rows and all(r.text and r.n_chars == len(r.text) and "<" not in r.text and "©" not in r.text for r in rows)


def test_op7_finds_the_damage(spark, con):
    rows = QUERIES["op7_warc"](spark, SF).collect()
    ids = [r[0] for r in con.sql("SELECT page_id FROM pages").fetchall()]
    by = {f: sorted(r.page_id for r in rows if r.fault == f and r.page_id is not None) for f in ("changed", "missing")}
    assert by == {"changed": sorted(i for i in ids if i % 97 == 13 and i % 389 != 7), "missing": sorted(i for i in ids if i % 389 == 7)}
    assert sum(r.fault == "extra" for r in rows) == sum(i % 499 == 3 for i in ids)


def test_op7_replicas_are_hashed(spark, con):
    rows = QUERIES["op7_replicas"](spark, SF).collect()
    pages = con.sql("SELECT page_id FROM pages").fetchall()
    stored = {r.digest for r in rows if r.digest}
    hurt = [i for i, in pages if i % 97 == 13 and i % 389 != 7]
    # the altered text has a digest that no stored record has
    assert hurt and sum(r.other_digest is not None and r.other_digest not in stored for r in rows if r.fault in ("changed", "extra")) >= len(hurt)
    assert {i for i, in pages if i % 389 == 7} <= {r.page_id for r in rows if r.fault in ("missing", "changed")}


def test_op10_held_out_accuracy(spark, con):
    rows = {r.doc_id: r for r in QUERIES["op10_quality"](spark, "/root/testdata/sf0.01").collect()}
    labels = duckdb.connect().sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall()
    held = [(rows[d].predicted, q) for d, q in labels if rows[d].held_out]
    assert len(held) > 50 and sum(p == q for p, q in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows.values())
