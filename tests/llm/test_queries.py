"""The registered queries: their columns, types and values on a small folder."""

import hashlib
import zlib

import pytest

from axonlake.llm import queries as Q

from ..oracle import connect, rows_of
from .helpers import corpus, docs
from .test_pii import slow as private
from .test_quality import slow as counts
from .test_secrets import slow as secret
from .test_simhash import classes
from .test_simhash import slow as print_of
from .test_suffix_dedup import slow as removed

TYPES = {
    "op1": {"doc_id": "bigint", "n_bytes": "bigint", "shard": "string", "depth": "int", "shard_bytes": "bigint"},
    "op2": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op3": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op4": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
    "op5": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op6": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
    "op7": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    "op8": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op9": {"doc_id": "bigint", "item_id": "bigint"},
    "op10": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op11": {"doc_id": "bigint", "leaf": "string", "subroot": "string", "root": "string", "proof_sha256": "string", "folded_root": "string", "verified": "boolean"},
    "op12": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
    "op13": {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"},
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    docs(spark).repartition(2).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(0, "w1x7 " * 3), (1, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(i, [0.1 * (i % 5), 0.3], i % 3) for i in range(201)], "vec_id long, embedding array<float>, label int").write.parquet(f"{d}/embeddings.parquet")
    return d


@pytest.fixture(scope="module")
def results(spark, folder):
    return {name.split("_")[0]: f(spark, folder) for name, f in Q.queries().items()}


def test_columns(results):
    assert sorted(results) == sorted(TYPES)
    for name, df in results.items():
        assert TYPES[name].items() <= dict(df.dtypes).items(), name


def sha(kinds, spans):
    return hashlib.sha256(",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()


def test_values(results):
    texts = corpus()
    rows = {k: {r.doc_id: r for r in results[k].collect()} for k in ("op2", "op3", "op5", "op6", "op7", "op8", "op4")}
    assert all(sorted(r) == list(range(len(texts))) for r in rows.values())
    fps = [print_of(t) for t in texts]
    groups, gone, at = classes(list(range(len(texts))), fps), removed(texts, 50), 0
    for i, t in enumerate(texts):
        assert (rows["op2"][i].fingerprint, rows["op2"][i].component_id) == (f"{fps[i]:016x}", groups[i])
        assert tuple(rows["op3"][i])[1:] == gone[i]
        c = counts(t)
        assert (rows["op5"][i].n_words, rows["op5"][i].word_chars, rows["op5"][i].n_symbols, rows["op5"][i].n_dup_lines, rows["op5"][i].n_repeat_words) == c
        p, s = private(t), secret(t)
        x, y = rows["op6"][i], rows["op7"][i]
        assert (x.n_email, x.n_ip, x.n_card, x.n_phone) == tuple(sum(z[1] == k for z in p) for k in range(4))
        assert x.base_sha256 == sha(("email", "ip", "card", "phone"), p)
        assert (y.n_assign, y.n_access, y.n_hex) == tuple(sum(z[1] == k for z in s) for k in range(3))
        assert y.base_sha256 == sha(("assign", "access", "hex"), s)
        assert rows["op8"][i].start == at
        at += rows["op8"][i].n_tokens
        assert rows["op4"][i].held_out == (zlib.crc32(str(i).encode()) % 10 == 0)


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_against_sql(spark, name):
    d = "/root/testdata/sf0.001"
    df = Q.queries()[name](spark, d)
    cur = connect(d).execute(Q.oracle_sql()[name])
    want = rows_of([c[0] for c in cur.description], cur.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want


@pytest.mark.parametrize("name", ["op3_suffix_array_dedup", "op5_line_frequency_quality"])
def test_odd_texts_against_sql(spark, folder, name):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    cur = con.execute(Q.oracle_sql()[name])
    want = rows_of([c[0] for c in cur.description], cur.fetchall())
    df = Q.queries()[name](spark, folder)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want
