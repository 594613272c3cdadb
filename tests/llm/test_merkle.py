"""Merkle manifest against a plain fold of the same rules."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from axonlake.llm import merkle
from axonlake.llm import queries as Q

from .helpers import corpus, docs

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def grown(nodes):
    """(root, siblings of each node from the bottom up as (before, after))."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for p, k in zip(paths, at, strict=True):
            run = nodes[k // 8 * 8 : k // 8 * 8 + 8]
            p.append(("".join(run[: k % 8]), "".join(run[k % 8 + 1 :])))
        nodes, at = [h(*nodes[k : k + 8]) for k in range(0, len(nodes), 8)], [k // 8 for k in at]
    return (nodes or [None])[0], paths


def expected(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = (own, *grown([leaf(r) for r in own]))
    root, tops = grown([trees[x][1] for x in langs])
    out = []
    for lang, top in zip(langs, tops, strict=True):
        own, sub, paths = trees[lang]
        for r, p in zip(own, paths, strict=True):
            low = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            x = leaf((*r[:4], r[4].translate({c: c + 32 for c in range(65, 91)}) if low and r[4] else r[4]))
            for before, after in p + top:
                x = h(before, x, after)
            out.append((r[0], leaf(r), sub, root, h(*(a + b for a, b in p + top)), x, x == root))
    return out


def found(spark, tmp_path, df):
    df.write.parquet(f"{tmp_path}/documents.parquet")
    x = Q.op11_merkle_manifest(spark, str(tmp_path))
    assert x.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return [tuple(r) for r in x.collect()]


def key(r):
    return tuple((v is not None, v) if v is not None else (False, 0) for v in r)


@pytest.mark.parametrize("n", [1, 8, 9, 65, 130])
def test_sizes(spark, tmp_path, n):
    rows = [(3 * i, "s", "en" if i % 3 else ("de" if i % 2 else None), i, f"Text {i} ñ") for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert sorted(found(spark, tmp_path, df), key=key) == sorted(expected(rows), key=key)


def test_odd_rows(spark, tmp_path):
    rows = [(None, None, None, None, None), (None, "a", "", 1, ""), (4, "a", "", 1, "A"), (4, "a", "", 1, "A"), (4, "a", "", 1, "B"), (5, "é", "zz", -1, "x" * 100_000), (-7, "", "zz", 0, None), (7, "b", None, 2, "Q")]
    df = spark.createDataFrame([(*r, "i", "g") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, h string, g string")
    got = found(spark, tmp_path, df)
    assert sorted(got, key=key) == sorted(expected(rows), key=key)
    assert not all(r[-1] for r in got)


def test_empty(spark, tmp_path):
    assert found(spark, tmp_path, docs(spark, corpus()[:1]).where("false")) == []


def test_paths_verify(spark):
    x = merkle.manifest(docs(spark), F.col("source"), F.col("doc_id"), merkle.leaf(F.col("text")), {"doc_id": F.col("doc_id")})
    assert x.where(merkle.folded(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0
    assert x.count() == len(corpus()) and x.select("root").distinct().count() == 1
