import hashlib

from axonlake.llm import sharding

from .helpers import corpus, docs


def slow(keys, sizes, limit):
    h = [int(hashlib.md5(str(k).encode()).hexdigest()[:15], 16) for k in keys]
    out = {}
    for k, x in zip(keys, h, strict=True):
        for d in range(61):
            n = sum(s for y, s in zip(h, sizes, strict=True) if y >> (60 - d) == x >> (60 - d))
            if n <= limit:
                break
        out[k] = (f"{x:060b}"[:d], d, n)
    return out


def test_shards_match_brute_force(spark):
    texts = corpus()
    sizes = [len((t or "").encode()) for t in texts]
    for limit in (max(sizes), 3 * max(sizes), sum(sizes)):
        got = {r.doc_id: (r.shard, r.depth, r.shard_bytes) for r in sharding.shards(docs(spark), limit, more_bits=2).collect()}
        assert got == slow(list(range(len(texts))), sizes, limit)
    x = sharding.shards(docs(spark), max(sizes))
    assert sum(r.n_entries for r in sharding.directory(x).collect()) <= 2 ** max(r.depth for r in x.collect())


def test_hot_key_and_large_document(spark):
    x = docs(spark, ["x" * 100] * 30 + ["y" * 900])
    x = x.withColumn("doc_id", x.doc_id * 0)
    rows = sharding.shards(x, 250).collect()
    assert len(rows) == 31 and all(r.depth == 60 for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.part, []).append(r.n_bytes)
    assert all(sum(v) <= 350 or len(v) <= 3 for v in by.values())
    assert sharding.shards(docs(spark, []), 10).collect() == []
