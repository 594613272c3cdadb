from itertools import combinations

import numpy as np
import xxhash

from axonlake.llm import simhash
from axonlake.llm.components import connected_components

from .helpers import corpus, docs


def slow(text, width=4):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not w:
        return 0
    sh = [b" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))]
    h = [xxhash.xxh64(s, seed=42).intdigest() for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(ids, fps, bits=4):
    parent = {i: i for i in ids}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(ids)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= bits:
            p, q = top(ids[a]), top(ids[b])
            parent[max(p, q)] = min(p, q)
    return {i: top(i) for i in ids}


def test_fingerprints_and_groups_match_brute_force(spark):
    texts = corpus()
    got = {r.doc_id: r for r in simhash.near_duplicates(docs(spark)).collect()}
    fps = [slow(t) for t in texts]
    want = classes(list(range(len(texts))), fps)
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{f:016x}" for i, f in enumerate(fps)}
    assert {i: r.component_id for i, r in got.items()} == want


def test_links_of_planted_fingerprints(spark):
    r = np.random.default_rng(5)
    base = [int(x) for x in r.integers(0, 2**63, 40)]
    fps = list(base)
    for f in base[:30]:
        for k in (1, 3, 4, 5, 6):
            fps.append(f ^ sum(1 << int(b) for b in r.choice(64, k, replace=False)))
    fps = list(dict.fromkeys(fps))
    positions = simhash.key_positions(4)
    assert all(any(set(p) <= set(c) for p in positions) for c in combinations(range(8), 4))
    rows = []
    for i, f in enumerate(fps):
        for k, p in enumerate(positions):
            key = k
            for x in p:
                key = key << 8 | (f >> 8 * x & 255)
            rows.append((key, f - 2**64 if f >= 2**63 else f, i))
    df = spark.createDataFrame(rows, "key long, fp long, root long")
    links = df.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(simhash._links(positions, 4), "a long, b long")
    got = {r.node: r.component for r in connected_components(links).collect()}
    want = {i: c for i, c in classes(list(range(len(fps))), fps).items()}
    assert {i: got.get(i, i) for i in want} == want


def test_components(spark):
    r = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in r.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2000 + i) for i in range(50)] + [(5, None)]
    got = {x.node: x.component for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    adj = {}
    for a, b in edges:
        if b is not None and a != b:
            adj.setdefault(a, set()).add(b)
            adj.setdefault(b, set()).add(a)
    want, seen = {}, set()
    for s in sorted(adj):
        if s not in seen:
            todo = [s]
            while todo:
                x = todo.pop()
                if x not in seen:
                    seen.add(x)
                    want[x] = s
                    todo += adj[x]
    assert got == want


def test_empty(spark):
    assert simhash.near_duplicates(docs(spark, [])).collect() == []


def test_similar_documents_find_near_copies(spark):
    r = np.random.default_rng(8)
    word = lambda: "".join(chr(97 + int(c)) for c in r.integers(0, 26, 5))
    base = [[word() for _ in range(300)] for _ in range(60)]
    texts = [" ".join(b) for b in base]
    for k, b in enumerate(base[:40]):  # 5 edits of 300 words: similarity about 0.85
        e = list(b)
        for i in range(25, 300, 60):
            e[i + int(r.integers(0, 20))] = word()
        texts.append(" ".join(e))
    for b in base[40:]:  # half the words edited: not alike
        texts.append(" ".join(w if i % 10 > 2 else word() for i, w in enumerate(b)))
    got = {x.doc_id: x.component_id for x in simhash.similar_documents(docs(spark, texts + [None, "", texts[0]])).collect()}
    assert sum(got[60 + k] == k for k in range(40)) >= 37
    assert all(got[i] == i for i in [*range(60), *range(100, 120)])
    assert got[120] == got[121] == 120 and got[122] == 0
    assert simhash.similar_documents(docs(spark, [])).collect() == []


def test_saved_tables_can_be_deleted(spark):
    import os

    from axonlake.llm import common

    common.saved(spark.range(3), "t")
    folder = common._tables(spark).removeprefix("file://")
    assert os.listdir(folder)
    common.clean(spark)
    assert not os.path.exists(folder)


def test_hot_keys_are_split_without_losing_links(spark):
    from pyspark.sql import functions as F

    r = np.random.default_rng(6)
    top = 0x1122334400000000
    fps = {top | int(x) for x in r.integers(0, 2**32, 150)}  # agree in four bytes: hot keys even with one more byte
    fps |= {f ^ 1 << int(a) ^ 1 << int(b) ^ (1 << int(c)) for f in sorted(fps)[:60] for a, b, c in r.integers(0, 63, (3, 3))}
    fps |= {0x55AA660000000000 | int(x) for x in r.integers(0, 2**40, 80)} | {int(x) for x in r.integers(0, 2**63, 80)}
    fps = sorted(fps)
    df = spark.createDataFrame([(f, i) for i, f in enumerate(fps)], "fp long, root long")
    want = classes(list(range(len(fps))), fps)
    assert len(set(want.values())) < len(fps) - 50
    for bits in (4, 5):  # a key shares one more byte of its links, or none
        positions = simhash.key_positions(bits)
        code = lambda k, p: F.lit(k << 24).bitwiseOR(sum(((F.shiftrightunsigned("fp", 8 * x).bitwiseAND(F.lit(255))) * (1 << 8 * (2 - i)) for i, x in enumerate(p)), F.lit(0)))
        postings = df.select(F.explode(F.array(*(code(k, p).cast("long") for k, p in enumerate(positions)))).alias("key"), "fp", "root")
        split = simhash._split(postings, positions, bits, 10)
        assert postings.groupBy("key").count().agg(F.max("count")).first()[0] > 150
        assert split.groupBy("key").count().agg(F.max("count")).first()[0] <= 40
        links = split.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(simhash._links(positions, bits), "a long, b long")
        got = {x.node: x.component for x in connected_components(links).collect()}
        assert {i: got.get(i, i) for i in want} == classes(list(range(len(fps))), fps, bits)
    texts = corpus()
    a, b = (sorted(map(tuple, simhash.near_duplicates(docs(spark), hot=h).collect())) for h in (1, simhash.HOT))
    assert a == b and len(a) == len(texts)
