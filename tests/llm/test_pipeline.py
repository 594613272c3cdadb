"""The pipeline's stages against brute-force rules on a small corpus with planted cases."""

import random

import corpus_pipeline as cp

from .helpers import SCHEMA
from .test_quality import slow as counts
from .test_secrets import slow as secret_spans


def prose(r, n=90):
    return " ".join("".join(r.choice("abcdefgilmnorstu") for _ in range(r.randrange(2, 9))) for _ in range(n))


def alike(a, b):
    a, b = ({tuple(t.lower().split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in (a, b))
    return len(a & b) >= 0.8 * len(a | b)


def test_stages(spark, tmp_path):
    r = random.Random(9)
    item = prose(r, 30)
    base = [prose(r) for _ in range(12)]
    texts = [*base, base[0], base[1].replace(" ", "  "), "short text", None, "", "spam egg ham " * 40, base[2] + "\n" + item + "\n" + base[3], base[4] + " password = hunter2hunter " + base[5]]
    rows = [(i, t, "en", "s", None if t is None else len(t), "x", 0) for i, t in enumerate(texts)] + [(None, base[6] + " z" * 3, "en", None, 5, "x", 0), (3, base[3], "en", "s", 1, "x", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    spark.createDataFrame([(0, item), (1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    names = docs.columns

    kept = cp.quality_rules(spark, docs, str(tmp_path))
    good = {i for i, t, *_ in rows if (c := counts(t))[0] >= 50 and 100 * c[4] <= 50 * c[0]}
    assert kept.columns == names and {x.doc_id for x in kept.collect()} == good
    assert kept.count() == len([1 for x in rows if x[0] in good])

    single = cp.near_dedup(spark, kept, str(tmp_path))
    ids = [i for i in sorted(good - {None})]
    want = {i for i in ids if not any(alike(texts[i], texts[j]) for j in ids if j < i)} | {None}
    got = [x.doc_id for x in single.collect()]
    assert single.columns == names and set(got) == want and len(got) == len(want)

    clean = cp.decontaminate(spark, single, str(tmp_path))
    assert clean.columns == names and {x.doc_id for x in clean.collect()} == want - {18}

    safe = cp.redact_secrets(spark, clean, str(tmp_path))
    assert safe.columns == names
    for x in safe.collect():
        if x.doc_id == 19:
            assert "hunter2" not in x.text and "[SECRET]" in x.text and x.n_chars == len(x.text)
        elif x.doc_id is not None:
            assert x.text == texts[x.doc_id] and not secret_spans(x.text)

    packed = cp.pack(spark, safe, str(tmp_path)).collect()
    assert {x.doc_id for x in packed} == want - {18}
    docs.drop("spans", "pack").write.parquet(f"{tmp_path}/documents.parquet")
    assert {x.doc_id for x in cp.run(spark, str(tmp_path)).collect()} == want - {18}


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.collect() == []


def test_clashing_columns_pass_through(spark, tmp_path):
    r = random.Random(4)
    spark.createDataFrame([(0, prose(r, 30))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    extra = ["_id", "_key", "_base", "_runs", "_nulls", "_spans", "_row", "spans", "component_id", "fp", "kept"]
    rows = [(i, prose(r) + (" password=hunter2hunter" if i == 3 else ""), "en", "s", 9, *range(len(extra))) for i in range(6)] + [(None, prose(r), "en", None, 9, *range(len(extra)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in extra))
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        got = out.collect()
        assert len(got) == 7 and all(tuple(x)[5:] == tuple(range(len(extra))) for x in got)
        docs = out
