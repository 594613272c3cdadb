import random
import re

import numpy as np

from axonlake.llm import pii

from .helpers import corpus, docs


def slow(t):
    t, out = t or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 12 <= len(d) <= 19 and sum(sum(divmod(2 * x, 10)) if i % 2 else x for i, x in enumerate(d[::-1])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_patterns_match_regular_expressions():
    r = random.Random(2)
    for letters in ("ab.@-", "19. -+()", "@a.b%+ 12", "0123456789 .-"):
        for _ in range(1500):
            t = "".join(r.choice(letters) for _ in range(r.randrange(60)))
            assert [(s, k, e) for s, k, e, _ in pii.base_spans(t)] == slow(t), t


def test_scan_base_and_edges(spark):
    texts = corpus()
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.scan(docs(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert [s for s in got[i] if s[1] < 4] == slow(t)
    assert pii.scan(docs(spark, [])).collect() == []


def test_disclosing_terms(spark):
    r = random.Random(5)
    filler = lambda n: " ".join(r.choice(["alder", "birch", "cedar", "dune", "elm", "fern"]) for _ in range(n))
    texts = [f"{filler(6)} zorblax mail jo.doe@corp.example now {filler(6)}" for _ in range(6)]
    texts += [f"{filler(4)} common mail p{i}@x.example {filler(9)}" for i in range(30)]
    texts += [filler(30) + " common" for _ in range(60)]
    texts += [f"kept qwerty q@once.example {'same ' * 5}"] * 5  # copies are one piece of evidence
    got = {x.doc_id: list(x.spans) for x in pii.scan(docs(spark, texts)).collect()}
    for i in range(6):
        at = texts[i].index("zorblax")
        assert [(s.start, s.end) for s in got[i] if s.k >= 4 and s.start == at] == [(at, at + 7)]
        assert all(texts[i][s.start : s.end] in ("zorblax", "now") for s in got[i] if s.k >= 4)
    assert all(s.k < 4 for i in range(6, len(texts)) for s in got[i])
    clean = {x.doc_id: x.text for x in pii.sanitised(docs(spark, texts)).collect()}
    assert "zorblax" not in clean[0] and "[WORD]" in clean[0] and "[EMAIL]" in clean[0] and clean[60] == texts[60]


def test_each_row_is_sanitised_by_its_own_text(spark):
    rows = [(1, "write bob@example.com now", "a"), (1, "see x zed@site.org y", "b"), (None, "x zed@site.org y", "c"), (None, "long clean text of the same id", "d"), (2, None, "e"), (1, "write bob@example.com now", "a")]
    x = pii.sanitised(spark.createDataFrame(rows, "doc_id long, text string, _row string").withColumnRenamed("_row", "_spans"))
    assert x.columns == ["doc_id", "text", "_spans"]
    got = sorted((tuple(r) for r in x.collect()), key=lambda r: r[2])
    assert [r[0] for r in got] == [1, 1, 1, None, None, 2]
    assert all(r[1].count("[EMAIL]") == 1 and "@" not in r[1] for r in got[:4]) and got[0][1] == got[1][1] and got[2][1].startswith("see")
    assert got[4][1] == rows[3][1] and got[5][1] is None


def test_classes_of_generalised_terms(spark):
    from pyspark.sql import functions as F

    terms = ["(Smith),", "12-34", "A7x!", "NASA", "zorb.", "ñu", "Émile"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in terms], "t string").select(pii._general(F.col("t"))).collect()]
    assert got == ["([NAME]),", "[NUMBER]", "[CODE]!", "[ACRONYM]", "[WORD].", "[WORD]", "[NAME]"]


def test_terms_of_rare_entities_are_judged(spark):
    filler = "alder birch cedar dune elm fern"
    texts = [f"{filler} zorblax mail jo.doe@corp.example {filler}", f"{filler} {filler}", f"mail {filler}"] + [f"mail {filler} {filler}"] * 2000
    texts += [f"quimby {filler} tel +1 (389) 555-5010 {filler}"] * 2
    got = {x.doc_id: [(texts[x.doc_id][s.start : s.end], s.k) for s in x.spans] for x in pii.scan(docs(spark, texts)).collect()}
    assert got[0] == [("zorblax", 4), ("jo.doe@corp.example", 0)]
    assert [t for t, _ in got[2003]] == [t for t, _ in got[2004]] == ["quimby", "tel", "+1 (389) 555-5010"]
    assert not any(got[i] for i in range(1, 2003))


def test_eight_words_on_either_side_however_long():
    long = ["x" * n for n in (500, 3, 900, 40, 7, 320, 5, 11, 6)]
    t = " ".join(long) + "  mail:a@b.example, " + "\n".join(long)
    got = [t[a:z] for _, _, _, a, z in pii.nearby(t, pii.base_spans(t))]
    assert got == [*long[2:], "mail:", *long[:7]]


def test_same_counts_same_verdict_at_any_size(spark):
    # (term, documents with both, different surroundings, documents with the term)
    cases = [(1, 1, 1, 1), (2, 1, 1, 2), (3, 1, 1, 62), (4, 6, 6, 8), (5, 6, 6, 14), (6, 9, 9, 9), (7, 5, 1, 5), (8, 20, 20, 20)]
    pairs = spark.createDataFrame([(7, t, i % seen, t * 1000 + i) for t, both, seen, _ in cases for i in range(both)], "entity long, term long, around long, row long")
    counts = spark.createDataFrame([(t, n) for t, _, _, n in cases], "term long, n long")
    entities = spark.createDataFrame([(7, 25)], "entity long, n_entity long")
    verdicts = []
    for n_docs in (10**3, 10**5, 10**7, 10**9):
        got = {x.term: x.p for x in pii.disclosing(pairs, counts, entities, n_docs, pii.GENERALISE).collect()}
        verdicts.append({t: p >= pii.CERTAIN for t, p in got.items()})
    assert verdicts == [{1: False, 4: False, 6: True, 7: False, 8: True}] * 4
    assert pii.disclosing(pairs, counts, entities, 25, pii.GENERALISE).count() == 0


def slow_spans(texts):
    """The method's spans from counts over all texts: (document, start, end) -> whether the term is removed."""
    found = [pii.base_spans(t) for t in texts]
    near, docs_of, held = {}, {}, {}
    for d, t in enumerate(texts):
        for w in {pii.term_of(w) for w in t.encode().lower().split()} - {None}:
            docs_of[w] = docs_of.get(w, 0) + 1
        words = [(m.start(), m.end()) for m in re.finditer(r"\S+", t)]
        for s, k, e, value in found[d]:
            held.setdefault((k, value), set()).add(d)
            mine = [(a, z) for a, z in words if z <= s][-8:] + [(a, z) for a, z in words if a >= e][:8]
            mine = [(a, z) for a, z in mine if all(z <= x or a >= y for x, _, y, _ in found[d])]
            around = " ".join(t[a:z] for a, z in mine)
            for a, z in mine:
                if w := pii.term_of(t[a:z].lower().encode()):
                    near.setdefault(((k, value), w), []).append((around, d, a, z))
    out = {}
    for (entity, w), places in near.items():
        both, seen = len({x[:2] for x in places}), len({x[0] for x in places})
        p_entity = len(held[entity]) / len(texts)
        p = seen / (seen * max(1, docs_of[w] / both) + 1)
        if p_entity < 1 and p >= 0.5 and np.log(p / p_entity) / -np.log(p_entity) >= 0.8:
            for _, d, a, z in places:
                out[d, a, z] = out.get((d, a, z), False) or p >= 0.9
    return out


def test_spans_of_terms_match_brute_force(spark):
    r = random.Random(8)
    vocab = [f"term{k}" for k in range(60)]
    texts = []
    for i in range(300):
        w = [vocab[int(60 * r.random() ** 2)] for _ in range(r.randrange(5, 30))]
        for _ in range(r.randrange(0, 3)):
            p = r.randrange(12)
            w.insert(r.randrange(len(w)), f"p{p}@mail.example")
            if r.random() < 0.7:
                w.insert(w.index(f"p{p}@mail.example"), f"alias{p}")
        texts.append(" ".join(w))
    texts += [texts[0]] * 5 + [f"{texts[k]} alias3" for k in range(4)] + ["alone once@mail.example here"]
    got = {(x.doc_id, s.start, s.end): s.k == 5 for x in pii.scan(docs(spark, texts)).collect() for s in x.spans if s.k >= 4}
    want = slow_spans(texts)
    assert got == want and True in want.values() and False in want.values()
