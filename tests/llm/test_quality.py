import re
from collections import Counter

from axonlake.llm import quality

from .helpers import corpus, docs


def slow(t):
    t = t or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines, seen, dup = t.split("\n"), set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n, cover = Counter(grams), set()
    for i, g in enumerate(grams):
        if n[g] > 1:
            cover |= {i, i + 1, i + 2}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover))


def test_counts_match_brute_force(spark):
    texts = corpus() + ["a b c a b c", "# * $ %&|<>\nx\nx\n\n\nx", "ñ　ñ \x1c x\x85y"]
    got = {r.doc_id: r for r in quality.judged(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        want = slow(t)
        assert tuple(got[i][s] for s in quality.STATS) == want
        assert got[i].base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (got[i].base_failed and got[i].kept)


def prose(k, n=60):
    return " ".join(f"v{k}x{j * j % 97}y{j}" for j in range(n))


def test_boilerplate_depletes_and_copies_do_not(spark):
    menu = "\n".join(" ".join(f"m{i}n{j}" for j in range(20)) for i in range(6))
    lines = menu.split("\n")
    spam = ["\n".join([prose(100 + k, 20), *sorted(lines, key=lambda x: hash((x, k)))]) for k in range(60)]
    copies = ["\n".join([prose(1), prose(2), prose(3)])] * 60
    clean = [prose(200 + k) + "\n" + lines[0] for k in range(30)]
    got = [r.kept for r in quality.judged(docs(spark, spam + copies + clean).withColumn("source", __import__("pyspark.sql.functions").sql.functions.lit("s")), min_docs=20).orderBy("doc_id").collect()]
    assert not any(got[:60]) and all(got[60:])


def test_edges(spark):
    assert quality.judged(docs(spark, [])).collect() == []
    x = quality.kept_documents(docs(spark, [prose(1), None, prose(2), "x"]))
    assert [r.doc_id for r in x.orderBy("doc_id").collect()] == [0, 2] and x.columns == docs(spark, []).columns


def test_fixed_header_and_footer_are_boilerplate(spark):
    part = lambda name, n: [" ".join(f"{name}{i}n{j}" for j in range(12)) for i in range(n)]
    pages = ["\n".join([*part("h", 10), prose(k, 25), *part("f", 6)]) for k in range(40)]
    same = ["\n".join([prose(500), prose(501)])] * 40
    got = quality.judged(docs(spark, pages + same).selectExpr("doc_id", "text", "'s' AS source")).orderBy("doc_id").collect()
    assert [r.kept_words for r in got[:40]] == [25] * 40 and not any(r.kept for r in got[:40])
    assert all(r.kept and r.kept_words == 120 for r in got[40:])
