"""Personal data: fixed patterns, and terms that reveal them by the corpus's co-occurrence counts."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, saved, ship, words_of

KINDS = ("email", "ip", "card", "phone", "general", "removed")
#: Words on either side of an entity that may reveal it.
REACH = 8
#: Documents without the entity that a term's estimate starts from, so that little evidence discloses less.
PRIOR = 1.0
#: A term discloses an entity if its mutual information with it is this share of the entity's information ...
GENERALISE = 0.8
#: ... and the entity is at least so probable where the term is: generalised from the first, removed from the second.
PROBABLE, CERTAIN = 0.5, 0.9
#: Distinct terms that a task counts in memory before it passes the counts on.
HELD_TERMS = 600_000
EDGE = b".,;:!?\"'()[]{}<>"
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
MASKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "removed": ""}
#: What a generalised term becomes: the first of these classes whose pattern its core (without EDGE) has, else [WORD].
GENERAL = (("[NUMBER]", r"^[0-9][0-9.,:/-]*$"), ("[CODE]", r"[0-9_@/\\=+]"), ("[ACRONYM]", r"^\p{Lu}{2,}$"), ("[NAME]", r"^\p{Lu}"))


def emails(t: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of local@domain, walking back from each @ so that long runs stay linear."""
    free, at = 0, t.find("@")
    while at >= 0:
        m = DOMAIN.match(t, at)
        if m:
            s = at
            while s > free and t[s - 1] in LOCAL:
                s -= 1
            if s < at:
                yield s, m.end()
                free = m.end()
                at = t.find("@", free)
                continue
        at = t.find("@", at + 1)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) << (k & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(t: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) by start, then kind; value is the entity without its layout."""
    out = [(s, 0, e, t[s:e].lower()) for s, e in emails(t)] if "@" in t else []
    for m in IP.finditer(t):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end(), m[0]))
    for m in CARD.finditer(t):
        d = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end(), d))
    if "+" in t:
        for m in PHONE.finditer(t):
            d = re.sub(r"[^0-9]", "", m[0])
            if 9 <= len(d) <= 15:
                out.append((m.start(), 3, m.end(), d))
    return sorted(out)


def term_of(word: bytes) -> bytes | None:
    w = word.strip(EDGE)
    return w if len(w) >= 3 else None


def _hash(x: bytes) -> int:
    return xxhash.xxh64_intdigest(x) - (1 << 63)


def nearby(t: str, spans: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, int, int]]:
    """(entity, term, surroundings, start, end) of the terms within REACH words of an entity and outside all spans."""
    out = []
    found = [m.span() for m in WORD.finditer(t)] if spans else []
    starts, ends = [a for a, _ in found], [z for _, z in found]
    for s, k, e, value in spans:
        entity = _hash(f"{k}:{value}".encode())
        i, j = bisect_left(starts, s), bisect_right(ends, e)
        # words that touch the entity are cut there
        near = [(a, min(z, s)) for a, z in found[max(0, i - REACH) : i]] + [(max(a, e), z) for a, z in found[j : j + REACH]]
        words = [(a, z) for a, z in near if all(z <= x or a >= y for x, _, y, _ in spans)]
        around = _hash(" ".join(t[a:z] for a, z in words).encode())
        for a, z in words:
            if (w := term_of(t[a:z].encode("utf-8", "surrogatepass").lower())) is not None:
                out.append((entity, _hash(w), around, a, z))
    return out


PAIR = "array<struct<entity:long,term:long,around:long,start:int,end:int>>"
FOUND = f"doc_id long, row long, base array<struct<start:int,k:int,end:int>>, pairs {PAIR}"
_BASE = pa.list_(pa.struct([("start", pa.int32()), ("k", pa.int32()), ("end", pa.int32())]))
_PAIRS = pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.int64()), ("around", pa.int64()), ("start", pa.int32()), ("end", pa.int32())]))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        base, pairs = [], []
        for t in b.column("text").to_pylist():
            t = t or ""
            spans = base_spans(t)
            base.append([{"start": s, "k": k, "end": e} for s, k, e, _ in spans])
            pairs.append([dict(zip(("entity", "term", "around", "start", "end"), p, strict=True)) for p in nearby(t, spans)] if spans else [])
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("row"), pa.array(base, _BASE), pa.array(pairs, _PAIRS)], ["doc_id", "row", "base", "pairs"])


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, n): documents that hold a term, added up in memory and passed on when there are HELD_TERMS terms."""
    n: dict[bytes, int] = {}

    def out():
        terms = np.fromiter((_hash(w) for w in n), np.int64, len(n))
        return pa.RecordBatch.from_arrays([pa.array(terms), pa.array(np.fromiter(n.values(), np.int64, len(n)))], ["term", "n"])

    for b in batches:
        for t in b.column("text"):
            for w in {term_of(w) for w in set(words_of(t.as_py()))}:
                if w is not None:
                    n[w] = n.get(w, 0) + 1
            if len(n) >= HELD_TERMS:
                yield out()
                n = {}
    yield out()


def disclosing(pairs: DataFrame, counts: DataFrame, entities: DataFrame, n_docs: int, generalise: float, probable: float = PROBABLE) -> DataFrame:
    """(entity, term, share, p): terms that disclose an entity. p is the probability of the entity where the term is:
    documents with both / documents with the term in the term's independent documents, of which the pair has one for each
    of its surroundings, and PRIOR more without the entity, so that p is lower the less evidence there is. It must be
    probable at least, whatever the size of the corpus. The pair's mutual information log(p / p(e)) must be a share of at
    least generalise of the entity's information -log p(e): an entity that is everywhere is disclosed by no term. Where
    one document in so many as probable ** (-1 / (1 - generalise)) (32) or fewer hold the entity, p alone decides."""
    both = pairs.groupBy("entity", "term", "around").agg(F.countDistinct("row").alias("d")).groupBy("entity", "term").agg(F.sum("d").alias("both"), F.count("*").alias("seen"))
    x = both.join(counts, "term").join(entities, "entity")
    information = -F.log(F.col("n_entity") / F.lit(float(max(1, n_docs))))
    p = F.col("seen") / (F.col("seen") * F.greatest(F.lit(1.0), F.col("n") / F.col("both")) + F.lit(PRIOR))
    x = x.where(information > 0).withColumn("p", p).withColumn("share", (information + F.log("p")) / information)
    return x.where((F.col("share") >= generalise) & (F.col("p") >= probable)).select("entity", "term", "share", "p")


def scan(docs: DataFrame, generalise: float = GENERALISE, probable: float = PROBABLE, certain: float = CERTAIN, row: str | None = None) -> DataFrame:
    """(doc_id, spans), and row if named, a column of docs that numbers its rows: array of (start, k, end) in code points by start, then kind; k indexes KINDS.

    Base kinds are the four fixed patterns; their values are the protected entities. A term near an entity is generalised
    or removed if it discloses the entity: from how many documents of the whole corpus hold the term, the entity and both
    near each other, the entity is probable (generalised) or certain (removed) where the term is, and their pointwise
    mutual information is at least the set share of the entity's information. The estimate is smoothed by the number of
    different surroundings of a pair, so copies of a document are one piece of evidence: one piece makes an entity just
    probable, nine without a counterexample certain. Verdicts on the same counts don't change with the corpus's size once
    the entity is in one document of 32 or fewer.

    Null text is empty; repeated rows are scanned each (as evidence they count once, as documents each); an empty table
    gives no rows; other columns are ignored. Counts are added up in tasks before they are shuffled; only the terms near
    entities are joined with them.
    """
    ship(docs.sparkSession)
    number = F.lit(0).cast("long") if row is None else F.col(row).cast("long")
    x = docs.select(F.col("doc_id").cast("long").alias("doc_id"), number.alias("row"), F.col("text").cast("string").alias("text"))
    found = x.mapInArrow(_find, FOUND)
    found = saved(found if row else found.withColumn("row", F.monotonically_increasing_id()), "personal")
    pairs = found.where(F.size("pairs") > 0).select("row", F.explode("pairs").alias("p")).select("row", "p.*")
    counts = x.select("text").mapInArrow(_term_counts, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    entities = pairs.groupBy("entity", "row").agg(F.lit(1).alias("one")).groupBy("entity").agg(F.count("*").alias("n_entity"))
    known = disclosing(pairs, counts, entities, found.count(), generalise, probable)
    known = saved(known, "disclosing").select(F.col("entity").alias("e"), F.col("term").alias("t"), "p")
    hit = pairs.join(known.hint("shuffle_merge"), (F.col("entity") == F.col("e")) & (F.col("term") == F.col("t")))
    k = F.when(F.max("p") >= certain, F.lit(KINDS.index("removed"))).otherwise(F.lit(KINDS.index("general")))
    terms = hit.groupBy("row", "start", "end").agg(k.alias("k")).groupBy(F.col("row").alias("r")).agg(F.collect_list(F.struct("start", "k", "end")).alias("terms"))
    y = found.select("row", "doc_id", "base").join(terms, F.col("row") == F.col("r"), "left")
    return y.select(*([F.col("row").alias(row)] if row else []), "doc_id", F.when(F.col("terms").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "terms"))).alias("spans"))


def digest(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda r: F.concat_ws(":", F.element_at(kinds, r["k"] + 1), r["start"].cast("string"), r["end"].cast("string"))), ",")


def _general(term: Column) -> Column:
    """The class of a term, between the marks at its ends."""
    mark = "[.,:;!?\"'()\\[\\]{}<>]*"
    head, core, tail = (F.regexp_extract(term, f"(?s)^({mark})(.*?)({mark})$", k) for k in (1, 2, 3))
    name = F.lit("[WORD]")
    for label, pattern in reversed(GENERAL):
        name = F.when(core.rlike(pattern), F.lit(label)).otherwise(name)
    return F.concat(head, name, tail)


def sanitised(docs: DataFrame, **limits) -> DataFrame:
    """docs with texts sanitised and every other column and row as it was: entities are masked by kind, terms that disclose
    them become their class ([NUMBER], [CODE], [ACRONYM], [NAME] or [WORD]) or go. Spans that overlap are replaced
    together. Each row is judged by its own text, whatever its doc_id; null texts stay null."""
    row, own, spans, cut = fresh(docs, "_row", "_own", "_spans", "_cut")
    names = docs.columns
    x = saved(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = scan(x, row=row, **limits).select(F.col(row).alias(own), F.col("spans").alias(spans))
    x = x.join(found.hint("shuffle_merge"), F.col(row) == F.col(own))
    text = F.col("text").cast("string")
    masks = F.array(*(F.lit(MASKS.get(k, "")) for k in KINDS))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a, r):
        new = F.when(r["k"] == KINDS.index("general"), _general(F.substring(text, r["start"] + 1, r["end"] - r["start"]))).otherwise(F.element_at(masks, r["k"] + 1))
        more = F.concat(a["out"], F.array(F.substring(text, a["at"] + 1, r["start"] - a["at"]), new))
        return F.when(r["start"] >= a["at"], F.struct(r["end"].alias("at"), more.alias("out"))).otherwise(F.struct(F.greatest(a["at"], r["end"]).alias("at"), a["out"].alias("out")))

    x = x.withColumn(cut, F.when(F.size(spans) > 0, F.aggregate(spans, start, step)))
    left = F.concat(F.array_join(F.col(cut)["out"], ""), F.substring(text, F.col(cut)["at"] + 1, F.length(text)))
    return x.withColumn("text", F.when(F.col(cut).isNotNull(), left).otherwise(text)).select(*names)
