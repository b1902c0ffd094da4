from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from spanvec.llm import queries
from spanvec.llm import source_divergence as S

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(rows, least_docs=10, top=10):
    """``rows`` of text, lang, source; sums in Python's integers."""
    rows = [tuple(x or "" for x in r) for r in rows]
    counts, docs = {}, Counter()
    for text, lang, source in rows:
        terms = Counter(TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text)))
        counts.setdefault((lang, source), Counter()).update(terms)
        docs.update((lang, t) for t in terms)
    out = []
    for lang in {g[0] for g in counts}:
        kept = [t for (x, t), n in docs.items() if x == lang and n >= least_docs]
        of = {s: c for (x, s), c in counts.items() if x == lang}
        whole = sum(of.values(), Counter())

        def share(c, t):
            return 1 + 10**9 * (c[t] + 2) // (sum(c[k] for k in kept) + 2 * len(kept))

        p = {s: {t: share(c, t) for t in kept} for s, c in of.items()}
        q = {t: share(whole, t) for t in kept}
        apart = lambda a, b: (a - b) ** 2 // (a + b)
        for s in of:
            pairs = [(-sum(apart(p[s][t], p[o][t]) for t in kept), o.encode()) for o in of if o != s]
            terms = [(-apart(p[s][t], q[t]), t.encode()) for t in kept if of[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -v, i) for i, (v, item) in enumerate(found, 1)]
    return sorted(out)


def got(frame):
    return sorted(tuple(r) for r in frame.collect())


def random_rows(rng, n, terms=60, sources=5):
    names = np.array([f"{'aeiou'[i % 5]}{'é' if i % 7 == 0 else 'X'}{'bcdf'[i % 4] * (1 + i // 20)}" for i in range(terms)])
    return [(" ".join(rng.choice(names[: 10 + 10 * (i % sources)], size=rng.integers(0, 30))), ["en", "de", None][i % 3], [None, "s1", "s2", "s10", "ß"][i % sources]) for i in range(n)]


@pytest.mark.parametrize("bits", [64, 4, 0])
def test_against_brute_force(spark, rng, bits):
    """Digests of 4 bits and of none: all terms collide and are split by their strings."""
    rows = random_rows(rng, 300)
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    assert got(S.divergence(docs, bits=bits)) == brute(rows)
    assert got(S.divergence(docs, bits=bits, least_docs=1, top=3)) == brute(rows, 1, 3)


def test_buckets_and_blocks(spark, rng, monkeypatch):
    """Terms in many buckets, sources in many blocks, counts in many tables."""
    rows = [(t, "en", f"{i % 23}") for i, (t, _, _) in enumerate(random_rows(rng, 400))]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    monkeypatch.setattr(S, "CELLS", 64)
    size = S.pair_rows.__globals__["BLOCK"]
    assert size == 256
    assert got(S.divergence(docs, least_docs=2)) == brute(rows, 2)


def test_blocks_of_sources():
    """A bucket's sums of two blocks, with terms that neither has."""
    import pyarrow as pa

    rng = np.random.default_rng(1)
    sources = [3, 5, 300, 301]
    total = {s: int(rng.integers(5_000, 9_000)) for s in sources}
    count = {(s, t): int(rng.integers(1, 200)) for s in sources for t in range(6) if rng.random() < 0.6}
    names = ["lang", "bucket", "a", "b", "side", "number", "x", "y", "n"]
    rows = [("en", 0, 0, 1, 0, s, total[s], 9, 0) for s in sources] + [("en", 0, 0, 1, 1, s, 10**12 * t, 0, n) for (s, t), n in count.items()]
    found = S._pair_sums(iter([pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows])]))
    value = {(r["x"], r["y"]): r["value"] for b in found for r in b.to_pylist()}
    p = {(s, t): 1 + 10**9 * (count.get((s, t), 0) + 2) // total[s] for s in sources for t in range(9)}
    assert value == {(a, b): sum((p[a, t] - p[b, t]) ** 2 // (p[a, t] + p[b, t]) for t in range(9)) for a in (3, 5) for b in (300, 301)}


def test_counts_in_small_tables(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(S, "HELD", 5)
    monkeypatch.setattr(S, "CHUNK", 20)
    texts = ["a b c a", "B c d", None, "", "é a", "a " * 30]
    batch = pa.RecordBatch.from_pydict({"lang": ["x", "x", "x", "y", "x", "y"], "source": ["s"] * 6, "text": pa.array(texts)})
    sums = Counter()
    whole = Counter()
    for b in S._count(iter([batch, batch]), strings=True):
        for r in b.to_pylist():
            sums[r["lang"], r["term"], "n"] += r["n"]
            sums[r["lang"], r["term"], "docs"] += r["docs"]
            whole[r["lang"], r["source"], r["digest"], "n"] += r["n"]
            whole[r["lang"], None, r["term"], "docs"] += r["docs"]
    apart = Counter()
    for b in S._count(iter([batch, batch])):
        for r in b.to_pylist():
            if r["source"] is None:
                apart[r["lang"], None, r["term"], "docs"] += r["docs"]
            else:
                apart[r["lang"], r["source"], r["digest"], "n"] += r["n"]
    assert apart == whole
    want = {("x", "a"): (6, 4), ("x", "b"): (4, 4), ("x", "c"): (4, 4), ("x", "d"): (2, 2), ("x", "é"): (2, 2), ("y", "a"): (60, 2)}
    assert sums == Counter({(*k, w): v[i] for k, v in want.items() for i, w in enumerate(("n", "docs"))})


def test_shares_of_large_counts(spark):
    counts = np.array([0, 1, 10**6, 5 * 10**14 - 7, 10**15 - 12], np.int64)
    total = 10**15
    want = [1 + 10**9 * (int(c) + 2) // total for c in counts]
    assert S.shares(counts, np.array(total)).tolist() == want
    frame = spark.createDataFrame([(int(c), total) for c in counts], "c bigint, t bigint")
    assert [r[0] for r in frame.selectExpr(S._share("c", "t")).collect()] == want


def test_query_against_brute_force(spark):
    rows = [(r.text, r.lang, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got(queries.op12_source_divergence(spark, SF)) == brute(rows)


def test_odd_rows(spark, odd_docs, clashing_docs, no_docs):
    for docs in (odd_docs, clashing_docs.withColumns({c: F_lit(1) for c in ("digest", "term", "sub", "total", "p", "rank", "part")})):
        rows = [(r.text, r.lang, r.source) for r in docs.collect()]
        for least in (1, 2, 10):
            assert got(S.divergence(docs, least_docs=least)) == brute(rows, least)
    assert S.divergence(no_docs).count() == 0


def F_lit(value):
    from pyspark.sql import functions as F

    return F.lit(value)
