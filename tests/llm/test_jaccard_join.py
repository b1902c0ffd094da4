from __future__ import annotations

import os
import random
import re
import time
from collections import Counter

import numpy as np
import pytest

from spanvec.llm import jaccard_join as J


def brute(rows, size, num, den):
    """doc_id: set size, smallest id reachable; rows with an id only."""
    sets = []
    for i, text in rows:
        if i is None:
            continue
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        grams = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} or ({tuple(words)} if words else set())
        sets.append((i, grams))
    parent = {i: i for i, _ in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and den * len(a & b) >= num * len(a | b):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return Counter((i, len(a), find(i)) for i, a in sets)


def edited(words, rng, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, i = [], 0
    for length in (1, 2, 3, 5, 8, 12, 14, 19, 25, 30, 45, 60, 110, 300, 700):
        base = [rng.choice(vocabulary) for _ in range(length)]
        for edits in (0, 0, 0, 1, 1, 1, 2, 2, 3, 4, 6, 9):
            text = edited(base, rng, edits)
            if rng.random() < 0.3:
                text += " " + " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 2 + length // 8)))
            rows.append((i, text))
            i += 7
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("size", "num", "den"), [(3, 90, 100), (5, 80, 100), (2, 60, 100)])
def test_against_all_pairs(spark, size, num, den):
    rows = corpus(size)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = J.jaccard_components(docs, size=size, num=num, den=den).collect()
    assert Counter(tuple(r) for r in got) == brute(rows, size, num, den)


def test_differences_in_many_buckets_of_a_pivot(spark, monkeypatch):
    monkeypatch.setattr(J, "BUCKET", 16)
    rows = corpus(11)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = J.jaccard_components(docs, size=5, num=80, den=100).collect()
    assert Counter(tuple(r) for r in got) == brute(rows, 5, 80, 100)


@pytest.mark.parametrize(("num", "den"), [(90, 100), (80, 100), (60, 100)])
def test_linked_sets_share_a_key(num, den):
    """Light with light, light with heavy, heavy with heavy, across classes and with empty parts."""
    rule, rng = J.Jaccard(num, den), np.random.default_rng(3)
    for n in [*range(1, 60), 80, 120, 200, 333, 500, 1000]:
        for _ in range(12):
            a = rng.integers(0, 2**64, n, np.uint64)
            lost = int(rng.integers(0, rule.most_apart(2 * n) + 1))
            cut = min(n - 1, int(rng.integers(0, lost + 1)))
            b = np.concatenate([a[: n - cut], rng.integers(0, 2**64, lost - cut, np.uint64)])
            a, b = np.unique(a), np.unique(b)
            if den * len(np.intersect1d(a, b)) >= num * len(np.union1d(a, b)):
                assert np.intersect1d(J.keys(a, rule), J.keys(b, rule)).size


def test_near_copies_cost_their_size(spark):
    """A group whose members differ in their own words: differences, not all pairs, are joined."""
    rng = random.Random(2)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, edited(base, rng, rng.choice((1, 1, 2, 3, 4)))) for i in range(400)] + [(1000, " ".join(base))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = J.jaccard_components(docs, size=3, num=90, den=100).collect()
    assert Counter(tuple(r) for r in got) == brute(rows, 3, 90, 100)


def test_odd_rows(odd_docs, clashing_docs, no_docs):
    want = [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 5, 4), (4, 5, 4), (5, 5, 4), (None, 5, None), (6, 1, 6), (7, 1, 7), (8, 1, 8), (9, 1, 9)]
    for docs in (odd_docs, clashing_docs):
        assert Counter(tuple(r) for r in J.jaccard_components(docs, size=3, num=90, den=100).collect()) == Counter(want)
    assert J.jaccard_components(no_docs).count() == 0
    kept = J.one_of_each(odd_docs, size=3, num=90, den=100).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 1, 2, 3, 4, 6, 7, 8, 9]


def test_sets_far_from_their_pivot_meet_again(spark, monkeypatch):
    """Many documents share a passage with one pivot; near copies among them still link."""
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(80)]
    rows = [(0, " ".join(passage))]
    for i in range(1, 120):
        own = [f"d{i // 2}_{j}" for j in range(160)]
        own[rng.randrange(160)] = f"edit{i}"
        rows.append((i, " ".join(passage + own)))
    again = []

    def spy(*args):
        compared = compare(*args)
        again.append(compared.where("keys is not null").count())
        return compared

    compare = J.compare_pairs
    monkeypatch.setattr(J, "compare_pairs", spy)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = J.jaccard_components(docs, size=5, num=80, den=100).collect()
    assert Counter(tuple(r) for r in got) == brute(rows, 5, 80, 100)
    assert len(again) == 2 and again[0] > 20 and again[1] == 0


@pytest.mark.parametrize("texts", [["a b"], ["a"], [None, "", " "], ["a", None, "b c"]])
def test_batches_of_fewer_words_than_an_n_gram(texts):
    sizes = [len(h) for h in J.shingle_sets(texts, 5)]
    assert sizes == [1 if (t or "").split() else 0 for t in texts]


def test_one_id_with_two_texts_stays_twice(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, a, 1), (1, b, 1), (1, a, 1), (2, a + " more", 1), (3, b, 1), (4, None, 1), (4, "", 1), (4, None, 1), (5, a.upper(), 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, hash int").repartition(3)
    kept = J.one_of_each(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([(1, a), (1, b), (4, None), (4, "")])


def test_dealt_rows_grow_with_the_sets_of_a_group_only(spark, rng, tmp_path, monkeypatch):
    deal = J._deal

    def links(sets):
        """Rows that differences from one pivot are dealt into."""
        seen = tmp_path / str(sets)
        seen.mkdir()

        def counted(batches):
            for i, batch in enumerate(deal(batches)):
                (seen / f"{os.getpid()}-{time.time_ns()}-{i}").write_text(str(batch.num_rows))
                yield batch

        monkeypatch.setattr(J, "_deal", counted)
        rows = [(x, 0, 100, 100, 60, [int(e) for e in rng.integers(0, 2**62, 60)]) for x in range(1, sets + 1)]
        compared = spark.createDataFrame(rows, "x bigint, p bigint, nx bigint, np bigint, apart bigint, d array<bigint>")
        assert J.links_by_difference(compared, J.Jaccard(80, 100)).count() == 0
        return sum(int(f.read_text()) for f in seen.iterdir())

    few, many = links(20), links(640)
    assert 20 <= few and many <= 1.1 * 32 * few


@pytest.mark.parametrize(("num", "den"), [(90, 100), (80, 100), (60, 100)])
def test_linked_sets_share_a_list_that_both_read(num, den):
    """As far apart as linked sets can be, they share two lists more than both may leave unread."""
    rule, rng = J.Jaccard(num, den), np.random.default_rng(4)
    free = np.array(rule.free_of_kinds())
    assert free.max() > 0 and free[J.SUBSET] == 0
    for n in (40, 65, 100, 180, 400, 1500, 6000):
        for cut in (0, 1):
            a = rng.integers(0, 2**64, n, np.uint64)
            lost = rule.most_apart(2 * n) // 2
            b = np.concatenate([a[lost:], rng.integers(0, 2**64, lost, np.uint64)])
            a, b = np.unique(a), np.unique(b)
            assert den * len(np.intersect1d(a, b)) >= num * len(np.union1d(a, b))
            shared = np.intersect1d(J.keys(a, rule, cut), J.keys(b, rule, cut)) & np.uint64(J.KIND)
            assert any((shared == kind).sum() >= 2 * free[int(kind)] + 1 for kind in np.unique(shared))


def test_a_common_passage_alone_is_not_compared(spark, monkeypatch):
    """Documents of their own words that share a passage meet by chance in few lists; near copies still link."""
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for i in range(300):
        own = [f"d{i}_{j}" for j in range(200)]
        rows.append((i, " ".join(own[:100] + passage + own[100:])))
    rows += [(1000 + i, edited(rows[i][1].split(), rng, 3)) for i in range(0, 300, 10)]
    compared, compare = [], J.compare_pairs

    def spy(docs, sets, pairs, *args):
        compared.append(pairs.count())
        return compare(docs, sets, pairs, *args)

    monkeypatch.setattr(J, "compare_pairs", spy)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = J.jaccard_components(docs, size=5, num=80, den=100).collect()
    assert Counter(tuple(r) for r in got) == brute(rows, 5, 80, 100)
    assert 30 <= sum(compared) <= 60


def test_sets_far_from_their_pivots_are_compared_with_few_others(spark, monkeypatch):
    """Documents edited from one text, too far apart to link, agree in lists by chance; near copies still link."""
    rng = random.Random(12)
    base = [f"w{i}" for i in range(300)]
    rows = [(i, edited(base, rng, 13)) for i in range(160)]
    rows += [(1000 + i, edited(rows[i][1].split(), rng, 1)) for i in range(0, 160, 10)]
    compared, compare = [], J.compare_pairs

    def spy(docs, sets, pairs, *args):
        compared.append(pairs.count())
        return compare(docs, sets, pairs, *args)

    monkeypatch.setattr(J, "compare_pairs", spy)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = J.jaccard_components(docs, size=3, num=90, den=100).collect()
    assert Counter(tuple(r) for r in got) == brute(rows, 3, 90, 100)
    assert compared[1] <= 3 * len(rows)


def test_linked_sets_share_a_list_of_the_second_cut_that_both_read():
    """It leaves more lists unread than the first, and linked sets share as many more."""
    rule, rng = J.Jaccard(90, 100), np.random.default_rng(6)
    free = np.array(rule.free_of_kinds(1))
    assert free[J.SUBSET] == 0 and (free >= np.array(rule.free_of_kinds())).all()
    for n in [*range(25, 60), 100, 180, 400, 1500, 6000]:
        for _ in range(5):
            a = rng.integers(0, 2**64, n, np.uint64)
            lost = rule.most_apart(2 * n) // 2
            b = np.concatenate([a[lost:], rng.integers(0, 2**64, lost, np.uint64)])
            a, b = np.unique(a), np.unique(b)
            shared = np.intersect1d(J.keys(a, rule, 1), J.keys(b, rule, 1)) & np.uint64(J.KIND)
            assert any((shared == kind).sum() >= 2 * free[int(kind)] + 1 for kind in np.unique(shared))
