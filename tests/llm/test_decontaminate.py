from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest

from spanvec.llm import decontaminate as D
from spanvec.llm import queries

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    """By every window at every place."""
    windows = {}
    for name, text in items:
        w = words(text)
        for i in range(max(len(w) - window, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + window]), set()).add(name)
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for m in {len(x) for x in windows}:
            for i in range(len(w) - m + 1):
                if tuple(w[i : i + m]) in windows:
                    hit.update(range(i, i + m))
                    found |= windows[tuple(w[i : i + m])]
        out.append((doc_id, len(w), len(hit), sorted(str(f) for f in found if f is not None)))
    return sorted(out, key=str)


def got(frame):
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in frame.collect()), key=str)


def random_rows(rng, n, words_, letters="abcd"):
    return [(i, " ".join(rng.choice(list(letters), size=rng.integers(*words_)))) for i in range(n)]


@pytest.mark.parametrize("window", [1, 2, 5, 10])
def test_automaton_against_every_window(window):
    """Few words, so that runs share suffixes and states are split."""
    rng = np.random.default_rng(window)
    items = [(str(i) if i % 7 else None, t) for i, t in random_rows(rng, 40, (0, 14))]
    items += [(str(100 + i), t) for i, t in random_rows(rng, 20, (3, 60), "abcdefgh")]
    docs = [*random_rows(rng, 60, (0, 80), "abcdefghx"), (99, None)]
    automaton = D.Automaton.of([(n, D.words_of(t)) for n, t in items], window)
    found = D.match_texts([t for _, t in docs], [automaton], [None] * len(docs))
    lines = [(i, f["n_words"], sum(s["last"] - s["first"] + 1 for s in f["spans"]), f["items"]) for (i, _), f in zip(docs, found, strict=True)]
    assert sorted(lines, key=str) == brute(docs, items, window)


def test_spans_are_places_of_the_text():
    item = "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich, 1 2 3"
    text = f"Vorher -- {item.upper().replace('Ö', 'ö').replace('Ä', 'ä').replace('Ü', 'ü').replace('SS', 'ß')}! Nachher {item}."
    automaton = D.Automaton.of([("7", D.words_of(item))], 10)
    (found,) = D.match_texts([text], [automaton], [None])
    raw = text.encode()
    cut = [raw[s["begin"] : s["end"]].decode() for s in found["spans"]]
    assert cut[-1] == item and all(s["longest"] >= 10 for s in found["spans"])
    assert [words(c) == words(text)[s["first"] : s["last"] + 1] for c, s in zip(cut, found["spans"], strict=True)] == [True] * len(cut)


def test_blocks_and_passes(spark, rng):
    """Many automata and passes give what one gives; long items are cut into pieces."""
    items = [(i, t) for i, t in random_rows(rng, 30, (0, 40), "abcdefgh")]
    items.append((77, " ".join(f"w{i % 977} v{i % 1009}" for i in range(6000))))
    docs = random_rows(rng, 40, (0, 60), "abcdefghx") + [(50, items[-1][1][30_000:60_000]), (51, "x")]
    d, i = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    want = brute(docs, items)
    assert got(D.contamination(d, i)) == want
    assert got(D.contamination(d.repartition(3), i.repartition(5), block_words=1500)) == want


def test_query_against_every_window(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    want = brute([(r.doc_id, r.text) for r in docs], [(r.item_id, r.text) for r in items])
    sha = lambda names: hashlib.sha256(",".join(names).encode()).hexdigest()
    rows = queries.op13_decontaminate(spark, SF).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows), key=str) == [
        (i, n, h, len(names), sha(names), h > 0) for i, n, h, names in want
    ]
    assert any(h for _, _, h, _ in want)


def test_cut(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    docs = [
        (1, f"Start: {item.upper()}! The end of a text that is longer than what it quotes, by some words.", "a"),
        (2, item, "b"),
        (3, "one two three four five six seven eight nine only", "c"),
        (4, None, "d"),
        (5, "", "e"),
    ]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, found string")
    i = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    kept = {r.doc_id: (r.text, r.found) for r in D.cut(d, i).collect()}
    assert kept == {1: ("Start: ! The end of a text that is longer than what it quotes, by some words.", "a"), 3: (docs[2][1], "c"), 4: (None, "d"), 5: ("", "e")}
    assert {r.doc_id: r.text for r in D.cut(d, i, longest=13, coverage=1.0).collect()} == {i: t for i, t, _ in docs}


def test_odd_rows(spark, odd_docs, clashing_docs, no_docs):
    texts = [(None, "One two three four five six seven"), (5, "one two three four five six seven"), (5, "x"), (6, None), (7, ""), (8, "!!"), (9, "word " * 30), (9, "word " * 30)]
    items = spark.createDataFrame(texts, "item_id bigint, text string")
    for docs in (odd_docs, clashing_docs.withColumns({"found": clashing_docs.n, "items": clashing_docs.n})):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        assert got(D.contamination(docs, items)) == brute(rows, texts)
        assert D.cut(docs, items).columns == docs.columns
        assert got(D.contamination(docs, items.limit(0))) == brute(rows, [])
    assert D.contamination(no_docs, items).count() == 0
