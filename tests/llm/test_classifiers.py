from __future__ import annotations

import itertools
import zlib

import numpy as np

from spanvec.llm import language_crf as C
from spanvec.llm import pairwise_quality as Q
from spanvec.llm.labelled import texts_of

SF = "/root/testdata/sf0.01"


def out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in C.predict(docs, C.learn(docs)).collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert all(r.held_out == out(i) and 0 <= r.score <= 1 for i, r in got.items())
    held = [i for i in truth if out(i)]
    assert np.mean([got[i].lang_pred == truth[i] for i in held]) > 0.98
    other = {r.doc_id: r for r in C.predict(docs.drop("lang", "source").repartition(5), C.learn(docs)).collect()}
    assert all(other[i].lang_pred == r.lang_pred and abs(other[i].score - r.score) < 1e-9 for i, r in got.items())


def test_held_out_labels_teach_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    hidden = "crc32(cast(cast(doc_id as string) as binary)) % 5 = 0"
    wrong = docs.selectExpr("doc_id", "text", f"if({hidden}, 'zz', lang) as lang")
    model = C.learn(wrong)
    assert "zz" not in model.languages and np.array_equal(model.weights, C.learn(docs).weights)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.selectExpr("doc_id", f"if({hidden}, 1 - quality, quality) as quality")
    assert np.array_equal(Q.learn(docs, labels).weights, Q.learn(docs, turned).weights)


def test_forward_backward_against_all_sequences():
    rng = np.random.default_rng(1)
    lengths = np.array([3, 1, 4, 2])
    move = rng.random((3, 3)) + 0.1
    chains = C.Chains.of(lengths)
    emission = rng.random((10, 3)) + 0.1
    laid = np.empty_like(emission)
    laid[chains.place] = emission
    chances, moves, _ = chains.forward_backward(laid, move)
    chances = chances[chains.place]
    want_moves = np.zeros((3, 3))
    for begin, n in zip(np.cumsum(lengths) - lengths, lengths, strict=True):
        total, each = 0.0, np.zeros((n, 3))
        pairs = np.zeros((3, 3))
        for labels in itertools.product(range(3), repeat=int(n)):
            p = np.prod([emission[begin + i, s] for i, s in enumerate(labels)]) * np.prod([move[a, b] for a, b in itertools.pairwise(labels)])
            total += p
            for i, s in enumerate(labels):
                each[i, s] += p
            for a, b in itertools.pairwise(labels):
                pairs[a, b] += p
        assert np.allclose(chances[begin : begin + n], each / total)
        want_moves += pairs / total
    assert np.allclose(moves, want_moves)


def test_code_switched_words(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = C.learn(docs)
    text = "the and of that with was for\nund der die das nicht ist von\nthe and of und der die 123"
    frame = spark.createDataFrame([(1, text), (2, None)], "doc_id bigint, text string")
    rows = {r.line: r.langs for r in C.label_words(frame, model).collect()}
    assert set(rows[0]) == {"en"} and set(rows[1]) == {"de"} and rows[2] == ["en"] * 3 + ["de"] * 3 + ["und"]


def test_quality_of_held_out_documents(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = {r.doc_id: r for r in Q.score(docs, Q.learn(docs, labels)).collect()}
    held = [(got[r.doc_id], r.quality) for r in labels.collect() if out(r.doc_id) and r.doc_id in got]
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 and r.held_out == out(i) for i, r in got.items())
    assert np.mean([r.predicted == q for r, q in held]) > 0.97
    assert np.mean([r.predicted for r, q in held if q == 1]) > 0.99


def test_preferences_give_the_weights():
    """Pairs whose winners follow known weights: the direction is found, the cut is the quantile."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, Q.FEATURES))
    true = np.zeros(Q.FEATURES)
    true[:3] = (2, -1, 0.5)
    label = (x @ true + rng.logistic(size=4000) > -1).astype(int)
    model = Q.fit(x, label)
    found = model.weights / model.scale
    assert found @ true / np.linalg.norm(found) / np.linalg.norm(true) > 0.98
    assert abs((model.score(x) < 0.3).mean() - (label == 0).mean()) < 0.01


def test_odd_rows(spark, odd_docs, clashing_docs, no_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    languages, quality = C.learn(docs), Q.learn(docs, labels)
    for frame in (odd_docs, clashing_docs):
        found = [(r.doc_id, r.lang_pred, r.score) for r in C.predict(frame, languages).collect()]
        assert len(found) == 11 and {x[1:] for x in found if x[0] in (1, 2, 3, 8)} == {("und", 0.0)}
        assert all(0 < s <= 1 for i, _, s in found if i not in (1, 2, 3, 8))
        scored = Q.score(frame, quality).collect()
        assert len(scored) == 11 and all(0 <= r.score <= 1 for r in scored)
        assert len({r.score for r in scored if r.doc_id in (1, 2)}) == 1
        assert C.keep_known(frame, languages).columns == frame.columns and Q.keep_good(frame, quality).columns == frame.columns
        assert {r.doc_id for r in C.keep_known(frame, languages).collect()} == {4, 5, None, 6, 7, 9}
    assert C.predict(no_docs, languages).count() == 0 and Q.score(no_docs, quality).count() == 0
    nothing = C.learn(odd_docs.where("lang is null"))
    assert {r.lang_pred for r in C.predict(odd_docs, nothing).collect()} == {"und"}
    untaught = Q.learn(odd_docs, labels.limit(0))
    assert {r.score for r in Q.score(odd_docs, untaught).collect()} == {0.5}
    twice = spark.createDataFrame([(4, 0, 0), (4, 1, 0), (5, 1, 0), (None, 1, 0), (9, None, 0)], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in Q.score(odd_docs, Q.learn(clashing_docs, twice)).collect()} == {0.5}


def test_runs_of_bounded_text():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"i": pa.array(range(6)), "t": pa.array(["a" * 5, None, "b" * 20, "c", "", "d" * 9])})
    parts = [(p.column(0).to_pylist(), t) for p, t in texts_of(iter([batch, batch.slice(0, 0)]), 1, 10)]
    assert [p for p, _ in parts] == [[0, 1], [2], [3, 4, 5]] and parts[1][1] == ["b" * 20]


def test_a_document_without_id_teaches_no_language(spark):
    rows = [(4, "one two three", "en"), (None, "one two four", "en"), (6, "eins zwei drei", "de"), (7, "un deux trois", "fr")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got, want = C.learn(docs), C.learn(docs.where("doc_id is not null"))
    assert got.languages == want.languages and len(C.predict(docs, got).collect()) == 4


def test_a_document_in_four_languages_stays(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = "the and of that with\nund der die das nicht\nque los las una por el\nles des est dans pour une"
    frame = spark.createDataFrame([(1, text, "en"), (2, "123", "en"), (3, None, "en")], "doc_id bigint, text string, lang string")
    model = C.learn(docs)
    assert [r.doc_id for r in C.keep_known(frame, model).collect()] == [1]
    assert 0 < C.predict(frame, model).where("doc_id = 1").first().score < 0.6


def test_long_lines_are_several_chains(monkeypatch):
    """Chances of words in a long line, and what is learned from it, do not depend on where it is cut."""
    rng = np.random.default_rng(4)
    words = {"en": ["the", "and", "of", "that"], "de": ["und", "der", "nicht", "das"]}
    texts = ["\n".join(" ".join(rng.choice(words[x], 60)) for _ in range(3)) for x in ("en", "de") * 5]
    model = C.fit(texts, ["en", "de"] * 5)
    line = " ".join(" ".join(rng.choice(words[x], rng.integers(1, 40))) for x in ("en", "de") * 200)
    want, _, lengths, lines = C.Labeller(model).words_of([line, "the und", None, line])
    assert want.shape[0] == 2 * len(line.split()) + 2 and lines.tolist() == [1, 1, 0, 1]
    monkeypatch.setattr(C, "LONG", 100)
    have, _, cut_lengths, _ = C.Labeller(model).words_of([line, "the und", None, line])
    assert cut_lengths.tolist() == lengths.tolist() and np.abs(have - want).max() < 1e-9
    begin, sizes, own = C.pieces(np.array([250, 3, 100]))
    assert begin.tolist() == [0, 36, 136, 250, 253] and sizes.tolist() == [164, 214, 114, 3, 100] and own.sum() == 353


def test_batches_bound_what_is_learned_from_at_a_time(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    monkeypatch.setattr(C, "BATCH_CELLS", 60_000)
    model = C.learn(docs, steps=8)
    got = {r.doc_id: r for r in C.predict(docs, model).collect()}
    assert np.mean([got[r.doc_id].lang_pred == r.lang for r in docs.collect() if out(r.doc_id)]) > 0.97
