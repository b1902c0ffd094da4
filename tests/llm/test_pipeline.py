from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers
import tiktoken

import corpus_pipeline
from spanvec.llm import language_crf, pairwise_quality, source_mix
from spanvec.llm.queries import vocabulary

from .test_jaccard_join import brute

SF = "/root/testdata/sf0.01"


def ids(docs):
    return Counter(r.doc_id for r in docs.select("doc_id").collect())


def test_each_stage_against_its_definition(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, outs = docs.columns, []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        assert isinstance(name, str)
        stage(spark, docs, SF).write.parquet(str(tmp_path / f"{i}"))
        docs = spark.read.parquet(str(tmp_path / f"{i}"))
        outs.append(docs)
        assert i == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
    good, known, single, mixed, encoded = outs
    source = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = pairwise_quality.score(source, pairwise_quality.learn(source, labels))
    assert ids(good) == ids(scored.where("predicted = 1"))
    found = language_crf.predict(good, language_crf.learn(good))
    assert ids(known) == ids(found.where("lang_pred <> 'und'"))
    rows = [(r.doc_id, r.text) for r in known.collect()]
    assert ids(single) == Counter(i for i, _, first in brute(rows, 5, 80, 100) if i == first)
    taken = {r.doc_id: int(r.taken / r.size + 0.5) for r in source_mix.mix(single).collect() if r.size}
    assert ids(mixed) == Counter({i: n for i, n in taken.items() if n})
    assert ids(encoded) == ids(mixed)
    tokenizer = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary(), special_tokens={})
    texts = dict(rows)
    for r in encoded.collect():
        got = tokenizer.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(got) and r.ids_sha256 == hashlib.sha256(",".join(map(str, got)).encode()).hexdigest()
    whole = corpus_pipeline.run(spark, SF)
    assert Counter(map(tuple, whole.collect())) == Counter(map(tuple, encoded.collect()))
    # Clean documents stay: what the labels call good is not rejected.
    fine = {r.doc_id for r in labels.where("quality = 1").collect()} & set(ids(source))
    assert len(fine & set(ids(known))) >= 0.98 * len(fine)


def test_odd_rows(spark, odd_docs, clashing_docs, no_docs):
    for docs in (odd_docs, clashing_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns and set(ids(out)) <= set(ids(docs))
        last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert ids(last) == ids(docs)
