"""The stages of the corpus pipeline against plain versions, and its whole run."""

from collections import Counter, defaultdict

import corpus_pipeline as pipeline
from pyspark.sql import functions as F

from . import brute

SMALL = "/root/testdata/sf0.001"


def test_stages(spark, docs, rows, texts):
    names = [name for name, _ in pipeline.STAGES]
    assert names == ["quality_rules", "near_dedup", "personal_data", "mix_sources", "pack_sequences"]
    stage = dict(pipeline.STAGES)
    kept = stage["quality_rules"](spark, docs, SMALL)
    good = Counter((i, t) for i, t in rows if not brute.failed_bits(brute.measures(t)))
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == good
    kept = kept.persist()
    once = stage["near_dedup"](spark, kept, SMALL).persist()
    expected = brute.near_duplicates({i: t for i, t in good if i is not None}, 5)
    assert Counter(r.doc_id for r in once.where("doc_id IS NOT NULL").collect()) == Counter({c for _, c in expected.values()})
    clean = stage["personal_data"](spark, once, SMALL).persist()
    assert clean.schema == once.schema and clean.count() == once.count()
    assert clean.where("n_chars <> length(text)").count() == 0
    assert not any(brute.base_spans(r.text) for r in clean.collect())
    mixed = stage["mix_sources"](spark, clean, SMALL).persist()
    assert mixed.schema == docs.schema
    assert max(Counter((r.doc_id, r.text) for r in mixed.collect()).values(), default=0) <= 2
    packed = stage["pack_sequences"](spark, mixed, SMALL).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(r.doc_id for r in mixed.collect())
    places = defaultdict(list)
    for r in packed:
        places[r.sequence_id].append((r.offset, r.offset + r.length))
    for spans in places.values():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] <= 4096
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_empty_stages(spark, empty):
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty, SMALL).collect() == []


def test_run(spark):
    assert pipeline.ORACLE_SQL is None
    assert pipeline.run(spark, SMALL).agg(F.max(F.col("offset") + F.col("length"))).first()[0] <= 4096
