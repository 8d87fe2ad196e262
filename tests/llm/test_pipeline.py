"""The pipeline's stages on the smallest corpus, each held against what its operator
promises, and the pipeline as a whole."""

import itertools

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from arborlex.llm import toxicity  # noqa: E402
from arborlex.llm.common import cut  # noqa: E402
from arborlex.llm.decontaminate import overlaps  # noqa: E402
from tests.conftest import SF  # noqa: E402
from tests.llm.test_operators import linked, shingles  # noqa: E402


def test_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "ngram_jaccard", "decontamination", "mixing", "sharding"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    outs = [docs]
    for name, stage in corpus_pipeline.STAGES:
        outs.append(cut(stage(spark, outs[-1], SF), name))
    assert all(o.columns == docs.columns for o in outs[:-1])
    clean, single, safe, mixed, sharded = outs[1:]
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    scored = toxicity.toxicity(docs, labels)
    assert ids(clean) == ids(scored.where("score < 0.3"))
    sets = {r.doc_id: shingles(r.text) for r in clean.collect()}
    left = ids(single)
    for a, b in itertools.combinations(left, 2):
        assert not linked(sets[a], sets[b])
    for gone in set(sets) - left:
        assert any(linked(sets[gone], s) for d, s in sets.items() if d != gone)
    assert ids(safe) == left - ids(overlaps(single, bench))
    assert overlaps(safe, bench).count() == 0
    copies = mixed.groupBy("doc_id").count().agg({"count": "max"}).first()[0]
    assert ids(mixed) <= ids(safe) and copies <= 3
    assert sharded.count() == mixed.count() and sharded.select("shard", "slot").distinct().count() == mixed.count()
    assert corpus_pipeline.run(spark, SF).count() == sharded.count()
