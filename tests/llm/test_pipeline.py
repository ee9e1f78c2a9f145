"""The pipeline, stage by stage, against brute-force versions on the small documents."""

import corpus_pipeline
import pytest
import test_minhash
import test_suffix_dedup
from fixtures import SF, here, odd_documents, table
from pyspark.sql import functions as F

fold_case = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def by_id(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = table(spark, "documents"), [table(spark, "documents")]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


@here
def test_stages(spark, stages):
    first, clean, distinct, apart, cut, packed = stages
    for df in (clean, distinct, apart, cut):
        assert df.columns == first.columns and df.schema == first.schema
    texts = by_id(clean)
    assert 0 < len(texts) < first.count()
    # exact: the largest id of each text
    keep = {}
    for d, t in texts.items():
        keep[fold_case(t)] = max(d, keep.get(fold_case(t), d))
    assert by_id(distinct) == {d: texts[d] for d in keep.values()}
    # near: the smallest id of each group
    rows = sorted(by_id(distinct).items())
    kept = {eval(r)[0] for r in test_minhash.brute(rows) if eval(r)[3]}
    assert by_id(apart) == {d: t for d, t in rows if d in kept}
    # passages: what no repeated string covers
    rows = sorted(by_id(apart).items())
    raws = [(t or "").encode() for _, t in rows]
    want = {}
    for (d, t), raw, mark in zip(rows, raws, test_suffix_dedup.cover(raws, corpus_pipeline.PASSAGE_BYTES)):
        want[d] = bytes(b for b, m in zip(raw, mark) if not m).decode(errors="ignore") if any(mark) else t
    assert by_id(cut) == want
    assert {r["doc_id"]: r["n_chars"] for r in cut.collect()} == {d: len(t) for d, t in want.items()}
    # packing: every document, whole
    lengths = {}
    for r in packed.collect():
        lengths.setdefault(r["sequence_id"], []).append(r["length"])
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(want)
    assert all(sum(x) <= 2048 for x in lengths.values())


@here
def test_run(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == stages[-1].columns and got.select("doc_id").distinct().count() == stages[-1].select("doc_id").distinct().count()


@here
def test_stages_on_odd_rows(spark):
    docs = odd_documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert stage(spark, docs.limit(0), SF).count() == 0
        if name != "packing":
            assert out.columns == docs.columns
            kept = out.collect()
            assert 0 < len(kept) <= docs.count()
            assert any(r["doc_id"] is None for r in kept)
        else:
            assert out.count() >= docs.count()


def test_workers_drop_what_other_stages_kept(spark):
    """Tables that one stage's tasks kept in their worker are gone when another stage works on groups there."""
    import sys

    import pyarrow as pa

    from kpimill.llm.base import by_batch, by_group, kept

    def fill():
        kept("test tables", lambda: [0])
        return lambda batch: batch

    def look():
        held = getattr(sys, "_kpimill_kept", None) is not None
        return lambda rows, cuts: pa.RecordBatch.from_arrays([pa.array([held])], ["held"])

    df = spark.range(8).repartition(2)
    by_batch(df, fill, "id long").count()
    assert not any(r["held"] for r in by_group(df, ["id"], look, "held boolean").collect())


def held(spark, fill=False):
    """Whether each of the session's workers keeps an object; with ``fill`` it is given one."""
    from kpimill.llm.base import kept

    def look(batches):
        import sys
        import time

        import pyarrow as pa

        for _ in batches:
            if fill:
                kept("test tables", lambda: [0])
            time.sleep(0.5)
            yield pa.RecordBatch.from_arrays([pa.array([getattr(sys, "_kpimill_kept", None) is not None])], ["held"])

    return [r.held for r in spark.range(0, 4, 1, 4).mapInArrow(look, "held boolean").collect()]


def test_packing_leaves_nothing_in_workers(spark):
    import public_tokenizers

    from kpimill.llm.packing import pack

    docs = spark.createDataFrame([(i, f"text {i}") for i in range(40)], "doc_id long, text string").repartition(8)
    assert all(held(spark, fill=True))
    assert pack(docs, public_tokenizers.path("byte_bpe_50k.json")).count() == 40
    assert not any(held(spark))


def test_training_drops_what_other_stages_kept(spark, monkeypatch):
    from kpimill.llm import toxicity

    def train(texts, y, weight):
        import sys

        return toxicity.Network(["held"] if getattr(sys, "_kpimill_kept", None) is not None else ["free"])

    monkeypatch.setattr(toxicity, "train", train)
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(8)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, toxic int")
    assert all(held(spark, fill=True))
    assert list(toxicity.fit(docs, labels, "toxic", F.lit(True)).words) == ["free"]


def test_training_has_one_scorer_at_a_time(monkeypatch):
    import weakref

    import numpy as np

    from kpimill.llm import toxicity

    alive, most = weakref.WeakSet(), []

    class Counted(toxicity.Scorer):
        def __init__(self, *a):
            super().__init__(*a)
            alive.add(self)
            most.append(len(alive))

    monkeypatch.setattr(toxicity, "Scorer", Counted)
    monkeypatch.setattr(toxicity, "STEPS_PER_ROUND", 2)
    texts = [f"{'bad' if i % 2 else 'good'} word{i} thing{i} that{i}" for i in range(20)]
    toxicity.train(texts, np.arange(20) % 2, np.ones(20))
    assert most == [1] * toxicity.ROUNDS


def test_parts_of_a_batch():
    import pyarrow as pa

    from kpimill.llm.base import parts_of

    batch = pa.RecordBatch.from_pydict({"x": list(range(1300))})
    parts = list(parts_of(batch))
    assert max(p.num_rows for p in parts) == 512 and [x for p in parts for x in p.column("x").to_pylist()] == list(range(1300))
    assert not list(parts_of(batch.slice(0, 0)))
