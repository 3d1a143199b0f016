"""The stages one by one, each against a plain version on its own input."""

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from conftest import SF
from test_decontaminate import brute as contaminated
from test_jaccard import brute as linked
from test_secrets import found

import corpus_pipeline
from veriledger.llm import bpe, kneser_ney
from veriledger.llm.frames import stored, table


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into each stage and what comes out of the last, as rows."""
    docs = table(spark, SF, "documents")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "stage")
        seen.append(docs)
    return [[r.asDict() for r in df.collect()] for df in seen]


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "byte-level BPE"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_all_but_the_last_keep_the_columns(stages):
    for rows in stages[:-1]:
        assert all(list(r) == ["doc_id", "text", "lang", "source", "n_chars"] for r in rows)


def test_quality(spark, stages):
    """The rejected are those beyond their limit; no document that is labelled good is lost."""
    before, after = stages[0], {r["doc_id"] for r in stages[1]}
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    kept = {r["doc_id"]: r["kept"] for r in kneser_ney.verdicts(docs, labels).collect()}
    assert {r["doc_id"] for r in before if kept[r["doc_id"]]} == after
    good = {r["doc_id"] for r in labels.filter("quality = 1").collect()}
    assert good <= after and len(after) < len(before)


def test_near_duplicates(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[1]]
    expected = {int(c) for _, _, c in linked(rows)}
    assert sorted(r["doc_id"] for r in stages[2]) == sorted(expected)


def test_decontamination(spark, stages):
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    verdict = {i: bad for i, *_, bad in contaminated([(r["doc_id"], r["text"]) for r in stages[2]], items)}
    assert {r["doc_id"] for r in stages[3]} == {r["doc_id"] for r in stages[2] if not verdict[str(r["doc_id"])]}


def test_secrets(stages):
    after = {r["doc_id"]: r for r in stages[4]}
    assert len(after) == len(stages[3])
    for r in stages[3]:
        out, at = [], 0
        for a, _, b, _ in found(r["text"])[1]:
            if a >= at:
                out += [r["text"][at:a], "[SECRET]"]
            at = max(at, b)
        assert after[r["doc_id"]]["text"] == "".join([*out, r["text"][at:]])
        assert after[r["doc_id"]]["n_chars"] == len(after[r["doc_id"]]["text"])


def test_encoding(stages):
    ranks = bpe.Vocabulary(public_tokenizers.path(bpe.VOCABULARY)).ranks
    encoder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert len(stages[5]) == len(stages[4])
    for r in stages[5]:
        ids = np.frombuffer(r["token_ids"], "<u4").tolist()
        assert ids == encoder.encode_ordinary(r["text"]) and r["n_tokens"] == len(ids)


def test_run(spark, stages):
    rows = [r.asDict() for r in corpus_pipeline.run(spark, SF).collect()]
    key = lambda r: r["doc_id"]
    assert sorted(rows, key=key) == sorted(stages[5], key=key)


def test_odd_rows(spark, odd, nothing):
    """Columns of documents, with nulls, empty, very long and repeated texts, through all stages."""
    docs = odd.selectExpr("doc_id", "text", "lang", "spans as source", "n_words as n_chars")
    for empty in (False, True):
        rows = docs.limit(0) if empty else docs
        for name, stage in corpus_pipeline.STAGES:
            rows = stored(stage(spark, rows, SF), "odd")
        texts = [r["text"] for r in rows.collect()]
        assert all(texts) and len(set(texts)) == len(texts)


def test_batches_are_bounded(spark):
    """Rows go to Python in a few MB at once, whatever a row's size: a batch of 10,000 texts had tens of MB."""
    docs = table(spark, SF, "documents")
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    wide = spark.range(6000, numPartitions=1).selectExpr("repeat('x', 4000) as text")

    def sizes(parts):
        for batch in parts:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["bytes"])

    before = spark.conf.get(limit)
    try:
        for name, stage in corpus_pipeline.STAGES:
            if name == "secret scans":
                continue  # it runs without Python
            spark.conf.unset(limit)
            stage(spark, docs.limit(20), SF)
            largest = max(r["bytes"] for r in wide.mapInArrow(sizes, "bytes long").collect())
            assert largest <= (9 << 20), name
    finally:
        spark.conf.set(limit, before)


def test_workers_forget_pieces(spark, stages):
    """What a task remembers of pieces does not stay in its worker for the steps that follow."""
    corpus_pipeline.encoding(spark, table(spark, SF, "documents"), SF).write.format("noop").mode("overwrite").save()

    def held(parts):
        for _ in parts:
            kept = [len(x) for v in bpe._OPEN.values() for x in (v._last, v._pairs, v._pieces)]
            yield pa.RecordBatch.from_arrays([pa.array([len(bpe._OPEN)]), pa.array([sum(kept)])], names=["open", "kept"])

    rows = spark.range(64, numPartitions=32).mapInArrow(held, "open long, kept long").collect()
    assert any(r["open"] for r in rows) and not any(r["kept"] for r in rows)
