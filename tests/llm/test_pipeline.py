"""Every stage of the pipeline against plain Python on that stage's own input."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from meterlake.llm.quality import classify
from meterlake.llm.secrets import BASE, MASK
from tests.llm.conftest import CASES
from tests.llm.test_exact import normal
from tests.llm.test_neardup import classes_by_hand
from tests.llm.test_secrets import base_spans
from tests.llm.test_tokens import check_packing

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def stored(spark, frame, path):
    frame.write.parquet(str(path))
    return spark.read.parquet(str(path))


def by_id(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_stages_on_given_documents(spark, tmp_path, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    inputs = [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        inputs.append(stored(spark, stage(spark, inputs[-1], SF_DIR), tmp_path / str(number)))
    assert all(frame.schema == docs.schema for frame in inputs[:5])
    start, good, exact, near, clean, packed = inputs

    kept = {r.doc_id for r in classify(docs, labels).filter("kept").collect()}
    rows = {r.doc_id: r for r in docs.collect()}
    assert by_id(good) == {i: rows[i] for i in kept}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert all(truth.get(i, 1) == 1 for i in kept)
    assert all(i in kept for i, quality in truth.items() if quality == 1)

    first = {}
    for i in sorted(kept):
        first.setdefault(normal(rows[i].text), i)
    assert by_id(exact) == {i: rows[i] for i in first.values()}

    hand = classes_by_hand([(i, rows[i].text) for i in first.values()])
    heads = {eval(text)[1] for text in hand}
    assert by_id(near) == {i: rows[i] for i in heads}

    result = by_id(clean)
    assert result.keys() == heads
    hidden = 0
    for i, row in result.items():
        text = rows[i].text
        assert row.n_chars == len(row.text) and not base_spans(row.text)
        if not base_spans(text) and MASK not in row.text:
            assert row == rows[i]
        hidden += MASK in row.text
    assert hidden >= any(base_spans(rows[i].text) for i in heads) and len(BASE) == 3

    check_packing([(i, r.text) for i, r in result.items()], packed, library, 2048)


def test_stages_on_every_case(spark, documents, tmp_path):
    docs = documents(CASES)
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stored(spark, stage(spark, docs, SF_DIR), tmp_path / str(number))
        assert docs.count() > 0
    empty = documents([])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0


def test_run_is_the_stages_in_turn(spark):
    result = corpus_pipeline.run(spark, SF_DIR)
    assert result.columns[:3] == ["doc_id", "start", "length"]
    assert result.count() > 0


@pytest.mark.parametrize("rows, labelled", [(CASES, True), (CASES, False), ([], True)])
def test_run_on_every_case_and_on_empty_tables(spark, documents, tmp_path, rows, labelled):
    docs = documents(rows)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    (labels if labelled else labels.limit(0)).write.parquet(str(tmp_path / "labels.parquet"))
    result = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert bool(result) == bool(rows)
    if rows and not labelled:
        kept = {r.doc_id for r in result}
        assert {1, 4, 5, 7, 8, 10, 11, 12} <= kept
        assert not {2, 3, 6, 9} & kept  # empty, white space alone, copies but for white space
