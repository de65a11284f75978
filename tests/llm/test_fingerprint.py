"""Fingerprints: order of ids, edited texts, and what their likeness tells."""

from __future__ import annotations

import hashlib
import random

from meterlake.llm.fingerprint import MOST, compare_with_next, difference, fingerprint, likeness
from tests.llm.conftest import CASES


def by_hand(rows):
    rows = sorted(
        ((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1])
    )
    result = []
    for number, (doc_id, text) in enumerate(rows):
        following = rows[(number + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        one, other, third = fingerprint(text), fingerprint(edited), fingerprint(following)
        result.append(
            (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), one, other,
             likeness(one, other), likeness(one, third))
        )
    return sorted(map(repr, result))


def test_every_case(documents):
    got = sorted(repr(tuple(r)) for r in compare_with_next(documents(CASES)).collect())
    assert got == by_hand(CASES)


def test_few_documents(documents):
    for rows in ([], [(3, "only one")], [(None, "x")], [(2, "b"), (1, "a")]):
        got = sorted(repr(tuple(r)) for r in compare_with_next(documents(rows)).collect())
        assert got == by_hand(rows)


def test_many_ranges_and_partitions(documents, settings):
    rows = [(i * 7 % 1_009, f"text {i} " * (i % 5)) for i in range(1_009)]
    with settings({"spark.sql.shuffle.partitions": "17"}):
        docs = documents(rows).repartition(13)
        got = sorted(repr(tuple(r)) for r in compare_with_next(docs).collect())
    assert got == by_hand(rows)


def test_given_documents_edited_is_nearer_than_next(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [r for r in compare_with_next(docs).collect() if r.n_chars > 100]
    nearer = sum(r.near_edited > r.near_next for r in rows if r.fingerprint != r.edited_fingerprint)
    assert nearer > 0.95 * sum(r.fingerprint != r.edited_fingerprint for r in rows)


def test_difference_is_bounded_and_symmetric():
    rng = random.Random(4)
    texts = ["".join(rng.choices("abcdefg ", k=rng.randint(0, 400))) for _ in range(60)]
    digests = [fingerprint(t) for t in texts]
    for a in digests:
        assert difference(a, a) == 0 and likeness(a, a) == 1
        for b in digests:
            assert 0 <= difference(a, b) == difference(b, a) <= MOST
            assert 0 <= likeness(a, b) <= 1


def test_small_edits_stay_near():
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghijklmnop", k=5)) for _ in range(300)]
    text = " ".join(rng.choices(words, k=400))
    tokens = text.split()
    tokens[200] = "changed"
    other = " ".join(rng.choices(words, k=400))
    one = fingerprint(text)
    assert likeness(one, fingerprint(" ".join(tokens))) > 0.9
    assert likeness(one, fingerprint(other)) < 0.6
