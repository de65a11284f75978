"""Near-duplicates against all pairs; signatures against weighted similarity."""

from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from meterlake.llm import neardup
from meterlake.llm.components import components
from meterlake.llm.darts import signature
from meterlake.llm.neardup import keep_one, near_duplicates
from meterlake.llm.spans import mixed
from tests.llm.conftest import CASES


def shingle_set(text):
    words = (text or "").encode().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def classes_by_hand(rows, similarity=0.8):
    sets = [shingle_set(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] == sets[j] or shared >= similarity * len(sets[i] | sets[j]) > 0:
                parent[root(i)] = root(j)
    members = {}
    for i, (doc_id, _) in enumerate(rows):
        members.setdefault(root(i), []).append(doc_id)
    result = []
    for ids in members.values():
        least = min((i for i in ids if i is not None), default=None)
        result += [(i, least, len(ids)) for i in ids]
    return sorted(map(repr, result))


def classes(docs, **more):
    rows = near_duplicates(docs, **more).select("doc_id", "class_id", "class_size").collect()
    return sorted(repr(tuple(r)) for r in rows)


def test_every_case(documents):
    assert classes(documents(CASES)) == classes_by_hand(CASES)
    assert classes(documents([])) == []


@pytest.mark.parametrize("block", [512, 3])
def test_chains_and_stars_of_edits(documents, monkeypatch, block):
    """Each text is an edit of an earlier one, so that many similarities lie around 0.8."""
    monkeypatch.setattr(neardup, "BLOCK_NODES", block)
    rng = random.Random(7)
    words = [f"w{i}" for i in range(500)]
    texts = [rng.choices(words, k=rng.randint(40, 90)) for _ in range(8)]
    for _ in range(110):
        text = list(rng.choice(texts))
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(len(text))] = rng.choice(words)
        texts.append(text + rng.choices(words, k=rng.randint(0, 6)))
    rows = [(i * 13 % 997, " ".join(t)) for i, t in enumerate(texts)]
    assert classes(documents(rows)) == classes_by_hand(rows)


def test_large_group_of_near_copies(documents, settings):
    rng = random.Random(8)
    base = [f"w{rng.randrange(10_000)}" for _ in range(120)]
    rows = []
    for i in range(400):
        text = list(base)
        text[rng.randrange(len(text))] = f"edit{i}"
        rows.append((i, " ".join(text)))
    rows += [(1_000 + i, " ".join(f"v{rng.randrange(9_999)}" for _ in range(50))) for i in range(50)]
    assert classes(documents(rows)) == classes_by_hand(rows)


def test_keep_one(documents):
    docs = documents(CASES)
    kept = keep_one(docs)
    assert kept.schema == docs.schema
    want = {shingle_set(text) for _, text in CASES}
    rows = kept.collect()
    assert {shingle_set(r.text) for r in rows} == want and len(rows) == len(want)
    named = {r.doc_id for r in rows}
    assert {2, 4, 5, 8} & named == {4, 5, 8} and 9 not in named


def test_components_of_paths_and_stars(spark):
    rng = random.Random(9)
    order = rng.sample(range(300), 300)
    edges = [(order[i], order[i + 1]) for i in range(200)]
    edges += [(order[250], order[i]) for i in range(251, 300)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in components(frame).collect()}
    path, star = order[:201], order[250:]
    assert got == {**{n: min(path) for n in path}, **{n: min(star) for n in star}}
    assert components(frame.limit(0)).collect() == []


@pytest.mark.parametrize("similarity", [0.2, 0.5, 0.8])
def test_signatures_agree_as_often_as_weighted_sets_are_similar(similarity):
    rng = np.random.default_rng(1)
    agree = trials = 0
    for number in range(40):
        elements = mixed(np.arange(1, 61, dtype=np.uint64) + np.uint64(1_000 * number))
        one, other = rng.uniform(0.1, 3, 60), rng.uniform(0.1, 3, 60)
        low, high = 0.0, 1.0
        for _ in range(40):  # mix until the weighted similarity is as wanted
            share = (low + high) / 2
            blend = share * one + (1 - share) * other
            found = np.minimum(one, blend).sum() / np.maximum(one, blend).sum()
            low, high = (share, high) if found < similarity else (low, share)
        if abs(found - similarity) > 0.01:
            blend = np.concatenate([one * similarity])
        agree += (signature(elements, 128, one) == signature(elements, 128, blend)).sum()
        trials += 128
    assert abs(agree / trials - similarity) < 4 * (similarity * (1 - similarity) / trials) ** 0.5 + 0.01


def test_signature_of_whole_weights_equals_that_of_a_set():
    elements = mixed(np.arange(1, 5_000, dtype=np.uint64))
    for size in (1, 3, 40, 4_999):
        plain = signature(elements[:size], 100)
        assert (plain != 0).all()
        shuffled = signature(elements[:size][::-1], 100)
        assert (plain == shuffled).all()
    assert (signature(elements[:0], 100) == 0).all()


def linked_by_hand(sets, similarity=0.8):
    """Pairs of similar sets, looked up by the elements that two sets share."""
    places = {}
    for number, elements in enumerate(sets):
        for element in elements:
            places.setdefault(element, []).append(number)
    shared = Counter(pair for numbers in places.values() for pair in combinations(numbers, 2))
    return [
        (i, j)
        for (i, j), n in shared.items()
        if n >= similarity * (len(sets[i]) + len(sets[j]) - n)
    ]


def test_no_link_of_the_given_documents_is_lost(spark):
    """Recall of all pairs at 0.8 and more, and no class that such pairs do not join."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    sets = sorted({shingle_set(r.text) for r in rows}, key=sorted)
    links = linked_by_hand(sets)
    assert links
    root = {elements: i for i, elements in enumerate(sets)}
    for i, j in links:
        one, other = root[sets[i]], root[sets[j]]
        if one != other:
            root = {k: one if v == other else v for k, v in root.items()}
    least = {}
    for r in rows:
        where = root[shingle_set(r.text)]
        least[where] = min(least.get(where, r.doc_id), r.doc_id)
    got = {r.doc_id: r.class_id for r in near_duplicates(docs).collect()}
    assert got == {r.doc_id: least[root[shingle_set(r.text)]] for r in rows}
