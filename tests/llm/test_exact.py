"""Exact copies and repeated passages against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from meterlake.llm.radix import exact_groups, keep_first
from meterlake.llm.substrings import remove_repeats
from tests.llm.conftest import CASES


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def check_groups(rows, result):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(normal(text), []).append(doc_id)
    got = [tuple(r) for r in result.collect()]
    assert len(got) == len(rows)
    want = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), digest(text)) for i in ids]
    assert sorted(map(repr, want)) == sorted(repr((a, b, c, e)) for a, b, c, _, e in got)
    kept = [(a, e) for a, _, _, flag, e in got if flag]
    assert len(kept) == len(groups) == len({e for _, e in kept})
    assert all(a == b for a, b, _, flag, _ in got if flag)


def test_groups_of_every_case(documents):
    check_groups(CASES, exact_groups(documents(CASES)))


def test_groups_that_part_late_or_end_early(documents):
    base = "".join(random.Random(1).choices("ab ", k=9_000))
    rows = [(i, base[:n] + tail) for i, (n, tail) in enumerate(
        [(9_000, ""), (9_000, "x"), (64, ""), (64, ""), (63, ""), (65, ""), (9_000, ""),
         (4_096, "y"), (4_096, "z"), (4_096, "z"), (4_160, ""), (4_160, "")]
    )]
    check_groups(rows, exact_groups(documents(rows)))
    check_groups(rows, exact_groups(documents(rows), first_bytes=2))


def test_no_documents(documents):
    assert exact_groups(documents([])).collect() == []
    assert remove_repeats(documents([])).collect() == []
    assert keep_first(documents([])).columns == documents([]).columns


def test_keep_first_keeps_columns_and_one_row_of_each_text(documents):
    docs = documents(CASES)
    kept = keep_first(docs)
    assert kept.schema == docs.schema
    rows = kept.collect()
    assert len(rows) == len({normal(r.text) for r in docs.collect()})
    assert {(r.doc_id, r.text) for r in rows} <= {(r.doc_id, r.text) for r in docs.collect()}


def removed_by_hand(rows, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    first = {}
    for (doc_id, _), tokens in zip(rows, words):
        for i in range(len(tokens) - window + 1):
            if doc_id is not None:
                body = tuple(tokens[i : i + window])
                first[body] = min(first.get(body, doc_id), doc_id)
    result = []
    for (doc_id, _), tokens in zip(rows, words):
        gone = set()
        for i in range(len(tokens) - window + 1):
            found = first.get(tuple(tokens[i : i + window]))
            if found is not None and (doc_id is None or found < doc_id):
                gone.update(range(i, i + window))
        left = " ".join(t for i, t in enumerate(tokens) if i not in gone)
        result.append((doc_id, len(tokens), len(gone), digest(left)))
    return sorted(map(repr, result))


def test_repeats_of_every_case(documents):
    got = sorted(repr(tuple(r)) for r in remove_repeats(documents(CASES)).collect())
    assert got == removed_by_hand(CASES, 50)


@pytest.mark.parametrize("seed", range(4))
def test_repeats_of_woven_passages(documents, seed):
    """Few words, so that windows repeat within, across and around branches of the graph."""
    rng = random.Random(seed)
    passages = [rng.choices("abcdefgh"[: 2 + 2 * seed], k=rng.randint(5, 60)) for _ in range(12)]
    rows = []
    for i in range(40):
        tokens = []
        for _ in range(rng.randint(0, 6)):
            tokens += rng.choice(passages) if rng.random() < 0.8 else rng.choices("xyz", k=9)
        rows.append((None if i == 17 else i % 35, " ".join(tokens)))
    got = remove_repeats(documents(rows), window=12).collect()
    assert sorted(repr(tuple(r)) for r in got) == removed_by_hand(rows, 12)
