"""The quality classifier: held-out accuracy, shrinking, and defined results."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from meterlake.llm.quality import classify, keep_good
from tests.llm.conftest import CASES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture
def labels(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")

    return make


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    known = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    truth = {r.doc_id: r.quality for r in known.collect()}
    scored = classify(docs, known.filter("doc_id % 2 = 0")).collect()
    assert len(scored) == docs.count()
    held = [(r.kept, truth[r.doc_id] == 1) for r in scored if truth.get(r.doc_id) is not None
            and r.doc_id % 2]
    assert len(held) > 150
    assert sum(kept == good for kept, good in held) > 0.97 * len(held)
    assert sum(good and not kept for kept, good in held) <= 0.01 * len(held)


def test_keep_good_keeps_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    known = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    kept = keep_good(docs, known)
    assert kept.schema == docs.schema
    decided = {r.doc_id for r in classify(docs, known).filter("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == decided


def test_every_case_and_no_labels(documents, labels):
    docs = documents(CASES)
    for known in ([], [(4, 1, 0, "x")], [(None, 0, 0, "x"), (4, None, 0, "x"), (4, 7, 1, "y")]):
        rows = classify(docs, labels(known)).collect()
        assert len(rows) == len(CASES) and all(r.kept and r.score == 0.5 for r in rows)
        assert keep_good(docs, labels(known)).count() == len(CASES)
    rows = classify(docs, labels([(4, 1, 0, "x"), (8, 0, 0, "x"), (8, 0, 0, "x")])).collect()
    assert len(rows) == len(CASES) and all(0 <= r.score <= 1 for r in rows)
    assert classify(documents([]), labels([(4, 1, 0, "x")])).collect() == []


def test_sites_shrink_towards_hosts_and_hosts_towards_all(spark, labels):
    rng = random.Random(1)
    rows, known = [], []
    for i in range(600):
        host, path = ("good", "a") if i < 300 else ("bad", "b" if i % 2 else "c")
        clean = rng.random() < (0.95 if host == "good" else 0.2)
        words = [f"w{rng.randrange(300)}" for _ in range(40)]
        rows.append((i, " ".join(words) if clean else " ".join(w + "!!" for w in words), path, host))
        known.append((i, int(clean), 0, ""))
    middling = "some words w1! with w2! signs " * 4
    rows += [(1_000, middling, "a", "good"), (1_001, middling, "b", "bad"),
             (1_002, middling, "new", "bad"), (1_003, middling, "new", "unseen"),
             (1_004, middling, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = {r.doc_id: r for r in classify(docs, labels(known)).collect()}
    site = {i: found[i].site_score for i in range(1_000, 1_005)}
    assert site[1_000] > 0.85 and site[1_001] < 0.4
    assert site[1_001] - 0.15 < site[1_002] < site[1_003] < site[1_000]
    assert abs(site[1_003] - site[1_004]) < 0.05
    assert found[1_000].score > found[1_003].score > found[1_001].score
    assert found[1_003].site_documents == 1


def looks_by_hand(text):
    """The features of a text, character by character and word by word."""
    data = text.encode()
    words = data.split()
    upper = sum(65 <= b <= 90 for b in data)
    lower = sum(97 <= b <= 122 or b >= 128 for b in data)
    size, number = max(1, len(data)), max(1, len(words))
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    most = max((words.count(w) for w in set(words)), default=0)
    shares = [
        upper / max(1, upper + lower),
        sum(48 <= b <= 57 for b in data) / size,
        sum(b in b"!#$%&*|<>{}[]()@=+_/\\~^" for b in data) / size,
        sum(b in b"!.,;:?" for b in data) / size,
        data.count(b"!") / size,
        data.count(b"|") / size,
        data.count(b"\n") / size,
        most / number,
        len(set(words)) / number,
        sum(a == b for a, b in zip(words, words[1:])) / number,
        1 - len(set(triples)) / max(1, len(triples)),
        len(data) / number / 20,
        (upper + lower) / size,
    ]
    return [math.log1p(len(words)), *[math.log(share + 1e-3) for share in shares]]


def logit(p):
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


def odds_by_hand(texts, known):
    """Log odds of each text from a ridge regression, found by plain descent on its slope."""
    raw = np.array([looks_by_hand(t) for t in texts])
    seen = np.array([raw[i] for i, _ in known])
    good = np.array([g for _, g in known], float)
    middle, scale = seen.mean(axis=0), seen.std(axis=0) + 1e-9

    def x(rows):
        z = (rows - middle) / scale
        return np.hstack([z, z * z, np.ones((len(z), 1))])

    design, penalty = x(seen), np.array([1.0] * 28 + [1e-6])
    weights = np.zeros(29)
    for _ in range(200):
        chance = 1 / (1 + np.exp(-design @ weights))
        slope = design.T @ (good - chance) - penalty * weights
        bend = (design.T * (chance * (1 - chance))) @ design + np.diag(penalty)
        weights = weights + np.linalg.solve(bend, slope)
    return np.clip(x(raw) @ weights, -10, 10).tolist()


def strength_by_hand(sites, share):
    variance = share * (1 - share)
    total = sum(n for n, _ in sites)
    spread = sum(n * (good / n - share) ** 2 for n, good in sites)
    between = (spread - variance * (len(sites) - 1)) / max(
        1.0, total - sum(n * n for n, _ in sites) / total
    )
    return max(2.0, variance / max(1e-6, between) - 1)


def test_scores_equal_plain_python(spark):
    """Evidence, moments, shrinking and leaving a document out of its own site, one by one."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    known = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = [(r.doc_id, r.text or "", r.source or "", r.lang or "") for r in docs.collect()]
    place = {doc_id: i for i, (doc_id, *_) in enumerate(rows)}
    labels = [(place[r.doc_id], r.quality) for r in known.collect() if r.doc_id in place]
    odds = odds_by_hand([text for _, text, *_ in rows], labels)
    own = [sigmoid(o) for o in odds]
    paths, hosts = {}, {}
    for (_, _, host, path), score in zip(rows, own):
        for level, key in ((paths, (host, path)), (hosts, host)):
            n, good = level.get(key, (0, 0.0))
            level[key] = n + 1, good + score
    share = sum(own) / len(own)
    of_hosts = strength_by_hand(list(hosts.values()), share)
    of_paths = strength_by_hand(list(paths.values()), share)
    want = {}
    for (doc_id, _, host, path), o, score in zip(rows, odds, own):
        n, good = hosts[host]
        host_score = (good + of_hosts * share) / (n + of_hosts)
        n, good = paths[host, path]
        site = (good - score + of_paths * host_score) / (n - 1 + of_paths)
        final = sigmoid(o + 0.5 * (logit(site) - logit(share)))
        want[doc_id] = (final, score, site, n)
    got = classify(docs, known).collect()
    assert len(got) == len(want)
    for r in got:
        final, score, site, n = want[r.doc_id]
        assert r.site_documents == n and r.kept == (final >= 0.5)
        assert [r.score, r.own_score, r.site_score] == pytest.approx([final, score, site], abs=1e-6)
