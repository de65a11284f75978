"""The manifest against plain Python and SQL."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from checks.compare import duckdb_rows

from meterlake.llm import merkle
from meterlake.llm.merkle import build_manifest, document_leaves, fold, manifest_check
from meterlake.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.conftest import CASES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, part int"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    fields = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return H(*["-" if v is None else f"{len(v.encode())}:{v}" for v in fields])


def grow(nodes):
    """Root and, for each node, its siblings with their sides."""
    proofs = [[] for _ in nodes]
    owners = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(i, min(i + 2, len(nodes))) for i in range(0, len(nodes), 2)]
        for run in runs:
            for i in run:
                others = [("L" if j < i else "R", nodes[j]) for j in run if j != i]
                for owner in owners[i]:
                    proofs[owner].append(others)
        owners = [[o for i in run for o in owners[i]] for run in runs]
        nodes = [H(*[nodes[i] for i in run]) for run in runs]
    return nodes[0], proofs


def by_hand(rows):
    """``rows``: (doc_id, text, lang, source, n_chars)."""
    langs = {}
    for doc_id, text, lang, source, n_chars in rows:
        leaf = leaf_of(doc_id, source, lang, n_chars, text)
        langs.setdefault(lang, []).append((doc_id, leaf, (doc_id, source, lang, n_chars, text)))
    order = sorted(langs, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {}
    for lang in order:
        langs[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[lang] = grow([leaf for _, leaf, _ in langs[lang]])
    root, upper = grow([trees[lang][0] for lang in order]) if order else (None, [])
    result = []
    for lang, above in zip(order, upper):
        subroot, proofs = trees[lang]
        for (doc_id, leaf, row), proof in zip(langs[lang], proofs):
            path = proof + above
            start = leaf
            if doc_id is not None and row[3] is not None:
                if zlib.crc32(str(doc_id).encode()) % 7 == 0:
                    start = leaf_of(row[0], row[1], row[2], row[3] + 1, row[4])
            node = start
            for level in path:
                left = [h for side, h in level if side == "L"]
                right = [h for side, h in level if side == "R"]
                node = H(*left, node, *right)
            proof_hash = H(*[h for level in path for _, h in level])
            result.append((doc_id, leaf, subroot, root, proof_hash, node, node == root))
    return sorted(map(repr, result))


def check(spark, rows):
    docs = spark.createDataFrame([(*row, "t", 3) for row in rows], SCHEMA)
    got = [tuple(r) for r in manifest_check(docs).collect()]
    assert sorted(map(repr, got)) == by_hand(rows)
    return got


def test_every_case(spark):
    langs = ["en", None, "", "de", "é", "=", "-", "zz\U0001f600"]
    rows = [
        (doc_id, text, langs[i % len(langs)], "s" if i % 3 else None, None if i % 4 == 0 else i)
        for i, (doc_id, text) in enumerate(CASES)
    ]
    rows += rows[3:6] + [(50, "t", "en", "s", (1 << 63) - 1), (-7, "t", "en", "s", -1)]
    got = check(spark, rows)
    assert {r[6] for r in got} == {True, False}
    check(spark, rows[:1])
    check(spark, [])


@pytest.mark.parametrize(
    "levels, sizes",
    [(1, [1]), (1, [2, 1, 5]), (2, [33, 4, 17, 1, 1, 9]), (8, [3, 5, 8, 1]), (8, [300])],
)
def test_trees_of_any_size_in_few_levels(spark, monkeypatch, levels, sizes):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    rng = random.Random(len(sizes))
    ids = rng.sample(range(10_000), sum(sizes))
    langs = [f"l{k}" if k else None for k, size in enumerate(sizes) for _ in range(size)]
    check(spark, [(i, f"t{i}", lang, "s", i) for i, lang in zip(ids, langs)])


def test_a_proof_leads_to_the_root(spark):
    rows = [(i, "x" * i, "ab"[i % 2], "s", i, "t", 1) for i in range(20)]
    docs = spark.createDataFrame(rows, SCHEMA)
    manifest = build_manifest(document_leaves(docs))
    assert manifest.columns == ["doc_id", "leaf", "proof", "subroot", "root"]
    folded = manifest.select((fold(manifest["leaf"], manifest["proof"]) == manifest["root"]))
    assert {r[0] for r in folded.collect()} == {True}


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    columns, rows = duckdb_rows(sf_dir, ORACLE_SQL["op13_merkle_manifest"])
    result = QUERIES["op13_merkle_manifest"](spark, sf_dir).select(*columns)
    got = sorted(map(tuple, result.collect()))
    assert got == sorted(rows) and len({r[-1] for r in got}) == 2
