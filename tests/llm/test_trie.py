"""The prefix trie against plain Python and SQL."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from checks.compare import duckdb_rows

from meterlake.llm import trie
from meterlake.llm.queries import ORACLE_SQL, QUERIES
from meterlake.llm.trie import prefix_trie, shared_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth long, high long, part int"


def table(spark, rows):
    return spark.createDataFrame([(*row, 1, 2, 3) for row in rows], SCHEMA)


def conversations_of(rows):
    found = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            pair = (role or "", text or "")
            both = f"{len(pair[0].encode())}:{pair[0]}{pair[1]}".encode()
            key = (turn is not None, turn or 0, hashlib.sha256(both).digest())
            found.setdefault(conv_id, []).append((key, pair))
    return {c: [pair for _, pair in sorted(turns)] for c, turns in found.items()}


def rebuilt(convs):
    result = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        result[c] = convs.get(c - c % 20, [])[:h] + turns[h:]
    return result


def by_hand(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    result = []
    for node, ids in members.items():
        below = [n for n in members if n[: len(node)] == node]
        saved = sum(
            (len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1]))
            for n in below if n
        )
        ends = sorted(c for c in ids if len(convs[c]) == len(node))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        leaves = sum(n not in children for n in below)
        result.append((min(ids), len(node), parent, len(ids), len(children.get(node, [])), leaves,
                       saved, digest))
    return sorted(result, key=repr)


def nodes(result):
    return sorted((tuple(r) for r in result.collect()), key=repr)


ROWS = [
    (0, 0, "user", "hello there  you"),
    (0, 1, "assistant", "yes"),
    (0, 2, None, "more words here"),
    (20, 0, "user", "hello there  you"),
    (20, 1, "assistant", "yes"),
    (21, 0, "user", "x"),
    (22, 0, "user", "a b"),
    (22, None, "user", "null comes first"),
    (22, 0, "user", "a b"),  # a repeated row
    (22, 0, "assistant", "a b"),  # the same turn
    (23, 5, None, None),
    (24, 5, "", ""),
    (41, 1, "user", "base is missing"),
    (42, 1, "user", "x"),
    (43, 1, "user", "x"),
    (44, 1, "user", "x"),
    (-3, 1, "us", "erx"),
    (-4, 1, "user", "x"),
    (None, 1, "user", "no conversation"),
    (60, 1, "user", "😀 größe \t\n x" + "y" * 50_000),
]


def test_every_case(spark):
    convs = conversations_of(ROWS)
    assert nodes(prefix_trie(table(spark, ROWS))) == by_hand(convs)
    # in Python c % 20 of a negative c is positive, in SQL it is not
    rows = [row for row in ROWS if row[0] is None or row[0] >= 0]
    convs = rebuilt(conversations_of(rows))
    assert any(not turns for turns in convs.values())
    assert nodes(shared_prefix_trie(table(spark, rows))) == by_hand(convs)
    assert nodes(shared_prefix_trie(table(spark, []))) == []


def random_rows(seed, most, convs=60, words="ab"):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        length = rng.choice([1, 2, 3, most])
        same = rng.random() < 0.6
        for turn in range(length):
            text = "a" if same and turn < most - 2 else rng.choice(words)
            rows.append((c, turn, rng.choice(["u", "u", "v"]) if not same else "u", text))
    return rows


@pytest.mark.parametrize("band, most, children", [(2, 9, 100), (3, 30, 1)])
def test_deep_tries_in_low_bands(spark, monkeypatch, band, most, children):
    monkeypatch.setattr(trie, "MOST_CHILDREN", children)
    monkeypatch.setattr(trie, "IDS_TOGETHER", 2)
    rows = random_rows(band, most)
    want = by_hand(rebuilt(conversations_of(rows)))
    assert nodes(shared_prefix_trie(table(spark, rows), band=band)) == want


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    columns, rows = duckdb_rows(sf_dir, ORACLE_SQL["op12_prefix_trie"])
    result = QUERIES["op12_prefix_trie"](spark, sf_dir).select(*columns)
    assert nodes(result) == sorted(rows, key=repr) and len(rows) > 50
