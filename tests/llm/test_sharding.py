"""Shards: the law, the slots, and groups that stay together."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from meterlake.llm.sharding import shard_documents
from tests.llm.conftest import CASES


def check_law(rows, result, shards):
    got = result.collect()
    want = Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(rows)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return got


def test_every_case(documents):
    check_law(CASES, shard_documents(documents(CASES)), 16)
    check_law(CASES, shard_documents(documents(CASES), shards=3), 3)
    check_law(CASES, shard_documents(documents(CASES), shards=1), 1)
    assert shard_documents(documents([])).collect() == []


def test_groups_stay_together(documents):
    rows = [(i, f"copy {i % 40}" if i < 200 else f"single {i}") for i in range(1_000)]
    got = check_law(rows, shard_documents(documents(rows), shards=8), 8)
    shards = defaultdict(set)
    for r in got:
        if r.group_size > 1:
            shards[r.text_crc32].add(r.shard)
    assert len(shards) == 40
    assert sum(len(s) > 1 for s in shards.values()) <= 4


@pytest.mark.parametrize("hot", [400, 900, 1_200])
def test_a_large_group_fills_few_shards(documents, hot):
    rows = [(i, "hot" if i < hot else f"single {i}") for i in range(1_200)]
    got = check_law(rows, shard_documents(documents(rows), shards=8), 8)
    filled = Counter(r.shard for r in got if r.group_size > 1)
    assert len(filled) <= min(8, 2 + 8 * hot // 1_200 * 2)


def shards_by_hand(spark, rows, shards):
    """Rounds of wishes and quotas in plain Python; only the hash function is Spark's."""

    def hashes(kinds, values):
        frame = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], f"i int, {kinds}")
        found = frame.select("i", F.xxhash64(*frame.columns[1:]).alias("h")).collect()
        return dict(zip(values, (r.h for r in sorted(found, key=lambda r: r.i))))

    docs = []
    for doc_id, text in rows:
        data = (text or "").encode()
        docs.append({"id": doc_id, "size": len(data) + 1, "crc": zlib.crc32(data),
                     "sha": hashlib.sha256(data).digest()})
    total, room = len(docs), -(-len(docs) // shards)
    members = Counter(d["sha"] for d in docs)
    most = max(1, int(room / 16))
    of_doc = hashes("a long, b long", sorted({(d["id"], d["crc"]) for d in docs}))
    of_id = hashes("a long", sorted({(d["id"],) for d in docs}))
    of_sha = hashes("a binary", sorted((sha,) for sha, n in members.items() if n > 1))
    groups = sorted(set(of_sha.values()))
    of_wish = hashes("a long, b int", [(g, s) for g in groups for s in range(shards)])
    for d in docs:
        d["shard"] = of_doc[d["id"], d["crc"]] % shards
        d["group"] = of_sha.get((d["sha"],))
        d["n"] = members[d["sha"]]
        d["part"] = of_id[(d["id"],)] % -(-d["n"] // most)
    units = hashes("a long, b long", sorted({(d["group"], d["part"]) for d in docs if d["group"]}))
    for d in docs:
        d["unit"] = units[d["group"], d["part"]] if d["group"] else 42
    linked = [d for d in docs if d["group"]]
    closed = set()
    for number in range(shards + 4):
        steps = hashes("a long, b int", [(u, number) for u in sorted({d["unit"] for d in linked})])
        votes = {}
        for d in linked:
            if d["shard"] not in closed:
                votes.setdefault(d["group"], Counter())[d["shard"]] += 1
        moves = []
        for d in linked:
            found = votes.get(d["group"])
            wish = d["shard"]
            if found and not (d["n"] > room and d["shard"] in closed):
                wish = max(found, key=lambda s: (found[s], of_wish[d["group"], s]))
            moves.append((d, wish, steps[d["unit"], number] % 64))
        admitted = [64] * shards

        def sizes():
            after = Counter(w if step < admitted[w] else d["shard"] for d, w, step in moves)
            new = {w for d, w, step in moves if step < admitted[w] and w != d["shard"]}
            return [after[s] - int(room * 1.02) if s in new else 0 for s in range(shards)]

        while max(over := sizes()) > 0:
            admitted[over.index(max(over))] -= 1
        closed |= {s for s in range(shards) if admitted[s] < 64}
        gone = [(d, w) for d, w, step in moves if step < admitted[w] and w != d["shard"]]
        for d, wish in gone:
            d["shard"] = wish
        if not gone:
            break
    seats, waiting, free = [], [], []
    for s in range(shards):
        own = [d for d in docs if d["shard"] == s]
        own.sort(key=lambda d: (
            (d["unit"] % 2**20 / 2**20) if d["group"] else 1 + of_doc[d["id"], d["crc"]] % 2**20 / 2**20,
            d["unit"], d["id"], d["crc"], d["size"]))
        target = total // shards + (s < total % shards)
        seats += [(d["id"], s, slot) for slot, d in enumerate(own[:target])]
        waiting += own[target:]
        free += [(s, slot) for slot in range(len(own), target)]
    return sorted(seats + [(d["id"], *seat) for d, seat in zip(waiting, free)])


@pytest.mark.parametrize("shards", [3, 5])
def test_shards_equal_plain_python(spark, documents, shards):
    texts = ["large"] * 70 + ["b", "c", "d", "e"] * 9 + [f"own {i}" for i in range(50)]
    rows = list(enumerate(texts))
    got = shard_documents(documents(rows), shards=shards).select("doc_id", "shard", "slot")
    assert sorted(map(tuple, got.collect())) == shards_by_hand(spark, rows, shards)
