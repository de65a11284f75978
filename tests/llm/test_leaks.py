"""Benchmark windows in documents against plain Python and SQL."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from checks.compare import duckdb_rows

from meterlake.llm import leaks
from meterlake.llm.leaks import cut_words, find_leaks, leak_digests, remove_leaks, segments
from meterlake.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.conftest import CASES, regular

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def by_hand(rows, items, window=10):
    windows = {}
    for item, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(item)
    sizes = {len(w) for w in windows}
    result = []
    for doc_id, text in rows:
        words, hit, found = words_of(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if items_of := windows.get(tuple(words[i : i + size])):
                    found |= items_of
                    hit.update(range(i, i + size))
        names = sorted(str(item) for item in found if item is not None)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        result.append((doc_id, len(words), len(hit), len(names), digest, bool(hit)))
    return sorted(map(repr, result))


def digests(docs, items, **options):
    return sorted(repr(tuple(r)) for r in leak_digests(docs, items, **options).collect())


@pytest.fixture
def benchmark(spark):
    def make(items):
        schema = "item_id long, text string, row string, firsts int, chunk string"
        return spark.createDataFrame([(i, t, "r", 1, "c") for i, t in items], schema)

    return make


ITEMS = [
    (1, "A b, C"),  # shorter than a window
    (2, "word " * 12),
    (3, None),
    (4, ""),
    (5, "--- !!"),
    (6, " ".join("abcdefghijkl")),
    (6, " ".join("abcdefghijkl")),  # a repeated row
    (10, "b c d e f g h i j k l m n"),
    (None, "größe naïve"),
    (7, "ß"),
    (8, " ".join(["x" * 200] * 11)),
    (9, regular("a", "b", 1024)),
]
TEXTS = [
    (20, "x A B c d E-f.g/h;i j.K l m"),
    (21, "GRÖSSE Größe Naïve NAÏVE größe naïve"),
    (22, "ẞ ß É"),
    (23, ("x" * 200 + " ") * 30 + "a b c"),
    (24, "a\x00b\x7fc"),
    (25, regular("b", "a", 1024)),
    (26, "a b b c"),
]


def test_every_case(documents, benchmark):
    docs, items = documents(CASES + TEXTS), benchmark(ITEMS)
    assert digests(docs, items) == by_hand(CASES + TEXTS, ITEMS)
    assert digests(docs, items, slice_bytes=200) == by_hand(CASES + TEXTS, ITEMS)
    assert digests(docs, benchmark([])) == by_hand(CASES + TEXTS, [])
    assert digests(documents([]), items) == []


@pytest.mark.parametrize("seed", range(3))
def test_few_words_in_small_blocks(documents, benchmark, seed, monkeypatch):
    rng = random.Random(seed)
    letters = ["ab", "abcd", "abcdefgh"][seed]
    items = [(i % 7, " ".join(rng.choices(letters, k=rng.randint(0, 9)))) for i in range(12)]
    rows = [(i, " ".join(rng.choices(letters + "z", k=rng.randint(0, 80)))) for i in range(60)]
    monkeypatch.setattr(leaks, "CHUNK_BYTES", 9)
    assert digests(documents(rows), benchmark(items), window=4) == by_hand(rows, items, 4)
    index = leaks.Index(*map(list, zip(*[(str(i), leaks.normalised(t)) for i, t in items])), 4)
    monkeypatch.setattr(leaks, "BLOCK", 17)
    whole = leaks._Scan(index, [t for _, t in rows])
    n_hit = [int(sum(b - a for a, b in leaks.merged(s))) for s in whole.spans]
    assert [(n, h) for n, h in zip(whole.n_words, n_hit)] == [
        eval(r)[1:3] for r in sorted(by_hand(rows, items, 4), key=lambda r: eval(r)[0])
    ]


def test_a_window_under_the_hash_of_another_is_no_hit(monkeypatch):
    monkeypatch.setattr(leaks, "word_hashes", lambda data, a, b: (b - a).astype("uint64"))
    index = leaks.Index(["1", "2"], [b"aa bb cc", b"xx"], 3)
    scan = leaks._Scan(index, ["aa bb cd", "zz aa bb cc", "xx yy"])
    assert [len(s) for s in scan.spans] == [0, 1, 1]
    assert scan.items == [set(), {"1"}, {"2"}]


def test_segments_hold_every_run_of_words():
    rng = random.Random(3)
    for _ in range(300):
        words = [b"w" * rng.randint(1, 12) for _ in range(rng.randint(0, 40))]
        data, overlap = b" ".join(words), rng.randint(0, 5)
        again = []
        for part, repeated in segments(data, rng.randint(1, 30), overlap):
            own = part.split()
            assert own[:repeated] == again[len(again) - repeated :]
            again += own[repeated:]
            assert repeated <= overlap and (repeated == overlap or len(again) == len(own))
        assert again == words


def test_spans_and_documents_are_removed(documents, benchmark):
    rows = [(1, "Keep this, A b  c! and this"), (2, "nothing here"), (3, None), (4, "a B c")]
    docs, items = documents(rows), benchmark([(1, "a b c")])
    spans = {r.doc_id: (list(r.firsts), list(r.lasts)) for r in find_leaks(docs, items).collect()}
    assert spans == {1: ([2], [5]), 2: ([], []), 3: ([], []), 4: ([0], [3])}
    left = remove_leaks(docs, items)
    assert left.schema == docs.schema
    got = {r.doc_id: (r.text, r.n_chars) for r in left.collect()}
    assert got == {1: ("Keep this, ! and this", 21), 2: ("nothing here", 12), 3: (None, None),
                   4: ("", 0)}
    clean = remove_leaks(docs, items, whole_documents=True)
    assert clean.schema == docs.schema and {r.doc_id for r in clean.collect()} == {2, 3}
    assert cut_words("a b", [], []) == "a b"


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    columns, rows = duckdb_rows(sf_dir, ORACLE_SQL["op11_leak_scan"])
    result = QUERIES["op11_leak_scan"](spark, sf_dir)
    assert sorted(result.columns) == sorted(columns)
    got = sorted(tuple(r) for r in result.select(*columns).collect())
    assert got == sorted(rows) and any(r.contaminated for r in result.collect())
