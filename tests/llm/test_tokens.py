"""Encoding, decoding and packing against the libraries."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from meterlake.llm import common
from meterlake.llm import pieces as cutting
from meterlake.llm.bpe import encode_texts, round_trip
from meterlake.llm.common import range_bounds, range_of, ranges_for
from meterlake.llm.hilbert import hilbert_keys, pack_documents
from meterlake.llm.merges import MergeReplay
from meterlake.llm.vocabulary import Decoder, library_pieces, merging_pieces, read_ranks
from tests.llm.conftest import CASES

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def ranked():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS),
        special_tokens={},
    )


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(JSON)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def odd_texts(count):
    rng = random.Random(5)
    parts = [*"ab'stlvermdLL  \n\t\r'’éßЖ中١½²_-!?.\x1c\x85  ​\x00😀", "'s", "'ll", "'re",
             " '", "  ", "\n\n", "՘", "͸", "<|endoftext|>"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(count)] + [""]


def ids_of(pieces, texts):
    found = [[]]
    for _, ended, ids, _ in pieces.encode(texts):
        found[-1] += ids.tolist()
        if ended:
            found.append([])
    return found[:-1]


def test_odd_texts_as_both_libraries(ranked, library):
    texts = odd_texts(8_000)
    assert ids_of(merging_pieces(RANKS)[0], texts) == [ranked.encode_ordinary(t) for t in texts]
    assert ids_of(library_pieces(JSON, 1), texts) == [library(t) + [1] for t in texts]


def test_every_character_as_both_libraries(ranked, library):
    every = cutting.every_character()
    texts = ["a" + every[i : i + 997] + "1" for i in range(0, len(every), 997)]
    texts += ["a1 ".join(every[i : i + 97]) for i in range(0, 40_000, 97)]
    assert ids_of(merging_pieces(RANKS)[0], texts) == [ranked.encode_ordinary(t) for t in texts]
    assert ids_of(library_pieces(JSON, 1), texts) == [library(t) + [1] for t in texts]


def test_small_blocks_and_cut_texts(ranked, monkeypatch):
    monkeypatch.setattr(cutting, "BLOCK", 60)
    texts = odd_texts(300) + ["aa bb  cc's " * 50]
    assert ids_of(merging_pieces(RANKS)[0], texts) == [ranked.encode_ordinary(t) for t in texts]


def thue_morse(bits):
    """A word that is regular in a way that running sums do not see, and its complement."""
    word = "a"
    for _ in range(bits):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("bits", [4, 5, 8, 10, 11, 13])
def test_regular_words_keep_their_own_ids(ranked, library, bits):
    texts = [*thue_morse(bits), " ".join(thue_morse(bits)), *thue_morse(bits)]
    assert ids_of(merging_pieces(RANKS)[0], texts) == [ranked.encode_ordinary(t) for t in texts]
    assert ids_of(library_pieces(JSON, 1), texts) == [library(t) + [1] for t in texts]


def test_pieces_under_one_hash_are_told_apart(ranked, monkeypatch):
    """With a hash that knows two values only, all ids still come from the pieces themselves."""
    replay = MergeReplay(read_ranks(RANKS))
    table = cutting.Pieces(
        lambda words: replay.encode([w.encode() for w in words]), merging_pieces(RANKS)[0]._classes
    )
    monkeypatch.setattr(
        cutting, "mixed_runs", lambda part, starts, sizes, width: 1 + (sizes % 2).astype(np.uint64)
    )
    texts = odd_texts(300) + ["two words and two more", "owt more words"]
    for _ in range(2):
        assert ids_of(table, texts) == [ranked.encode_ordinary(t) for t in texts]


def test_strings_of_added_tokens(library):
    end = "<|endoftext|>"
    texts = [end, f"a{end}b", f"it's {end} 's", f"{end}{end}x", f"  {end}\n\n{end} ", f"'{end}ll",
             f"<|endoftext|{end}|>", f"<|end{end}oftext|>"]
    assert ids_of(library_pieces(JSON, 1), texts) == [library(t) + [1] for t in texts]
    assert 50256 in ids_of(library_pieces(JSON, 1), texts)[0]


def test_table_of_pieces_starts_anew(ranked, monkeypatch):
    monkeypatch.setattr(cutting, "MOST_PIECES", 20)
    monkeypatch.setattr(cutting, "BLOCK", 200)
    texts = odd_texts(500)
    assert ids_of(merging_pieces(RANKS)[0], texts) == [ranked.encode_ordinary(t) for t in texts]


def test_few_words_at_a_time_go_to_the_library(library, monkeypatch):
    """Many new words do not make as many objects of the library at once."""
    import tokenizers

    class Counting:
        def __init__(self, inner):
            self._inner = inner

        def __getattr__(self, name):
            return getattr(self._inner, name)

        def encode_batch_fast(self, words, **options):
            sizes.append(len(words))
            return self._inner.encode_batch_fast(words, **options)

        @staticmethod
        def from_file(path):
            return Counting(Tokenizer.from_file(path))

    sizes: list[int] = []
    monkeypatch.setattr(tokenizers, "Tokenizer", Counting)
    pieces = library_pieces.__wrapped__(JSON, 1)
    texts = [" ".join(f"w{i}x" for i in range(at, at + 6_000)) for at in range(0, 18_000, 6_000)]
    texts += odd_texts(200)
    assert ids_of(pieces, texts) == [library(t) + [1] for t in texts]
    assert 1 < len(sizes) and max(sizes) <= 4_096


def test_replay_of_overlapping_merges():
    tokens = [bytes([i]) for i in range(256)]
    tokens += [b"aa", b"ab", b"aaaa", b"bc", b"aab", b"abc", b"ca"]
    ranks = {token: rank for rank, token in enumerate(tokens)}
    encoding = tiktoken.Encoding("t", pat_str=r"[a-c]+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(2)
    words = ["".join(rng.choices("abc", k=rng.randint(1, 14))) for _ in range(3_000)]
    got = MergeReplay(ranks).encode([w.encode() for w in words])
    assert got == [encoding.encode_ordinary(w) for w in words]


def test_round_trip_of_every_case(documents, ranked):
    docs = documents(CASES)
    got = sorted(map(repr, map(tuple, round_trip(docs).collect())))
    want = []
    for doc_id, text in CASES:
        ids = ranked.encode_ordinary(text or "")
        raw = np.array(ids, "<u4").tobytes()
        body = (text or "").encode()
        want.append(
            (doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(body).hexdigest())
        )
    assert got == sorted(map(repr, want))
    stored = encode_texts(docs, RANKS).filter("doc_id = 7").collect()
    assert np.frombuffer(stored[0].ids, "<u4").tolist() == ranked.encode_ordinary(CASES[10][1])
    assert round_trip(documents([])).collect() == []


def test_decoder():
    decode = Decoder(read_ranks(RANKS))
    assert decode(np.zeros(0, np.uint32)) == b""


def test_hilbert_neighbours_touch():
    side = np.arange(8)
    grid = np.stack(np.meshgrid(side, side, side, indexing="ij"), axis=-1).reshape(-1, 3)
    keys = hilbert_keys(grid, 3)
    assert sorted(keys.tolist()) == list(range(512))
    path = grid[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def check_packing(rows, result, encode, length):
    pieces = [tuple(r) for r in result.collect()]
    sequences = defaultdict(list)
    for doc_id, start, size, crc, total, sequence, offset in pieces:
        sequences[sequence].append((offset, size))
        assert 0 < size <= length
    assert sorted(sequences) == list(range(len(sequences)))
    for number, parts in sequences.items():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at == length or number == len(sequences) - 1
    want = defaultdict(int)
    for doc_id, text in rows:
        want[(doc_id, tuple([*encode(text or ""), 1]))] += 1
    by_document = defaultdict(list)
    for doc_id, start, size, crc, total, *_ in pieces:
        by_document[doc_id, total].append((start, size, crc))
    for (doc_id, ids), count in want.items():
        found = by_document[doc_id, len(ids)]
        for start, size, crc in found:
            if count == 1:
                raw = np.array(ids[start : start + size], "<u4").tobytes()
                assert zlib.crc32(raw) == crc
        assert sum(size for _, size, _ in found) % len(ids) == 0
    assert sum(p[2] for p in pieces) == sum(len(k[1]) * n for k, n in want.items())


def test_packing_of_every_case(documents, library):
    rows = [case for case in CASES if case[0] != 5] + [(5, "once"), (21, "once")]
    for length in (2048, 7):
        if length == 7:
            rows = [case for case in rows if len(case[1] or "") < 1_000]
        check_packing(rows, pack_documents(documents(rows), length=length), library, length)
    assert pack_documents(documents([])).collect() == []


def test_packing_of_given_documents(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check_packing(rows, pack_documents(docs), library, 2048)


def test_ranges_are_even_in_ids(spark, settings):
    """Long texts whose places lie close together are spread over ranges."""
    rows = spark.range(4000).select(
        F.col("id").alias("place"),
        F.when(F.col("id").between(1000, 1099), 1000).otherwise(1).alias("weight"),
    )
    bounds = range_bounds(rows, "place", 8, F.col("weight"))
    assert len(bounds) == 7
    cut = rows.groupBy(range_of(F.col("place"), bounds)).agg(F.sum("weight").alias("size"))
    assert max(row["size"] for row in cut.collect()) < 1.4 * (100 * 1000 + 3900) / 8
    assert range_bounds(rows.limit(0), "place", 8, F.col("weight")) == []
    with settings({"spark.sql.shuffle.partitions": "4"}):
        assert ranges_for(spark, 0) == ranges_for(spark, 4 * common.RANGE_BYTES) == 4
        assert ranges_for(spark, 9 * common.RANGE_BYTES + 1) == 10
        assert ranges_for(spark, 1 << 60) == common.MOST_RANGES


def test_copies_lie_together(documents):
    rows = [(i, f"text {i % 3} " + "same words here " * 5 * (1 + i % 3)) for i in range(60)]
    found = pack_documents(documents(rows), length=64).orderBy("sequence_id", "offset").collect()
    order = [r.doc_id % 3 for r in found if r.start == 0]
    assert sum(a != b for a, b in zip(order, order[1:])) == 2
