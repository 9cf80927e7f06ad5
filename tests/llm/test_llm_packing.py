"""Packing: exact ids, gapless sequences, as few as best fit makes; awkward input."""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pytest

from tellerlake.llm import packing, tokens
from tellerlake.llm.queries import tokenizer_path

SIZE = 256


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def test_encoder_equals_tokenizer(tokenizer):
    encode, rng = tokens.make_encoder(tokenizer_path()), random.Random(1)
    alphabet = list("abcXYZ .,!?'09-|\n\t\r") + ["é", "É", "ß", "ñ", "́", " ", " ", "\x1c", "\x85", "中", "😀", "İ", "ﬁ", "²", "<|endoftext|>", "'re", "don't "]
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def best_fit_one_by_one(sizes, capacity):
    rooms = []
    for size in sorted(sizes, reverse=True):
        at = bisect_left(rooms, size)
        room = rooms.pop(at) if at < len(rooms) else capacity
        insort(rooms, room - size)
    return sorted(rooms)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(2)
    for capacity in (7, 64, 300):
        sizes = [rng.randint(1, capacity) for _ in range(800)]
        plan = packing.best_fit_plan({s: sizes.count(s) for s in set(sizes)}, capacity)
        used, at = defaultdict(int), 0
        for i, (size, rank, first, each, offset) in enumerate(plan):
            end = plan[i + 1][1] if i + 1 < len(plan) and plan[i + 1][0] == size else sizes.count(size)
            for k in range(end - rank):
                assert offset + k % each * size + size <= capacity
                used[first + k // each] += size
            at += end - rank
        assert at == len(sizes)
        assert sorted(capacity - u for u in used.values()) == best_fit_one_by_one(sizes, capacity)


def check(rows, texts, tokenizer):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for pieces in by_sequence.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= SIZE
    for doc, own in texts.items():
        wanted = sorted(
            (k // SIZE, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
            for text in own for ids in [ids_of(tokenizer, text)] for k in range(0, len(ids), SIZE) for part in [ids[k : k + SIZE]]
        )
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[doc]) == wanted


def test_packs_awkward_documents(awkward, no_docs, tokenizer):
    texts = defaultdict(list)
    for r in awkward.select("doc_id", "text").collect():
        texts[r.doc_id].append(r.text)
    rows = packing.pack(awkward, tokenizer_path(), SIZE).collect()
    check(rows, texts, tokenizer)
    sizes = [r.length for r in rows]
    assert len({r.sequence_id for r in rows}) == len(best_fit_one_by_one(sizes, SIZE))
    assert packing.pack(no_docs, tokenizer_path(), SIZE).collect() == []


def test_sequences_hold_the_documents(awkward, tokenizer):
    docs = awkward.filter("doc_id < 140 and doc_id not in (5, 7, 8, 9)")
    packed = packing.pack(docs, tokenizer_path(), SIZE, keep_ids=True)
    ids = defaultdict(dict)
    for s in packing.sequences(packed).collect():
        whole = np.frombuffer(bytes(s.ids), "<u4").tolist()
        assert len(whole) <= SIZE
        for p in s.places:
            ids[p.doc_id][p.piece] = whole[p.offset : p.offset + p.length]
    for r in docs.select("doc_id", "text").collect():
        assert sum((ids[r.doc_id][k] for k in sorted(ids[r.doc_id])), []) == ids_of(tokenizer, r.text)
