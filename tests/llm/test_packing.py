import bisect
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rinkstat.llm import packing

from .data import documents, frame

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        i = bisect.bisect_left(rooms, n)
        room = rooms.pop(i) if i < len(rooms) else capacity
        bisect.insort(rooms, room - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(40))
def test_plan_equals_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 37, 100, 2048])
    lengths = [min(capacity, max(1, int(rng.expovariate(3 / capacity)))) for _ in range(rng.randint(1, 400))]
    used, seen = {}, Counter()
    for n, first, last, sequence, each, offset in packing.plan_best_fit(dict(Counter(lengths)), capacity):
        for r in range(first, last):
            used.setdefault(sequence + (r - first) // each, []).append((offset + (r - first) % each * n, n))
            seen[n] += 1
    assert seen == Counter(lengths)
    assert len(used) == best_fit(lengths, capacity)
    for places in used.values():
        end = 0
        for at, n in sorted(places):
            assert at == end
            end += n
        assert end <= capacity


def test_word_ids_equal_the_tokenizer():
    rng = random.Random(2)
    alphabet = "abzABZéÉñÑßüÜÿÀ×÷ .,!'’-_#12٣ªºµ\t\nſKΣσ́  \x1c|<>"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["<|endoftext|> <|startoftext|>x", "don't we'LL", "İstanbul ǅ", "한국 日本語　語", "", " "]
    known = packing.WordIds(PATH)
    for _ in range(2):
        ids, places = known.encode([t.encode() for t in texts])
        for i, t in enumerate(texts):
            assert list(ids[places[i] : places[i + 1]]) == TOKENIZER.encode(t, add_special_tokens=False).ids, t


def test_small_cache(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 3)
    known = packing.WordIds(PATH)
    for t in ("a b c", "d e f g h", "a h", "a b c d e"):
        ids, _ = known.encode([t.encode()])
        assert list(ids) == TOKENIZER.encode(t, add_special_tokens=False).ids


def test_packing_of_documents(spark):
    rows = [*documents(), (1000, "word " * 5000, None, None, 0), (None, "null id", None, None, 0)]
    docs = frame(spark, rows).withColumn("piece", F.lit("clash"))
    pieces = packing.token_pieces(docs, PATH, capacity=64)
    got = packing.pack(pieces, capacity=64).collect()
    want = {}
    for d, text, *_ in rows:
        ids = np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for p, s in enumerate(range(0, len(ids), 64)):
            want[d, p] = (s, len(ids[s : s + 64]), zlib.crc32(ids[s : s + 64].tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want
    assert len(got) == len(want)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        end = 0
        for at, n in sorted(places):
            assert at == end
            end += n
        assert end <= 64
    assert len(by) == best_fit([v[1] for v in want.values()], 64)


def test_empty_table(spark):
    assert packing.pack(packing.token_pieces(frame(spark, []), PATH)).count() == 0
