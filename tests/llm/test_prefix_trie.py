import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from rinkstat.llm import prefix_trie
from rinkstat.llm.queries import QUERIES

TURNS = "conv_id long, turns array<struct<id: binary, bytes: bigint>>"


def brute(strings):
    """Nodes of ``{conversation: [(name, bytes), ...]}``, every beginning looked at on its own."""
    members = {}
    for c, s in strings.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    children = {}
    for k in members:
        if k:
            children.setdefault(k[:-1], []).append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        own = children.get(k, [])
        leaves[k] = sum(leaves[x] for x in own) or 1
        saved[k] = (len(members[k]) - 1) * (k[-1][1] if k else 0) + sum(saved[x] for x in own)
    out = []
    for k, m in members.items():
        ends = sorted(c for c in m if len(strings[c]) == len(k))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        up = min(members[k[:-1]]) if k else None
        out.append((min(m), len(k), up, len(m), len(children.get(k, [])), leaves[k], saved[k], digest))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r[c.split()[0]] for c in prefix_trie.NODES.split(",")) for r in df.collect()), key=repr)


def strings(seed, n=60):
    """Short random strings, cuts of one long string, many copies and a string of no turns."""
    rng = random.Random(seed)
    turns = lambda k: [(bytes([rng.randrange(3)]) * 16,) for _ in range(k)]
    base, out = turns(40), {}
    for c in rng.sample(range(-50, 5000), n):
        s = turns(rng.randrange(9))
        out[c] = [(x, x[0] * 7) for (x,) in (base[: rng.randrange(41)] + s[:2] if rng.random() < 0.4 else s)]
    copy = next(s for s in out.values() if s)
    return out | {6000 + i: copy for i in range(30)} | {7000: []}


def frame(spark, given):
    rows = [(c, [{"id": bytearray(a), "bytes": b} for a, b in s]) for c, s in given.items()]
    return spark.createDataFrame(rows, TURNS)


@pytest.mark.parametrize(("seed", "limit"), [(1, 1), (2, 5), (3, 20), (4, 1000)])
def test_equals_brute_force(spark, seed, limit):
    given = strings(seed)
    df = frame(spark, given).withColumns({"path": F.lit("clash"), "len": F.lit(0)}).repartition(4)
    assert result(prefix_trie.trie_nodes(df, limit)) == brute(given)


def test_blocks_of_ids(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ID_BLOCK", 4)
    given = strings(5)
    assert result(prefix_trie.trie_nodes(frame(spark, given), 2)) == brute(given)


def test_no_conversation_and_no_turn(spark):
    assert prefix_trie.trie_nodes(spark.createDataFrame([], TURNS)).count() == 0
    assert result(prefix_trie.trie_nodes(frame(spark, {4: [], 2: []}))) == brute({4: [], 2: []})


def test_rounds_double(spark):
    """A long common beginning of an oversized container bursts in few rounds."""
    given = {c: [(bytes([i % 7]) * 16, 1) for i in range(200)] + [(bytes([c]) * 16, 2)] for c in range(12)}
    made = []
    stored, prefix_trie.stored = prefix_trie.stored, lambda df, label: (made.append(label), stored(df, label))[1]
    try:
        assert result(prefix_trie.trie_nodes(frame(spark, given), 10)) == brute(given)
    finally:
        prefix_trie.stored = stored
    assert made.count("burst-strings") <= 10


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn, role or "", text or ""))
    for c, turns in own.items():
        name = lambda t: hashlib.md5(f"{len(t[2].encode())}:{t[2]}{t[3]}".encode()).hexdigest()
        own[c] = [((t[2], t[3]), len(t[3].encode())) for t in sorted(turns, key=lambda t: (t[0], t[1] or 0, name(t)))]
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


SCHEMA = "conv_id long, turn long, role string, text string"


def test_rebuilt_conversations(spark):
    """NULL turns, roles and texts, ties and repeated rows, absent families, NULL ids left out."""
    rng = random.Random(2)
    rows = []
    for c in [*range(-6, 30), 41, 43]:
        rows += [(c, i, rng.choice(["user", None]), rng.choice(["Hi", "é", None, "a b"])) for i in range(rng.randrange(12))]
    rows += [(7, None, "user", "first"), (7, 2, "x", "tie"), (7, 2, "x", "tie"), (7, 2, "", "tie"), (None, 0, "user", "nobody")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit(1), "turns": F.lit("clash")})
    convs = prefix_trie.conversations(df.repartition(3))
    assert result(prefix_trie.trie_nodes(prefix_trie.grafted(convs))) == brute(rebuilt(rows))


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    assert result(QUERIES["op13_conversation_trie"](spark, sf)) == brute(rebuilt(rows))
