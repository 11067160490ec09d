import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from rinkstat.llm import merkle
from rinkstat.llm.queries import QUERIES

from .data import documents, frame


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(row, lower=False):
    doc_id, text, lang, source, n_chars = row
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return H(*map(field, (doc_id, source, lang, n_chars, text)))


def tree(leaves, arity):
    """The last node, and the path ``[(left, right), ...]`` of every leaf."""
    nodes, at, paths = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(nodes) > 1:
        for i, path in enumerate(paths):
            run = nodes[at[i] // arity * arity : at[i] // arity * arity + arity]
            path.append(("".join(run[: at[i] % arity]), "".join(run[at[i] % arity + 1 :])))
            at[i] //= arity
        nodes = [H(*nodes[i : i + arity]) for i in range(0, len(nodes), arity)]
    return nodes[0], paths


def brute(rows, arity=8):
    low = lambda v: (v is not None, v)  # noqa: E731  NULL first
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    subs, found = [], []
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (low(r[0]), leaf_of(r)))
        sub, paths = tree([leaf_of(r) for r in own], arity)
        subs.append(sub)
        found.append((own, sub, paths))
    root, tops = tree(subs, arity)
    out = []
    for (own, sub, paths), top in zip(found, tops, strict=True):
        for r, path in zip(own, paths, strict=True):
            path = path + top
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            h = leaf_of(r, hit)
            for left, right in path:
                h = H(left, h, right)
            out.append((r[0], leaf_of(r), sub, root, H(*[x for s in path for x in s]), h, h == root))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect()), key=repr)


def proofs(df, arity=8):
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    got = merkle.manifest(df, merkle.leaf(*fields, F.col("text")), F.when(hit, merkle.leaf(*fields, lowered)), arity=arity)
    return got.withColumn("proof_sha256", merkle.proof_sha256(F.col("path")))


def in_languages(rows, langs):
    return [(d, t, langs[i % len(langs)], s, n) for i, (d, t, _, s, n) in enumerate(rows)]


@pytest.mark.parametrize("langs", [["en"], [None, "", "de", "é", "en"], [f"l{i}" for i in range(70)], ["en"] * 40 + ["x"]])
def test_equals_brute_force(spark, langs):
    rows = in_languages(documents(n=120), langs)
    df = frame(spark, rows).withColumns({"tree": F.lit(1), "hash": F.lit("clash"), "_tie": F.lit(0), "root": F.lit("r")})
    assert result(proofs(df.repartition(5))) == brute(rows)


def test_narrow_tree(spark):
    rows = in_languages(documents(n=90), ["a", "b", "b"])
    assert result(proofs(frame(spark, rows), arity=2)) == brute(rows, arity=2)


def test_nulls_ties_and_repeated_rows(spark):
    rows = in_languages(documents(n=20), ["a", None])
    rows += [(None, None, None, None, None), (None, "x", "a", None, 1), (None, "x", "a", None, 1), (9, "Tie", "a", "s", 3), (9, "tie", "a", "s", 3)]
    rows += [(77, "Same row", "a", "s", 8)] * 50
    got = result(proofs(frame(spark, rows).repartition(7)))
    assert got == brute(rows)
    assert {r[6] for r in got} == {True, False}


def test_empty_and_lone(spark):
    assert proofs(frame(spark, [])).count() == 0
    rows = documents()[3:4]
    assert result(proofs(frame(spark, rows))) == brute(rows)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert result(QUERIES["op12_merkle_manifest"](spark, sf)) == brute(rows)
