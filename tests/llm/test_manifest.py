"""Merkle manifest against a plain tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from plantlake.llm import merkle_manifest
from plantlake.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, key int"


def digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def reduced(nodes):
    """Root, and for each node the digests around its path."""
    paths = [[] for _ in nodes]
    level = [(h, [i]) for i, h in enumerate(nodes)]
    while len(level) > 1:
        above = []
        for k in range(0, len(level), 8):
            run = level[k:k + 8]
            for j, (_, below) in enumerate(run):
                for i in below:
                    paths[i].append(("".join(h for h, _ in run[:j]), "".join(h for h, _ in run[j + 1:])))
            above.append((digest("".join(h for h, _ in run)), [i for _, below in run for i in below]))
        level = above
    return level[0][0], paths


def brute(rows):
    groups = {}
    for i, text, lang, source, n in rows:
        h = leaf((i, source, lang, n, text))
        other = h
        if i is not None and zlib.crc32(str(i).encode()) % 3 == 0 and text is not None:
            other = leaf((i, source, lang, n, "".join(c.lower() if "A" <= c <= "Z" else c for c in text)))
        groups.setdefault(lang, []).append((i is not None, i or 0, h, other))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for g in names:
        groups[g].sort()
    made = {g: reduced([h for _, _, h, _ in groups[g]]) for g in names}
    root, tops = reduced([made[g][0] for g in names])
    out = []
    for g, top in zip(names, tops):
        for (known, i, h, other), path in zip(groups[g], made[g][1]):
            again = other
            for a, b in path + top:
                again = digest(a + again + b)
            out.append((i if known else None, h, made[g][0], root, digest("".join(a + b for a, b in path + top)), again, again == root))
    return sorted(out, key=str)


def run(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x", 3) for r in rows], SCHEMA).repartition(5)
    lowered = F.translate(frame["text"], "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = merkle_manifest.manifest(frame, tampered={"text": lowered}, tampered_where=F.crc32(frame["doc_id"].cast("string").cast("binary")) % 3 == 0, **options)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in out.collect()), key=str)


ROWS = [(k, f"Text number {k} É" if k % 5 else None, ("en", "fr", "de")[min(k % 7, 2)], "s", k) for k in range(150)] + [
    (None, "No id", "en", None, None), (7, "Text number 7 É", "fr", "s", 7), (7, "another", "fr", "s", 7), (-4, "", None, "", 0), (900, "alone", "Ä", "s", 5),
    (901, "A" * 20_000, "", "s", 5), (3, "Text number 3 É", "de", "s", 3), (3, "Text number 3 É", "de", "s", 3)]


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_manifest(spark, levels):
    want = brute(ROWS)
    assert run(spark, ROWS, levels=levels) == want
    assert 0 < sum(not r[-1] for r in want) < len(want)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65])
def test_manifest_sizes(spark, n):
    rows = [(k, f"T{k}", "en", "s", 1) for k in range(n)]
    assert run(spark, rows, levels=1) == brute(rows)


def test_many_groups(spark):
    rows = [(k, f"T{k}", f"l{k % 83}", "s", 1) for k in range(200)]
    assert run(spark, rows, levels=1) == brute(rows)


def test_repeated_rows(spark):
    """One row makes most of the table; ranges cut between its copies."""
    rows = [(5, "Same", "en", "s", 1)] * 200 + [(k, "x", "en", "s", 1) for k in range(20)]
    assert run(spark, rows, levels=1) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == []


def test_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    assert sorted((tuple(r) for r in QUERIES["op13_merkle_manifest"](spark, "/root/testdata/sf0.001").collect()), key=str) == brute([tuple(r) for r in docs.collect()])
