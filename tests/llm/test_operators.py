"""Each operator against a brute-force version on small awkward tables, and on the given ones."""

import base64
import hashlib
import io
import math
import os
import re
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plantlake.llm import (
    char_language, common, content_chunks, deleted_interpolation, fold_bpe, framed_ids, heap_bpe, lsh_forest, substring_levels, warc, winnowing)
from plantlake.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 97} t{i}" for i in range(6000))
ROWS = [(0, "The cat sat on the mat and looked at the dog by the door of the old house again."),
        (1, "Prefix words. The cat sat on the mat and looked at the dog by the door of the old house again."),
        (1, "Prefix words. The cat sat on the mat and looked at the dog by the door of the old house again."),
        (2, None), (3, ""), (None, "no id here but cat"), (4, "one"), (5, "  \n\t "), (6, LONG), (7, LONG + " tail"), (8, "x" * 300 + " <|endoftext|> é日本　don't  A1b2"),
        (9, "ONE"), (10, "naïve café — 12,5 % it's\r\n\r\nnew")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if k % 2 else "fr", 1, "z") for k, (i, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score int, n_words string").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("doc_id > 1000")


def words(text, lower):
    text = text or ""
    if lower:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(r"[^\x20\x09-\x0D]+", text)


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    import check
    assert check.compare(spark, check.oracle(SF), SF, name) is None


def test_names():
    assert [re.match(r"op(\d+)_", n)[1] for n in QUERIES if n != "pipeline"] == [str(i) for i in range(1, 14)]


def test_counts(docs, empty):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = heap_bpe.token_counts(docs, P.path("byte_bpe_50k.json"), P.PATTERN)
    want = sorted(((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in ROWS), key=str)
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got.collect()), key=str) == want
    assert heap_bpe.token_counts(empty, P.path("byte_bpe_50k.json"), P.PATTERN).count() == 0


def test_fold(spark, docs, empty):
    import tiktoken
    path = P.path("byte_bpe_multi_50k.tiktoken")
    coder = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=fold_bpe.load_ranks(path), special_tokens={})
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for frame, rows in ((docs, ROWS), (spark.createDataFrame(given, "doc_id long, text string"), given)):
        got = fold_bpe.round_trip(frame, path, P.PATTERN).collect()
        want = sorted(((i, hashlib.sha256(np.array(coder.encode_ordinary(t or ""), "<u4").tobytes()).hexdigest(),
                        hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows), key=str)
        assert sorted(((r.doc_id, r.ids_sha256, r.decoded_sha256) for r in got), key=str) == want
    assert fold_bpe.round_trip(empty, path, P.PATTERN).count() == 0


def test_framed(docs, empty, tmp_path, monkeypatch):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    monkeypatch.setattr(framed_ids, "FRAME_IDS", 50)
    folder = str(tmp_path / "ids")
    manifest = framed_ids.write_ids(docs.where("doc_id <> 1"), folder, P.path("byte_bpe_50k.json"), files=3)
    got = framed_ids.read_ids(manifest, folder).collect()
    at = 0
    for i, t in sorted((x for x in ROWS if x[0] not in (None, 1))):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        assert [(r.start, r.n_tokens, r.ids_crc32) for r in got if r.doc_id == i] == [(at, len(ids), zlib.crc32(ids.tobytes()))]
        at += len(ids)
    names = [r.name for r in manifest.collect()]
    found = [x for n in names for x in framed_ids.FrameReader(folder, n).documents([4, 9])]
    assert sorted(d for d, _ in found) == [4, 9]
    assert framed_ids.framed_ids(empty, P.path("byte_bpe_50k.json")).count() == 0


def test_chunks(docs, empty):
    got = {r.doc_id: r for r in content_chunks.fingerprints(docs.dropDuplicates(["doc_id"]), parts=3).collect()}
    rows = sorted({i: t or "" for i, t in ROWS}.items(), key=lambda x: -1 if x[0] is None else x[0])
    for (i, t), (_, following) in zip(rows, rows[1:] + rows[:1]):
        cut = len(t) // 4
        assert got[i].n_chars == len(t)
        assert got[i].edited_sha256 == hashlib.sha256((t[:len(t) - cut] + following[:cut]).encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    assert got[2].fingerprint == got[3].fingerprint == "" and got[6].near_next > 0.9 and got[6].near_edited > 0.6
    moved = content_chunks.chunk_sets([LONG.encode(), ("some more words " + LONG).encode()])
    assert content_chunks.likeness(*moved) > 0.95
    assert content_chunks.fingerprints(empty).count() == 0


def test_warc(spark, tmp_path):
    noise = np.random.default_rng(0).integers(0, 256, 5000, dtype=np.uint8).tobytes().decode("latin-1")
    rows = [(1, "http://a/\r\nb", "same"), (2, None, "same"), (3, "u", "same"), (4, "u", None), (5, "u", ""), (None, "u", "same"), (6, "u", noise), (6, "u", noise + "\r\n\r\nx")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, refers_to int")
    for span in (1 << 20, 64):
        folder = str(tmp_path / f"w{span}")
        manifest = warc.write_archives(pages, folder, file_bytes=400)
        got = warc.read_archives(manifest, folder, range_bytes=span).collect()
        want = []
        for i, _, h in rows:
            payload = (h or "").encode()
            top = max(j for j, _, g in rows if j is not None and (g or "").encode() == payload)
            want.append((i, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "response" if i == top else "revisit", None if i == top else top))
        assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == sorted(want, key=str)
    assert warc.round_trip(spark, pages.where("page_id > 99")).count() == 0


def test_damaged_archives(spark, tmp_path):
    """A flipped byte in any record, a cut file and a missing one are errors, whatever the ranges; bytes behind the stated size are not read."""
    members = [warc.member(i, "u", f"page {i} ".encode() * 90, None) for i in range(5)]
    whole = b"".join(members)
    edges = np.cumsum([0, *map(len, members)]).tolist()

    def read(data, span):
        return [int(h["X-Page-ID"]) for a in range(0, len(whole), span) for h, _ in warc.records(io.BytesIO(data), len(whole), a, min(len(whole), a + span))]

    for span in (1 << 20, 4096, 200, 64, 1, edges[1], edges[2]):
        assert read(whole, span) == list(range(5)) == read(whole + b"more", span)
        for a, b in zip(edges, edges[1:]):
            for at in (a, a + 20, (a + b) // 2, b - 6):
                with pytest.raises(ValueError, match="no whole record"):
                    read(whole[:at] + bytes([whole[at] ^ 0x55]) + whole[at + 1:], span)
        for length in (0, 10, edges[2], len(whole) - 20, len(whole) - 1):
            with pytest.raises(ValueError, match="no whole record"):
                read(whole[:length], span)

    folder = str(tmp_path / "w")
    pages = spark.createDataFrame([(i, "u", f"page {i}") for i in range(6)], "page_id long, url string, html string")
    manifest = warc.write_archives(pages, folder, file_bytes=400)
    again = warc.write_archives(pages, folder, file_bytes=400)  # another attempt leaves the files of the first alone
    names = [r.name for r in manifest.collect()]
    assert not set(names) & {r.name for r in again.collect()}
    assert warc.read_archives(manifest, folder).count() == 6 == manifest.agg({"n_records": "sum"}).first()[0]
    os.rename(f"{folder}/{names[0]}", f"{folder}/gone")
    with pytest.raises(Exception, match="FileNotFoundError|No such file"):
        warc.read_archives(manifest, folder).collect()
    with pytest.raises(ValueError, match="tasks cannot write"):
        warc.write_archives(pages, "dbfs://archives/a")


@pytest.mark.parametrize("length, base", [(13, 7), (13, 3), (5, 7), (4, 1)])
def test_substrings(docs, empty, length, base):
    first = {}
    for i, t in ROWS:
        w = words(t, False)
        for k in range(len(w) - length + 1 if i is not None else 0):
            first[tuple(w[k:k + length])] = min(i, first.get(tuple(w[k:k + length]), i))
    want = []
    for i, t in ROWS:
        w = words(t, False)
        gone = {k + o for k in range(len(w) - length + 1 if i is not None else 0) if first[tuple(w[k:k + length])] < i for o in range(length)}
        want.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
    got = substring_levels.deduplicated(docs, length, base).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == sorted(want, key=str)
    assert all(r.text == dict(ROWS)[r.doc_id] for r in got if not r.n_removed)
    assert substring_levels.deduplicated(empty, length, base).count() == 0


@pytest.mark.parametrize("length", [13, 50])
def test_substrings_of_short_shards(spark, length):
    """Partitions of one document of a few words."""
    rows = [(n, " ".join(f"{n}w{k}" for k in range(n))) for n in range(1, 8)]
    frame = spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), "doc_id long, text string")
    got = substring_levels.deduplicated(frame, length).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.text) for r in got) == [(n, n, 0, t) for n, t in rows]


def test_winnowing(spark, docs, empty):
    marked = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    items = [(1, "sat on THE mat, and looked at the dog by the door!"), (2, "one"), (12, "One"), (3, None), (4, "..."), (None, "café — 12 5"), (5, LONG), (6, "the cat")]
    frame = spark.createDataFrame([(*x, 3) for x in items], "item_id long, text string, n_hit int")
    want = []
    for i, t in ROWS:
        w, hit, ids = marked(t), set(), []
        for item, text in items:
            v = marked(text)
            n = min(10, len(v))
            windows = {tuple(v[k:k + n]) for k in range(len(v) - n + 1)} if n else set()
            at = [k for k in range(len(w) - n + 1) if tuple(w[k:k + n]) in windows] if n else []
            hit |= {k + o for k in at for o in range(n)}
            ids += [item] if at else []
        named = sorted(str(x) for x in ids if x is not None)
        want.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(named).encode()).hexdigest(), bool(hit)))
    got = winnowing.contamination(docs, frame).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)
    assert winnowing.contamination(empty, frame).count() == 0
    assert not any(r.contaminated for r in winnowing.contamination(docs, frame.where("item_id > 99")).collect())


def test_winnowing_shared_phrase(spark, monkeypatch):
    """A phrase in all items and documents costs rows in proportion to their sum."""
    phrase = " ".join(f"p{i}" for i in range(15))
    stored = {}

    def counted(df, label):
        out = common.written(df, label)
        stored[label] = max(stored.get(label, 0), out.count())
        return out

    monkeypatch.setattr(winnowing, "written", counted)
    n = 60
    docs = spark.createDataFrame([(i, f"d{i} {phrase} e{i}") for i in range(n)], "doc_id long, text string")
    items = spark.createDataFrame([(i, f"a{i} {phrase} b{i}") for i in range(n)], "item_id long, text string")
    digest = hashlib.sha256(",".join(sorted(map(str, range(n)))).encode()).hexdigest()
    got = winnowing.contamination(docs, items).collect()
    assert [tuple(r) for r in sorted(got)] == [(i, 17, 15, n, digest, True) for i in range(n)]
    assert max(stored.values()) <= 8 * n, stored


def brute_components(rows, size, percent):
    sets = {}
    for i, t in rows:
        w = words(t, True)
        sets.setdefault(i, []).append({tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set()))
    root = {i: i for i in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(root)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_forest(spark, docs, empty, monkeypatch):
    got = lsh_forest.near_duplicates(docs, size=2).collect()
    want = brute_components(ROWS, 2, 80)
    assert all(r.component_id == want[r.doc_id] for r in got if r.doc_id is not None) and len(got) == len(ROWS)
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    assert lsh_forest.near_duplicates(empty).count() == 0
    # A large group around one text, in many blocks and crowded regions.
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        w = list(base)
        for k in rng.choice(60, rng.integers(0, 9), replace=False):
            w[k] = f"x{rng.integers(1 << 30)}"
        rows.append((i, " ".join(w)))
    for name, value in (("BLOCK", 16), ("HUBS", 3), ("REGION", 30)):
        monkeypatch.setattr(lsh_forest, name, value)
    got = lsh_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(rows, 2, 80)


def test_forest_crowds(spark, monkeypatch):
    """Crowds of one whole key and of one long prefix, both larger than REGION."""
    monkeypatch.setattr(lsh_forest, "REGION", 20)
    same = np.tile(np.arange(lsh_forest.TREES * lsh_forest.DEPTH, dtype=">u2"), (300, 1))
    same[150:, lsh_forest.DEPTH - 1::lsh_forest.DEPTH] = np.arange(1000, 1150)[:, None]
    classes = spark.createDataFrame([(i, x.tobytes()) for i, x in enumerate(same)], "rep long, sig binary")
    pairs = lsh_forest.candidates(classes)
    assert {(r.node, r.root) for r in lsh_forest.components(pairs).collect()} == {(i, 0) for i in range(300)}
    assert pairs.count() < 300 * 2 * lsh_forest.TREES
    base = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join([*base[:2 * i], f"x{i}", *base[2 * i + 1:]])) for i in range(120)]
    got = lsh_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(rows, 2, 80) == dict.fromkeys(range(120), 0)


def test_forest_unlike_crowd(spark, monkeypatch):
    """A large group of one template, nearly all unlike: classes go to other blocks by what they share, not all to all."""
    monkeypatch.setattr(lsh_forest, "BLOCK", 16)
    rng = np.random.default_rng(11)
    rows = []
    for i in range(200):
        w = [f"w{k}" for k in range(120)]
        for k in rng.choice(120, 8, replace=False):
            w[k] = f"x{rng.integers(1 << 30)}"
        rows.append((i, " ".join(w)))
    rows += [(200 + i, rows[i][1].replace("w60", f"y{i}")) for i in range(0, 200, 10)]
    sets = {i: np.unique(lsh_forest.shingle_sets([t.encode()], 2)[0]) for i, t in rows}
    blocks = {i: i * 7 % 17 for i in sets}
    several = spark.createDataFrame([(i, 0, blocks[i], s.tobytes()) for i, s in sets.items()], "rep long, g long, block int, grams binary")
    rooted = spark.createDataFrame([(i, 0, i, i > 0) for i in sets], "rep long, g long, root long, apart boolean")
    cells = {}
    for r in lsh_forest._meetings(several, rooted, 80).collect():
        cells.setdefault((r.slice, r.block), ([], []))[r.role == 0].append(r.rep)
    met = {frozenset((a, b)) for askers, asked in cells.values() for a in askers for b in asked}
    alike = {frozenset((a, b)) for a in sets for b in sets if a < b and blocks[a] != blocks[b]
             and 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))}
    assert len(alike) >= 15 and alike <= met
    assert sum(len(x) + len(y) for x, y in cells.values()) < 10 * len(sets)
    monkeypatch.setattr(lsh_forest, "AGREE", 1)
    got = lsh_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(rows, 2, 80)


def test_forest_shared_ids(spark, monkeypatch):
    """Doc ids on several texts, of which some have no words."""
    a, b, c = ([f"{x}{i}" for i in range(40)] for x in "abc")
    rows = [(5, " ".join(a)), (5, " ".join(b)), (9, " ".join([*a[:39], "y"])), (8, " ".join([*b[:39], "z"])), (7, " ".join(c)), (7, ""), (6, " ".join(c)),
            (4, None), (3, "alone here"), (3, None), (10, " ".join(a)), (10, " ".join(c))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute_components(rows, 2, 80)
    assert {(r.doc_id, r.component_id) for r in lsh_forest.near_duplicates(frame, size=2).collect()} == set(want.items())
    assert want[9] == want[8] == want[7] == 5
    several = frame.where("doc_id in (5, 8, 9)")
    assert {(r.doc_id, r.component_id) for r in lsh_forest.near_duplicates(several, size=2).collect()} == {(5, 5), (8, 5), (9, 5)}


def test_language(spark, docs, empty):
    got = QUERIES["op10_char_language"](spark, SF).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.9 * len(held) and all(0 <= r.score <= 1 for r in got)
    small = {(r.doc_id, r.lang_pred) for r in char_language.identified(docs.drop("score")).collect()}
    assert {(2, "und"), (3, "und"), (5, "und")} <= small
    assert char_language.identified(empty.drop("score")).count() == 0


def test_scores(spark, docs, empty):
    got = {r.doc_id: r for r in deleted_interpolation.scored(docs).collect()}
    counts, total = {}, 0
    for i, t in ROWS:
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            for w in [*words(t, True), None]:
                counts[w] = counts.get(w, 0) + 1
                total += 1
    for i, t in ROWS:
        tokens = [*words(t, True), None]
        base = sum(math.log10((counts.get(w, 0) + 0.1) / (total + 0.1 * (len(counts) + 1))) for w in tokens)
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(w in counts for w in tokens), total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    assert deleted_interpolation.scored(empty).count() == 0
    rows = deleted_interpolation.scored(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    assert sum(r.score for r in rows if r.held_out) > sum(r.base_score for r in rows if r.held_out)


def test_pipeline(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF).collect()
    kept = {r.doc_id for r in out}
    near = brute_components([(r.doc_id, r.text) for r in docs.collect()], 5, 80)
    assert kept and all(near[i] == i for i in kept)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.where("doc_id < 0"), SF).columns == docs.columns, name


def test_pipeline_decisions_by_row(spark, tmp_path):
    """Null ids, and ids on several texts, through the stages that drop rows."""
    import corpus_pipeline
    item = "one two three four five six seven eight nine ten eleven"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    other = " ".join(f"v{i}" for i in range(30))
    rows = [(None, f"see {item} here"), (None, "clean text"), (3, f"also {item}"), (3, "clean on the same id"), (4, None), (None, None), (1, other), (2, other), (2, "unique text on the id of a copy")]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = lambda f: sorted(((r.doc_id, r.text) for r in f.collect()), key=str)
    assert left(corpus_pipeline.decontaminated(spark, frame, str(tmp_path))) == sorted([x for x in rows if item not in (x[1] or "")], key=str)
    assert left(corpus_pipeline.near_duplicates(spark, frame, str(tmp_path))) == sorted([x for x in rows if x != (2, other)], key=str)
    # Of repeated rows one stays, the one with the smallest other columns.
    again = frame.unionByName(frame.withColumn("lang", F.lit("da"))).unionByName(frame)
    kept = corpus_pipeline.near_duplicates(spark, again, str(tmp_path))
    assert left(kept) == sorted([x for x in rows if x != (2, other)], key=str) and {r.lang for r in kept.collect()} == {"da"}


def test_pipeline_rows_of_each_stage(spark, tmp_path):
    """Kept rows and texts of the stages against brute force, with and without labels."""
    import corpus_pipeline
    import tiktoken
    given = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*corpus_pipeline.COLUMNS).collect()]
    copied = " ".join(f"r{i}" for i in range(70))
    rows = [*given, (9001, None, "en", "s", 0), (9002, "12 34 !", "en", "s", 7), (None, "no id here", None, "s", 10), (9003, f"a start {copied} and end", "en", "s", 0), (9004, f"other opening {copied}", "en", "s", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    left = lambda f: sorted(((r.doc_id, r.text) for r in f.collect()), key=str)
    lettered = sorted(((i, t) for i, t, *_ in rows if any(c.isalpha() for c in t or "")), key=str)
    assert left(corpus_pipeline.language(spark, frame, SF)) == lettered
    assert left(corpus_pipeline.language(spark, frame.drop("lang").selectExpr("doc_id", "text", "string(null) AS lang", "source", "n_chars"), SF)) == lettered

    # A missing language is filled where the classifier is sure; given ones stay.
    hidden = frame.withColumn("lang", F.when(F.col("doc_id") % 5 != 0, F.col("lang")))
    model = {r.doc_id: r for r in char_language.identified(hidden).collect()}
    filled = {r.doc_id: r.lang for r in corpus_pipeline.language(spark, hidden, SF).collect()}
    gaps = [(i, lang) for i, t, lang, *_ in rows if i is not None and i % 5 == 0 and i in filled]
    assert all(filled[i] == (model[i].lang_pred if model[i].score >= corpus_pipeline.FILL_FROM else None) for i, _ in gaps)
    assert sum(filled[i] == lang for i, lang in gaps) > 0.5 * len(gaps) and all(filled[i] in (lang, None) for i, lang in gaps)
    assert all(filled[i] == lang for i, _, lang, *_ in rows if i is not None and i in filled and i % 5)

    first, want = {}, []
    for i, t, *_ in rows:
        w = words(t, False)
        for k in range(len(w) - 49 if i is not None else 0):
            first[tuple(w[k:k + 50])] = min(i, first.get(tuple(w[k:k + 50]), i))
    for i, t, *_ in rows:
        w = words(t, False)
        gone = {k + o for k in range(len(w) - 49 if i is not None else 0) if first[tuple(w[k:k + 50])] < i for o in range(50)}
        if not gone or len(gone) < len(w):
            want.append((i, " ".join(x for k, x in enumerate(w) if k not in gone) if gone else t))
    assert (9004, "other opening") in want
    assert left(corpus_pipeline.substrings(spark, frame, SF)) == sorted(want, key=str)

    marked = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        v = marked(r.text)
        n = min(10, len(v))
        windows |= {tuple(v[k:k + n]) for k in range(len(v) - n + 1)} if n else set()
    sizes = {len(x) for x in windows}
    clean = lambda t: (w := marked(t), not any(tuple(w[k:k + n]) in windows for n in sizes for k in range(len(w) - n + 1)))[1]
    assert left(corpus_pipeline.decontaminated(spark, frame, SF)) == sorted(((i, t) for i, t, *_ in rows if clean(t)), key=str)

    coder = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=fold_bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    got = sorted(((r.doc_id, bytes(r.ids)) for r in corpus_pipeline.encoded(spark, frame, SF).collect()), key=str)
    assert got == sorted(((i, np.array(coder.encode_ordinary(t or ""), "<u4").tobytes()) for i, t, *_ in rows), key=str)


def test_recognised():
    model = char_language.Model(["a", "b", "c", "d"], None, None, 1.0)
    assert not model.recognised("text", 0.32, 0.1) and model.recognised("text", 0.33, 0.1) and not model.recognised("12", 0.9, 0.1)
    assert char_language.Model([], None, None, 1.0).recognised("text", 0.0, 0.1) and char_language.Model(["a"], None, None, 1.0).recognised("text", 1.0, 0.1)


def test_steps_hold_one_step_of_texts(monkeypatch):
    asked, real = [], common.strings
    monkeypatch.setattr(common, "strings", lambda column: asked.append(len(column)) or real(column))
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(["ab", None, "", "cdef", "g", "é" * 9, "h"])], names=["id", "text"])
    got = [(b.column(0).to_pylist(), t) for b, t in common.steps([batch, batch.slice(0, 0), batch.slice(5)], 4)]
    assert got == [([0, 1, 2, 3], [b"ab", b"", b"", b"cdef"]), ([4, 5], [b"g", "é".encode() * 9]), ([6], [b"h"]), ([5], ["é".encode() * 9]), ([6], [b"h"])]
    assert asked == [len(t) for _, t in got]  # never the whole batch


def test_language_sends_texts_once_and_in_slices(spark, docs, monkeypatch):
    keep = ("text", "lang")
    plain = sorted(map(repr, char_language.identified(docs, keep=keep).collect()))
    slim = char_language.identified(docs, keep=keep)
    assert "__text" not in slim._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(char_language, "ROWS", 2)
    model = char_language.Model(["en", "fr"], np.ones(char_language.FEATURES), np.zeros((char_language.FEATURES + 1, 2)), 1.0)
    found = char_language.predict(docs.select("doc_id", "text").coalesce(1), model)
    assert found.count() == len(ROWS) and {r.lang_pred for r in found.collect()} <= {"en", "und"}
    assert sorted(map(repr, char_language.identified(docs, keep=keep).collect())) == plain
    assert char_language.identified(docs).columns == ["doc_id", "held_out", "lang_pred", "score"]
