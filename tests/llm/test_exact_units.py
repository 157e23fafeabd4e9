"""Units are told apart by their bytes: words that a polynomial hash modulo 2^64 takes for equal, and forced collisions."""

import hashlib

import numpy as np
import public_tokenizers as P
import pytest

from plantlake.llm import common, fold_bpe, framed_ids, heap_bpe, lsh_forest, spans, substring_levels


def mirrored(a, b, n=2048):
    """A Thue-Morse word over two letters, and the same with the letters swapped."""
    bits = [bin(k).count("1") & 1 for k in range(n)]
    return "".join((a, b)[x] for x in bits), "".join((b, a)[x] for x in bits)


TEXTS = [*mirrored("t", "h"), *mirrored("i", "n", 512), *mirrored("e", "r"), " ".join(mirrored("t", "h")[::-1]), "plain words, 12", "plain words, 12 more"]


@pytest.fixture(params=[False, True])
def collide(request, monkeypatch):
    """With and without every span of like length having one hash."""
    if request.param:
        monkeypatch.setattr(spans, "span_hashes", lambda buf, starts, ends, seed=0: (ends - starts).astype(np.uint64) % np.uint64(3))


def test_words_have_hashes_of_their_own():
    for letters in ("th", "in", "er"):
        for seed in (0, 1):
            buf, starts, ends, _ = spans.words([w.encode() for w in mirrored(*letters)], False)
            assert len(set(spans.span_hashes(buf, starts, ends, seed).tolist())) == 2


def test_hash_does_not_depend_on_the_place(monkeypatch):
    texts = [b"x " * 40, b"some words some words " + b"y" * 700 + b" some"] * 3
    buf, starts, ends, _ = spans.words(texts, False)
    whole = spans.span_hashes(buf, starts, ends)
    monkeypatch.setattr(spans, "_BLOCK", 64)
    monkeypatch.setattr(spans, "_POWERS", {})
    assert np.array_equal(whole, spans.span_hashes(buf, starts, ends))
    names = [bytes(buf[a:b]) for a, b in zip(starts, ends)]
    assert len(set(names)) == len(set(whole.tolist())) == len(set(zip(names, whole.tolist())))


@pytest.mark.parametrize("long", [4096, 20])
def test_differing(monkeypatch, long):
    monkeypatch.setattr(spans, "_LONG", long)
    rng = np.random.default_rng(0)
    words = [bytes(rng.integers(97, 99, rng.integers(1, 40), dtype=np.uint8)) for _ in range(3000)] + [b"a" * 33 + b"b", b"a" * 34, b"b" + b"a" * 33]
    buf, starts, ends, _ = spans.words([b" ".join(words)], False)
    other = rng.integers(0, len(words), len(words))
    assert spans.differing(buf, starts, ends, other).tolist() == [i for i, j in enumerate(other) if words[i] != words[j]]
    at, each = spans.exact_distinct(buf, starts, ends)
    assert len(at) == len(set(words)) and all(words[at[k]] == words[i] for i, k in enumerate(each))


def test_counts_and_ids(collide):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    with open(P.path("byte_bpe_50k.json"), "rb") as file:
        data = file.read()
    want = [library.encode(t, add_special_tokens=False).ids for t in TEXTS]
    raw = [t.encode() for t in TEXTS]
    assert heap_bpe.count_step(raw, heap_bpe.Vocabulary(data, P.PATTERN)).tolist() == [len(w) for w in want]
    encoder = framed_ids.Encoder(data)
    for _ in range(2):
        assert [x.tolist() for x in encoder(raw)] == want
    for text, ids in zip(raw, want):  # one after the other, with what the worker has kept
        assert encoder([text])[0].tolist() == ids


def test_fold(spark, monkeypatch):
    import tiktoken
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = fold_bpe.load_ranks(path)
    coder = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [t[:300] for t in TEXTS]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.ids_sha256, r.decoded_sha256) for r in fold_bpe.round_trip(frame, path, P.PATTERN).collect()}
    assert got == {i: (hashlib.sha256(np.array(coder.encode_ordinary(t), "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
                   for i, t in enumerate(texts)}


def test_windows_and_sets(spark):
    """Texts of mirrored words are no copies of each other."""
    a, b = mirrored("t", "h")
    rows = [(1, " ".join([a] * 20)), (2, " ".join([b] * 20)), (3, " ".join([a] * 20))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in substring_levels.deduplicated(frame).collect()} == {1: 0, 2: 0, 3: 20}
    assert {r.doc_id: r.component_id for r in lsh_forest.near_duplicates(frame, size=2).collect()} == {1: 1, 2: 2, 3: 1}


def test_only_long_spans_are_hashed(monkeypatch):
    """Spans of up to 16 bytes are told apart by their first and last eight bytes."""
    words = [b"a", b"a\0", b"", b"12345678", b"123456789", b"1234567890abcdef", b"1234567890Abcdef", b"12345678-long-12345678", b"12345678+long+12345678"] * 2
    sizes = np.array([len(w) for w in words])
    ends = np.cumsum(sizes)
    hashed, real = [], spans.span_hashes
    monkeypatch.setattr(spans, "span_hashes", lambda buf, starts, ends, seed=0: hashed.extend((ends - starts).tolist()) or real(buf, starts, ends, seed))
    at, each = spans.exact_distinct(np.frombuffer(b"".join(words), np.uint8), ends - sizes, ends)
    assert len(at) == 9 and [words[at[k]] for k in each] == words
    assert hashed == [22] * 4


def test_words_of_many_shards_are_folded_once(spark, monkeypatch):
    """The fold gets a word once however many shards have it, in rows of few words, and every shard gets its ids back."""
    import tiktoken
    import pyarrow as pa
    import regex
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = fold_bpe.load_ranks(path)
    monkeypatch.setattr(fold_bpe, "FOLD_ROW", 8)
    texts = [f"qzxv{k % 40} wvut{k % 30}é " + "字" * 30 for k in range(200)]
    place, rows = {b" ": 0}, []
    for k in range(0, 200, 50):
        some = [t.encode() for t in texts[k:k + 50]]
        _, own = fold_bpe._shard(pa.RecordBatch.from_arrays([pa.array(range(50))], names=["k0"]), some, regex.compile(P.PATTERN), place, 3)
        rows += [{"shard": str(k), **r} for r in own.to_pylist()]
    folded, numbered = [], 0
    for bucket in range(3):
        own = [r for r in rows if r["bucket"] == bucket]
        out = fold_bpe._distinct(pa.RecordBatch.from_pylist(own, pa.schema([("shard", pa.string()), ("bucket", pa.int32()), ("sizes", pa.binary()), ("letters", pa.binary())])), fold_bpe.RankPairs(ranks))
        assert all(len(r["words"]) <= 8 for r in out.to_pylist())
        folded += [w for r in out.to_pylist() for w in r["words"] if w is not None]
        numbered += sum(len(common.unpacked(r["each"], np.int32)) for r in out.to_pylist() if r["shards"])
    assert sorted(folded) == sorted({w.encode().decode("latin-1") for t in texts for w in regex.findall(P.PATTERN, t) if len(w.encode()) <= fold_bpe.FOLD_BYTES and w != " "})
    assert numbered > 2 * len(folded)

    monkeypatch.setattr(fold_bpe, "SHARD", 400)
    monkeypatch.setattr(fold_bpe, "SEED_WORDS", 3)
    given = [*enumerate(texts), (7, texts[7]), (None, "null id"), (500, None), (501, "")]
    frame = spark.createDataFrame(given, "doc_id long, text string").coalesce(2)
    coder = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = sorted(((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in fold_bpe.round_trip(frame, path, P.PATTERN).collect()), key=str)
    assert got == sorted(((i, np.array(coder.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in given), key=str)


def test_words_folded_ahead_are_not_cut(monkeypatch):
    """A unit that is a word folded ahead gets its number without the pattern; others are cut once per shard."""
    import pyarrow as pa
    import regex

    class Counted:
        def __init__(self):
            self.real, self.seen = regex.compile(P.PATTERN), []

        def findall(self, text):
            self.seen.append(text)
            return self.real.findall(text)

    texts = [b"Plain words, 12  and odd99 words", b"", "Plain é 字 words".encode(), b"words"] * 3
    place = {w: i for i, w in enumerate([b"Plain", b" words", b",", b" and"])}
    monkeypatch.setattr(fold_bpe, "PIECE", 30)
    pattern = Counted()
    file, rows = fold_bpe._shard(pa.RecordBatch.from_arrays([pa.array(range(len(texts)))], names=["k0"]), texts, pattern, place, 3)
    assert not {x.encode() for x in pattern.seen} & set(place)
    assert len(pattern.seen) == len(set(pattern.seen))
    words = list(place)
    for row in rows.to_pylist():
        sizes = np.frombuffer(row["sizes"], np.uint32)
        words += [row["letters"][b - n:b] for n, b in zip(sizes, np.cumsum(sizes))]
    assert len(words) == len(set(words))
    held = common.from_ipc(file)
    edges, codes = common.unpacked(held.column(1)[0].as_py(), np.int64), common.unpacked(held.column(2)[0].as_py(), np.int32)
    got = [[words[c] for c in codes[a:b]] for a, b in zip(edges, edges[1:])]
    assert got == [[w.encode() for w in regex.findall(P.PATTERN, t.decode())] for t in texts]


def test_only_words_that_stand_alone_are_folded_ahead(spark):
    """A word that the pattern cuts further without what follows is left to the shards."""
    ranks = fold_bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    frame = spark.createDataFrame([(1, "xyz xy")], "doc_id long, text string")
    table = common.from_ipc(fold_bpe.fold_ahead(frame.select("text"), fold_bpe.Codec(ranks), r"xy(?=z)|x|y|z|[^xyz]+"))
    assert set(table.column("word").to_pylist()) == {"x", "y", "z", " "}


def test_packed_runs():
    values, stops = np.arange(70_000, dtype=np.uint32) * 7, np.array([0, 5, 5, 1000, 70_000])
    whole = [values[a:b] for a, b in zip([0, *stops[:-1]], stops)]
    assert common.packed_runs(values, stops) == [common.packed(x) for x in whole]
    assert common.packed_runs(values[:0], stops[:0]) == []


def test_tasks_give_back_what_they_freed(monkeypatch):
    """At the end of a task, after the operator's own function has ended."""
    said = []
    monkeypatch.setattr(common, "give_back", lambda: said.append("back"))

    def run(batches):
        for b in batches:
            yield b + 1
        said.append("ended")

    assert list(common.lean(run)([1, 2])) == [2, 3] and said == ["ended", "back"]
    assert common.lean_group(lambda t: t * 2)(4) == 8 and said == ["ended", "back", "back"]
    monkeypatch.undo()
    common.give_back()


def test_driver_gives_back_what_learning_and_seeds_took(spark, monkeypatch):
    """The driver gets no row objects of the learned cells, and returns its memory before the next step."""
    from plantlake.llm import char_language
    said, kinds = [], []
    monkeypatch.setattr(char_language, "give_back", lambda: said.append("fit"), raising=False)
    monkeypatch.setattr(fold_bpe, "give_back", lambda: said.append("ahead"), raising=False)
    collect = type(spark.range(0)).collect
    monkeypatch.setattr(type(spark.range(0)), "collect", lambda self: kinds.append(self.columns) or collect(self))
    rows = [(k, "the cat and the dog" if k % 2 else "der Hund und die Katze", "en" if k % 2 else "de") for k in range(20)]
    model = char_language.fit(spark.createDataFrame(rows, "key long, text string, lang string"))
    assert model.languages == ["de", "en"] and model.predict("the dog and the cat")[0] == "en"
    fold_bpe.fold_ahead(spark.createDataFrame([("a b",)], "text string"), fold_bpe.Codec(fold_bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))), P.PATTERN)
    assert said == ["fit", "ahead"] and kinds == [["lang", "n"]]
