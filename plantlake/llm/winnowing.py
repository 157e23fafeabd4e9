"""Benchmark decontamination by winnowing, in DataFrame functions only.

Both sides keep, of the hashes of every ``k`` words, the smallest in each run of ``w`` neighbours
(``k + w - 1`` is the window length), so two texts that share a window also share the hash kept for
it. A document's windows whose kept hash the benchmark keeps too are extended to their full length: the
hash of the whole window is joined with the *distinct* windows of the benchmark, and then its words
are compared, so a hash collision costs one comparison and never a wrong hit.

Documents and items never meet in pairs. Benchmark windows that lie in the same items (told by
their number and two 64-bit sums of them) share one set of items, a document has a list of such
sets, and the items are listed once per distinct list. So a phrase in many items and many documents
costs their sum and not their product.

No table is broadcast by order of this module: small ones are stored, and Spark broadcasts them below the
session's own size threshold. Documents send a kept hash per place of those that have one of the
benchmark's; only these are read again. Documents are recognised by id and text hash, so
repeated rows each get their result.

An item of fewer words than a window is one window itself: texts are then also searched for
runs of the lengths that such items have, in the same way with runs as fingerprints.

A null text has no words; a null item id counts as an item but is left out of ``items_sha256``.
Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from plantlake.llm.common import written

BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_array(text: Column) -> Column:
    """Lower-cased (A-Z) words of a text; empty for null."""
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(lower, BREAK), "")


def shifted(a: Column, by: int) -> Column:
    return F.slice(a, F.lit(by + 1), F.greatest(F.size(a) - by, F.lit(0)))


def neighbours(df: DataFrame, source: str, length: int, join, tag: str) -> tuple[DataFrame, str]:
    """Combine every ``length`` neighbours of the array ``source``, first those of 2, 4 and so on.
    ``join(a, b, overlap)`` combines two runs. Places without enough neighbours hold no meaning."""
    have, size = source, 1
    while size < length:
        step = min(size, length - size)
        name = f"__{tag}{size + step}"
        df = df.withColumn(name, F.zip_with(have, shifted(F.col(have), step), join))
        size, have = size + step, name
    return df, have


def head(a: Column, n: Column) -> Column:
    return F.slice(a, F.lit(1), F.greatest(n, F.lit(0)))


def gram_hashes(df: DataFrame, words: str, k: int, out: str) -> DataFrame:
    """Hash of every ``k`` words of the array ``words``, as array ``out``."""
    tag = f"{out}_h"
    df = df.withColumn(f"__{tag}1", F.transform(words, lambda x: F.xxhash64(x)))
    df, have = neighbours(df, f"__{tag}1", k, lambda a, b: F.xxhash64(a, b), tag)
    return df.withColumn(out, head(F.col(have), F.size(words) - (k - 1)))


def kept_hashes(df: DataFrame, grams: str, w: int, out: str) -> DataFrame:
    """Distinct smallest hashes of every ``w`` neighbours in ``grams``."""
    tag = f"{out}_m"
    df, have = neighbours(df, grams, w, lambda a, b: F.least(a, b), tag)
    return df.withColumn(out, F.array_distinct(head(F.col(have), F.size(grams) - (w - 1))))


def row_key(docs: DataFrame) -> Column:
    """Id and text hash of each row, never null."""
    return F.concat_ws(":", docs["doc_id"].cast("string"), F.xxhash64(docs["text"].cast("string")).cast("string"))


def benchmark_windows(classes: DataFrame, lengths: list[int]) -> tuple[DataFrame, DataFrame]:
    """``(items, c)``: the item classes of each set of items, and ``(len, h, window, items)``: the distinct windows
    with hash, words and the set of items that they lie in."""
    places = None
    for n in lengths:
        own = gram_hashes(classes.where(F.col("len") == n), "words", n, "h").select("c", "words", F.posexplode("h").alias("q", "h"))
        own = own.select(F.lit(n).alias("len"), "c", "h", F.slice("words", F.col("q") + 1, F.lit(n)).alias("window")).distinct()
        places = own if places is None else places.unionByName(own)
    places = written(places, "winnow-places")
    own = ["m", "a", "b"]
    sets = places.groupBy("len", "h", "window").agg(F.count("*").alias("m"), F.bit_xor(F.xxhash64("c")).alias("a"), F.bit_xor(F.xxhash64("c", F.lit(1))).alias("b"))
    sets = written(sets.withColumn("w", F.monotonically_increasing_id()), "winnow-sets")
    # One window stands for all that lie in the same items; these are at most the windows of one item.
    windows = written(sets.withColumn("items", F.min("w").over(Window.partitionBy(*own))).select("len", "h", "window", "w", "items"), "winnow-distinct")
    first = windows.where("w = items").select("len", "h", "window", "items")
    return written(places.join(first, ["len", "h", "window"]).select("items", "c"), "winnow-occurrences"), windows.drop("w")


def contamination(docs: DataFrame, items: DataFrame, length: int = 10, k: int = 4, keyed: bool = False) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` for every row of
    ``docs(doc_id, text)`` against ``items(item_id, text)``; ``keyed`` puts the ``row_key`` as ``key`` before them."""
    lead = ["key", "doc_id"] if keyed else ["doc_id"]
    items = items.select(F.col("item_id").cast("string").alias("item_id"), word_array(F.col("text").cast("string")).alias("words")).where(F.size("words") > 0)
    classes = written(items.groupBy("words").agg(F.count("*").alias("n_items"), F.array_sort(F.collect_list("item_id")).alias("ids")).select(
        F.monotonically_increasing_id().alias("c"), "words", F.least(F.size("words"), F.lit(length)).alias("len"), "n_items", "ids"), "winnow-items")
    lengths = sorted(r.len for r in classes.select("len").distinct().collect())  # at most ``length`` numbers

    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    key = row_key(texts)
    scanned = texts.select("doc_id", key.alias("key"), word_array(F.col("text")).alias("words")).withColumn("n_words", F.size("words"))
    plan = [(n, *((k, n - k + 1) if n == length else (n, 1))) for n in lengths]
    for n, gram, w in plan:
        scanned = kept_hashes(gram_hashes(scanned, "words", gram, f"g{n}"), f"g{n}", w, f"f{n}")
    prints = written(scanned.select("doc_id", "key", "n_words", *[f"f{n}" for n in lengths]), "winnow-prints")

    occurrences = windows = seen = None
    if plan:
        occurrences, windows = benchmark_windows(classes, lengths)
    for n, gram, w in plan:
        own = classes.where(F.col("len") == n)
        fingerprints = written(kept_hashes(gram_hashes(own, "words", gram, "g"), "g", w, "f").select(F.explode("f").alias("f")).distinct(), "winnow-fingerprints")
        keys = written(prints.select("key", F.explode(f"f{n}").alias("f")).join(fingerprints, "f", "left_semi").select("key").distinct(), "winnow-seeded")
        # Only texts with a seed are looked at again.
        text = texts.withColumn("key", key).join(keys, "key", "left_semi").select("key", word_array(F.col("text")).alias("words")).distinct()
        text = written(text, "winnow-texts")
        scan = gram_hashes(gram_hashes(text, "words", gram, "g"), "words", n, "h")
        scan, least = neighbours(scan, "g", w, lambda a, b: F.least(a, b), "m")
        spots = scan.select("key", F.posexplode(F.zip_with(head(F.col(least), F.size("words") - (n - 1)), "h", lambda f, h: F.struct(f.alias("f"), h.alias("h")))).alias("s", "x"))
        seeds = spots.select("key", "s", "x.f", "x.h").join(fingerprints, "f", "left_semi")
        near = seeds.join(windows.where(F.col("len") == n), "h").groupBy("key").agg(F.collect_list(F.struct("s", "items", "window")).alias("near"))
        same = F.filter("near", lambda x: F.slice("words", x["s"] + 1, F.lit(n)) == x["window"])
        found = near.join(text, "key").select("key", F.explode(same).alias("x")).select(
            "key", "x.items", F.col("x.s").cast("long").alias("s"), (F.col("x.s") + n).cast("long").alias("e"))
        seen = found if seen is None else seen.unionByName(found)
    if seen is None:
        none = F.lit(0).cast("long")
        return texts.withColumn("key", key).select(*lead, F.size(word_array(F.col("text"))).cast("long").alias("n_words"), none.alias("n_hit"), none.alias("n_items"),
                            F.sha2(F.lit(""), 256).alias("items_sha256"), F.lit(False).alias("contaminated"))

    seen = written(seen, "winnow-windows")
    before = Window.partitionBy("key").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1)
    hit = (seen.select("key", "s", "e").distinct().withColumn("done", F.coalesce(F.max("e").over(before), F.lit(0)))
           .groupBy("key").agg(F.sum(F.greatest(F.col("e") - F.greatest("s", "done"), F.lit(0))).alias("n_hit")))
    lists = written(seen.groupBy("key").agg(F.array_sort(F.collect_set("items")).alias("sets")), "winnow-lists")
    distinct = written(lists.select("sets").distinct().select(F.monotonically_increasing_id().alias("l"), "sets"), "winnow-distinct-lists")
    named = (distinct.select("l", F.explode("sets").alias("items")).join(occurrences, "items").select("l", "c").distinct().join(classes.select("c", "n_items", "ids"), "c")
             .groupBy("l").agg(F.sum("n_items").alias("n_items"), F.concat_ws(",", F.array_sort(F.flatten(F.collect_list("ids")))).alias("ids"))
             .select("l", "n_items", F.sha2("ids", 256).alias("digest")))
    answers = written(distinct.join(named, "l").drop("l"), "winnow-answers")
    found = hit.join(lists, "key").join(answers, "sets").select(F.col("key").alias("k"), "n_hit", "n_items", "digest")
    out = prints.select("doc_id", "key", F.col("n_words").cast("long").alias("n_words")).join(found, F.col("key") == F.col("k"), "left")
    return out.select(*lead, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                      F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("items_sha256"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))
