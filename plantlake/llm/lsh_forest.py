"""Near-duplicate documents by an LSH forest over MinHash signatures.

1. Each document's set of word shingles gives ``TREES`` keys of ``DEPTH`` MinHash values, and a
   128-bit hash of the set. Documents with equal sets become one class, through a partial
   aggregation, so the largest group of copies costs each task one row.
2. Every key orders the classes anew. In each order, classes of one whole key are candidates, and so
   are neighbours among the distinct keys if enough of their values agree. All orders are one
   range sort in slices of about ``REGION`` rows, by key and then class, so that no crowd of equal
   or near keys is one task's; the ends of all slices are compared with each other as well, so
   that a slice cuts no neighbours off.
3. Candidates connect classes into groups. Inside a group all pairs are compared on full sets, in
   blocks of at most ``BLOCK`` classes, by counting common shingles with a matrix product. A group
   of several blocks compares every block with itself and with its ``HUBS`` best-connected
   members first. What this leaves in different components meets again where it can still be alike:
   sets that are hold one of the rarest shingles of each in common (``_meetings``), so unlike sets
   of a large group cost their shingles and not their pairs. Links leave a task as a spanning
   forest, never as all pairs.
4. Components of the links are found by alternating large-star and small-star steps on written
   tables.

So a link between two documents is only missed if no chain of candidates joins them; two documents
of similarity 0.8 miss each other in all 16 orders with a probability below 1 in 10,000.

Documents without words (also null texts) have size 0 and link with nothing. Null doc ids link
with nothing, keep a null component and are kept. Rows that share a doc id share its component,
also with different texts: a doc id links the classes of its texts. With ``by_text`` it doesn't, and
each text is judged for itself. Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from plantlake.llm.common import lean, rows_to_batch, steps, written
from plantlake.llm.spans import mixed, span_hashes, window_hashes, words

U = np.uint64
TREES, DEPTH, AGREE = 16, 8, 5
REGION, BLOCK, HUBS, NEIGHBOURS = 20_000, 1024, 32, 2
#: Bytes of text whose shingles a task holds at once; sorting them takes some thirty times as much.
TEXTS = 1 << 20
#: Groups move to the texts by broadcast while they have at most so many rows (16 bytes each and as much for the hash).
BROADCAST_ROWS = 2_000_000
_RNG = np.random.default_rng(80)
_A = _RNG.integers(0, 1 << 31, TREES * DEPTH, dtype=np.int64).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_B = _RNG.integers(0, 1 << 32, TREES * DEPTH, dtype=np.int64).astype(np.uint32)


def shingle_sets(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, first)``: distinct shingle hashes of each text, ascending; those of text i are
    ``first[i]:first[i + 1]``. A text of fewer words is one shingle."""
    buf, starts, ends, first = words(texts, lower=True)
    h = span_hashes(buf, starts, ends)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    n = len(h) - size + 1
    inside = np.flatnonzero(doc[:n] == doc[size - 1:]) if n > 0 else np.empty(0, np.int64)
    grams, owner = window_hashes(h, size, seed=size)[inside], doc[inside]
    short = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < size))
    if len(short):
        whole = np.array([mixed(np.bitwise_xor.reduce(mixed(h[first[i]:first[i + 1]] + np.arange(first[i + 1] - first[i]).astype(U)), keepdims=True))[0] for i in short], U)
        grams, owner = np.concatenate([grams, whole]), np.concatenate([owner, short])
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    return grams[new], np.searchsorted(owner[new], np.arange(len(texts) + 1))


def signatures(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    """MinHash values (16 bits, big-endian) of each non-empty set."""
    filled = np.flatnonzero(np.diff(first) > 0)
    x, heads = (grams >> U(32)).astype(np.uint32), first[filled]
    out = np.empty((len(filled), TREES * DEPTH), np.uint32)
    for k in range(TREES * DEPTH):
        out[:, k] = np.minimum.reduceat(x * _A[k] + _B[k], heads)
    out ^= out >> np.uint32(16)
    out *= np.uint32(0x85EBCA6B)
    return (out >> np.uint32(16)).astype(">u2")


def set_hashes(grams: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each set; 0 for empty ones."""
    out = []
    for salt in (U(0x1234567), U(0xABCDEF98765)):
        sums = np.concatenate([np.zeros(1, U), np.cumsum(mixed(grams ^ salt))])
        out.append((sums[first[1:]] - sums[first[:-1]]).view(np.int64))
    return out[0], out[1]


def text_hash(docs: DataFrame) -> Column:
    """Tells the texts of one doc id apart."""
    return F.xxhash64(docs["text"].cast("string"))


def _features(docs: DataFrame, size: int) -> DataFrame:
    """``(doc_id, text_hash, n, lo, hi, sig)``; ``sig`` is null for empty sets."""
    def run(batches):
        for batch, texts in steps(batches, TEXTS):
            grams, first = shingle_sets(texts, size)
            n = np.diff(first)
            lo, hi = set_hashes(grams, first)
            sig = iter(signatures(grams, first))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(lo), pa.array(hi),
                                              pa.array([next(sig).tobytes() if k else None for k in n.tolist()], pa.binary())],
                                             names=["doc_id", "text_hash", "n", "lo", "hi", "sig"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(docs).alias("text_hash"), F.col("text").cast("string").alias("text")).mapInArrow(
        lean(run), "doc_id long, text_hash long, n long, lo long, hi long, sig binary")


_ORDER_SQL = "u long, v long, tree int, key binary"
_ORDER = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("tree", pa.int32()), ("key", pa.binary())])


def _neighbours(batches):
    """From sorted rows ``(tree, key, rep)``: pairs ``(u, v)`` of equal keys with the first row of the key, and of
    near keys where enough values agree; then, with v null, the first rows of the outermost keys."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    keys = table.column("key").to_pylist()
    tree, rep = table.column("tree").to_numpy(), table.column("rep").to_numpy()
    values = np.frombuffer(b"".join(keys), ">u2").reshape(-1, DEPTH)
    new = np.ones(len(rep), bool)
    new[1:] = (tree[1:] != tree[:-1]) | (values[1:] != values[:-1]).any(axis=1)
    heads = np.flatnonzero(new)
    u, v = [rep[~new]], [rep[heads[np.cumsum(new) - 1]][~new]]
    for k in range(1, NEIGHBOURS + 1):
        after, before = heads[k:], heads[:-k]
        near = (tree[after] == tree[before]) & ((values[after] == values[before]).sum(axis=1) >= AGREE)
        u.append(rep[after[near]])
        v.append(rep[before[near]])
    u, v = np.concatenate(u), np.concatenate(v)
    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.nulls(len(u), pa.int32()), pa.nulls(len(u), pa.binary())], schema=_ORDER)
    edge = np.union1d(heads[:NEIGHBOURS], heads[-NEIGHBOURS:])
    yield pa.RecordBatch.from_arrays([pa.array(rep[edge]), pa.nulls(len(edge), pa.int64()), pa.array(tree[edge], pa.int32()),
                                      pa.array([keys[i] for i in edge.tolist()], pa.binary())], schema=_ORDER)


def candidates(classes: DataFrame) -> DataFrame:
    """Distinct pairs ``(u, v)``, u > v, of neighbours in some order."""
    width = 2 * DEPTH
    keys = classes.select("rep", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"), "sig").select(
        "tree", F.expr(f"substring(sig, tree * {width} + 1, {width})").alias("key"), "rep")
    order = ["tree", "key", "rep"]
    slices = max(1, -(-TREES * classes.count() // REGION))
    found = written(keys.repartitionByRange(slices, *order).sortWithinPartitions(*order).mapInArrow(lean(_neighbours), _ORDER_SQL), "forest-order")
    # The ends of the slices meet in one task; they are a few rows a slice.
    ends = found.where("v is null").select("tree", "key", F.col("u").alias("rep")).coalesce(1).sortWithinPartitions(*order)
    across = ends.mapInArrow(lean(_neighbours), _ORDER_SQL)
    pairs = found.unionByName(across).where("v is not null and u <> v")
    return pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def stars(edges: DataFrame, label: str) -> DataFrame:
    """``(u, v)`` for every end u of an edge ``(u, v)`` but the smallest node v that it reaches."""
    edges = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), label)
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = large.groupBy("u").agg(F.min("v").alias("m"), F.collect_set("v").alias("below"))
        edges = written(small.select(F.explode(F.concat("below", F.array("u"))).alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), label)
    return edges


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(node, root)`` for every end of an edge ``(u, v)``; the root is the smallest node reachable."""
    edges = stars(edges, label)
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _linked(sets: list[np.ndarray], rows: np.ndarray, columns: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets ``rows`` and ``columns`` are alike, by common shingles counted exactly."""
    sizes = np.array([len(s) for s in sets])
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    owner = np.repeat(np.arange(len(sets)), sizes)
    common = np.zeros((len(rows), len(columns)), np.float32)
    order = np.argsort(codes, kind="stable")
    codes, owner = codes[order], owner[order]
    row_of, column_of = np.full(len(sets), -1), np.full(len(sets), -1)
    row_of[rows], column_of[columns] = np.arange(len(rows)), np.arange(len(columns))
    width = 2048
    for low in range(0, int(codes[-1]) + 1 if len(codes) else 0, width):
        a, b = np.searchsorted(codes, [low, low + width])
        c, o = codes[a:b] - low, owner[a:b]
        left, right = np.zeros((len(rows), width), np.float32), np.zeros((width, len(columns)), np.float32)
        r, k = row_of[o] >= 0, column_of[o] >= 0
        left[row_of[o[r]], c[r]] = 1
        right[c[k], column_of[o[k]]] = 1
        common += left @ right
    union = sizes[rows][:, None] + sizes[columns][None, :] - common
    return 100 * common.astype(np.float64) >= percent * union


def spanning(links: np.ndarray, rows: np.ndarray, columns: np.ndarray, known: list[int] | None = None) -> list[tuple[int, int]]:
    """Links (as places) that join what was apart before; at most as many as places."""
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    if known is not None:
        first: dict[int, int] = {}
        for place, label in enumerate(known):
            parent[root(place)] = root(first.setdefault(label, place))
    out = []
    for i, j in zip(*np.nonzero(links)):
        a, b = int(rows[i]), int(columns[j])
        if a != b and (x := root(a)) != (y := root(b)):
            parent[x] = y
            out.append((a, b))
    return out


def _to_least(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Links of the same components, each to the smallest of its component."""
    root: dict[int, int] = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return [(x, find(x)) for x in list(root) if find(x) != x]


_LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64())])
_SETS_SQL = "rep long, g long, block int, part int, root long, grams binary"


def _compare(percent: int, across: bool = False):
    """Function for one (group, part): compare its rows (role 0) with each other and with its guests
    (role 1) if it is a block, or its askers (role 2) with its rows if parts go ``across`` blocks."""
    def run(table: pa.Table) -> pa.Table:
        reps, roles, roots = (table.column(c).to_pylist() for c in ("rep", "role", "root"))
        sets = [np.frombuffer(g, U) for g in table.column("grams").to_pylist()]
        keep = list({(rep, role): i for i, (rep, role) in enumerate(zip(reps, roles))}.values())
        reps, roles, roots, sets = ([x[i] for i in keep] for x in (reps, roles, roots, sets))
        role = np.array(roles)
        if across:
            rows, columns = np.flatnonzero(role == 2), np.flatnonzero(role == 0)
        else:
            rows, columns = np.arange(len(reps)), np.flatnonzero(role == 0)
        if not len(rows) or not len(columns):
            return _LINKS.empty_table()
        known = roots if across else None
        found = spanning(_linked(sets, rows, columns, percent), rows, columns, known)
        return pa.Table.from_batches([rows_to_batch(_to_least([(reps[a], reps[b]) for a, b in found if reps[a] != reps[b]]), _LINKS)])

    return run


def _part_sets(docs: DataFrame, members: DataFrame, size: int, label: str) -> DataFrame:
    """Full sets of the classes ``members(rep, doc_id, text_hash, lo, hi, ...)`` from their texts."""
    small = members.count() <= BROADCAST_ROWS
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(docs).alias("text_hash"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(members) if small else members, ["doc_id", "text_hash"])

    def run(batches):
        for batch, texts in steps(batches, TEXTS):
            grams, first = shingle_sets(texts, size)
            lo, hi = set_hashes(grams, first)
            same = (batch.column("lo").to_numpy() == lo) & (batch.column("hi").to_numpy() == hi)
            keep = pa.array(np.flatnonzero(same))
            out = [grams[first[i]:first[i + 1]].tobytes() for i in keep.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(c).take(keep) for c in ("rep", "g", "block", "blocks", "hub")] + [pa.array(out, pa.binary())],
                                             names=["rep", "g", "block", "blocks", "hub", "grams"])

    return written(chosen.select("text", "rep", "g", "block", "blocks", "hub", "lo", "hi").mapInArrow(
        lean(run), "rep long, g long, block int, blocks int, hub boolean, grams binary"), label)


_SHINGLES_SQL = "rep long, g long, block int, root long, apart boolean, n int, gram long"


def _shingles(batches):
    """A row for each shingle of the sets in column ``text``, with the size of the set."""
    for batch, sets in steps(batches, TEXTS):
        sizes = np.array([len(s) // 8 for s in sets], np.int32)
        each = pa.array(np.repeat(np.arange(len(sets)), sizes))
        yield pa.RecordBatch.from_arrays([batch.column(c).take(each) for c in ("rep", "g", "block", "root", "apart")] + [
            pa.array(np.repeat(sizes, sizes)), pa.array(np.frombuffer(b"".join(sets), np.int64))], names=["rep", "g", "block", "root", "apart", "n", "gram"])


def _meetings(several: DataFrame, rooted: DataFrame, percent: int) -> DataFrame:
    """``(g, slice, block, role, rep, root)``: the classes of different components that may still be alike, dealt to
    pairs of blocks. Askers (role 2) are those outside the group's largest component.

    Shingles of one component tell nothing. The others of a set of n are put in one order for the whole group, rare ones
    first. Of two sets that are alike each has ``percent`` of its shingles in the other, so the first they have in
    common has as many from there on in both, and too few stand before it to leave it out of the shingles taken here."""
    own = ["rep", "g", "block", "root", "apart", "n"]
    shingles = written(several.join(rooted.select("rep", "root", "apart"), "rep").select("rep", "g", "block", "root", "apart", F.col("grams").alias("text")).mapInArrow(
        lean(_shingles), _SHINGLES_SQL), "forest-shingles")
    common = shingles.groupBy("g", "gram").agg(F.count("*").alias("often"), F.min("root").alias("low"), F.max("root").alias("high")).where(
        "low <> high").select("g", "gram", "often")
    held = shingles.join(common, ["g", "gram"]).groupBy(*own).agg(F.sort_array(F.collect_list(F.struct("often", "gram"))).alias("grams"))
    taken = held.withColumn("taken", F.expr(f"cast(size(grams) - ({percent} * n + 99) div 100 + 1 as int)")).where("taken > 0")
    places = written(taken.select(*own, F.size("grams").alias("size"), F.posexplode(F.slice("grams", F.lit(1), F.col("taken"))).alias("place", "x")).select(
        *own, (F.col("size") - F.col("place")).alias("rest"), "x.gram"), "forest-places")
    crowds = places.groupBy("g", "gram", F.col("block").alias("there"), F.col("apart").alias("aside")).agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max("rest").alias("most_rest"), F.min("root").alias("low"), F.max("root").alias("high"))
    met = places.join(crowds, ["g", "gram"]).where(
        f"block <> there and (low <> root or high <> root) and 100 * n >= {percent} * least and 100 * most >= {percent} * n "
        f"and {100 + percent} * least(rest, most_rest) >= {percent} * (n + least)")
    asks, asked = F.expr("apart and (not aside or there < block)"), F.expr("aside and (not apart or block < there)")
    return met.where(asks | asked).select(
        "g", F.when(asks, F.col("block")).otherwise(F.col("there")).alias("slice"), F.when(asks, F.col("there")).otherwise(F.col("block")).alias("block"),
        F.when(asks, 2).otherwise(0).alias("role"), "rep", "root").distinct()


def _shared_ids(features: DataFrame) -> DataFrame:
    """``(doc_id, most)`` of the doc ids on several sets; ``most`` is one of its sets with most shingles."""
    own = F.struct("n", "lo", "hi")
    return features.where("doc_id is not null").groupBy("doc_id").agg(F.min(own).alias("least"), F.max(own).alias("most")).where("least <> most").select("doc_id", "most")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, by_text: bool = False) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row; documents link where at least
    ``percent`` of the union of their shingle sets (``size`` words each) is common. The component is the
    smallest doc id in it. With ``by_text`` there is a column ``text_hash`` too."""
    features = written(_features(docs, size), "forest-features")
    named = features.where("n > 0 and doc_id is not null")
    # Classes have numbers of their own, as one doc id may be the smallest of several.
    classes = written(named.groupBy("n", "lo", "hi").agg(F.min(F.struct("doc_id", "text_hash")).alias("least"), F.first("sig").alias("sig")).select(
        F.monotonically_increasing_id().alias("rep"), "n", "lo", "hi", "least.doc_id", "least.text_hash", "sig"), "forest-classes")
    pairs = written(candidates(classes), "forest-candidates")
    groups = written(components(pairs, "forest-groups").withColumnsRenamed({"node": "rep", "root": "g"}), "forest-members")

    # Blocks and hubs. Degrees count candidates; a group's hubs are its members with most of them.
    degree = pairs.select(F.explode(F.array("u", "v")).alias("rep")).groupBy("rep").agg(F.count("*").alias("degree"))
    sizes = groups.groupBy("g").agg(F.count("*").alias("members"))
    large = sizes.where(F.col("members") > BLOCK)
    ranked = Window.partitionBy("g").orderBy(F.desc("degree"), "rep")
    hubs = (groups.join(large, "g").join(degree, "rep").withColumn("place", F.row_number().over(ranked))
            .where(F.col("place") <= HUBS).select("rep", F.lit(True).alias("hub")))
    blocks = F.ceil(F.col("members") / BLOCK * 1.25).cast("int")
    members = written(groups.join(sizes, "g").join(classes.select("rep", "doc_id", "text_hash", "lo", "hi"), "rep").join(hubs, "rep", "left").select(
        "rep", "g", "doc_id", "text_hash", "lo", "hi", F.coalesce("hub", F.lit(False)).alias("hub"),
        F.when(F.col("members") > BLOCK, blocks).otherwise(1).alias("blocks"),
        F.when(F.col("members") > BLOCK, F.pmod(F.xxhash64("rep"), blocks)).otherwise(0).cast("int").alias("block")), "forest-blocks")
    sets = _part_sets(docs, members, size, "forest-sets")

    guests = sets.where("hub and blocks > 1").select("rep", "g", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("role"), "grams")
    own = sets.select("rep", "g", "block", F.lit(0).alias("role"), "grams")
    none = F.lit(None).cast("long").alias("root")
    compare = _compare(percent)
    links = written(own.unionByName(guests).withColumn("root", none).groupBy("g", "block").applyInArrow(compare, "u long, v long"), "forest-links")

    # Groups of several blocks: what is in different components, across the blocks.
    several = sets.where("blocks > 1")
    if not large.isEmpty():
        links = stars(links, "forest-first")
        rooted = several.select("rep", "g").join(links, F.col("rep") == F.col("u"), "left").select("rep", "g", F.coalesce("v", "rep").alias("root"))
        main = rooted.groupBy("g", "root").count().groupBy("g").agg(F.max_by("root", F.struct("count", -F.col("root"))).alias("main"))
        rooted = written(rooted.join(main, "g").withColumn("apart", F.col("root") != F.col("main")).drop("main"), "forest-apart")
        if not rooted.where("apart").isEmpty():
            more = _meetings(several, rooted, percent).join(several.select("rep", "grams"), "rep").groupBy("g", "slice", "block").applyInArrow(
                _compare(percent, across=True), "u long, v long")
            links = links.unionByName(written(more, "forest-rest"))

    # Rows that share a doc id link their classes too.
    shared = None if by_text else written(_shared_ids(features), "forest-shared")
    if shared is not None and (n_shared := shared.count()):
        shared = F.broadcast(shared) if n_shared <= BROADCAST_ROWS else shared
        numbers = classes.select(F.struct("n", "lo", "hi").alias("own"), "rep")
        same = named.join(shared, "doc_id").select(F.struct("n", "lo", "hi").alias("own"), "most").distinct()
        same = same.join(numbers, "own").select(F.col("rep").alias("u"), F.col("most").alias("own")).join(numbers, "own").select("u", F.col("rep").alias("v"))
        links = links.unionByName(written(same.where("u <> v"), "forest-same-id"))
        # A row without words belongs to the other texts of its id.
        features = features.join(shared, "doc_id", "left")
        own = F.when((F.col("n") == 0) & F.col("most").isNotNull(), F.col("most")).otherwise(F.struct("n", "lo", "hi"))
    else:
        own = F.struct("n", "lo", "hi")

    found = components(links, "forest-components")
    rooted = written(classes.select("n", "lo", "hi", "rep", "doc_id").join(found, F.col("rep") == F.col("node"), "left").select(
        "n", "lo", "hi", "root", "doc_id"), "forest-rooted")
    least = written(rooted.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component")), "forest-least")
    least = F.broadcast(least) if least.count() <= BROADCAST_ROWS else least
    alone = rooted.where("root is null").select("n", "lo", "hi", F.col("doc_id").alias("component"))
    c = written(rooted.where("root is not null").join(least, "root").select("n", "lo", "hi", "component").unionByName(alone), "forest-result").select(
        F.col("n").alias("cn"), F.col("lo").alias("cl"), F.col("hi").alias("ch"), "component")
    out = features.withColumn("own", own).join(c, (F.col("own.n") == F.col("cn")) & (F.col("own.lo") == F.col("cl")) & (F.col("own.hi") == F.col("ch")), "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "doc_id"))
    return out.select("doc_id", *(["text_hash"] if by_text else []), F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
