"""Dimension lookups and unions.

A lookup is a plain join at every size: Spark broadcasts a dimension below the
session's own threshold, and beyond it adaptive execution splits the tasks of a hot
key. Streams get no adaptive execution; there the caller may spread a hot key
over copies of the dimension by a hash of named id columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

_SALT = "__salt"


def lookup(fact: DataFrame, dim: DataFrame, on: str | dict[str, str],
           cols: list[str] | dict[str, str] | None = None, how: str = "left",
           where: Column | None = None, salt: int = 1, salt_by: list[str] | None = None) -> DataFrame:
    """Add dimension attributes to every fact row.

    on       shared key name, or ``{fact column: dim column}``
    cols     attributes to bring, or ``{dim column: output name}``; default all non-keys
    how      "left" keeps facts without a match, "inner" drops them
    where    predicate on the dimension side, applied below the join
    salt     copies of the dimension over which the facts of a key are spread, by a
             hash of the columns ``salt_by``; these should differ between the facts of
             a key. Size it by the share of the hottest key: a key with a third of
             the rows needs as many copies as a third of the tasks
    """
    keys = {on: on} if isinstance(on, str) else dict(on)
    if cols is None:
        cols = [c for c in dim.columns if c not in keys.values()]
    names = cols if isinstance(cols, dict) else {c: c for c in cols}
    if salt > 1 and not salt_by:
        raise ValueError("salt needs salt_by, columns that differ between the facts of a key")
    if where is not None:
        dim = dim.where(where)
    tagged = {f: f"__key{i}" for i, f in enumerate(keys)}
    right = dim.select(*[F.col(keys[f]).alias(tagged[f]) for f in keys],
                       *[F.col(c).alias(n) for c, n in names.items()])
    left, extra = fact, []
    if salt > 1:
        left = fact.withColumn(_SALT, F.pmod(F.xxhash64(*salt_by), F.lit(salt)))
        right = right.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        extra = [F.col(_SALT) == F.col("__copy")]
    condition = reduce(lambda a, b: a & b, [left[f] == right[t] for f, t in tagged.items()] + extra)
    out = left.join(right, condition, how)
    return out.select(*[left[c] for c in fact.columns], *[right[n] for n in names.values()])


def enrich_left(fact: DataFrame, dim: DataFrame, on, cols=None, **options) -> DataFrame:
    """Left lookup; ``fact`` may be a stream."""
    return lookup(fact, dim, on, cols, how="left", **options)


def star_enrich(fact: DataFrame, dims: list[tuple], **options) -> DataFrame:
    """Several left lookups, given as ``(dim, on, cols)``."""
    return reduce(lambda df, d: lookup(df, *d, how="left", **options), dims, fact)


def join_inner(fact: DataFrame, dims: list[tuple], **options) -> DataFrame:
    """Several inner lookups, given as ``(dim, on, cols)``."""
    return reduce(lambda df, d: lookup(df, *d, how="inner", **options), dims, fact)


def join_filtered(left: DataFrame, right: DataFrame, on, predicate: Column, cols=None, **options) -> DataFrame:
    """Inner lookup of the right-hand rows that satisfy ``predicate``."""
    return lookup(left, right, on, cols, how="inner", where=predicate, **options)


def join_derived_key(fact: DataFrame, dim: DataFrame, fact_key: str, key_expr: Column,
                     cols: list[str], **options) -> DataFrame:
    """Inner lookup on a key computed from a dimension column, such as the number
    inside a text id."""
    return lookup(fact, dim.withColumn("__derived", key_expr), {fact_key: "__derived"}, cols,
                  how="inner", **options)


def dim_first(dim: DataFrame, facts: DataFrame, on, cols=None) -> DataFrame:
    """Dimension rows first, with aggregated facts where there are any. ``facts``
    may hold several rows per key, each giving an output row."""
    return lookup(dim, facts, on, cols, how="left")


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """Bag union by column name over the columns of the first feed. Rules applied
    after it exist once for all feeds."""
    names = feeds[0].columns
    return reduce(lambda a, b: a.unionByName(b), [f.select(*names) for f in feeds])
