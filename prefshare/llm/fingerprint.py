"""Document fingerprints by I-Match over randomised lexicons.

A term (a run of letters or digits, in lower case) belongs to the lexicon if its
inverse document frequency ln(N / df) lies in a band; both are counted over
distinct texts, so that copies do not make their terms common. A document's distinct
lexicon terms, sorted, are hashed once for each of several random subsets of the
lexicon. Subsets come in levels that keep ever fewer terms, one in 2**level, so
that short documents have terms in the dense ones and an edit of a long document
leaves some of the sparse ones untouched. A level has a subset in each of four
lanes; a lane hashes the terms once, and its subset of a level is what is left of the
one of the level before. Two fingerprints are as alike as the share of the subsets on
which they agree, among those in which either has a term; those without any are equal.

All of it is DataFrame expressions. Terms are carried as 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefshare.functions.flags import quoted
from prefshare.llm.common import join_small
from prefshare.sources.scratch import stage

# A band between common and rare words. Its lower end of df, N / e**6, bounds the
# lexicon: e**6 times the mean number of distinct terms of a document.
IDF_BAND = (2.0, 6.0)
# Subset 0 is the whole lexicon (level 0); each level after it has one in each lane,
# as far as there are subsets.
SUBSETS = 32
LANES = 4
SEPARATOR = r"[^\p{L}\p{N}]+"
# Stands for a null doc_id, which comes first in the order.
FIRST = -(2**63)


def terms(text: Column) -> Column:
    """Hashes of the distinct terms."""
    words = F.array_remove(F.split(F.lower(text), SEPARATOR), "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(texts: DataFrame, text: str, band: tuple[float, float] = IDF_BAND) -> DataFrame:
    """Rows (term) of the terms within the band, over the distinct texts of the table."""
    hashed = texts.select(F.xxhash64(quoted(text)).alias("h"), quoted(text).alias("t"))
    sizes = stage(hashed.groupBy("h").count(), "text-copies")
    repeated = stage(sizes.filter("count > 1").select("h"), "repeated-texts")
    # Only texts that repeat are gathered, after their copies are combined in the tasks.
    once = join_small(hashed, repeated, ["h"], "left_anti").select("t")
    copied = join_small(hashed, repeated, ["h"], "left_semi")
    distinct = once.unionAll(copied.groupBy("h").agg(F.first("t").alias("t")).select("t"))
    counts = distinct.select(F.explode(terms(F.col("t"))).alias("term")).groupBy("term")
    idf = F.log(F.lit(float(max(sizes.count(), 1))) / F.col("df"))
    return (
        counts.agg(F.count(F.lit(1)).alias("df"))
        .filter((idf >= band[0]) & (idf <= band[1]))
        .select("term")
    )


def with_subset_hashes(df: DataFrame, found: str, name: str) -> DataFrame:
    """The frame with ``name``, the hash of each subset of the sorted terms ``found``
    (null where it has none), in place of them."""
    kept = [c for c in df.columns if c != found]
    hashed = "if(size({0}) = 0, null, hash({0}))"
    done = [hashed.format(found)]
    # Each term with its hash in every lane; filtered further from level to level.
    lanes = {
        f"_lane{j}": f"transform({found}, t -> named_struct('t', t, 'x', xxhash64(t, {j})))"
        for j in range(LANES)
    }
    work = df.selectExpr(*kept, f"array({done[0]}) as {name}", *[f"{e} as {c}" for c, e in lanes.items()])
    level = 0
    while LANES * level + 1 < SUBSETS:
        level += 1
        left = list(lanes)[: SUBSETS - 1 - LANES * (level - 1)]
        work = work.selectExpr(
            *kept,
            name,
            *[f"filter({c}, y -> pmod(y.x, {1 << level}L) = 0) as {c}" for c in left],
        )
        parts = [hashed.format(f"transform({c}, y -> y.t)") for c in left]
        work = work.selectExpr(*kept, f"concat({name}, array({', '.join(parts)})) as {name}", *left)
    return work.select(*kept, name)


def written(hashes: str) -> Column:
    """Eight hexadecimal digits for each subset, or a dash."""
    return F.expr(
        f"array_join(transform({hashes}, h -> lpad(right(hex(h), 8), 8, '0')), ':', '-')"
    )


def likeness(mine: str, theirs: str) -> Column:
    """Subsets with equal hashes over those where either has one; without any the
    fingerprints are equal, and 1."""
    return F.expr(
        f"""aggregate(zip_with({mine}, {theirs}, (a, b) -> struct(a, b)),
        named_struct('same', 0, 'any', 0),
        (s, x) -> named_struct('same', s.same + if(x.a <=> x.b and x.a is not null, 1, 0),
                               'any', s.any + if(coalesce(x.a, x.b) is null, 0, 1)),
        s -> if(s.any = 0, 1D, cast(s.same as double) / s.any))"""
    )


def _successors(keys: DataFrame) -> DataFrame:
    """Distinct (k, h) in order, each with the next one's (after the last: the
    first), and the copies of the row. Positions come from a range partitioning
    that is written once, and from the sizes of its partitions."""
    part = F.spark_partition_id()
    placed = stage(
        keys.groupBy("k", "h")
        .agg(F.count(F.lit(1)).alias("copies"), F.first("n_chars").alias("n_chars"))
        .repartitionByRange("k", "h")
        .withColumn("part", part),
        "document-order",
    )
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range partition.
    bases = sizes.select(
        "part",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
        F.sum("n").over(Window.partitionBy()).alias("all"),
    )
    inside = Window.partitionBy("part").orderBy("k", "h")
    ordered = placed.withColumn("row", F.row_number().over(inside) - 1).join(
        F.broadcast(bases), "part"
    )
    position = F.col("base") + F.col("row")
    here = ordered.select(
        "k", "h", "copies", "n_chars", ((position + 1) % F.col("all")).alias("at")
    )
    there = ordered.select(
        F.col("k").alias("next_k"), F.col("h").alias("next_h"), position.alias("at")
    )
    return stage(here.join(there, "at").drop("at"), "next-documents")


def _edited(rows: DataFrame, wanted: DataFrame, others: DataFrame) -> DataFrame:
    """Rows (k, h, t) with e, the text whose end is the start of the next one's, which
    is among the others."""
    # Only the part that is needed of the next document travels to its neighbour.
    heads = (
        join_small(others, wanted, ["k", "h"], "inner")
        .select(
            F.col("for_k").alias("k"),
            F.col("for_h").alias("h"),
            "q",
            F.expr("substring(t, 1, q)").alias("head"),
        )
        .groupBy("k", "h")
        .agg(F.first("q").alias("q"), F.first("head").alias("head"))
    )
    edited = F.expr("concat(substring(t, 1, length(t) - q), head)")
    return rows.join(heads, ["k", "h"]).withColumn("e", edited)


def _whole_terms(hashed: DataFrame, rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The hashes (k, h, f, g), with those of all of a text's terms where it has none
    in the lexicon. Only such documents are read again."""
    bare = stage(
        hashed.filter("f[0] is null or g[0] is null").select("k", "h"), "bare-documents"
    )
    theirs = bare.select(F.col("k").alias("for_k"), F.col("h").alias("for_h"))
    again = _edited(
        join_small(rows, bare, ["k", "h"], "left_semi"),
        join_small(wanted, theirs, ["for_k", "for_h"], "left_semi"),
        rows,
    )
    found = again.select(
        "k",
        "h",
        F.sort_array(terms(F.col("t"))).alias("own"),
        F.sort_array(terms(F.col("e"))).alias("changed"),
    ).dropDuplicates(["k", "h"])
    found = with_subset_hashes(found, "own", "whole_f")
    whole = stage(with_subset_hashes(found, "changed", "whole_g"), "whole-terms")
    return join_small(hashed, whole, ["k", "h"], "left").select(
        "k",
        "h",
        "edited_sha256",
        F.expr("if(f[0] is null, coalesce(whole_f, f), f)").alias("f"),
        F.expr("if(g[0] is null, coalesce(whole_g, g), g)").alias("g"),
    )


def fingerprint_documents(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    band: tuple[float, float] = IDF_BAND,
    whole_terms: bool = False,
) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    A null text is empty. Documents of one doc_id follow each other by a hash of
    their texts; equal rows are one document in the order and each get its row.
    A null doc_id comes first. A document without a lexicon term has an empty
    fingerprint, which is like empty ones only; with ``whole_terms`` only one without
    any term has, and where none is in the lexicon all terms are hashed. Other columns
    are not read. An empty table gives no rows.
    """
    whole = F.coalesce(quoted(text), F.lit(""))
    rows = docs.select(
        F.coalesce(quoted(doc).cast("bigint"), F.lit(FIRST)).alias("k"),
        F.xxhash64(whole).alias("h"),
        whole.alias("t"),
    )
    order = _successors(rows.select("k", "h", F.length("t").cast("bigint").alias("n_chars")))
    chosen = stage(lexicon(rows, "t", band), "lexicon").withColumn("known", F.lit(True))
    quarter = F.expr("cast(n_chars div 4 as int)")
    wanted = order.select(
        F.col("next_k").alias("k"),
        F.col("next_h").alias("h"),
        F.col("k").alias("for_k"),
        F.col("h").alias("for_h"),
        quarter.alias("q"),
    )
    both = _edited(rows, wanted, rows)
    # A null beside the terms keeps documents that have none in the lexicon.
    kinds = F.explode(
        F.array(
            F.struct(F.lit(0).alias("kind"), F.col("t").alias("x")),
            F.struct(F.lit(1).alias("kind"), F.col("e").alias("x")),
        )
    )
    every = both.select("k", "h", F.sha2("e", 256).alias("edited_sha256"), kinds.alias("one"))
    listed = every.select(
        "k",
        "h",
        "edited_sha256",
        "one.kind",
        F.explode(
            F.concat(terms(F.col("one.x")), F.array(F.lit(None).cast("bigint")))
        ).alias("term"),
    )
    # The digest travels once for each document, beside the null.
    listed = listed.withColumn(
        "edited_sha256", F.when(F.col("term").isNull() & (F.col("kind") == 0), F.col("edited_sha256"))
    )
    kept = join_small(listed, chosen, ["term"], "left").filter("known or term is null")

    def collected(kind: int) -> Column:
        return F.sort_array(F.collect_set(F.when(F.col("kind") == kind, F.col("term"))))

    hashed = (
        kept.groupBy("k", "h")
        .agg(
            F.max("edited_sha256").alias("edited_sha256"),
            collected(0).alias("own"),
            collected(1).alias("changed"),
        )
    )
    hashed = with_subset_hashes(with_subset_hashes(hashed, "own", "f"), "changed", "g")
    hashed = stage(hashed, "fingerprints")
    if whole_terms:
        hashed = stage(_whole_terms(hashed, rows, wanted), "fingerprints")
    following = hashed.select(
        F.col("k").alias("next_k"), F.col("h").alias("next_h"), F.col("f").alias("next_f")
    )
    return (
        order.join(hashed, ["k", "h"])
        .join(following, ["next_k", "next_h"])
        .withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))
        .select(
            F.when(F.col("k") != FIRST, F.col("k")).alias("doc_id"),
            "n_chars",
            "edited_sha256",
            written("f").alias("fingerprint"),
            written("g").alias("edited_fingerprint"),
            likeness("f", "g").alias("near_edited"),
            likeness("f", "next_f").alias("near_next"),
        )
    )
