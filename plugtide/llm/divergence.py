"""Source divergence audit: how far the words of a source lie from those of its language's other sources.

Terms of a group are never ranked one by one. They are counted per cell (count in the group, count
in the language), the divergence is worked out once per cell, equal values merge, and only the
cells that reach the first ranks are expanded into their terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plugtide.functions.durable import durable
from plugtide.functions.lookups import attach
from plugtide.llm.terms import LETTERS, split_terms
from plugtide.llm.words import coded, rows_of, slices

SCALE = 1_000_000_000
# Text handled at once inside a task, and rows compared in one group of a pair of blocks.
SLICE_BYTES = 8 << 20
PART_ROWS = 100_000
# Sources of a language compared with one another in one group.
BLOCK = 256
# Elements of a table of terms by sources that are worked on at once.
CELLS = 1 << 21


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per language, source and term of a slice: its occurrences, and the texts that hold it."""
    for batch in slices(batches, "text", SLICE_BYTES):
        terms, starts = split_terms(batch.column("text"), LETTERS)
        if not len(terms):
            continue
        places, distinct = coded(terms)
        size = len(distinct)
        groups = pa.table([batch.column("lang"), batch.column("source")], ["lang", "source"])
        keyed = groups.append_column("row", pa.array(np.arange(len(batch))))
        firsts = keyed.group_by(["lang", "source"], use_threads=False).aggregate([("row", "list")])
        members = firsts.column("row_list").combine_chunks()
        group = np.empty(len(batch), np.int64)
        group[members.flatten().to_numpy()] = rows_of(members.offsets.to_numpy())

        in_text, counts = np.unique(rows_of(starts) * size + places, return_counts=True)
        cell, back = np.unique(group[in_text // size] * size + in_text % size, return_inverse=True)
        yield pa.RecordBatch.from_arrays(
            [
                *[firsts.column(c).combine_chunks().take(pa.array(cell // size)) for c in ("lang", "source")],
                distinct.take(pa.array(cell % size)).cast(pa.string()),
                pa.array(np.bincount(back, weights=counts).astype(np.int64)),
                pa.array(np.bincount(back).astype(np.int64)),
            ],
            ["lang", "source", "term", "n", "texts"],
        )


def share(n: Column | str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)), whole numbers throughout."""
    own = (F.col(n) if isinstance(n, str) else n).cast("decimal(19,0)") + F.lit(2).cast("decimal(1,0)")
    above = (own * F.lit(SCALE).cast("decimal(10,0)")).cast("decimal(30,0)")
    below = (F.col(total).cast("decimal(19,0)") + F.lit(2).cast("decimal(1,0)") * F.col(terms).cast("decimal(18,0)")).cast("decimal(21,0)")
    return F.call_function("div", above, below) + F.lit(1)


def divergence(p: Column, q: Column) -> Column:
    """(p - q)^2 / (p + q), rounded down."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _between(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """Per pair of sources of two blocks, the sum of divergences over the terms of this part.

    `left` has the shares of terms that occur (side 0 or 1, i, p, term), `right` each source's share of
    a term that it does not have (side, i, p0). `terms` counts the terms of this part.
    """
    lang, first, second, _ = (k.as_py() for k in key)
    absent = [right.filter(pc.equal(right["side"], side)).sort_by("i") for side in (0, 1)]
    numbers = [a["i"].to_numpy() for a in absent]
    zero = [a["p0"].to_numpy() for a in absent]
    coded_terms = left["term"].combine_chunks().dictionary_encode()
    row, side = coded_terms.indices.to_numpy(), left["side"].to_numpy()
    i, p, height = left["i"].to_numpy(), left["p"].to_numpy(), len(coded_terms.dictionary)
    order = np.argsort(row, kind="stable")
    row, side, i, p = row[order], side[order], i[order], p[order]
    sums = np.zeros((len(numbers[0]), len(numbers[1])), np.int64)
    step = max(1, CELLS // max(len(numbers[0]) + len(numbers[1]), 1))
    for low in range(0, height, step):
        cut = slice(*np.searchsorted(row, [low, low + step]))
        tables = []
        for s in (0, 1):
            table = np.repeat(zero[s][None, :], min(step, height - low), axis=0)
            mine = np.flatnonzero(side[cut] == s) + cut.start
            table[row[mine] - low, np.searchsorted(numbers[s], i[mine])] = p[mine]
            tables.append(np.ascontiguousarray(table.T))
        for a, shares in enumerate(tables[0]):
            gap = shares[None, :] - tables[1]
            sums[a] += (gap * gap // (shares[None, :] + tables[1])).sum(axis=1)
    a, b = np.meshgrid(numbers[0], numbers[1], indexing="ij")
    size = a.size
    return pa.table(
        {
            "lang": pa.array([lang] * size, pa.string()),
            "a": pa.array(a.ravel(), pa.int32()),
            "b": pa.array(b.ravel(), pa.int32()),
            "sum": pa.array(sums.ravel()),
            "terms": pa.array(np.full(size, height, np.int64)),
        }
    )


def audit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_texts: int = 10,
    top: int = 10,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank).

    Part `pair`: the divergence of each source from each other source of its language, over all kept
    terms. Part `term`: the `top` kept terms that a source has more often than its language.

    A language keeps the terms that occur in at least `least_texts` of its rows; each row counts as a
    text of its own, repeated ones too, and ids are not looked at. Null text, language and source count as ''.
    A group without terms, or of a language that keeps none, has its pairs all the same (value 0
    without kept terms) and no terms. An empty table gives an empty one; other columns are not looked at.

    Counts are summed in each task before the shuffle. A term's rows number at most the sources of
    its language. Pairs are summed over parts of some 100,000 rows and blocks of 256 sources,
    and only sums leave a part. What is ranked per group are merged values of cells, not terms.
    """
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))]
    given = docs.select(*text, F.col(text_col).alias("text"))
    counted = given.mapInArrow(_count, "lang string, source string, term string, n long, texts long")
    summed = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"))
    of_lang = Window.partitionBy("lang", "term")
    kept = (
        summed.withColumns({"all_n": F.sum("n").over(of_lang), "all_texts": F.sum("texts").over(of_lang)})
        .filter(F.col("all_texts") >= least_texts)
        .drop("texts", "all_texts")
    )
    kept = durable(kept, "kept-terms")

    present = given.select("lang", "source").distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang", "term").agg(F.first("all_n").alias("n")).groupBy("lang").agg(
        F.count(F.lit(1)).alias("v"), F.sum("n").alias("all_total")
    )
    rows = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("_rows"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = (
        present.join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .join(rows, "lang", "left")
        .na.fill(0, ["total", "v", "all_total", "_rows"])
        .withColumn("i", number)
    )
    groups = durable(groups, "groups")
    facts = attach(kept, groups.select("lang", "source", "i", "total", "v", "all_total"), ["lang", "source"])
    return _terms(facts, top).unionByName(_pairs(facts, groups))


def _terms(facts: DataFrame, top: int) -> DataFrame:
    cells = facts.groupBy("lang", "source", "n", "all_n", "total", "v", "all_total").agg(F.count(F.lit(1)).alias("terms"))
    p, q = share("n", "total", "v"), share("all_n", "all_total", "v")
    cells = cells.withColumns({"p": p, "q": q}).filter("p > q")
    cells = cells.select("lang", "source", "n", "all_n", "terms", divergence(F.col("p"), F.col("q")).alias("value"))
    # Every value has a term, so the first ranks lie in as many values.
    values = cells.groupBy("lang", "source", "value").agg(F.sum("terms").alias("terms"))
    falling = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    first = values.withColumn("_at", F.row_number().over(falling)).filter(F.col("_at") <= top)
    before = F.sum("terms").over(falling.rowsBetween(Window.unboundedPreceding, -1))
    first = first.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < top)
    reached = cells.drop("terms").join(first.select("lang", "source", "value", "before"), ["lang", "source", "value"])
    members = facts.select("lang", "source", "n", "all_n", "term").join(reached, ["lang", "source", "n", "all_n"])
    in_value = Window.partitionBy("lang", "source", "value").orderBy("term")
    members = members.withColumn("_in", F.row_number().over(in_value)).filter(F.col("_in") <= top)
    ranked = members.withColumn("rank", (F.col("before") + F.col("_in")).cast("int")).filter(F.col("rank") <= top)
    return ranked.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


def _pairs(facts: DataFrame, groups: DataFrame) -> DataFrame:
    """Blocks of sources meet in pairs, each pair in parts by term."""
    blocks = groups.groupBy("lang").agg(
        F.floor(F.max("i") / BLOCK).cast("int").alias("last"), F.max("_rows").alias("_rows")
    )
    blocks = blocks.withColumn("parts", F.ceil(F.col("_rows") / PART_ROWS).cast("int"))
    block = F.floor(F.col("i") / BLOCK).cast("int")
    sides = F.array(F.struct(F.lit(0).alias("side")), F.struct(F.lit(1).alias("side")))

    def meeting(df: DataFrame) -> DataFrame:
        """Each row once for every pair of blocks, first <= second, that its source is a side of."""
        placed = df.withColumn("_block", block).select("*", F.inline(sides))
        other = F.explode(
            F.when(F.col("side") == 0, F.sequence("_block", "last")).otherwise(F.sequence(F.lit(0), "_block"))
        )
        placed = placed.withColumn("_other", other)
        return placed.withColumns({
            "first": F.when(F.col("side") == 0, F.col("_block")).otherwise(F.col("_other")),
            "second": F.when(F.col("side") == 0, F.col("_other")).otherwise(F.col("_block")),
        })

    sized = attach(facts, blocks.select("lang", "last", "parts"), ["lang"])
    part = F.pmod(F.xxhash64("term"), F.col("parts").cast("long")).cast("int")
    occurring = meeting(sized.withColumns({"part": part, "p": share("n", "total", "v")}))
    p0 = F.when(F.col("v") > 0, share(F.lit(0), "total", "v")).otherwise(F.lit(0))
    # A language that keeps nothing has no part and no sums.
    missing = groups.withColumn("p0", p0).join(blocks.select("lang", "last", "parts").filter("parts > 0"), "lang")
    missing = meeting(missing.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))
    keys = ["lang", "first", "second", "part"]
    sums = (
        occurring.select(*keys, "side", "i", "p", "term").groupBy(*keys)
        .cogroup(missing.select(*keys, "side", "i", "p0").groupBy(*keys))
        .applyInArrow(_between, "lang string, a int, b int, sum long, terms long")
        .groupBy("lang", "a", "b")
        .agg(F.sum("sum").alias("sum"), F.sum("terms").alias("terms"))
    )
    # Within a block both orders of a pair come out; across blocks one does.
    inside = F.floor(F.col("a") / BLOCK) == F.floor(F.col("b") / BLOCK)
    other = sums.filter(~inside).select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "sum", "terms")
    sums = sums.unionByName(other)

    own = groups.select("lang", "source", F.col("i").alias("a"), "v", p0.alias("p0"))
    others = groups.select("lang", F.col("source").alias("item"), F.col("i").alias("b"), p0.alias("q0"))
    met = own.join(others, "lang").filter("a <> b").join(sums, ["lang", "a", "b"], "left")
    # Terms that neither source's block has still differ, as both shares of an absent term do.
    rest = (F.col("v") - F.coalesce("terms", F.lit(0))) * divergence(F.col("p0"), F.col("q0"))
    value = F.when(F.col("v") > 0, F.coalesce("sum", F.lit(0)) + rest).otherwise(F.lit(0))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = met.withColumn("value", value).withColumn("rank", rank)
    return ranked.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
