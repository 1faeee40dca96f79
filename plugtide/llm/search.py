"""Ranked lexical search: texts with the same bag of item words form a class that is scored once."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plugtide.functions.durable import durable
from plugtide.llm.terms import LETTERS_AND_DIGITS, split_terms
from plugtide.llm.words import coded, gather, rows_of, slices

# Items that are searched in one pass over the documents have some so many terms together; tasks
# hold those terms.
PASS_TERMS = 400_000
SLICE_BYTES = 2 << 20
# Scores (classes by items), and matches of a class's terms with an item's, that a task holds at once.
SCORES = 1 << 20
MATCHES = 1 << 20
# Keys over which the members of one class, or the finds for one item, are spread at first.
SPREAD = 64
# The score's fixed values: unit of a term's share, and the length's constant and share in hundredths.
UNIT, STEEP, LENGTH = 1_000_000_000, 12, 25


def _bags(vocabulary: pa.Array, top: int):
    """Per slice one row for each distinct (number of terms, bag): how many texts, the smallest ids."""

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            terms, starts = split_terms(batch.column("text"), LETTERS_AND_DIGITS)
            lengths = np.diff(starts)
            cells, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
            size = max(len(vocabulary), 1)
            if len(terms):
                places, distinct = coded(terms)
                known = pc.fill_null(pc.index_in(distinct, vocabulary), -1).to_numpy().astype(np.int64)[places]
                inside = known >= 0
                cells, counts = np.unique(rows_of(starts)[inside] * size + known[inside], return_counts=True)
            ends = np.searchsorted(cells, np.arange(len(batch) + 1) * size)
            bag = np.stack([(cells % size).astype("<i4"), counts.astype("<i4")], axis=1)
            classes: dict[tuple[int, bytes], list] = {}
            for row, doc in enumerate(batch.column("doc_id").to_pylist()):
                if lengths[row]:
                    key = int(lengths[row]), bag[ends[row] : ends[row + 1]].tobytes()
                    classes.setdefault(key, []).append(doc)
            kind = batch.schema.field("doc_id").type
            least = [sorted(ids, key=lambda d: (d is None, d))[:top] for ids in classes.values()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([n for n, _ in classes], pa.int64()),
                    pa.array([b for _, b in classes], pa.binary()),
                    pa.array([len(ids) for ids in classes.values()], pa.int64()),
                    pa.array(least, pa.list_(kind)),
                ],
                ["n", "bag", "texts", "ids"],
            )

    return bags


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch, the texts that hold each term."""
    for batch in batches:
        terms, starts = _unpacked(batch.column("bag"))
        texts = np.repeat(batch.column("texts").to_numpy(), np.diff(starts))
        sums = np.bincount(terms[:, 0], weights=texts) if len(terms) else np.zeros(0)
        held = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int32()), pa.array(sums[held].astype(np.int64))], ["term", "texts"]
        )


def _unpacked(bags: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The (term, count) rows of all bags, and where each bag's begin and the last one's end."""
    plain = bags.to_pylist()
    starts = np.concatenate([[0], np.cumsum([len(b) // 8 for b in plain])]).astype(np.int64)
    return np.frombuffer(b"".join(plain), "<i4").reshape(-1, 2), starts


def _steps(batch: pa.RecordBatch, matches: np.ndarray, items: int) -> Iterator[pa.RecordBatch]:
    """The classes in runs of some `SCORES` scores and some `MATCHES` matches, or that have one class.

    `matches` are the items of each term.
    """
    step = max(1, SCORES // max(items, 1))
    for part in (batch.slice(low, step) for low in range(0, len(batch), step)):
        terms, starts = _unpacked(part.column("bag"))
        ends = np.concatenate([[0], np.cumsum(matches[terms[:, 0]])])[starts[1:]]
        start = 0
        while start < len(part):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + MATCHES, "right")))
            yield part.slice(start, stop - start)
            start = stop


def _rank(postings, weights: np.ndarray, item_ids: pa.Array, top: int, kind: pa.DataType):
    """Each task's best documents for every item, from one score per class and item.

    `postings` are the (item, count) pairs of each term, one after the other, and where they begin.
    """
    item_of, times, begins = postings
    items = len(item_ids)

    def scored(batch: pa.RecordBatch) -> np.ndarray:
        terms, starts = _unpacked(batch.column("bag"))
        row, term, tf = rows_of(starts), terms[:, 0].astype(np.int64), terms[:, 1].astype(np.int64)
        m = batch.column("m").to_numpy()[row]
        worth = weights[term] * (UNIT * tf // (1000 * tf + STEEP * m))
        place, ends = gather(np.arange(len(item_of)), begins, term)
        many = np.diff(ends)
        cell = np.repeat(row, many) * items + item_of[place]
        own = np.repeat(worth, many) * times[place]
        # Summed in two parts, each exact in a double.
        high, low = (np.bincount(cell, part, len(batch) * items).astype(np.int64) for part in (own >> 26, own & (1 << 26) - 1))
        return ((high << 26) + low).reshape(len(batch), items)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in range(items)]
        least = np.ones(items, np.int64)
        for part in (part for batch in batches for part in _steps(batch, np.diff(begins), items)):
            ids = part.column("ids").to_pylist()
            order = np.array(sorted(range(len(ids)), key=lambda c: _order(ids[c][0])))
            scores = scored(part)[order]
            for item in np.flatnonzero((scores >= least).any(axis=0)):
                own = scores[:, item]
                # A class comes in by its smallest id: `top` classes before it hold as many documents before its own.
                first = np.argsort(-own, kind="stable")[:top]
                found = [(-int(own[c]), *_order(d)) for c in first if own[c] >= least[item] for d in ids[order[c]]]
                best[item] = sorted(best[item] + found)[:top]
                if len(best[item]) == top:
                    least[item] = -best[item][-1][0]
        rows = [(item, *found) for item, own in enumerate(best) for found in own]
        numbers = pa.array([r[0] for r in rows], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                numbers,
                item_ids.take(numbers),
                pa.array([None if r[2] else r[3] for r in rows], kind),
                pa.array([-r[1] for r in rows], pa.int64()),
            ],
            ["item", "item_id", "doc_id", "score"],
        )

    return rank


def _order(doc) -> tuple:
    """Sorts ids, nulls last."""
    return doc is None, 0 if doc is None else doc


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        terms, starts = split_terms(batch.column("text"), LETTERS_AND_DIGITS)
        lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), terms.cast(pa.string()))
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), batch.column("text"), lists], ["item_id", "text", "terms"])


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    pass_terms: int = PASS_TERMS,
) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): each item's `top` documents with a score above 0.

    Equal scores go by ascending id, null ids last. Rows of `docs` with equal ids are documents of
    their own. Rows of `items` with equal id and text are one item; rows with equal id and different texts are each
    ranked by themselves. Null texts have no terms; items without known terms have no rows, and neither has
    anything when either table is empty. Other columns are not looked at.

    Documents shrink to the items' terms in the task that reads them, and equal ones merge there; the
    driver holds the items of one pass, of some `pass_terms` terms together, and a further
    pass over the documents takes the next ones. A class of equal bags and lengths keeps its `top` smallest ids,
    which meet over several keys first, and is scored once for all items; each task then gives its
    best `top` for every item.
    """
    wanted = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).distinct()
    item_kind = wanted.schema["item_id"].dataType.simpleString()
    wanted = durable(
        wanted.mapInArrow(_item_terms, f"item_id {item_kind}, text string, terms array<string>").filter(F.size("terms") > 0),
        "items",
    )
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    total = wanted.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    passes = math.ceil(total / pass_terms)
    out = f"item_id {item_kind}, rank int, doc_id {given.schema['doc_id'].dataType.simpleString()}, score long"
    ranked = docs.sparkSession.createDataFrame([], out)
    for number in range(passes):
        of_pass = F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == number
        part = wanted.filter(of_pass).select("item_id", "terms").toArrow()
        if len(part):
            ranked = ranked.unionByName(_one_pass(given, part, top))
    return ranked


def _one_pass(given: DataFrame, items: pa.Table, top: int) -> DataFrame:
    kind = given.schema["doc_id"].dataType.simpleString()
    terms = items["terms"].combine_chunks()
    encoded = terms.flatten().dictionary_encode()
    vocabulary = encoded.dictionary.cast(pa.large_string())
    size = len(items)
    pairs, times = np.unique(
        encoded.indices.to_numpy().astype(np.int64) * size + rows_of(terms.offsets.to_numpy() - terms.offsets[0].as_py()),
        return_counts=True,
    )
    begins = np.searchsorted(pairs, np.arange(len(vocabulary) + 1) * size)

    bags = durable(
        given.mapInArrow(_bags(vocabulary, top), f"n long, bag binary, texts long, ids array<{kind}>"), "bags"
    )
    count, length = bags.agg(F.coalesce(F.sum("texts"), F.lit(0)), F.coalesce(F.sum(F.col("n") * F.col("texts")), F.lit(0))).first()
    held = bags.select("bag", "texts").mapInArrow(_frequencies, "term int, texts long")
    held = held.groupBy("term").agg(F.sum("texts").alias("texts")).toArrow()
    frequency = np.zeros(len(vocabulary), np.int64)
    frequency[held["term"].to_numpy()] = held["texts"].to_numpy()
    weights = np.array([math.floor(1000 * math.log((2 * count + 2) / (2 * int(f) + 1))) for f in frequency], np.int64)

    wide = "decimal(38,0)"
    longer = F.call_function(
        "div", ((F.col("n") * LENGTH).cast("decimal(19,0)") * F.lit(count).cast("decimal(18,0)")).cast(wide), F.lit(max(length, 1)).cast(wide)
    )
    classes = bags.filter(F.length("bag") > 0).withColumn("m", longer + (100 - LENGTH))
    classes = classes.select(F.xxhash64("bag", "m").alias("hash"), "bag", "m", "ids")
    for slot in ([F.pmod(F.xxhash64("ids"), F.lit(SPREAD)).alias("slot")], []):
        least = F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, top)
        classes = classes.groupBy("hash", "bag", "m", *slot).agg(least.alias("ids"))
    item_ids = items["item_id"].combine_chunks()
    doc_kind = pa.int64() if kind == "bigint" else pa.string() if kind == "string" else pa.int32()
    found = classes.select("bag", "m", "ids").mapInArrow(
        _rank((pairs % size, times, begins), weights, item_ids, top, doc_kind),
        f"item int, item_id {_name_of(item_ids.type)}, doc_id {kind}, score long",
    )
    found = found.withColumn("slot", F.pmod(F.xxhash64("doc_id"), F.lit(SPREAD)))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for keys in (["item", "slot"], ["item"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= top)
    return found.select("item_id", "rank", "doc_id", "score")


def _name_of(kind: pa.DataType) -> str:
    return {pa.int64(): "bigint", pa.int32(): "int"}.get(kind, "string")
