"""Ranked lexical search by an Aho-Corasick scan of the documents.

The terms of all items go into one automaton. Each term carries a space at both
ends and the texts are scanned with every separator turned into a space, so that
only whole words match; two matches may share a space. The scan counts how often
each term occurs in each text straight from its bytes: no index of the documents
is made. A first scan adds up the document frequencies, a second one scores; the
automaton's outputs lead to the items that hold a term. Every task keeps the best
documents of each item, which lose nothing, and these are ranked.

The terms and their lists go to every task, which builds the automaton. Items are
dealt into lots whose terms are bounded in number and bytes; each lot is a search of
its own over all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opslake.llm.graph import cut
from opslake.llm.textkit import slices, texts_of, words_of

#: most terms (with repeats among items) and most bytes of terms in a lot of several items
LOT_TERMS, LOT_BYTES = 1 << 18, 4 << 20
#: parts in which an item's best documents are ranked first
PARTS = 64

#: what a byte of a term becomes: A-Z lower-cased, every other separator a space
_SPACED = bytes(0x20 if b < 0x80 and not (chr(b).isascii() and chr(b).isalnum()) else b + 32 if 65 <= b <= 90 else b
                for b in range(256))
_TERM = np.frombuffer(_SPACED, np.uint8) != 0x20


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term: the distinct terms of each item (of all rows of its id)."""
    spaced = F.regexp_replace(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
                              r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    return (items.select(F.col("item_id").cast("long").alias("item_id"), F.explode(F.split(spaced, " ")).alias("term"))
            .where("term <> '' and item_id is not null").distinct())


@dataclass
class Lot:
    """Terms with their items: those of term t are items[first[t]:first[t + 1]], as places in ``ids``."""

    terms: list[str]
    ids: np.ndarray
    first: np.ndarray
    items: np.ndarray


def _lots(items: DataFrame) -> Iterator[Lot]:
    """The items in lots of bounded size. Only the sizes of a bucket of items and the
    rows of one lot at a time come to the driver. One item whose own terms exceed the
    bound is a lot by itself."""
    terms = cut(item_terms(items))
    total = terms.agg(F.count("*").alias("n"), F.sum(F.octet_length("term")).alias("b")).first()
    number = max(1, -(-2 * total["n"] // LOT_TERMS), -(-2 * (total["b"] or 0) // LOT_BYTES))
    dealt = terms.withColumn("lot", F.pmod(F.xxhash64("item_id"), F.lit(number)))
    for lot in range(number):
        own = dealt.where(F.col("lot") == lot).select("item_id", "term")
        # an unlucky lot over the bound is taken item by item
        size = own.agg(F.count("*").alias("n"), F.sum(F.octet_length("term")).alias("b")).first() if number > 1 else total
        if size["n"] <= LOT_TERMS and (size["b"] or 0) <= LOT_BYTES:
            yield from _lot(own.toArrow())
        else:
            for row in own.select("item_id").distinct().sort("item_id").toLocalIterator():
                yield from _lot(own.where(F.col("item_id") == row["item_id"]).toArrow())


def _lot(rows: pa.Table) -> Iterator[Lot]:
    if not rows.num_rows:
        return
    ids, item = np.unique(rows.column("item_id").to_numpy(), return_inverse=True)
    terms = rows.column("term").combine_chunks().dictionary_encode()
    term = terms.indices.to_numpy(zero_copy_only=False)
    order = np.lexsort((item, term))
    first = np.concatenate(([0], np.cumsum(np.bincount(term)))).astype(np.int64)
    yield Lot(terms.dictionary.to_pylist(), ids, first, item[order].astype(np.int64))


def automaton(terms: list[str]):
    """Finds each term with a space at both ends; bytes are written as one letter each."""
    import ahocorasick
    a = ahocorasick.Automaton()
    for i, term in enumerate(terms):
        a.add_word(f" {term} ".encode("utf-8").decode("latin-1"), i)
    if len(a):
        a.make_automaton()
    return a


def count_terms(found, column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For an Arrow column of texts: the number of terms of each text, and (text,
    item term, occurrences) for each pair that occurs, by text and term."""
    texts = texts_of(column)
    spaced = np.frombuffer(_SPACED, np.uint8)[texts.data]
    texts = type(texts)(spaced, texts.starts, texts.null)
    words = words_of(texts, _TERM)
    n = np.diff(words.first)
    if not len(found):
        z = np.zeros(0, np.int64)
        return n, z, z, z
    data = spaced.tobytes()
    starts = texts.starts.tolist()
    # one space before, between and after the texts
    line = " " + " ".join(data[starts[i]:starts[i + 1]].decode("latin-1") for i in range(len(texts))) + " "
    hits = np.fromiter(chain.from_iterable(found.iter(line)), np.int64).reshape(-1, 2)
    begins = texts.starts[:-1] + 1 + np.arange(len(texts))
    # a match ends at the space after its term: at most at the space after its text
    text = np.searchsorted(begins, hits[:, 0] - 1, side="right") - 1
    width = len(found)
    pair, tf = np.unique(text * width + hits[:, 1], return_counts=True)
    return n, pair // width, pair % width, tf


def scores_of(lot: Lot, weights: np.ndarray, total: tuple[int, int], n: np.ndarray, text: np.ndarray, term: np.ndarray,
              tf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, text, score) of each pair with a score above 0; all in 64-bit integers."""
    count, length = total
    m = 50 + (50 * n.astype(np.int64) * count) // max(length, 1)
    part = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[text]))
    size = lot.first[term + 1] - lot.first[term]
    # each (text, term) meets the items that hold the term
    at = np.repeat(lot.first[term] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(int(size.sum()))
    key = np.repeat(text, size) * len(lot.ids) + lot.items[at]
    part = np.repeat(part, size)
    order = np.argsort(key, kind="stable")
    key, part = key[order], part[order]
    heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    score = np.add.reduceat(part, heads) if len(heads) else np.zeros(0, np.int64)
    key, score = key[heads][score > 0], score[score > 0]
    return key % len(lot.ids), key // len(lot.ids), score


def best_of(item: np.ndarray, doc: np.ndarray, known: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Which rows are among the ``k`` best of their item: highest score, then smallest
    doc, rows without a doc (known is False) last."""
    order = np.lexsort((doc, ~known, -score, item))
    heads = np.flatnonzero(np.concatenate(([True], item[order][1:] != item[order][:-1]))) if len(order) else order
    rank = np.arange(len(order)) - np.repeat(heads, np.diff(np.append(heads, len(order))))
    return order[rank < k]


def _frequencies(lot: Lot):
    """For the first scan: how many texts hold each term, with the number of texts
    that have terms and of all their terms as terms -2 and -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(lot.terms)
        df = np.zeros(len(lot.terms), np.int64)
        count = length = 0
        for batch in slices(batches, 1):
            n, _, term, _ = count_terms(found, batch.column(1))
            df += np.bincount(term, minlength=len(df))
            count, length = count + int((n > 0).sum()), length + int(n.sum())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-2, len(df))), pa.array(np.append([count, length], df))], ["term", "n"])

    return run


def _best(lot: Lot, weights: np.ndarray, total: tuple[int, int], k: int):
    """For the second scan: a task's ``k`` best documents of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(lot.terms)
        z = np.zeros(0, np.int64)
        best = [z, z, z.astype(bool), z]
        for batch in slices(batches, 1):
            item, text, s = scores_of(lot, weights, total, *count_terms(found, batch.column(1)))
            there = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            ids = batch.column(0).fill_null(0).to_numpy()
            best = [np.concatenate(p) for p in zip(best, (item, ids[text], there[text], s))]
            keep = best_of(*best, k)
            best = [p[keep] for p in best]
        item, doc, there, s = best
        yield pa.RecordBatch.from_arrays([pa.array(lot.ids[item]), pa.array(doc, mask=~there), pa.array(s)],
                                         ["item_id", "doc_id", "score"])

    return run


def lexical_search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's ``k`` highest-scoring
    documents with a score above 0, equal scores by ascending doc_id.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII, with
    A-Z lower-cased. A null text has none; neither items nor documents without terms
    get a row. Rows that repeat an item_id are one item with the terms of all, rows
    without one are left out. Each row of ``docs`` is a document, repeated ones too; a
    null doc_id stays null and comes last among equals. Other columns are ignored; an
    empty table on either side gives an empty one. ``ahocorasick`` must be present.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for lot in _lots(items):
        got = texts.mapInArrow(_frequencies(lot), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
        sums = np.zeros(len(lot.terms) + 2, np.int64)
        sums[got.column("term").to_numpy() + 2] = got.column("n").to_numpy()
        total, df = (int(sums[0]), int(sums[1])), sums[2:]
        weights = np.floor(1000 * np.log((2 * total[0] + 2) / (2 * df + 1))).astype(np.int64)
        found = texts.mapInArrow(_best(lot, weights, total, k), "item_id long, doc_id long, score long")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = docs.sparkSession.createDataFrame([], "item_id long, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))
    out = out.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "part").orderBy(*order)))
    out = out.where(F.col("rank") <= k).withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))
    return out.where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
