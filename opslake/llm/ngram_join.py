"""N-gram Jaccard join: which documents share at least a given part of their
distinct word n-grams, exactly, and the groups these links form.

1. ``word_counts``: how often each word occurs in all rows, summed in a table of
   fixed size. N-grams are ordered rare first by the product of their words'
   frequencies: an n-gram is at most as frequent as its rarest word, and words are
   few enough for a table that n-grams would overfill. Any fixed order gives the
   same links; a better one gives fewer candidates.
2. Documents with equal sets form a class; one of each class goes on, so a
   group of copies, however large, costs one row.
3. Prefix filter: two sets that are similar enough share an n-gram within the
   rarest ``n - ceil(t n) + 1`` of each. Documents are joined on these prefix
   n-grams. A short list gives its pairs that pass the length filter. A long one
   is dealt in blocks, each document in one, and a block returns only as many
   pairs as connect the same documents. Either way a pair must pass a bitmap
   filter: each set has the parity of its n-grams by cell, and the bits in which
   two sets differ bound their overlap from above.
4. ``deal_across``: where a list of several blocks is not connected by then, the
   documents of different components meet: those outside the largest component
   with its blocks, and with each other by bands of length. A group of near copies
   lies in several lists with blocks of their own and is connected before this
   step, so its rows grow in proportion to the group and not to its pairs.
   The components of all pairs are clusters that no link leaves.
5. Clusters are verified in the same two rounds: blocks (of two dealings, where
   there are several), then what is still apart. In a block the documents' n-grams are ordered rare first anew, joined on
   prefix n-grams under the length, positional and suffix filters, and each
   pair that is left, and not yet connected, is verified once by the exact
   intersection. Only links that connect something new are returned.
6. Connected components of these links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.llm.graph import Scratch, components
from opslake.llm.textkit import batch_shingles, batch_words, shingles_of, slices, texts_of

#: cells of the table of word frequencies
SKETCH_BITS = 21
#: documents and n-grams of one verification block
BLOCK_DOCS = 2048
BLOCK_GRAMS = 500_000
#: bytes of text that a task splits into words at once
SLICE = 2 << 20
#: bits of the filter that picks candidates' texts from the second scan
BLOOM_BITS = 23
#: a list up to this long gives its pairs; longer ones are dealt in blocks, and so, without
#: being gathered first, are those of n-grams of which every word is this frequent (above a cell's mean)
SHORT_LIST = 64
HOT_LIST = 20_000

_PART = 12


def _need(size, per_mille: int):
    """Smallest overlap with any set for a set of this size: ceil(t * size)."""
    return (size * per_mille + 999) // 1000


def _cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def word_counts(docs: DataFrame) -> np.ndarray:
    """Occurrences of all rows' words by cell (uint32, fixed size)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in slices(batches, 0, SLICE):
            total += np.bincount(_cell(batch_words(texts_of(batch.column(0)))[0]), minlength=len(total))
        cells = np.flatnonzero(total)
        edges = np.searchsorted(cells >> _PART, np.arange((1 << (SKETCH_BITS - _PART)) + 1))
        rows = [(p, (cells[a:b] & ((1 << _PART) - 1)).astype("<u2").tobytes(), total[cells[a:b]].astype("<i8").tobytes())
                for p, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if b > a]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()),
             pa.array([r[2] for r in rows], pa.binary())], ["part", "cells", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(1 << _PART, np.int64)
        for c, n in zip(table.column("cells").to_pylist(), table.column("counts").to_pylist()):
            total[np.frombuffer(c, "<u2")] += np.frombuffer(n, "<i8")
        return pa.table({"part": pa.array([table.column("part")[0].as_py()], pa.int32()),
                         "counts": pa.array([np.minimum(total, 0xFFFFFFFF).astype("<u4").tobytes()], pa.binary())})

    rows = (docs.select("text").mapInArrow(count, "part int, cells binary, counts binary")
            .groupBy("part").applyInArrow(add, "part int, counts binary").collect())
    out = np.zeros((1 << (SKETCH_BITS - _PART), 1 << _PART), np.uint32)
    for r in rows:  # at most 2**(SKETCH_BITS - _PART) rows
        out[r["part"]] = np.frombuffer(r["counts"], "<u4")
    return out.reshape(-1)


def prefixes(docs: DataFrame, k: int, per_mille: int, counts: np.ndarray) -> DataFrame:
    """doc_id, n (set size), s1, s2 (128 bits of the set), bits (parities by
    cell), prefix (rarest n-grams), hot (those of them whose words are all frequent)."""
    logs = np.log(np.maximum(counts, 1).astype(np.float64))
    limit = float(counts.mean()) + HOT_LIST

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, SLICE):
            hashes, first = batch_words(texts_of(batch.column(1)))
            cells = _cell(hashes)
            weight = logs[cells]
            common = np.concatenate(([0], np.cumsum(counts[cells] > limit)))
            sizes = np.zeros(batch.num_rows, np.int64)
            signs = np.zeros((batch.num_rows, 2), "<i8")
            cold, hot, bits = [_NONE] * batch.num_rows, [_NONE] * batch.num_rows, [b""] * batch.num_rows
            for i in range(batch.num_rows):
                a, b = int(first[i]), int(first[i + 1])
                if a == b:
                    continue
                s, rare = shingles_of(hashes[a:b], k, weight[a:b])
                sizes[i] = len(s)
                signs[i] = np.frombuffer(hashlib.blake2b(s.astype("<u8").tobytes(), digest_size=16).digest(), "<i8")
                bits[i] = parity_bits(s)
                p = len(s) - _need(len(s), per_mille) + 1
                head = s[np.lexsort((s, rare))[:p]] if p < len(s) else s  # ties by n-gram
                cold[i] = head
                span = min(k, b - a)
                if (common[a + span:b + 1] - common[a:b + 1 - span]).max() == span:  # an n-gram of frequent words only
                    whole = shingles_of(hashes[a:b], k, (counts[cells[a:b]] > limit).astype(np.float64))
                    frequent = whole[0][whole[1] == span]
                    is_hot = np.isin(head, frequent)
                    cold[i], hot[i] = head[~is_hot], head[is_hot]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array(signs[:, 0].copy()), pa.array(signs[:, 1].copy()),
                 pa.array(bits, pa.binary()), _lists(cold), _lists(hot)],
                ["doc_id", "n", "s1", "s2", "bits", "prefix", "hot"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n long, s1 long, s2 long, bits binary, prefix array<long>, hot array<long>")


_NONE = np.zeros(0, np.uint64)


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    flat = np.concatenate(rows) if rows else _NONE
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def parity_bits(grams: np.ndarray) -> bytes:
    """Parity of a set's n-grams by cell; one to two bits for each n-gram, 256 at least. With fewer, bits of sets that
    have nothing in common agree by chance often enough for a shared n-gram to join them: the clusters run together."""
    size = 1 << max(8, min(16, (len(grams) - 1).bit_length()))
    return np.packbits(np.bincount((grams & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1, bitorder="little").tobytes()


def _fold(bits: np.ndarray, size: int) -> np.ndarray:
    """Rows of parities over fewer cells."""
    while bits.shape[-1] > size:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def _may_link(n, bits: np.ndarray, sizes: np.ndarray, others: np.ndarray, per_mille: int) -> np.ndarray:
    """Length and bitmap filter of one set against others (bitmaps of one size), or of sets against one other each."""
    size = min(bits.shape[-1], others.shape[-1])
    apart = np.bitwise_count(_fold(others, size) ^ _fold(bits, size)).sum(axis=-1, dtype=np.int64)
    low, high = np.minimum(n, sizes), np.maximum(n, sizes)
    total = n + sizes
    # overlap <= (total - apart) / 2 must reach per_mille / (1000 + per_mille) * total
    return (low * 1000 >= high * per_mille) & ((total - apart) * (1000 + per_mille) >= 2 * per_mille * total)


def _may_link_pairs(n: np.ndarray, bits: list[bytes], others: np.ndarray, other_bits: list[bytes], per_mille: int) -> np.ndarray:
    """``_may_link`` for pairs, those of one pair of bitmap sizes at a time."""
    ok = np.zeros(len(n), bool)
    sizes = np.array([(len(x), len(y)) for x, y in zip(bits, other_bits)], np.int64).reshape(-1, 2)
    for x, y in np.unique(sizes, axis=0):
        at = np.flatnonzero((sizes == (x, y)).all(axis=1))
        a = np.frombuffer(b"".join(bits[i] for i in at.tolist()), np.uint8).reshape(len(at), x)
        b = np.frombuffer(b"".join(other_bits[i] for i in at.tolist()), np.uint8).reshape(len(at), y)
        ok[at] = _may_link(n[at], _fold(a, min(x, y)), others[at], b, per_mille)
    return ok


def _short_pairs(rows: DataFrame, per_mille: int) -> DataFrame:
    """(gram, n, doc) to pairs (a, b) of short lists, and to the rows of longer
    ones (gram, a; b null). A task streams its lists one after the other and holds
    SHORT_LIST rows of one at most."""

    def pairs(n: np.ndarray, doc: np.ndarray, first: np.ndarray, width: int):
        """Of all lists of one length, which begin at ``first``."""
        i, j = np.triu_indices(width, 1)
        x, y = first[:, None] + i[None, :], first[:, None] + j[None, :]
        ok = n[x] * 1000 >= n[y] * per_mille  # sorted by n
        return doc[x[ok]], doc[y[ok]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # rows of the last, unfinished list
        long_gram = None  # a list known to be long

        def emit(gram, n, doc, last: bool):
            nonlocal held, long_gram
            begin = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
            width = np.diff(np.concatenate((begin, [len(gram)])))
            is_long = width > SHORT_LIST
            if long_gram is not None and gram[0] == long_gram:
                is_long[0] = True
            done = np.ones(len(begin), bool)
            if not last:
                done[-1] = is_long[-1]
            out_a, out_b = [], []
            for w in np.unique(width[~is_long & done]):
                if w > 1:
                    a, b = pairs(n, doc, begin[(width == w) & ~is_long & done], int(w))
                    out_a.append(a)
                    out_b.append(b)
            if out_a:
                both = np.unique(np.stack((np.concatenate(out_a), np.concatenate(out_b)), 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.nulls(len(both), pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1])],
                                                 ["gram", "a", "b"])
            rest = np.repeat(is_long, width)
            if rest.any():
                yield pa.RecordBatch.from_arrays([pa.array(gram[rest]), pa.array(doc[rest]), pa.nulls(int(rest.sum()), pa.int64())],
                                                 ["gram", "a", "b"])
            long_gram = gram[-1] if is_long[-1] else None
            held = None if done[-1] else tuple(x[begin[-1]:] for x in (gram, n, doc))

        for batch in batches:
            if batch.num_rows:
                cols = [batch.column(i).to_numpy() for i in range(3)]
                if held is not None:
                    cols = [np.concatenate(x) for x in zip(held, cols)]
                yield from emit(*cols, last=False)
        if held is not None:
            yield from emit(*held, last=True)

    return (rows.select("gram", "n", "doc").repartition("gram").sortWithinPartitions("gram", "n", "doc")
            .mapInArrow(run, "gram long, a long, b long"))


def _spread(number, *columns) -> Column:
    """One of ``number`` blocks by the hash of the columns."""
    return F.pmod(F.xxhash64(*columns), number).cast("int")


def deal_across(rows: DataFrame, key: str, per_mille: int) -> DataFrame:
    """Deals documents of one key that are not connected yet. ``rows``: key, doc, n,
    label (component so far), load (share of a block). To key, kind, band, i, j, side, doc, n, label:
    in one group of (key, kind, band, i, j) meet documents of both sides.

    Every pair of different labels and similar length has a group. Documents outside
    the largest component go to its blocks (kind 0; those of a length to link with
    any of it), and meet each other within bands of length (kind 1: pairs of blocks,
    one side where i = j) and in neighbouring bands (kind 2). A band spans the ratio
    of lengths a link allows, so a link leads at most to the next band. Keys with one
    label are left out.
    """
    by_label = rows.groupBy(key, "label").agg(F.count("*").alias("c"), F.sum("load").alias("load"), F.min("n").alias("low"),
                                              F.max("n").alias("high"))
    main = (by_label.groupBy(key).agg(F.max(F.struct("c", "label", "load", "low", "high")).alias("m"), F.count("*").alias("labels"))
            .where("labels > 1").select(key, F.col("m.label").alias("m_label"), F.greatest(F.ceil("m.load"), F.lit(1)).alias("m_blocks"),
                                        F.col("m.low").alias("low"), F.col("m.high").alias("high")))
    ratio = float(np.log(1000 / per_mille)) * (1 + 1e-9) if per_mille < 1000 else 1e-9
    rows = rows.join(main, key).withColumn("band", F.floor(F.log("n") / ratio))
    near = (F.col("n") * 1000 >= F.col("low") * per_mille) & (F.col("high") * 1000 >= F.col("n") * per_mille)
    rest = rows.where("label <> m_label")

    def group(df: DataFrame, kind: int, band, i, j, side) -> DataFrame:
        return df.select(key, F.lit(kind).alias("kind"), band.cast("long").alias("band"), i.cast("int").alias("i"),
                         j.cast("int").alias("j"), side.cast("int").alias("side"), "doc", "n", "label")

    def every(number) -> Column:
        return F.explode(F.sequence(F.lit(0), number - 1))

    zero = F.lit(0)
    beside = rest.where(near).groupBy(key).agg(F.ceil(F.sum("load")).alias("o_blocks"))
    first = rows.where("label = m_label").join(beside, key)
    second = rest.where(near).join(beside, key)
    out = group(first.withColumn("o", every(F.col("o_blocks"))), 0, zero, _spread(F.col("m_blocks"), "doc", key), F.col("o"), zero)
    out = out.unionByName(group(second.withColumn("o", every(F.col("m_blocks"))), 0, zero, F.col("o"),
                                _spread(F.col("o_blocks"), "doc", key), F.lit(1)))
    bands = rest.groupBy(key, "band").agg(F.ceil(F.sum("load")).alias("blocks"))
    rest = rest.join(bands, [key, "band"]).withColumn("own", _spread(F.col("blocks"), "doc", key))
    out = out.unionByName(group(rest.withColumn("o", every(F.col("blocks"))), 1, F.col("band"), F.least("own", "o"),
                                F.greatest("own", "o"), F.col("own") > F.col("o")))
    above = bands.select(key, (F.col("band") - 1).alias("band"), F.col("blocks").alias("others"))
    below = bands.select(key, (F.col("band") + 1).alias("band"), F.col("blocks").alias("others"))
    out = out.unionByName(group(rest.join(above, [key, "band"]).withColumn("o", every(F.col("others"))), 2, F.col("band"),
                                F.col("own"), F.col("o"), zero))
    return out.unionByName(group(rest.join(below, [key, "band"]).withColumn("o", every(F.col("others"))), 2, F.col("band") - 1,
                                 F.col("o"), F.col("own"), F.lit(1)))


_GROUP = ["kind", "band", "i", "j"]


def _cross(table: pa.Table) -> bool:
    """Whether only documents of different sides meet in a group."""
    return table.column("kind")[0].as_py() != 1 or table.column("i")[0].as_py() != table.column("j")[0].as_py()


def _alone(df: DataFrame, i: Column) -> DataFrame:
    """Rows for the first round: block ``i``, in which all meet."""
    return df.withColumn("kind", F.lit(1)).withColumn("band", F.lit(0).cast("long")).withColumn("i", i).withColumn(
        "j", F.col("i")).withColumn("side", F.lit(0)).withColumn("label", F.col("doc"))


def candidate_edges(reps: DataFrame, per_mille: int, scratch: Scratch) -> DataFrame:
    """Edges (a, b) whose components contain every pair that shares a prefix
    n-gram and passes the length and the bitmap filter. ``reps``: doc, n, bits,
    prefix, hot."""
    found = scratch.keep(_short_pairs(reps.select("doc", "n", F.explode("prefix").alias("gram")), per_mille).distinct())
    bits = reps.select("doc", "n", "bits")
    near = (found.where("b is not null").select("a", "b").distinct()
            .join(bits.toDF("a", "n1", "bits1"), "a").join(bits.toDF("b", "n2", "bits2"), "b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = _may_link_pairs(batch.column(2).to_numpy(), batch.column(3).to_pylist(), batch.column(4).to_numpy(),
                                 batch.column(5).to_pylist(), per_mille)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok))

    pairs = near.select("a", "b", "n1", "bits1", "n2", "bits2").mapInArrow(check, "a long, b long")
    long_rows = found.where("b is null").select("gram", F.col("a").alias("doc")).unionByName(
        reps.select(F.explode("hot").alias("gram"), "doc"))

    def connect(table: pa.Table) -> pa.Table:
        a, b = connect_block(table.column("doc").to_numpy(), table.column("n").to_numpy(),
                             table.column("bits").to_pylist(), table.column("side").to_numpy(),
                             per_mille, cross=_cross(table), label=table.column("label").to_numpy())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    lists = long_rows.groupBy("gram").agg(F.ceil(F.count("*") / BLOCK_DOCS).cast("int").alias("blocks"))
    dealt = _alone(long_rows.join(lists, "gram"), _spread(F.col("blocks"), "doc", "gram")).drop("blocks")
    linked = dealt.join(bits, "doc").groupBy("gram", *_GROUP).applyInArrow(connect, "a long, b long")
    edges = scratch.keep(pairs.unionByName(linked).distinct())
    wide = scratch.keep(lists.where("blocks > 1").select("gram"))
    if not wide.isEmpty():
        label = components(edges, scratch=scratch)
        apart = (long_rows.join(wide, "gram", "left_semi").join(label.toDF("doc", "component"), "doc", "left")
                 .join(reps.select("doc", "n"), "doc")
                 .select("gram", "doc", "n", F.coalesce("component", "doc").alias("label"), F.lit(1 / BLOCK_DOCS).alias("load")))
        dealt = deal_across(scratch.keep(apart), "gram", per_mille).join(bits.select("doc", "bits"), "doc")
        more = dealt.groupBy("gram", *_GROUP).applyInArrow(connect, "a long, b long")
        edges = edges.unionByName(scratch.keep(more.distinct()))
    scratch.drop(found)
    return edges


def connect_block(docs: np.ndarray, n: np.ndarray, bits: list[bytes], side: np.ndarray, per_mille: int, cross: bool,
                  label: np.ndarray | None = None):
    """Pairs of one block of a list that pass the length and bitmap filter, as few as connect the same
    documents. Those of one ``label`` are connected already."""
    order = np.lexsort((docs, n))
    docs, n, side = docs[order], n[order], side[order]
    rows = [np.frombuffer(bits[i], np.uint8) for i in order.tolist()]
    least = min(len(r) for r in rows)
    # sizes of bitmaps grow with n, and a set meets only sets nearly as large: each row is folded to that of its smallest partner
    folded: dict[int, np.ndarray] = {}
    for size in {len(r) for r in rows}:
        folded[size] = np.stack([_fold(r, size) if len(r) >= size else np.zeros(size, np.uint8) for r in rows])
    label = np.arange(len(docs)) if label is None else np.unique(label[order], return_inverse=True)[1]
    a, b = [], []
    for j in range(1, len(docs)):
        first = int(np.searchsorted(n[:j] * 1000, n[j] * per_mille))
        open_ = np.flatnonzero(label[first:j] != label[j]) + first
        if cross:
            open_ = open_[side[open_] != side[j]]
        if not len(open_):
            continue
        size = max(least, len(rows[open_[0]]))  # the smallest partner's
        ok = open_[_may_link(int(n[j]), rows[j], n[open_], folded[size][open_], per_mille)]
        for i in ok.tolist():
            if label[i] != label[j]:
                a.append(int(docs[i]))
                b.append(int(docs[j]))
                label[label == label[i]] = label[j]
    return a, b


def block_links(sets: list[np.ndarray], side: np.ndarray, per_mille: int, cross: bool,
                label: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links of one block, as few as connect the same documents: (i, j) indexes.

    cross: only pairs of which one document has side 0 and the other 1. Documents
    of one ``label`` are connected already.
    """
    m = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if m else np.zeros(0, np.uint64)
    grams, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.empty(len(grams), np.int64)
    rank[np.lexsort((grams, counts))] = np.arange(len(grams))  # rare first within the block
    owner = np.repeat(np.arange(m), sizes)
    key = np.sort(owner * len(grams) + rank[inverse]) if m else np.zeros(0, np.int64)
    ranks = key % max(len(grams), 1)
    first = np.concatenate(([0], np.cumsum(sizes)))
    prefix = np.where(sizes > 0, sizes - _need(sizes, per_mille) + 1, 0)
    at = np.arange(len(ranks)) - first[owner]
    inside = at < prefix[owner]
    # lists of the prefix n-grams: rank, document, position
    o = np.argsort(ranks[inside], kind="stable")
    list_rank, list_doc, list_at = ranks[inside][o], owner[inside][o], at[inside][o]
    label = np.arange(m) if label is None else np.unique(label, return_inverse=True)[1]
    marks = np.zeros(len(grams), bool)
    links: list[tuple[int, int]] = []
    order = np.lexsort((np.arange(m), sizes))
    place = np.empty(m, np.int64)
    place[order] = np.arange(m)
    for i in order.tolist():
        n = int(sizes[i])
        if not n:
            continue
        own = ranks[first[i]:first[i + 1]]
        head = own[:prefix[i]]
        lo, hi = np.searchsorted(list_rank, head), np.searchsorted(list_rank, head, side="right")
        width = hi - lo
        total = int(width.sum())
        if total == len(head):
            continue  # only its own entries
        pick = np.repeat(lo - np.concatenate(([0], np.cumsum(width)[:-1])), width) + np.arange(total)
        j, pos = list_doc[pick], list_at[pick]
        mine = np.repeat(np.arange(len(head)), width)
        # once a pair: the partner is smaller (or came before); length filter; not connected yet
        keep = (place[j] < place[i]) & (sizes[j] * 1000 >= n * per_mille) & (label[j] != label[i])
        if cross:
            keep &= side[j] != side[i]
        if not keep.any():
            continue
        j, pos, mine = j[keep], pos[keep], mine[keep]
        j, where = np.unique(j, return_index=True)  # the first, so rarest, common prefix n-gram of each pair
        pos, mine = pos[where], mine[where]
        size = sizes[j]
        need = (per_mille * (n + size) + 999 + per_mille) // (1000 + per_mille)  # smallest overlap of a link
        # positional filter: what can still match from this n-gram on
        keep = 1 + np.minimum(n - mine - 1, size - pos - 1) >= need
        # suffix filter: the parts below and above the middle of the own suffix match at most as far as both have them
        j, pos, mine, size, need = j[keep], pos[keep], mine[keep], size[keep], need[keep]
        if not len(j):
            continue
        mid = np.minimum((mine + 1 + n) // 2, n - 1)
        pivot = own[mid]
        cutj = np.searchsorted(key, j * len(grams) + pivot) - first[j]
        below = np.minimum(np.maximum(mid - mine - 1, 0), np.maximum(cutj - pos - 1, 0))
        above = np.minimum(n - mid, size - cutj)
        keep = 1 + below + above >= need
        j, size, need = j[keep], size[keep], need[keep]
        if not len(j):
            continue
        marks[own] = True
        begin = 0
        while begin < len(j):  # in parts of bounded size
            some = j[begin:begin + 4096]
            some = some[label[some] != label[i]]
            begin += 4096
            if not len(some):
                continue
            w = sizes[some]
            ends = np.cumsum(w)
            idx = np.repeat(first[some] - np.concatenate(([0], ends[:-1])), w) + np.arange(int(ends[-1]))
            both = np.add.reduceat(marks[ranks[idx]].astype(np.int64), np.concatenate(([0], ends[:-1])))
            for x in some[both * 1000 >= per_mille * (n + w - both)].tolist():
                if label[x] != label[i]:
                    links.append((i, x))
                    label[label == label[x]] = label[i]
        marks[own] = False
    return links


def _bloom(ids: DataFrame) -> bytes:
    """Bits set for the ids, merged by bit_or; a fixed size."""
    h = F.pmod(F.xxhash64("doc"), F.lit(1 << BLOOM_BITS))
    rows = (ids.select(h.alias("h")).selectExpr("shiftright(h, 6) w", "shiftleft(1L, int(h & 63)) b")
            .groupBy("w").agg(F.bit_or("b").alias("b")).collect())  # at most 2**BLOOM_BITS / 64 rows
    out = np.zeros((1 << BLOOM_BITS) // 64, "<i8")
    for r in rows:
        out[r["w"]] = r["b"]
    return out.tobytes()


def _may_be(bits: Column, doc: Column) -> Column:
    h = F.pmod(F.xxhash64(doc), F.lit(1 << BLOOM_BITS))
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(h, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (F.pmod(h, F.lit(8)) + 1).cast("int"))) != 0


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is not in ``gone`` (doc: distinct long); null ids stay. Only rows that a
    bitmap of the ids lets through are dealt to the join, so most texts stay where they are read."""
    ident = F.col("doc_id").cast("long")
    bits = docs.sparkSession.createDataFrame([(_bloom(gone),)], "bits binary").scalar()
    maybe = F.coalesce(_may_be(bits, ident), F.lit(False))
    rest = docs.where(maybe)
    return docs.where(~maybe).unionByName(rest.join(gone, rest["doc_id"].cast("long") == gone["doc"], "left_anti"))


def links(docs: DataFrame, heads: DataFrame, k: int, per_mille: int, scratch: Scratch) -> DataFrame:
    """Verified links (a, b) between class representatives, as few as connect
    them. ``docs``: doc_id, text; ``heads``: doc, n, bits, prefix, hot of representatives."""
    cluster = components(candidate_edges(heads, per_mille, scratch), scratch=scratch)
    member = scratch.keep(cluster.join(heads.select(F.col("doc").alias("node"), "n").distinct(), "node")
                          .select(F.col("node").alias("doc"), "component", "n", F.greatest(
                              F.lit(1 / BLOCK_DOCS), F.col("n") / BLOCK_GRAMS).alias("load")))

    def verify(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids = table.column("doc").to_numpy()
        sets = batch_shingles(texts_of(table.column("text")), k)
        found = block_links(sets, table.column("side").to_numpy(), per_mille, _cross(table), table.column("label").to_numpy())
        a = np.array([x for x, _ in found], np.int64)
        b = np.array([y for _, y in found], np.int64)
        return pa.table({"a": pa.array(ids[a]), "b": pa.array(ids[b])})

    def verified(dealt: DataFrame, among: DataFrame) -> DataFrame:
        # a value of the plan, not a part of its text
        bits = docs.sparkSession.createDataFrame([(_bloom(among.select("doc")),)], "bits binary").scalar()
        some = docs.where(F.col("doc_id").isNotNull() & _may_be(bits, F.col("doc_id"))).select(F.col("doc_id").alias("doc"), "text")
        return scratch.keep(dealt.join(some, "doc").groupBy("component", "salt", *_GROUP).applyInArrow(verify, "a long, b long"))

    blocks = member.groupBy("component").agg(F.ceil(F.sum("load")).cast("int").alias("blocks"))
    # a cluster of several blocks is dealt twice, so that its blocks overlap
    twice = F.explode(F.when(F.col("blocks") > 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    first = member.join(blocks, "component").withColumn("salt", twice)
    first = _alone(first, _spread(F.col("blocks"), "doc", "salt")).drop("blocks", "n", "load")
    found = verified(first, member)
    wide = scratch.keep(blocks.where("blocks > 1").select("component"))
    if wide.isEmpty():
        return found
    label = components(found, scratch=scratch).toDF("doc", "label")
    apart = (member.join(wide, "component", "left_semi").join(label, "doc", "left")
             .select("component", "doc", "n", "load", F.coalesce("label", "doc").alias("label")))
    dealt = scratch.keep(deal_across(scratch.keep(apart), "component", per_mille).withColumn("salt", F.lit(0)).drop("n"))
    return found if dealt.isEmpty() else found.unionByName(verified(dealt, dealt.select("doc").distinct()))


def ngram_join(docs: DataFrame, k: int = 5, per_mille: int = 800) -> DataFrame:
    """doc_id, n_shingles, component_id, class_id for every row of ``docs``.

    Words are the maximal runs of characters other than space and U+0009 to
    U+000D, with A-Z lower-cased; a document's set holds its distinct ``k``-word
    shingles (fewer words: the whole sequence as one). Documents link when
    intersection >= per_mille / 1000 * union. component_id is the smallest
    doc_id reachable by links, itself included; class_id the smallest doc_id
    with the same set.

    Null, empty and blank texts have no shingle and link with nothing: both ids
    are their own. Rows with a null doc_id keep their count, take part in no
    link and have null ids. Repeated rows each come back, in one group; rows
    that share a doc_id but not the text count as one document for links.
    Other columns are ignored. An empty table gives an empty table.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scratch = Scratch(docs.sparkSession)
    rows = scratch.keep(prefixes(docs, k, per_mille, word_counts(docs)))
    numbered = rows.withColumn("row", F.monotonically_increasing_id())  # fixed: the rows are written
    classes = scratch.keep(numbered.where("n > 0 and doc_id is not null").groupBy("s1", "s2")
                           .agg(F.min(F.struct("doc_id", "row")).alias("first"))
                           .select("s1", "s2", F.col("first.doc_id").alias("class_id"), F.col("first.row").alias("row")))
    # one head a class, also where its first row is repeated
    heads = scratch.keep(numbered.join(classes.select("row"), "row").select(F.col("doc_id").alias("doc"), "n", "bits", "prefix", "hot"))
    # copies reach each other by their class, rows of one doc_id by that id
    own = scratch.keep(rows.select("doc_id", "n", "s1", "s2").join(classes.drop("row"), ["s1", "s2"], "left")
                       .select("doc_id", "n", F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id")))
    scratch.drop(rows, classes)
    found = Scratch(docs.sparkSession)  # what the result reads
    group = components(links(docs, heads, k, per_mille, scratch), scratch=found)
    own = found.keep(own)
    scratch.close()
    return (own.join(group.withColumnRenamed("node", "class_id"), "class_id", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "class_id")).alias("component_id"),
                    F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id")))
