"""Best-fit packing of tokenised documents by a grouping genetic algorithm.

Pieces of documents are dealt into blocks of bounded size. Every block is
evolved on several islands, each a Spark group with a population of its own: a
crossover injects whole well-filled bins of one parent into the other, bins that
hold a document twice are dissolved, and the displaced documents are best-fitted.
After an epoch each island sends its elite to the next one in a ring (a shuffle). The worst-filled bins
of neighbouring blocks then meet in a last round.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opslake.llm.graph import cut

#: tokens of a sequence, and the id that ends a document
CAPACITY, END_ID = 1024, 2
#: pieces of a block, islands, epochs, generations of an epoch, individuals of an island
BLOCK, ISLANDS, EPOCHS, GENERATIONS, POPULATION = 4096, 3, 2, 24, 6
#: blocks of which the worst-filled bins meet in the last round, and bins each sends
NEIGHBOURS, LOOSE = 16, 128

# fixed value: how byte-level vocabularies of this kind split a text before merging
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WIDE = re.compile("[^\x00-\u024f]")
_workers: dict[str, Encoder] = {}


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """A text's token ids as little-endian unsigned 32-bit numbers.

    The ids are those of the tokenizer file. Where its merges are in the order
    of the ids they make, merging by least id gives the same ids, and tiktoken
    does that many times faster; it takes texts whose characters both libraries
    class alike (up to U+024F) and that hold no added token's string, tokenizers all
    others and other files.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.exact = Tokenizer.from_file(path)
        #: strings that the tokenizer takes as one token wherever they stand
        self.added = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        self.fast = _ranked(path)

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if (self.fast is not None and (text.isascii() or not _WIDE.search(text))
                and not any(t in text for t in self.added)):
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
        return np.asarray(self.exact.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def _ranked(path: str):
    """The same vocabulary as ranks, or None where that could differ."""
    import json

    import tiktoken
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (model.get("type") == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex")
             and not split.get("add_prefix_space") and not spec.get("normalizer") and not model.get("dropout")
             and not model.get("ignore_merges"))
    if not plain:
        return None
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = [model["vocab"].get(a + b, -1) for a, b in pairs]
    added = {t["content"] for t in spec.get("added_tokens", [])}
    back = {c: b for b, c in _byte_letters().items()}
    base = [i for t, i in model["vocab"].items() if len(t) == 1 and t not in added]
    if made != sorted(made) or len(set(made)) != len(made) or len(base) != 256 or max(base) > min(made, default=256):
        return None
    ranks = {bytes(back[c] for c in t): i for t, i in model["vocab"].items() if t not in added}
    return tiktoken.Encoding("ranked", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})


def _byte_letters() -> dict[int, str]:
    """The printable letter by which a byte-level vocabulary writes each byte."""
    seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out = {b: chr(b) for b in seen}
    out.update({b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in out)})
    return out


def encoder(path: str) -> Encoder:
    """One for each worker process."""
    if path not in _workers:
        _workers[path] = Encoder(path)
    return _workers[path]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 for each piece. A document is its
    ids and END_ID; one longer than ``capacity`` is cut so that all pieces but the
    first are full."""
    end = np.asarray([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0), batch.column(1)):
                doc, ids = doc.as_py(), encode(text.as_py() or "") + end
                n = len(ids) // 4
                start, length = 0, n % capacity or capacity
                for piece in range(-(-n // capacity)):
                    out.append((doc, piece, start, length, zlib.crc32(ids[4 * start:4 * (start + length)])))
                    start, length = start + length, capacity
            cols = list(zip(*out)) or [()] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long"))


# --- one block -----------------------------------------------------------------

def _fit(items: np.ndarray, lengths: np.ndarray, bins: np.ndarray, room: list[int], capacity: int) -> None:
    """Best-fits ``items`` in their order into bins with ``room`` (extended in place)."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for b, r in enumerate(room):
        if r > 0:
            by_room[r].append(b)
            mask |= 1 << r
    for i in items.tolist():
        need = int(lengths[i])
        above = mask >> need
        if above:
            r = need + (above & -above).bit_length() - 1  # the least room that is enough
            b = by_room[r].pop()
            if not by_room[r]:
                mask ^= 1 << r
        else:
            b, r = len(room), capacity
            room.append(capacity)
        bins[i] = b
        r -= need
        room[b] = r
        if r:
            by_room[r].append(b)
            mask |= 1 << r


def _renumber(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1].astype(np.int64)


def fitness(bins: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[float, float]:
    """Fewer bins first, then the fuller the full ones are."""
    fill = np.bincount(bins, weights=lengths) / capacity
    return -float(len(fill)), float((fill * fill).sum())


def least_bins(lengths: np.ndarray, capacity: int) -> int:
    """A lower bound: total length, and for each a the pieces over capacity - a,
    which share a bin with none of at least a, with what the others leave."""
    best = -(-int(lengths.sum()) // capacity)
    count = np.bincount(lengths, minlength=capacity + 1)
    total = np.cumsum(count * np.arange(capacity + 1))
    many = np.cumsum(count)
    for a in range(1, capacity // 2 + 1):
        big = int(many[capacity] - many[capacity - a])
        mid_sum = int(total[capacity - a] - total[capacity // 2])
        mid = int(many[capacity - a] - many[capacity // 2])
        small = int(total[capacity // 2] - total[a - 1])
        best = max(best, big + mid + max(0, -(-(small - (mid * capacity - mid_sum)) // capacity)))
    return best


def _cross(a: np.ndarray, b: np.ndarray, lengths: np.ndarray, capacity: int, rng) -> np.ndarray:
    """Some of b's well-filled bins go into a; a's bins that share a piece with them are dissolved."""
    fill = np.bincount(b, weights=lengths)
    good = np.argsort(-fill, kind="stable")[:max(1, len(fill) // 2)]
    chosen = np.zeros(len(fill), bool)
    chosen[good[rng.random(len(good)) < 0.5]] = True
    injected = chosen[b]
    broken = np.zeros(int(a.max()) + 1, bool)
    broken[a[injected]] = True
    worst = np.argsort(np.bincount(a, weights=lengths), kind="stable")[:max(1, len(broken) // 50)]
    broken[worst] = True  # mutation: the emptiest bins are dissolved as well
    kept = ~broken[a] & ~injected
    child = np.full(len(a), -1, np.int64)
    child[kept] = a[kept]
    child[injected] = b[injected] + len(broken)
    placed = child >= 0
    child[placed] = _renumber(child[placed])
    room = (capacity - np.bincount(child[placed], weights=lengths[placed])).astype(int).tolist() if placed.any() else []
    loose = np.flatnonzero(~placed)
    _fit(loose[np.argsort(-lengths[loose], kind="stable")], lengths, child, room, capacity)
    return child


def evolve(lengths: np.ndarray, elites: list[np.ndarray], capacity: int, seed: int,
           generations: int = GENERATIONS, population: int = POPULATION) -> np.ndarray:
    """The best grouping found from ``elites`` and random ones; ends when none can have fewer bins."""
    rng = np.random.default_rng(seed)
    least = least_bins(lengths, capacity)
    people = [_renumber(e) for e in elites]
    if not people:
        first = np.empty(len(lengths), np.int64)
        _fit(np.argsort(-lengths, kind="stable"), lengths, first, [], capacity)
        people.append(first)

    def score(p):
        return fitness(p, lengths, capacity)

    if max(-score(p)[0] for p in people) <= least or min(-score(p)[0] for p in people) <= least:
        return max(people, key=score)
    while len(people) < population:
        # best fit of pieces in falling order, with some noise in the order
        noisy = np.argsort(-(lengths * (1 + 0.1 * rng.random(len(lengths)))), kind="stable")
        new = np.empty(len(lengths), np.int64)
        _fit(noisy, lengths, new, [], capacity)
        people.append(new)
    for _ in range(generations):
        people.sort(key=score, reverse=True)
        if -score(people[0])[0] <= least:
            break
        a, b = people[0], people[1 + int(rng.integers(len(people) - 1))]
        children = [_cross(a, b, lengths, capacity, rng), _cross(b, a, lengths, capacity, rng)]
        people = sorted([*people, *children], key=score, reverse=True)[:population]
    return max(people, key=score)


# --- all blocks ----------------------------------------------------------------

_STATE = "block long, island int, uid binary, length binary, bins binary"


def _pack_blocks(items: DataFrame, capacity: int, seeded: bool) -> DataFrame:
    """``items`` (block, uid, length, bin) to one row of state for each block.
    seeded: ``bin`` is a grouping to start from."""

    def begin(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("uid")
        start = _renumber(rows["bin"].to_numpy(np.int64)).astype("<i4").tobytes() if seeded else b""
        state = (rows["uid"].to_numpy("<i8").tobytes(), rows["length"].to_numpy("<i4").tobytes(), start)
        return pd.DataFrame([(key[0], i, *state) for i in range(ISLANDS)], columns=["block", "island", "uid", "length", "bins"])

    def epoch(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        lengths = np.frombuffer(rows["length"].iloc[0], "<i4").astype(np.int64)
        elites = [np.frombuffer(b, "<i4").astype(np.int64) for b in sorted(set(rows["bins"])) if b]
        best = evolve(lengths, elites, capacity, seed=int(key[0] * 31 + key[1]) & 0x7FFFFFFF)
        return pd.DataFrame({"block": [key[0]], "island": [key[1]], "uid": [rows["uid"].iloc[0]],
                             "length": [rows["length"].iloc[0]], "bins": [best.astype("<i4").tobytes()]})

    def last(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        lengths = np.frombuffer(rows["length"].iloc[0], "<i4").astype(np.int64)
        best = max(sorted(set(rows["bins"])), key=lambda b: fitness(np.frombuffer(b, "<i4"), lengths, capacity))
        uid = np.frombuffer(rows["uid"].iloc[0], "<i8")
        bins = np.frombuffer(best, "<i4").astype(np.int64)
        fill = np.bincount(bins, weights=lengths).astype(np.int64)
        order = np.argsort(fill, kind="stable")
        rank = np.empty(len(fill), np.int64)
        rank[order] = np.arange(len(fill))
        return pd.DataFrame({"block": key[0], "uid": uid, "length": lengths, "bin": bins,
                             "loose": (rank[bins] < LOOSE) & (fill[bins] < capacity)})

    state = items.groupBy("block").applyInPandas(begin, _STATE)
    for i in range(EPOCHS):
        if i:  # elites migrate one way: an island's next epoch also has the elite of the island before it
            moved = F.explode(F.array(F.col("island"), F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int")))
            state = state.withColumn("to", moved).drop("island").withColumnRenamed("to", "island")
        state = state.groupBy("block", "island").applyInPandas(epoch, _STATE)
    return state.groupBy("block").applyInPandas(last, "block long, uid long, length long, bin long, loose boolean")


def pack(parts: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """``parts``: any columns with length (1 to capacity). Adds sequence_id and
    offset; the pieces of a sequence hold at most ``capacity`` tokens."""
    parts = cut(parts.withColumn("_uid", F.monotonically_increasing_id()))  # fixed once it is written
    small = parts.where(F.col("length") < capacity)
    blocks = max(1, -(-small.count() // block))
    items = small.select(F.pmod(F.xxhash64("_uid"), F.lit(blocks)).alias("block"), F.col("_uid").alias("uid"), "length",
                         F.lit(0).cast("long").alias("bin"))
    first = cut(_pack_blocks(items, capacity, seeded=False))
    done = first.where("not loose").select("uid", (F.col("block") * F.lit(1 << 20) + F.col("bin")).alias("sequence_id"))
    loose = first.where("loose").select(
        F.floor(F.col("block") / NEIGHBOURS).cast("long").alias("block"), "uid", "length",
        (F.pmod("block", F.lit(NEIGHBOURS)) * F.lit(1 << 20) + F.col("bin")).alias("bin"))
    second = _pack_blocks(loose, capacity, seeded=True).select(
        "uid", (F.lit(1 << 61) + F.col("block") * F.lit(1 << 25) + F.col("bin")).alias("sequence_id"))
    found = done.unionByName(second).withColumnRenamed("uid", "_uid")
    small = small.join(found, "_uid")
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "_uid").rowsBetween(Window.unboundedPreceding, -1)
    small = small.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    full = parts.where(F.col("length") >= capacity).withColumn("sequence_id", F.lit(1 << 62) + F.col("_uid")).withColumn(
        "offset", F.lit(0).cast("long"))
    return small.unionByName(full).drop("_uid")


def best_fit_packing(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece
    of each row of ``docs``.

    A null or empty text is the end id alone, one piece of one token. A special
    token's string in a text is what the tokenizer as loaded makes of it: its id. Null doc_ids stay null and are
    packed like others; repeated rows are packed each. Other columns are ignored;
    an empty table gives an empty one.
    """
    parts = pieces(docs.select("doc_id", "text"), tokenizer or default_tokenizer(), capacity)
    return pack(parts, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
