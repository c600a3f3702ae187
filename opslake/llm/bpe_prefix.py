"""Byte-level BPE encoding and decoding by a dynamic programme over prefixes.

A text is split into pieces by the vocabulary's pattern. For each byte prefix of
a piece one number is stored: the last token of the prefix's encoding. There is
exactly one token that ends there and fits the last token of the prefix before
it; "fits" means that merging the two tokens' bytes gives the two tokens again.
The ids are read off backwards from the last prefix.

Since a prefix's number depends on the prefix alone, bytes can be appended by
going on from the stored numbers, and after an edit only the numbers from the
edit up to where they agree with the old ones again are computed anew.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.llm.textkit import slices

#: entries of a worker's memory of pieces, and of pairs of tokens
REMEMBERED, PAIRS = 1 << 18, 1 << 17
#: characters of a piece that is remembered
SHORT = 64
_workers: dict[tuple[str, str], Vocabulary] = {}


def default_ranks() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


class Recent(dict):
    """Values by key, computed when they are first asked for. Those of the last one to
    two times ``size`` keys stay."""

    def __init__(self, compute, size: int):
        self.compute, self.size, self.before = compute, size, {}

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.size:
            self.before = dict(self)
            self.clear()
        self[key] = value
        return value


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}


def tokens_by_rank(ranks: dict[bytes, int]) -> list[bytes]:
    out = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


def decode(tokens: list[bytes], ids: bytes) -> bytes:
    """The bytes of little-endian unsigned 32-bit ids."""
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class Vocabulary:
    """Tokens by rank, and how the merges make each of them."""

    def __init__(self, path: str, pattern: str):
        import regex
        self.ranks = read_ranks(path)
        self.split = regex.compile(pattern).findall
        self.bytes_of = tokens_by_rank(self.ranks)
        self.size_of = list(map(len, self.bytes_of))
        self.longest = max(map(len, self.ranks), default=1)
        #: tokens that merging their own bytes makes, and the two tokens of the last merge
        self.made: dict[bytes, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for token, rank in self.ranks.items():
            steps = self.merged(token)
            if len(steps[-1]) == 1:
                self.made[token] = rank
                if len(steps) > 1:
                    self.halves[rank] = (steps[-2][0], steps[-2][1])
        self._left: dict[int, list[tuple[int, int]]] = {}
        self._right: dict[int, list[tuple[int, int]]] = {}
        self._fits: dict[int, bool] = {}
        self._pieces = Recent(self.piece, REMEMBERED)
        import ahocorasick
        self._ends = ahocorasick.Automaton()
        for token, rank in self.made.items():
            self._ends.add_word(token.decode("latin-1"), (rank, len(token)))
        self._ends.make_automaton()
        if sum(len(t) == 1 for t in self.made) < 256:
            raise ValueError("the vocabulary has no token for some bytes")

    def merged(self, data: bytes) -> list[list[int]]:
        """The states of merging by least rank, leftmost first, from single bytes on."""
        parts = [data[i:i + 1] for i in range(len(data))]
        states = [[self.ranks[p] for p in parts]]
        while len(parts) > 1:
            found = [(r, i) for i in range(len(parts) - 1) if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None]
            if not found:
                break
            _, i = min(found)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            states.append([self.ranks[p] for p in parts])
        return states

    # --- which tokens may follow each other ----------------------------------------

    def _edge(self, token: int, side: int, memory: dict) -> list[tuple[int, int]]:
        """(token, rank of the merge that takes it) of all that ever stand at a
        token's left (side 0) or right end while it is made, the token itself first."""
        edge = memory.get(token)
        if edge is None:
            edge, until = [], len(self.bytes_of)
            at: int | None = token
            while at is not None:
                edge.append((at, until))
                until = at
                at = self.halves[at][side] if at in self.halves else None
            memory[token] = edge
        return edge

    def fits(self, a: int, b: int) -> bool:
        """Whether no merge ever crosses from ``a`` to ``b``. Two that stand side by
        side at some time are merged if their merge comes before those that take
        them; of equal merges the left one comes first."""
        key = a << 32 | b
        known = self._fits.get(key)
        if known is None:
            known = self._apart(a, b)
            if len(self._fits) >= PAIRS:
                self._fits.clear()
            self._fits[key] = known
        return known

    def _apart(self, a: int, b: int) -> bool:
        left, right = self._edge(a, 1, self._right), self._edge(b, 0, self._left)
        i = j = 0
        while i < len(left) and j < len(right):
            (x, x_until), (y, y_until) = left[i], right[j]
            cross = self.ranks.get(self.bytes_of[x] + self.bytes_of[y])
            if cross is not None and cross < x_until and cross <= y_until:
                return False
            # back in time: the one that was made last is taken apart
            single_x, single_y = i + 1 == len(left), j + 1 == len(right)
            if single_x and single_y:
                break
            if single_y or (not single_x and x > y):
                i += 1
            elif single_x or y > x:
                j += 1
            else:  # the same token on both sides: the left one was made first
                j += 1
        return True

    # --- pieces -----------------------------------------------------------------------

    def prefixes(self, data: bytes) -> list[int]:
        """The last token of each prefix. The tokens that end at a byte are found by an
        automaton of all tokens, bytes written as one letter each."""
        out, done, known, apart = [0] * len(data), -1, self._fits.get, self.fits
        for end, (token, size) in self._ends.iter(data.decode("latin-1")):
            if end == done:
                continue
            before = end - size
            if before >= 0:
                fits = known(out[before] << 32 | token)
                if not (apart(out[before], token) if fits is None else fits):
                    continue
            out[end], done = token, end
        return out

    def extend(self, data: bytes, last: list[int], stop: int | None = None) -> list[int]:
        """``last`` (the last token of each prefix known so far) carried on to ``stop``, in
        place, by looking up the bytes before each end."""
        made, known, apart, longest = self.made.get, self._fits.get, self.fits, self.longest
        for end in range(len(last) + 1, (len(data) if stop is None else stop) + 1):
            for start in range(end - longest if end > longest else 0, end):
                token = made(data[start:end])
                if token is None:
                    continue
                if start:
                    before = last[start - 1]
                    fits = known(before << 32 | token)
                    if not (apart(before, token) if fits is None else fits):
                        continue
                last.append(token)
                break
        return last

    def ids(self, last: list[int], data: bytes) -> list[int]:
        """The ids, read off backwards. A piece that is a token is that token, whatever its merges make."""
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self._back(last)

    def _back(self, last: list[int]) -> list[int]:
        out, at, size = [], len(last), self.size_of
        while at:
            token = last[at - 1]
            out.append(token)
            at -= size[token]
        out.reverse()
        return out

    def piece(self, piece: str) -> bytes:
        """The ids of one piece as little-endian unsigned 32-bit numbers."""
        data = piece.encode("utf-8")
        whole = self.ranks.get(data)
        ids = [whole] if whole is not None else self._back(self.prefixes(data))
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        pieces, known = self.split(text), self._pieces.__getitem__
        if max(map(len, pieces), default=0) <= SHORT:
            return b"".join(map(known, pieces))
        return b"".join([known(p) if len(p) <= SHORT else self.piece(p) for p in pieces])

    def decode(self, ids: bytes) -> bytes:
        return decode(self.bytes_of, ids)


def vocabulary(path: str, pattern: str) -> Vocabulary:
    """One for each worker process."""
    if (path, pattern) not in _workers:
        _workers[path, pattern] = Vocabulary(path, pattern)
    return _workers[path, pattern]


class Encoded:
    """A text with its pieces and, for each of them, the last token of every byte
    prefix. Appends and edits keep the numbers they do not touch."""

    def __init__(self, words: Vocabulary, text: str = "", prefixes: np.ndarray | None = None):
        self.words, self.text = words, text
        self.pieces: list[str] = words.split(text)
        self.last: list[list[int]] = []
        #: prefixes computed since the object was made, a measure of the work
        self.computed = 0
        at = 0
        for piece in self.pieces:
            size = len(piece.encode("utf-8"))
            if prefixes is None:
                self.last.append(self._numbers(piece))
            else:
                self.last.append(prefixes[at:at + size].tolist())
            at += size

    def _numbers(self, piece: str) -> list[int]:
        data = piece.encode("utf-8")
        self.computed += len(data)
        return self.words.prefixes(data)

    def prefixes(self) -> np.ndarray:
        """The stored numbers of all pieces, one for each byte of the text."""
        return np.asarray([t for last in self.last for t in last], "<u4")

    def ids(self) -> list[int]:
        return [t for piece, last in zip(self.pieces, self.last) for t in self.words.ids(last, piece.encode("utf-8"))]

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, stop: int, more: str) -> None:
        """Puts ``more`` in place of the characters from start to stop.

        A piece is settled by its own characters and the two after it, so those
        that end two before the edit stay. From there the text is split anew, until a
        piece begins behind the edit where an old one did: the rest is as it was.
        A piece that only grew, or changed inside, keeps its untouched prefixes.
        """
        old, shift = self.text, len(more) - (stop - start)
        begins = np.cumsum([0, *map(len, self.pieces)]).tolist()
        keep = 0
        while keep < len(self.pieces) and begins[keep + 1] <= start - 2:
            keep += 1
        self.text = old[:start] + more + old[stop:]
        behind = {begins[i] + shift: i for i in range(keep, len(begins)) if begins[i] >= stop}
        new, numbers, at, to = [], [], begins[keep], len(self.pieces)
        for piece in _split_from(self.words, self.text, at):
            if at >= start + len(more) and at in behind:
                to = behind[at]
                break
            i = keep + len(new)
            same = 0
            if i < len(self.pieces) and at == begins[i]:  # the prefix shared with the old piece that began here
                a, b = self.pieces[i].encode("utf-8"), piece.encode("utf-8")
                same = _shared(a, b)
                numbers.append(self._repaired(a, self.last[i], b, same))
            else:
                numbers.append(self._numbers(piece))
            new.append(piece)
            at += len(piece)
        self.pieces[keep:to] = new
        self.last[keep:to] = numbers

    def _repaired(self, old: bytes, last: list[int], data: bytes, same: int) -> list[int]:
        """The numbers of ``data``, which begins like ``old`` for ``same`` bytes. Numbers
        behind the change are taken over once as many as the longest token has agree."""
        known = last[:same]
        tail = _shared(old[same:][::-1], data[same:][::-1])
        edit_end, agree = len(data) - tail, 0
        for end in range(same + 1, len(data) + 1):
            self.words.extend(data, known, end)
            self.computed += 1
            before = end - 1 + len(old) - len(data)
            agree = agree + 1 if end > edit_end and before >= 0 and last[before] == known[-1] else 0
            if agree >= self.words.longest:
                return known + last[before + 1:]
        return known


def _shared(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    return int(np.argmax(x != y))


def _split_from(words: Vocabulary, text: str, at: int, step: int = 256) -> Iterator[str]:
    """The pieces from a place where one begins, split in stretches so that a near end is cheap."""
    while at < len(text):
        found = words.split(text[at:at + step])
        whole = at + step >= len(text)
        # the last pieces of a stretch could go on behind it
        sure = found if whole else found[:-2]
        if not sure:
            step *= 4
            continue
        for piece in sure:
            yield piece
            at += len(piece)


# --- tables ----------------------------------------------------------------------------

def encode_documents(docs: DataFrame, ranks: str | None = None, pattern: str | None = None, prefixes: bool = False) -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit) for each row of ``docs``
    (doc_id, text); with ``prefixes`` also last_tokens (binary, alike): for each byte
    of the text the last token of its piece up to there.

    Null texts count as empty and have no ids; null doc_ids stay null, repeated rows
    are encoded each; strings that look like special tokens are ordinary text. Other
    columns are ignored, an empty table gives an empty one. One map over the rows.
    """
    ranks, pattern = ranks or default_ranks(), pattern or default_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(ranks, pattern)
        for batch in slices(batches, 1):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            out = [batch.column(0)]
            names = ["doc_id", "ids"]
            if prefixes:
                done = [Encoded(words, t) for t in texts]
                out += [pa.array([np.asarray(d.ids(), "<u4").tobytes() for d in done], pa.binary()),
                        pa.array([d.prefixes().tobytes() for d in done], pa.binary())]
                names.append("last_tokens")
            else:
                out.append(pa.array([words.encode(t) for t in texts], pa.binary()))
            yield pa.RecordBatch.from_arrays(out, names)

    schema = "doc_id long, ids binary" + (", last_tokens binary" if prefixes else "")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, ranks: str | None = None) -> DataFrame:
    """doc_id, ids, data (binary: the bytes of the ids) for each row; null ids give null."""
    ranks = ranks or default_ranks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_by_rank(read_ranks(ranks))
        for batch in batches:
            data = [None if i is None else decode(tokens, i) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(data, pa.binary())],
                                             ["doc_id", "ids", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, data binary")


def edit_documents(encoded: DataFrame, edits: DataFrame, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """``encoded`` (doc_id, text, last_tokens) with one edit a document (doc_id, start,
    stop, replacement; in characters, an append has start = stop = the length) to doc_id,
    text, ids, last_tokens. Only the neighbourhood of an edit is encoded anew.

    Documents without an edit stay as they are. Places beyond the text count as its
    end, a null replacement as empty. A second edit of a document is a second call;
    an edit repeated for a doc_id gives a row for each.
    """
    ranks, pattern = ranks or default_ranks(), pattern or default_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(ranks, pattern)
        for batch in slices(batches, 1):
            rows = []
            for doc, text, last, start, stop, more in zip(*(batch.column(i).to_pylist() for i in range(6))):
                e = Encoded(words, text or "", np.frombuffer(last or b"", "<u4"))
                if start is not None:
                    start = max(0, min(start, len(e.text)))
                    e.replace(start, max(start, min(start if stop is None else stop, len(e.text))), more or "")
                rows.append((doc, e.text, np.asarray(e.ids(), "<u4").tobytes(), e.prefixes().tobytes()))
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.binary()),
                 pa.array(cols[3], pa.binary())], ["doc_id", "text", "ids", "last_tokens"])

    left = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "last_tokens")
    right = edits.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("start").cast("long"),
                         F.col("stop").cast("long"), F.col("replacement").cast("string"))
    return left.join(right, "doc_id", "left").mapInArrow(run, "doc_id long, text string, ids binary, last_tokens binary")
