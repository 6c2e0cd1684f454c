"""Sum-of-squares online packing of tokenised documents into windows.

Method
------
A document's ids are followed by an end id.  What exceeds a window is cut
into full windows; the rest is placed online.  ``levels[h]`` counts the open
windows filled up to ``h``; a piece of size s goes to the level that makes
the sum of squared counts least (a new window is level 0, a window that is
done leaves the array), the fullest such level on a tie.  A window is done when
no more than ``SLACK`` of it is free: as cuts are free, the next piece first
gives what fills it up, and only what is left of the piece is placed.  So
windows close all the time, also in small partitions, and few are open.

At the end of a partition the pieces of the open windows are laid end to end
over full windows, and the last, partial one is cut along the binary digits of
its length: a sequence whose length is a power of two needs no padding, so the
packing pads nothing at all.

Scale: no shuffle; each partition of the input packs on its own and keeps its
open windows only (their number follows the window size, not the rows).  A
sequence id is the partition number above 40 bits of a counter.  A lost task
is run again from the same input split, with the same result.

Defined results
---------------
* null or empty text: one piece of length 1, the end id;
* null id: carried through; repeated rows: each row is a document of its own;
* an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import sys
from array import array
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from .common import python_tasks, pieces

WINDOW = 4096
#: The greatest part of a window that the next piece fills up.
SLACK = WINDOW // 16
#: Bytes of chunks, and of parts of chunks, that a task remembers the ids of
#: (with what Python adds for each, some three times as many); a memory that is
#: full takes no more, and none outlives its task.
MEMORY = 24 << 20
#: What a chunk costs besides its bytes.
_EACH = 64
#: ASCII marks without the apostrophe.
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
#: The byte-level alphabet: printable Latin-1 bytes stand for themselves, the
#: others, in order, for the characters from 256 on.
_PLAIN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}
_SEPARATORS = regex.compile("[\x1c-\x1f]")
SCHEMA = ("doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")


def _packed(ids: list[int]) -> bytes:
    """Little-endian 32-bit numbers."""
    a = array("I", ids)
    if sys.byteorder == "big":
        a.byteswap()
    return a.tobytes()


class Encoder:
    """Ids of whole texts, as little-endian 32-bit bytes.

    The tokenizer drops white space and never joins what it parts, so a text's
    ids are those of its white-space chunks in order; chunks that came before
    are looked up.  A chunk of letters and following marks is two such parts
    again, unless the marks hold an apostrophe."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.forget()

    def forget(self) -> None:
        self.chunks: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.room_chunks = self.room_parts = MEMORY

    def _direct(self, s: str) -> bytes:
        return _packed(self.tokenizer.encode(s, add_special_tokens=False).ids)

    def _keep(self, s: str, ids: bytes) -> bytes:
        if self.room_parts > 0:
            self.parts[s] = ids
            self.room_parts -= len(s) + len(ids) + _EACH
        return ids

    def _word(self, s: str) -> bytes:
        """Of lower-case letters in normal form: the model sees their bytes."""
        got = self.parts.get(s)
        if got is None:
            seen = s if s.isascii() else s.encode().decode("latin-1").translate(_BYTES)
            got = self._keep(s, _packed([t.id for t in self.model.tokenize(seen)]))
        return got

    def _marks(self, s: str) -> bytes:
        got = self.parts.get(s)
        return self._keep(s, self._direct(s)) if got is None else got

    def _chunk(self, s: str) -> bytes:
        word = s if s.isalpha() else s.rstrip(_MARKS)
        if len(s) >= 100 or not word.isalpha():
            return self._direct(s)
        marks = s[len(word):]
        if word.isascii():
            word = word.lower()
        else:
            word = normalize("NFC", word)
            # letters that become a letter and a mark, or lower by their place
            if "\u03a3" in word or not (word := word.lower()).isalpha():
                return self._direct(s)
        return self._word(word) + self._marks(marks) if marks else self._word(word)

    def __call__(self, text: str) -> bytes:
        if _SEPARATORS.search(text):   # white space for Python, not for the tokenizer
            return self._direct(text)
        chunks, known = text.split(), self.chunks
        out = list(map(known.get, chunks))
        if None in out:
            for i, got in enumerate(out):
                if got is None:
                    s = chunks[i]
                    got = known.get(s)
                    if got is None:
                        got = self._chunk(s)
                        if len(s) < 100 and self.room_chunks > 0:
                            known[s] = got
                            self.room_chunks -= len(s) + len(got) + _EACH
                    out[i] = got
        return b"".join(out)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each tokenizer file and Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class SumOfSquares:
    """The open windows of one partition, by fill level.  A window with
    ``slack`` or less free is done."""

    def __init__(self, window: int = WINDOW, slack: int = 0):
        self.window = window
        self.done = window - slack
        self.levels = np.zeros(window + 1, dtype=np.int64)
        self.open: dict[int, list[list]] = {}

    def place(self, size: int) -> int:
        """The fill level to put a piece of this size on."""
        n, w = self.levels, self.window
        h = np.flatnonzero(n[:w - size + 1])
        to = n[h + size]
        change = np.where(h + size < self.done, 2 * to + 1, 0) - (2 * n[h] - 1)
        fresh = 2 * n[size] + 1 if size < self.done else 0
        if not len(h) or fresh < change.min():
            return 0
        return int(h[np.flatnonzero(change == change.min())[-1]])

    def add(self, piece: tuple, size: int) -> list | None:
        """Place a piece; the pieces of the window that is done by it, if any."""
        h = self.place(size)
        if h:
            held = self.open[h].pop()
            self.levels[h] -= 1
        else:
            held = []
        held.append(piece)
        if h + size >= self.done:
            return held
        self.open.setdefault(h + size, []).append(held)
        self.levels[h + size] += 1
        return None

    def rest(self) -> list:
        """The pieces of all open windows, fullest windows first."""
        return [p for h in sorted(self.open, reverse=True) for held in self.open[h] for p in held]


class _Rows:
    def __init__(self, partition: int):
        self.sequence = partition << 40
        self.columns: list[list] = [[] for _ in range(7)]

    def sequence_of(self, pieces_: list) -> None:
        """One sequence: pieces are (id, start, ids bytes, tokens of the document)."""
        offset = 0
        for doc, start, ids, total in pieces_:
            n = len(ids) // 4
            for col, v in zip(self.columns, (doc, start, n, ids, total, self.sequence, offset)):
                col.append(v)
            offset += n
        self.sequence += 1

    def batch(self) -> pa.RecordBatch:
        kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        out = pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(self.columns, kinds)], names=names)
        self.columns = [[] for _ in range(7)]
        return out


def _laid_end_to_end(rest: list, window: int) -> list[list]:
    """Full windows from the pieces in order, then one for each binary digit
    of what is left; pieces are cut where a sequence ends."""
    left = sum(len(p[2]) // 4 for p in rest)
    sizes = [window] * (left // window)
    left %= window
    while left:
        sizes.append(1 << (left.bit_length() - 1))
        left -= sizes[-1]
    out, at = [], 0
    for room in sizes:
        held = []
        while room:
            doc, start, ids, total = rest[at]
            n = len(ids) // 4
            take = min(n, room)
            held.append((doc, start, ids[:4 * take], total))
            room -= take
            if take == n:
                at += 1
            else:
                rest[at] = (doc, start + take, ids[4 * take:], total)
        out.append(held)
    return out


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, end_id: int = 2, slack: int = SLACK) -> DataFrame:
    """A row for each piece: the document's id as ``doc_id``, ``start``,
    ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``,
    ``sequence_id``, ``offset``.  ``tokenizer`` is a file that every executor
    has."""
    python_tasks(docs.sparkSession)
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        encode, packer = encoder(tokenizer), SumOfSquares(window, slack)
        rows = _Rows(TaskContext.get().partitionId())
        due, room = [], 0                # the window that is done, and what fills it up
        try:
            for batch in batches:
                for b in pieces(batch):
                    for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                        ids = encode(text or "") + end
                        total = len(ids) // 4
                        for at in range(0, total - window + 1, window):
                            rows.sequence_of([(doc, at, ids[4 * at:4 * (at + window)], total)])
                        at = total - total % window
                        if due and at < total:
                            take = min(room, total - at)
                            due.append((doc, at, ids[4 * at:4 * (at + take)], total))
                            at, room = at + take, room - take
                            if not room:
                                rows.sequence_of(due)
                                due = []
                        if at < total:
                            held = packer.add((doc, at, ids[4 * at:], total), total - at)
                            if held:
                                room = window - sum(len(p[2]) // 4 for p in held)
                                if room:
                                    due = held
                                else:
                                    rows.sequence_of(held)
                    yield rows.batch()
        finally:
            encode.forget()
            _ENCODERS.clear()            # a worker outlives its task
        for held in _laid_end_to_end(due + packer.rest(), window):
            rows.sequence_of(held)
        yield rows.batch()

    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                      F.col(text_col).alias("text"))
    return src.mapInArrow(run, SCHEMA)
