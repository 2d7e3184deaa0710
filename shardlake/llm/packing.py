"""Sum-of-squares packing of tokenised documents into fixed windows.

Every scan task packs its own documents as they come.  A document's full
windows are sequences of their own; what is left of it (less than a window) is
placed online by the sum-of-squares rule: of all fill levels that have a
partially filled window with room, and of a new window, it takes the one after
which the sum over the levels of (number of windows at this level) squared is
least.  The counts are one array, so a choice is one vectorised minimum.

At the end of its input a task cuts the emptiest open windows into the room of
the fullest ones, and the last open window into powers of two, which need no
padding.  A task holds its open windows only; nothing is shuffled.
"""
from __future__ import annotations

import json
import os
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import MergeTable
from .chunks import ChunkCoder
from .common import small_batches

WINDOW = 2048
END_ID = 1


class WordTokenizer:
    """Ids of whole texts, as ``tokenizers`` gives them.  The tokenizer drops
    white space and joins nothing over it, so each distinct chunk is tokenised
    once.  Chunks of Latin letters, digits and signs, which no normalisation
    but lower case touches, go through the tokenizer's own merges together;
    all others through the library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        special = "|".join(regex.escape(t["content"]) for t in spec["added_tokens"])
        self.plain = regex.compile(rf"(?!.*(?:{special}))[ \n!-~\u00a1-\u00ac\u00ae-\u024f]+")
        merges = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.merges = MergeTable({(vocab[a], vocab[b]): (r, vocab[a + b]) for r, (a, b) in enumerate(merges)})
        # bytes that print stand for themselves, the others follow from 256 on
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        rest = iter(range(256, 512))
        names = [chr(b if b in shown else next(rest)) for b in range(256)]
        self.inner = np.array([vocab[c] for c in names], dtype=np.int32)
        self.last = np.array([vocab[c + end] for c in names], dtype=np.int32)
        self.coder = ChunkCoder(self._learn)

    def _learn(self, chunks: list[str], _keys) -> tuple[np.ndarray, np.ndarray]:
        out: list = [None] * len(chunks)
        plain = [i for i, c in enumerate(chunks) if self.plain.fullmatch(c)]
        parts = [self.words.findall(chunks[i].lower()) for i in plain]
        raw = [w.encode() for ws in parts for w in ws]
        if raw:
            sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
            points = np.frombuffer(b"".join(raw), dtype=np.uint8)
            first, ends = self.inner[points], np.cumsum(sizes) - 1
            first[ends] = self.last[points[ends]]
            got = iter(self.merges.many(first, sizes))
        for i, ws in zip(plain, parts):
            out[i] = b"".join([next(got) for _ in ws])
        other = [i for i, x in enumerate(out) if x is None]
        for i, e in zip(other, self.model.encode_batch_fast([chunks[i] for i in other], add_special_tokens=False)):
            out[i] = np.array(e.ids, dtype="<u4").tobytes()
        return np.frombuffer(b"".join(out), dtype="<i4"), np.fromiter(map(len, out), dtype=np.int64, count=len(out)) // 4

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit bytes."""
        ids, at = self.coder.encode(texts)
        raw = ids.astype("<u4").tobytes()
        return [raw[4 * a : 4 * z] for a, z in zip(at.tolist(), at[1:].tolist())]


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


class Packer:
    """Level array and open windows of one task.  Pieces are
    ``(doc_id, start, ids as bytes, doc_tokens)``."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.next = window, first_sequence
        self.count = np.zeros(window + 1, dtype=np.int64)
        self.open: dict[int, list[list]] = {}
        self.closed: list[tuple] = []

    def _close(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.closed.append((doc, start, len(ids) // 4, zlib.crc32(ids), total, self.next, offset))
            offset += len(ids) // 4
        self.next += 1

    def level_for(self, size: int) -> int:
        """The fill level whose choice leaves the least sum of squares; 0 is a
        new window.  Of equal choices the fullest level wins."""
        room = self.window - size
        change = 2 * (self.count[size : self.window + 1] - self.count[: room + 1]) + 2
        # a filled window leaves the array, a new one comes from no level
        change[room] -= 2 * self.count[self.window] + 1
        change[0] += 2 * self.count[0] - 1
        change[1 : room + 1][self.count[1 : room + 1] == 0] = np.iinfo(np.int64).max
        return room - int(np.argmin(change[::-1]))

    def add(self, doc, ids: bytes) -> None:
        total, width = len(ids) // 4, 4 * self.window
        whole = total // self.window * width
        for at in range(0, whole, width):
            self._close([(doc, at // 4, ids[at : at + width], total)])
        if whole < len(ids):
            self.place((doc, whole // 4, ids[whole:], total))

    def place(self, piece: tuple) -> None:
        size = len(piece[2]) // 4
        level = self.level_for(size)
        pieces = []
        if level:
            pieces = self.open[level].pop()
            self.count[level] -= 1
        pieces.append(piece)
        if level + size == self.window:
            self._close(pieces)
        else:
            self.open.setdefault(level + size, []).append(pieces)
            self.count[level + size] += 1

    def finish(self) -> None:
        """Top up the fullest open windows from the emptiest, then split the
        last one into powers of two."""
        left = [p for level in sorted(self.open) for p in self.open[level]]
        self.open, low, high = {}, 0, len(left) - 1
        self.count[:] = 0
        size = lambda pieces: sum(len(p[2]) // 4 for p in pieces)
        while low < high:
            room = self.window - size(left[high])
            left[high] += self._take(left[low], room)
            if size(left[high]) == self.window:
                self._close(left[high])
                high -= 1
            if not left[low]:
                low += 1
        if low <= high and left and left[low]:
            rest = left[low]
            while rest:
                self._close(self._take(rest, 1 << (size(rest).bit_length() - 1)))

    @staticmethod
    def _take(pieces: list, most: int) -> list:
        """Up to ``most`` ids cut off the end of ``pieces``."""
        got = []
        while most and pieces:
            doc, start, ids, total = pieces.pop()
            n = len(ids) // 4
            if n > most:
                pieces.append((doc, start, ids[: 4 * (n - most)], total))
                start, ids, n = start + n - most, ids[4 * (n - most) :], most
            got.append((doc, start, ids, total))
            most -= n
        return got


COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``.

    A document is the ids of its whole text and ``end_id``; a null or empty
    text is ``end_id`` alone.  Each row is packed on its own, so repeated rows
    and null ids are kept; an empty table gives no rows; other columns are
    ignored.  Sequences hold ``window`` ids, but for a few of a power of two
    at the end of each task.  ``sequence_id`` is unique over all tasks: the
    task's partition in the high bits, a counter in the low 33.
    """
    small_batches(docs.sparkSession)
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        packer, model = Packer(window, TaskContext.get().partitionId() << 33), tokenizer(tokenizer_path)

        def closed() -> pa.RecordBatch:
            out, packer.closed = packer.closed, []
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(len(COLUMNS))], names=COLUMNS)

        for b in batches:
            texts = [t or b"" for t in b.column("text").to_pylist()]
            for doc, ids in zip(b.column("doc_id").to_pylist(), model.encode(texts)):
                packer.add(doc, ids + end)
            yield closed()
        packer.finish()
        yield closed()

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
            .mapInArrow(run, ", ".join(f"{c} long" for c in COLUMNS)))
