"""Packing of documents into fixed windows by online sum of squares.

Each task packs the rows it scans, so nothing is shuffled and no task sees
more than its input split. A document longer than a window is cut at window
lengths; its remainder is one item. An item goes to the fill level (an open
window of that fill, or a new one) after which the sum over levels of squared
counts of partially filled windows is least; ties go to the fullest window.
The counts are one array over the levels. That rule keeps the levels of open
windows spread out, so that most later items find a window they complete.

Windows still open at the end of a task, or beyond `max_open` (a bound on
memory: max_open windows of ids, four bytes each), are recut: their contents are laid end to end and cut at window
lengths. A task's very last, partial window is cut at powers of two, lengths
that need no padding.

Defined results: a null or empty text is its end marker alone; every row is
packed, repeated rows each for themselves; a null id is carried; an empty
table gives no rows; further columns are ignored, whatever their names.
Sequence ids depend on the input splits and are the same for a retried task.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm import bpe

SCHEMA = ("id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")
_ARROW = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
                    ("sequence_id", pa.int64()), ("offset", pa.int64())])
_RUN = 1024  # pieces encoded as one text
#: Bounds on a worker's memory, not on results: texts are cut into pieces in slices
#: of about so many bytes, and ids are gathered for so many pieces at a time.
_SLICE_BYTES = 2 << 20
_GATHER = 1 << 16
_INNER = re.compile(r" \S(?:.*\S)?", re.DOTALL).fullmatch


class Packer:
    """One task's windows. A piece is (doc id, start, ids, document's tokens)."""

    def __init__(self, size: int, first_sequence: int, max_open: int = 4096):
        self.size, self.max_open = size, max_open
        self.count = np.zeros(size + 1, np.int64)  # open windows per fill level
        self.at: list[list[list[tuple]]] = [[] for _ in range(size)]
        self.n_open = 0
        self._next = first_sequence
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        n = len(ids)
        whole = n - n % self.size
        for start in range(0, whole, self.size):
            self._emit([(doc_id, start, ids[start:start + self.size], n)])
        if n > whole:
            self._place((doc_id, whole, ids[whole:].copy(), n))  # a view would keep the whole document
            if self.n_open > self.max_open:
                self._recut(last=False)

    def finish(self) -> None:
        self._recut(last=True)

    def _emit(self, window: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, n in window:
            self.rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), n,
                              self._next, offset))
            offset += len(ids)
        self._next += 1

    def _place(self, piece: tuple) -> None:
        need, count = len(piece[2]), self.count
        # Change of the sum of squares if a window leaves level h for h + need;
        # level 0 (a new window) and a full window count nothing.
        change = 2 * count[need:] + 1
        change[-1] = 0
        change[1:] += 1 - 2 * count[1:self.size - need + 1]
        change[1:][count[1:self.size - need + 1] == 0] = np.iinfo(np.int64).max
        level = len(change) - 1 - int(np.argmin(change[::-1]))
        window = self.at[level].pop() if level else []
        self.n_open += not level
        if level:
            count[level] -= 1
        window.append(piece)
        if level + need == self.size:
            self.n_open -= 1
            self._emit(window)
        else:
            count[level + need] += 1
            self.at[level + need].append(window)

    def _recut(self, last: bool) -> None:
        rest = [p for level in reversed(self.at) for window in level for p in window]
        self.at = [[] for _ in range(self.size)]
        self.count[:] = 0
        self.n_open = 0
        left = sum(len(p[2]) for p in rest)
        window, room = [], self.size
        for doc_id, start, ids, n in rest:
            while len(ids):
                if not window:  # the final partial window: powers of two
                    room = self.size if left >= self.size or not last else 1 << (left.bit_length() - 1)
                take = ids[:room]
                window.append((doc_id, start, take, n))
                start, ids = start + len(take), ids[len(take):]
                room, left = room - len(take), left - len(take)
                if not room:
                    self._emit(window)
                    window = []
        if window:
            fill = self.size - room
            self.count[fill] = self.n_open = 1
            self.at[fill].append(window)


class Encoder:
    """Ids of texts, equal to those of the tokenizers library for the same
    vocabulary, from tiktoken (the faster of the two) over distinct pieces."""

    def __init__(self, path: str):
        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        stand_in = bpe.byte_symbols()
        specials = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        ranks = {bytes(stand_in[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                 if token not in specials}
        self._model = tiktoken.Encoding("packing", pat_str=bpe.PRETOKEN.pattern,
                                        mergeable_ranks=ranks, special_tokens=specials)
        self._n_bytes = np.zeros(max([*ranks.values(), *specials.values()]) + 1, np.int64)  # of each id
        for token, i in [*ranks.items(), *((t.encode(), i) for t, i in specials.items())]:
            self._n_bytes[i] = len(token)

    def _ids(self, text: str) -> np.ndarray:
        return self._model.encode_to_numpy(text, allowed_special="all")

    def encode(self, wanted: list[str]) -> list[bytes]:
        """Ids of each piece, as bytes of uint32. Pieces with a space in front and no
        other white space at an end are encoded as one text, a run at a time: no
        pre-token spans the places between them, so the ids are cut there."""
        inner = [w for w in wanted if _INNER(w)]
        alone = [w for w in wanted if not _INNER(w)] if len(inner) < len(wanted) else []
        found: list[bytes] = []
        for lo in range(0, len(inner), _RUN):
            run = inner[lo:lo + _RUN]
            text = "".join(run)
            ends = np.cumsum(np.fromiter(map(len, run if text.isascii() else map(str.encode, run)), np.int64, len(run)))
            ids = self._ids(text)
            reached = np.cumsum(self._n_bytes[ids])
            at = np.searchsorted(reached, ends)
            if at[-1] == len(ids) - 1 and (reached[at] == ends).all():
                flat, cuts = ids.tobytes(), [0, *(4 * at + 4).tolist()]
                found += [flat[a:b] for a, b in zip(cuts, cuts[1:])]
            else:
                found += [self._ids(w).tobytes() for w in run]
        if not alone:
            return found
        every = dict(zip(inner, found)) | {w: self._ids(w).tobytes() for w in alone}
        return [every[w] for w in wanted]

    def documents(self, texts: pa.Array, end: int, memo: bpe.Memo) -> Iterator[tuple[int, np.ndarray]]:
        """(row, ids with the end marker) for every text."""
        for rows, parts in bpe.slices(texts, _SLICE_BYTES):
            codes, starts, distinct, firsts = bpe.pieces(parts)
            encoded = memo([" " + d for d in distinct])
            first = memo(firsts)
            bits = encoded + first
            flat = np.frombuffer(b"".join(bits), np.uint32)
            sizes = np.array([len(b) >> 2 for b in bits], np.int64)
            begins = np.cumsum(sizes) - sizes
            codes = codes.copy()
            codes[starts[:-1]] = len(encoded) + np.arange(len(rows))
            totals = np.add.reduceat(sizes[codes], starts[:-1])
            for row, lo, hi, total in zip(rows.tolist(), starts[:-1].tolist(), starts[1:].tolist(), totals.tolist()):
                ids = np.empty(total + 1, np.uint32)
                ids[-1], at = end, 0
                for c in (codes[k:min(k + _GATHER, hi)] for k in range(lo, hi, _GATHER)):
                    n = sizes[c]
                    ends = np.cumsum(n)
                    take = np.repeat(begins[c] - (ends - n), n) + np.arange(ends[-1])
                    ids[at:at + len(take)] = flat[take]
                    at += len(take)
                yield row, ids


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per Python worker."""
    return Encoder(path)


def pack(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", window: int = 1024, end_id: int = 0,
         max_open: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents with their place in the packed sequences.

    `tokenizer` is a path on every executor, or a file name of
    public_tokenizers; it must be a byte-level BPE vocabulary.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(bpe.vocabulary_path(tokenizer))
        memo = bpe.Memo(model.encode)  # the task's own, and gone with it
        packer = Packer(window, TaskContext.get().partitionId() << 40, max_open)

        def out():
            columns = list(zip(*packer.rows)) or [[] for _ in _ARROW]
            packer.rows = []
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)

        for b in batches:
            ids = b.column("id").to_pylist()
            for row, tokens in model.documents(b.column("text"), end_id, memo):
                packer.add(ids[row], tokens)
                if len(packer.rows) > 20_000:
                    yield out()
        packer.finish()
        yield out()

    src = docs.select(F.col(id_col).cast("bigint").alias("id"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return src.mapInArrow(run, SCHEMA).withColumnRenamed("id", id_col)
