"""Harmonic packing of token sequences: reciprocal-capacity classes, filled independently by every task.

Whole capacities of a document are sequences of their own. What is left of it, r
tokens, belongs to class k if capacity / (k + 1) < r <= capacity / k, and a bin of
class k takes exactly k such rests. The gap of a bin that has them all is filled
by the head of the next document, which is cut there and goes on with what
remains: no full bin has padding, and a document is cut once for a gap and never
otherwise. Each task (one partition of the scan) fills its own bins: there is no
shuffle, a task holds at most one open bin per class (2 * sqrt(capacity) classes)
and one that waits for its gap, and a lost task runs again by itself with the same
result. At its end the open bins, largest rests first, are cut into full
sequences, and one last stretch shorter than the capacity at powers of two, so it
needs no padding either; that is at most log2(capacity) short sequences a task.

Defined results: a null or empty text is the end id alone; a null id is carried
along; every input row, a repeated one too, is packed by itself; an empty table
gives no rows.
"""

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from lexitally.llm.tokens import encoder

CAPACITY = 2048
FLUSH = 4096
SCHEMA = "{id} {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class HarmonicBins:
    """The bins of one task. `put` and `close` return the rows of bins that are complete.

    A piece is (id, start, length, ids, document's tokens).
    """

    def __init__(self, capacity, first_sequence):
        self.capacity = capacity
        self.next = first_sequence
        self.open = {}
        self.waiting, self.gap = [], 0

    def _sequence(self, pieces):
        rows, offset = [], 0
        for piece in pieces:
            rows.append((*piece, self.next, offset))
            offset += piece[2]
        self.next += 1
        return rows

    def put(self, key, ids):
        """All ids of one document."""
        total, start, rows = len(ids) // 4, 0, []
        if self.gap:
            length = start = min(self.gap, total)
            self.waiting.append((key, 0, length, ids[: 4 * length], total))
            self.gap -= length
            if not self.gap:
                rows = self._sequence(self.waiting)
                self.waiting = []
        while total - start >= self.capacity:
            rows += self._sequence([(key, start, self.capacity, ids[4 * start : 4 * (start + self.capacity)], total)])
            start += self.capacity
        rest = total - start
        if rest:
            fit = self.capacity // rest
            held = self.open.setdefault(fit, [])
            held.append((key, start, rest, ids[4 * start :], total))
            if len(held) == fit:
                del self.open[fit]
                gap = self.capacity - sum(p[2] for p in held)
                if gap:
                    self.waiting, self.gap = held, gap
                else:
                    rows += self._sequence(held)
        return rows

    def close(self):
        left = self.waiting + [p for fit in sorted(self.open) for p in self.open[fit]]
        self.open, self.waiting, self.gap = {}, [], 0
        rest = sum(p[2] for p in left)
        rows, current, room = [], [], self._largest(rest)
        for key, start, length, ids, total in left:
            at = 0
            while at < length:
                taken = min(room, length - at)
                current.append((key, start + at, taken, ids[4 * at : 4 * (at + taken)], total))
                at += taken
                room -= taken
                rest -= taken
                if not room:
                    rows += self._sequence(current)
                    current, room = [], self._largest(rest)
        return rows

    def _largest(self, rest):
        return min(self.capacity, 1 << (rest.bit_length() - 1)) if rest else 0


def pack(docs, tokenizer, id_col="doc_id", text="text", capacity=CAPACITY, end_id=1):
    """One row per piece: id, start, length, ids (little-endian uint32), doc_tokens, sequence_id, offset.

    `tokenizer` is the path of a tokenizers file that all workers can read;
    `capacity` is a power of two. Sequence ids are unique, not dense: the
    partition's number, then a count within it.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    kind = dict(docs.dtypes)[id_col]
    end = int(end_id).to_bytes(4, "little")

    def filled(batches):
        bins = HarmonicBins(capacity, TaskContext.get().partitionId() << 40)
        done, schema = [], None
        for batch in batches:
            schema = pa.schema([batch.schema.field(0)] + FIELDS)
            for key, ids in zip(batch.column(0).to_pylist(), encoder(tokenizer).encode_array(batch.column(1))):
                done += bins.put(key, bytes(ids) + end)
                if len(done) >= FLUSH:
                    yield _batch(done, schema)
                    done = []
        done += bins.close()
        if done:
            yield _batch(done, schema)

    rows = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text}`"))
    return rows.mapInArrow(filled, SCHEMA.format(id=f"`{id_col}`", kind=kind))


FIELDS = [
    pa.field("start", pa.int64()), pa.field("length", pa.int64()), pa.field("ids", pa.binary()),
    pa.field("doc_tokens", pa.int64()), pa.field("sequence_id", pa.int64()), pa.field("offset", pa.int64()),
]


def _batch(rows, schema):
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
