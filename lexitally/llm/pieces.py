"""SentencePiece BPE models: offset-preserving encoding, and decoding.

The text is normalised by longest-prefix replacement through the model's compiled
character map. Every normalised byte remembers the source byte it came from, and
a piece's span of normalised bytes is projected back through that alignment, so
pieces tile the original bytes. A model with an empty map (identity) needs no map
lookups; the alignment is then a running sum of source lengths.

Merging never crosses a place that no vocabulary piece spans, so a text is cut
there, and the segments, which repeat, are merged once and kept (bounded, see
`PieceCodec.keep`); texts are encoded whole, whatever their length.

Defined results: a null or empty text has no ids; equal rows give equal rows; an
empty table gives an empty result; lone surrogates cannot occur in Spark strings.
"""

import gc
import heapq
import re
import struct
from array import array
from contextlib import contextmanager
from functools import lru_cache
from itertools import repeat
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

META = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


# --- the model file ---------------------------------------------------------------


def _fields(data):
    """(field number, value) of a protocol-buffer message, in order."""
    at = 0

    def number():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(kind) or number()
            yield key >> 3, data[at : at + size]
            at += size


class Model:
    """Pieces with scores and types, and the settings that encoding needs."""

    def __init__(self, data):
        self.pieces, self.scores, self.types = [], [], []
        trainer, normalizer = {}, {}
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
                self.types.append(piece.get(3, NORMAL))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                normalizer = dict(_fields(value))
        if trainer.get(3) != 2 or not trainer.get(35) or trainer.get(24) or USER in self.types or UNUSED in self.types:
            raise ValueError("only BPE models with byte fallback and without user-defined or unused pieces")
        self.unknown_text = trainer.get(44, " ⁇ ".encode()).decode()
        self.char_map = normalizer.get(2, b"")
        self.dummy_prefix = bool(normalizer.get(3, 1))
        self.squeeze = bool(normalizer.get(4, 1))


# --- normalising with alignment -----------------------------------------------------


class CharacterMap:
    """Longest-prefix replacement through a compiled map: a double-array trie over bytes, then its strings."""

    def __init__(self, blob):
        size = struct.unpack_from("<I", blob)[0]
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self.strings = blob[4 + size :]

    def longest(self, data, at):
        """(replacement, bytes matched) of the longest key that `data` has at `at`, or None."""
        units, found = self.units, None
        unit = units[0]
        node = (unit >> 10) << ((unit & 512) >> 6)
        for i in range(at, len(data)):
            node ^= data[i]
            unit = units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                start = units[node] & 0x7FFFFFFF
                found = self.strings[start : self.strings.index(b"\0", start)], i + 1 - at
        return found


def normalise(text, char_map=None, dummy_prefix=True, squeeze=False):
    """(normalised bytes, source byte of each normalised byte and of the end).

    White space becomes the meta symbol. `squeeze` drops leading, trailing and
    repeated white space; `dummy_prefix` puts one in front.
    """
    data, meta = text.encode(), META.encode()
    out, source, at = bytearray(), [], 0

    def step():
        found = char_map.longest(data, at) if char_map else None
        if found:
            return found
        first = data[at]
        size = 1 if first < 128 else 2 if first < 224 else 3 if first < 240 else 4
        return data[at : at + size], size

    if squeeze:
        while at < len(data):
            new, size = step()
            if new != b" ":
                break
            at += size
    if at == len(data):
        return b"", [0]
    if dummy_prefix:
        out += meta
        source += [at] * len(meta)
    after_space = squeeze
    while at < len(data):
        new, size = step()
        while after_space and new.startswith(b" "):
            new = new[1:]
        for byte in new:
            part = meta if byte == 32 else bytes((byte,))
            out += part
            source += [at] * len(part)
        if new:
            after_space = new.endswith(b" ")
        at += size
        after_space = after_space and squeeze
    if squeeze:
        while out.endswith(meta):
            del out[-len(meta) :]
            at = source[len(out)]
            del source[len(out) :]
    return bytes(out), [*source, at]


# --- merging ------------------------------------------------------------------------


class PieceCodec:
    """Encodes texts to (ids, source bytes where pieces end) and decodes ids."""

    def __init__(self, path, keep=300_000):
        with open(path, "rb") as file:
            model = Model(file.read())
        self.model, self.keep = model, keep
        self.ids = {p: i for i, (p, t) in enumerate(zip(model.pieces, model.types)) if t == NORMAL}
        order = {score: n for n, score in enumerate(sorted(set(model.scores), reverse=True))}
        self.rank = {p: order[model.scores[i]] for p, i in self.ids.items()}
        self.none = len(order)
        self.byte_id = {int(p[3:5], 16): i for i, (p, t) in enumerate(zip(model.pieces, model.types)) if t == BYTE}
        self.map = CharacterMap(model.char_map) if model.char_map else None
        self.plain = not model.char_map and not model.squeeze and model.dummy_prefix
        if any(META in p.lstrip(META) for p in self.ids):
            raise ValueError("a piece spans two words, so words cannot be encoded one by one")
        merging = {c for p in self.ids if len(p) > 1 for c in p}
        alone = "([^" + re.escape("".join(sorted(merging))) + " ])"
        joined = {a + b for p in self.ids for a, b in zip(p, p[1:])}
        if not any(j[0].isalpha() and j[1] in ".," for j in joined):
            alone += r"|(?<=[^\W\d_])(?=[.,])"  # no piece has a full stop or comma after a letter
        self.alone = re.compile(alone)
        self.known, self.before = {}, {}
        self.small, self.small_before = {}, {}
        self.surface = []
        for i, (p, t) in enumerate(zip(model.pieces, model.types)):
            whole = {CONTROL: "", UNKNOWN: model.unknown_text}.get(t, p.replace(META, " "))
            self.surface.append(bytes((int(p[3:5], 16),)) if t == BYTE else whole.encode())

    def merge(self, text):
        """Pieces of a normalised text: the best-scored neighbours merge first, the leftmost of equals."""
        rank, parts = self.rank, list(text)
        if len(parts) > 48:
            return self._merge_long(parts)
        none = self.none
        pairs = list(map(rank.get, map(add, parts, parts[1:]), repeat(none)))
        while pairs and (best := min(pairs)) < none:
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = rank.get(parts[i - 1] + parts[i], none)
            if i < len(pairs):
                pairs[i] = rank.get(parts[i] + parts[i + 1], none)
        return parts

    def _merge_long(self, parts):
        """The same for long runs, with a heap and links to the neighbours."""
        rank, n = self.rank, len(parts)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = []

        def offer(i):
            j = right[i]
            found = rank.get(parts[i] + parts[j]) if j >= 0 else None
            if found is not None:
                heapq.heappush(heap, (found, i, len(parts[i]), len(parts[j])))

        for i in range(n):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if parts[i] is None or j < 0 or len(parts[i]) != a or len(parts[j]) != b:
                continue
            parts[i], parts[j] = parts[i] + parts[j], None
            right[i] = right[j]
            if right[i] >= 0:
                left[right[i]] = i
            if left[i] >= 0:
                offer(left[i])
            offer(i)
        return [p for p in parts if p is not None]

    def _pieces(self, text):
        """(id, characters it covers) of a normalised text; of a character's fallback bytes the last one covers it."""
        for piece in self.merge(text):
            found = self.ids.get(piece)
            if found is not None:
                yield found, len(piece)
            else:
                raw = piece.encode()
                for byte in raw[:-1]:
                    yield self.byte_id[byte], 0
                yield self.byte_id[raw[-1]], 1

    # Identity models: characters of the source text are those of the normalised one, but for the space.

    def _segment(self, source):
        """(ids, source bytes per piece) of a source segment, both as packed 32-bit integers."""
        # Cutting out what never merges only makes parts repeat more often; plain words are not worth the search.
        if len(self.small) > self.keep:
            self.small, self.small_before = {}, self.small
        small = self.small
        if source[1:].isalpha():
            found = small.get(source)
            if found is None:
                found = small[source] = self.small_before.get(source) or self._part(source)
            return array("i", found[0]).tobytes(), array("i", found[1]).tobytes()
        parts = self.alone.split(source)
        ids, sizes = [], []
        for part in parts:
            if not part:
                continue
            found = small.get(part)
            if found is None:
                found = small[part] = self.small_before.get(part) or self._part(part)
            ids += found[0]
            sizes += found[1]
        return array("i", ids).tobytes(), array("i", sizes).tobytes()

    def _part(self, part):
        """(ids, source bytes per piece) of a run of text without a cut."""
        ids, sizes, known = [], [], self.ids
        at, narrow = 0, part.isascii()
        pieces = self.merge(part.replace(" ", META))
        if narrow:
            ids = list(map(known.get, pieces))
            if None not in ids:
                return ids, list(map(len, pieces))
            ids = []
        for piece in pieces:
            n = len(piece)
            covered = n if narrow else len(part[at : at + n].encode())
            at += n
            found = known.get(piece)
            if found is None:  # one character that is no piece: its bytes, of which the last one covers it
                raw = piece.encode()
                ids += [self.byte_id[byte] for byte in raw]
                sizes += [0] * (len(raw) - 1)
            else:
                ids.append(found)
            sizes.append(covered)
        return ids, sizes

    #: A cut before a space after something else than white space: pieces hold white space in front only.
    CUT = re.compile(f"(?<=[^ {META}]) ")

    def _cut(self, text):
        """The text cut at `CUT`; without repeated white space, that is at every space but a leading one."""
        if "  " in text or META in text or text.startswith(" "):
            return self.CUT.split(text)
        return text.split(" ")

    def _encode_plain(self, text):
        first, *rest = self._cut(text)
        if len(self.known) > self.keep:
            self.known, self.before = {}, self.known
        known, before = self.known, self.before
        for s in set(rest).difference(known):
            known[s] = before.get(s) or self._segment(" " + s)
        all_ids, all_sizes = zip(*map(known.__getitem__, rest)) if rest else ((), ())
        ids, sizes = self._segment(" " + first)
        sizes = np.frombuffer(sizes, np.int32).copy()
        sizes[0] -= 1  # the prefix stands for no source byte
        ends = np.concatenate([sizes, np.frombuffer(b"".join(all_sizes), np.int32)])
        return np.frombuffer(ids + b"".join(all_ids), np.int32), np.cumsum(ends, dtype=np.int32)

    def encode(self, text):
        """(ids, ends): piece i covers the source bytes from the end before it (from 0) to ends[i]."""
        if not text:
            return np.zeros(0, np.int32), np.zeros(0, np.int32)
        if self.plain:
            return self._encode_plain(text)
        data, source = normalise(text, self.map, self.model.dummy_prefix, self.model.squeeze)
        whole = data.decode()
        byte = np.cumsum([0, *[len(c.encode()) for c in whole]])
        ids, ends, at = [], [], 0
        for segment in re.split(f"(?<=[^{META}])(?={META})", whole):
            for id_, size in self._pieces(segment):
                at += size
                ids.append(id_)
                ends.append(source[byte[at]])
        return np.array(ids, np.int32), np.array(ends, np.int32)

    def decode(self, ids):
        """The text of ids: pieces joined, white space for the meta symbol, bytes read as UTF-8."""
        data = b"".join(map(self.surface.__getitem__, ids))
        if self.model.dummy_prefix and len(ids) and data.startswith(b" ") and self.model.pieces[ids[0]].startswith(META):
            data = data[1:]
        try:
            return data.decode()
        except UnicodeDecodeError:
            return data.decode("utf-8", errors="replace")


@contextmanager
def no_cycle_search():
    """Hold Python's search for reference cycles: encoding makes none, and a search walks all kept segments."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


@lru_cache(maxsize=4)
def codec(path):
    """One codec per worker process and model file."""
    return PieceCodec(path)


# --- as Spark jobs --------------------------------------------------------------------


def encode_documents(docs, model, id_col="doc_id", text="text", decoded=False):
    """Per row: id, `ids` and `ends` (source byte where each piece ends), and the decoded text if asked for.

    `model` is the path of a model file that all workers can read. No shuffle.
    """
    kind = dict(docs.dtypes)[id_col]

    def encoded(batches):
        tool = codec(model)
        for batch in batches:
            texts = batch.column(1)
            step = 512  # rows per output batch: bounds what a worker holds beside its input
            for start in range(0, batch.num_rows, step):
                with no_cycle_search():
                    ids, ends = zip(*[tool.encode(t) for t in texts.slice(start, step).to_pylist()])
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32))
                columns = [
                    batch.column(0).slice(start, step),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids))),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ends))),
                ]
                if decoded:
                    columns.append(pa.array([tool.decode(x.tolist()) for x in ids], pa.string()))
                names = [batch.schema.field(0).name, "ids", "ends", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    schema = f"`{id_col}` {kind}, ids array<int>, ends array<int>" + (", decoded string" if decoded else "")
    return docs.select(F.col(f"`{id_col}`"), F.col(f"`{text}`")).mapInArrow(encoded, schema)
