"""Token ids of whole texts by a public byte-level BPE file, encoded segment by segment."""

import os
import re
import sys
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A text may be cut before a space that a non-space follows: the tokenizer's own word pattern starts a word there,
#: whatever stands before it, so segments encode alone as they do in the text.
_CUT = re.compile(r" (?=\S)")
#: Within a segment a word also ends before a full stop or comma, and line feeds stand apart from what is before them.
#: From what follows only a single line feed does: of several spaces the pattern leaves the last one to a word of its own.
_INNER = re.compile(r"(?<=[^\W\d_])(?=[.,])|(?<=\S)(?=\n)|(?<=\S\n)(?=\S)")


_SWAP = sys.byteorder != "little" or array("I").itemsize != 4
#: Bytes of text whose segments are looked up together; bounds the memory of a worker (a longer text goes alone).
_AT_ONCE = 8 << 20


class SegmentEncoder:
    """Ids of a text as the tokenizers library gives them without special tokens.

    Segments (a word with its space and punctuation) repeat, so their ids are
    kept: once `keep` segments are held, the store starts anew and takes over from
    the one before what is asked for again. That bounds the memory of a worker and
    changes no result. A text with the string of an added
    token, which the library looks for in the whole text, is encoded whole.
    """

    def __init__(self, path, keep=400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.keep = keep
        self.known, self.before = {}, {}
        self.words = {}

    def _bytes(self, texts):
        return [np.array(e.ids, dtype="<u4").tobytes() if _SWAP else array("I", e.ids).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _segments(self, segments):
        """Ids of segments that are not known yet, from the ids of their words."""
        parts = [_INNER.split(" " + s) for s in segments]
        words = self.words
        missing = [w for w in {w for p in parts for w in p} if w not in words]
        if len(words) > self.keep:
            words = self.words = {w: words[w] for p in parts for w in p if w in words}
        words.update(zip(missing, self._bytes(missing)))
        return [b"".join([words[w] for w in p]) for p in parts]

    def encode(self, text):
        """The ids as little-endian unsigned 32-bit integers."""
        if any(a in text for a in self.added):
            return self._bytes([text])[0]
        first, *rest = _CUT.split(text)
        if len(self.known) > self.keep:
            self.known, self.before = {}, self.known
        known, before = self.known, self.before
        missing = []
        for s in set(rest):
            if s not in known:
                old = before.get(s)
                if old is None:
                    missing.append(s)
                else:
                    known[s] = old
        known.update(zip(missing, self._segments(missing)))
        return self._bytes([first])[0] + b"".join([known[s] for s in rest])

    def encode_array(self, texts):
        """Ids of the texts of an Arrow string array, as a list of buffers of little-endian unsigned 32-bit integers."""
        texts = texts.fill_null("")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _AT_ONCE, "right")))
            yield from self._encode_slice(texts.slice(at, to - at))
            at = to

    def _encode_slice(self, texts):
        """Every different segment is looked up once; the ids of the texts are gathered from theirs."""
        whole = np.zeros(len(texts), bool)  # texts with the string of an added token
        for a in self.added:
            whole |= pc.match_substring(texts, a).to_numpy(zero_copy_only=False)
        parts = pc.split_pattern(texts, " ")
        segments = parts.flatten().dictionary_encode()
        counts = parts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        firsts = np.cumsum(counts) - counts
        place = segments.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        values = segments.dictionary.to_pylist()
        # The first segment of a text has no space before it, and is encoded as it is.
        openings = segments.dictionary.take(pa.array(place[firsts])).dictionary_encode()
        place[firsts] = len(values) + openings.indices.to_numpy(zero_copy_only=False)
        # Two spaces, or a space and other white space: the cut is not before every space there.
        odd = np.array([not s or s[0].isspace() for s in values] + [False] * len(openings.dictionary))
        if odd.any():
            whole |= np.add.reduceat(odd[place], firsts) > 0
        used = np.zeros(len(odd), bool)
        used[place[np.repeat(~whole, counts)]] = True
        ids = self._lookup(values, used.tolist()) + self._bytes(openings.dictionary.to_pylist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(ids), "<u4")
        lengths = sizes[place]
        ends = np.cumsum(lengths)
        gathered = memoryview(flat[np.repeat(starts[place] - ends + lengths, lengths) + np.arange(ends[-1])]).cast("B")
        ends = 4 * ends[firsts + counts - 1]
        at = 0
        for i, (end, alone) in enumerate(zip(ends.tolist(), whole.tolist())):
            yield self.encode(texts[i].as_py()) if alone else gathered[at:end]
            at = end

    def _lookup(self, segments, used):
        """Ids of different segments, empty for those that no text uses."""
        if len(self.known) > self.keep:
            self.known, self.before = {}, self.known
        known, before = self.known, self.before
        found = [known.get(s) if u else b"" for s, u in zip(segments, used)]
        missing, places = [], []
        for i in [i for i, ids in enumerate(found) if ids is None]:
            s = segments[i]
            old = before.get(s)
            if old is None:
                missing.append(s)
                places.append(i)
            else:
                known[s] = found[i] = old
        for i, s, ids in zip(places, missing, self._segments(missing)):
            known[s] = found[i] = ids
        return found


@lru_cache(maxsize=4)
def encoder(path):
    """One encoder per worker process and file."""
    return SegmentEncoder(path)
