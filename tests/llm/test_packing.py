import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lexitally.llm.packing import HarmonicBins, pack
from lexitally.llm.tokens import SegmentEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_segments_encode_as_whole_texts():
    library, ours = Tokenizer.from_file(PATH), SegmentEncoder(PATH, keep=20)
    odd = ["", "  ", "a  b", "a   b", "a\n  b", "a \n b", "\n\n a", "x<|endoftext|> y", "don't 's we'll", "é b 　c d", "a\x1c b", "12 345,6 !!  ?",
           "a.\nB,\n\nc. d", "\u0000 a", "日本 語.", "e.g.,it is", "a,,b ., c"]
    for text in odd * 2:
        assert np.frombuffer(ours.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_line_feeds_in_later_segments():
    library, ours = Tokenizer.from_file(PATH), SegmentEncoder(PATH)
    random.seed(7)
    texts = ["One line.\n\nNext par.", "x y.\n\nZ", "x y\n\n\nZ", "x y\n\n\n\n z\n\n", "x y\n\t\nZ.\n\n\n.,\nq", "x y\r\n\r\nZ", "x y\x1c\n\nZ", "x y\u3000\nZ"]
    texts += ["x " + "".join(random.choices("aZ.,1'\t\n\n\n \r\u3000\x1cé", k=random.randint(1, 30))) for _ in range(5000)]
    for text in texts:
        assert np.frombuffer(ours.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_arrays_of_texts():
    library = Tokenizer.from_file(PATH)
    ours = SegmentEncoder(PATH, keep=50)
    random.seed(8)
    letters = "aZé.,1'\t\n \r\u3000\x1c日"
    texts = ["", None, " ", "  a", "a  b", "one", "x<|endoftext|> y", "a b " * 300, "plain words, plain words.", "\u0000 a", "end ", "a \n b"]
    texts += ["".join(random.choices(letters + " " * 8, k=random.randint(0, 40))) for _ in range(3000)]
    for rows in (texts, texts[:1], [], [None]):
        found = [np.frombuffer(x, "<u4").tolist() for x in ours.encode_array(pa.array(rows, pa.string()))]
        assert found == [library.encode(t or "", add_special_tokens=False).ids for t in rows]
    assert len(list(ours.encode_array(pa.array(texts, pa.large_string()).slice(3, 9)))) == 9


def test_long_arrays_are_encoded_in_slices(monkeypatch):
    from lexitally.llm import tokens

    monkeypatch.setattr(tokens, "_AT_ONCE", 30)
    ours, texts = SegmentEncoder(PATH), ["some words of a text", "and " * 50, "", "x", "more words"] * 4
    assert [bytes(x) for x in ours.encode_array(pa.array(texts))] == [ours.encode(t) for t in texts]


def packed_lengths(lengths, capacity):
    bins, rows = HarmonicBins(capacity, 0), []
    for key, n in enumerate(lengths):
        rows += bins.put(key, np.arange(n, dtype="<u4").tobytes())
    return rows + bins.close()


@settings(deadline=None, max_examples=100)
@given(st.lists(st.integers(1, 200), max_size=60))
def test_bins_need_no_padding(lengths):
    rows = packed_lengths(lengths, 64)
    sequences, documents = defaultdict(list), defaultdict(list)
    for key, start, length, ids, total, sequence, offset in rows:
        sequences[sequence].append((offset, length))
        documents[key].append((start, length))
        assert np.frombuffer(ids, "<u4").tolist() == list(range(start, start + length)) and total == lengths[key]
    for pieces in sequences.values():
        total = 0
        for offset, length in sorted(pieces):
            assert offset == total
            total += length
        assert total <= 64 and total & (total - 1) == 0
    for key, n in enumerate(lengths):
        at = 0
        for start, length in sorted(documents[key]):
            assert start == at and length > 0
            at += length
        assert at == n


def test_documents_are_cut_for_gaps_only():
    random.seed(9)
    lengths = [random.randint(1, 2000) for _ in range(5000)]
    rows = packed_lengths(lengths, 2048)
    sequences = {r[5] for r in rows}
    assert len(rows) <= len(lengths) + 2 * len(sequences)
    classes = defaultdict(set)
    for r in rows:
        if r[2] == r[4]:
            classes[r[5]].add(2048 // r[2])
    # bins of uncut documents hold one class, but for the last ones and documents that are shorter than a gap
    assert sum(len(c) == 1 for c in classes.values()) > 0.8 * len(classes)


def test_documents(spark, odd, empty):
    library = Tokenizer.from_file(PATH)
    rows = pack(odd.repartition(3), PATH).collect()
    ids = defaultdict(bytes)
    for r in sorted(rows, key=lambda r: (r.start, r.sequence_id)):
        if r.doc_id not in (3, None):  # repeated and null ids are checked by their number below
            assert r.length * 4 == len(r.ids)
            ids[r.doc_id] += bytes(r.ids)
    for d, text in {r.doc_id: r.text for r in odd.collect() if r.doc_id not in (3, None)}.items():
        assert np.frombuffer(ids[d], "<u4").tolist() == library.encode(text or "", add_special_tokens=False).ids + [1]
    assert sum(r.length for r in rows) == sum(len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in odd.collect())
    assert pack(empty, PATH).count() == 0
    with pytest.raises(ValueError):
        pack(odd, PATH, capacity=1000)
