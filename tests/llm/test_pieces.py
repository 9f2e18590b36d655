import gc
import random

import pytest
import public_tokenizers
import sentencepiece

from lexitally.llm import pieces as M

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def odd_texts():
    random.seed(0)
    letters = "ab  \n▁é日\u0000€😀.,\t<0x41><s>the ing"
    return ["", " ", "a  b", " a", "▁", " ▁ a", "▁ b", "a▁ b", "<s> <unk> <0x41>", "\u0000 a", "x" * 300, "é" * 100 + " " * 40] + [
        "".join(random.choice(letters) for _ in range(random.randint(1, 60))) for _ in range(400)
    ]


def test_ids_spans_and_round_trip_match_the_library(library):
    codec = M.PieceCodec(MODEL, keep=50)
    for text in odd_texts():
        ids, ends = codec.encode(text)
        assert ids.tolist() == library.encode(text), text
        assert codec.decode(ids.tolist()) == library.decode(library.encode(text)), text
        assert ends.tolist() == [p.end for p in library.encode(text, return_type="proto").pieces], text


def test_general_path_gives_the_same(library):
    codec = M.PieceCodec(MODEL)
    codec.plain = False
    for text in odd_texts()[:150]:
        ids, ends = codec.encode(text)
        assert ids.tolist() == library.encode(text)
        assert ends.tolist() == [p.end for p in library.encode(text, return_type="proto").pieces], text


@pytest.mark.parametrize("squeeze", [False, True])
@pytest.mark.parametrize("prefix", [False, True])
def test_normalising_through_a_compiled_map(squeeze, prefix):
    """Against the library's NFKC map, with the source of every normalised byte."""
    library = sentencepiece.SentencePieceNormalizer(
        rule_name="nmt_nfkc", add_dummy_prefix=prefix, remove_extra_whitespaces=squeeze, escape_whitespaces=True
    )
    spec = next(dict(M._fields(v)) for f, v in M._fields(library.serialized_model_proto()) if f == 3)
    char_map = M.CharacterMap(spec[2])
    random.seed(1)
    for _ in range(300):
        text = "".join(random.choice("ab  ①ﬁ＃ｱﾞ¼Å é　\t​한글ａ") for _ in range(random.randint(0, 12)))
        out, source = M.normalise(text, char_map, prefix, squeeze)
        whole, places = library.normalize(text, with_offsets=True)
        assert out.decode() == whole
        chars = [source[len(whole[:i].encode())] for i in range(len(whole) + 1)]
        assert [len(text[:p].encode()) for p in places] == chars, text


def test_documents(spark, odd, empty, library):
    found = M.encode_documents(odd, MODEL, decoded=True).collect()
    texts = [r.text or "" for r in odd.collect()]
    assert sorted((r.doc_id is None, r.doc_id, r.ids, r.decoded) for r in found if r.doc_id is not None) == sorted(
        (False, d, library.encode(t), library.decode(library.encode(t))) for d, t in zip([r.doc_id for r in odd.collect()], texts) if d is not None
    )
    assert M.encode_documents(empty, MODEL).count() == 0


def test_encoding_does_not_search_for_cycles():
    found = []
    watch = lambda phase, info: found.append(info["generation"])
    codec = M.PieceCodec(MODEL)
    texts = [" ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}x{i}y" for i in range(n, n + 500)) for n in range(0, 10_000, 500)]
    gc.callbacks.append(watch)
    try:
        with M.no_cycle_search():
            for text in texts:
                codec.encode(text)
            assert not found
    finally:
        gc.callbacks.remove(watch)
    assert gc.isenabled()


def test_cuts_are_those_of_the_pattern():
    codec = M.PieceCodec(MODEL)
    for text in [*odd_texts(), "a b", "a b ", " a b", "a\tb c", "a b  c"]:
        assert codec._cut(text) == codec.CUT.split(text), text


def test_query_takes_null_and_empty_texts(spark, tmp_path, library):
    from lexitally.llm.pieces_query import op3

    rows = [(1, None), (2, ""), (3, "a word")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: (r.n_tokens, r.n_bytes) for r in op3(spark, str(tmp_path)).collect()}
    assert found == {1: (0, 0), 2: (0, 0), 3: (len(library.encode("a word")), 6)}
