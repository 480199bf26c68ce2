import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ticketmill.llm import token_planes
from ticketmill.llm.encoding import Encoder, vocabulary_path

VOCABULARY = vocabulary_path("byte_bpe_50k.json")
TRICKY = [
    "a  b", "\n x y\n z", "a \n b", " lead", "trail ", "x\ty z", "<|endoftext|> q", "", "it's 's x y  z", "a\n\n\nb c", "é ü  ",
    "wörd, wörd. wörd", "42. 7, x", "  a  b", "\0 a\0b", "naïve naïve, naïve; 3.14!", "…, ... ?!", "ab cd" * 300,
]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=70), st.integers(1, 40))
def test_planes_round_trip(ids, block):
    ids = np.array(ids, "<u4")
    sizes, payload = token_planes.pack(ids, block)
    assert (token_planes.unpack(len(ids), block, sizes, payload) == ids).all()


def test_plane_count_follows_the_largest_id():
    sizes, _ = token_planes.pack(np.array([0, 1, 5], "<u4"), 2)
    assert [len(s) for s in sizes] == [1, 3]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab, .\n\t'é7 ", max_size=30), max_size=6))
def test_cached_encoding_is_the_tokenizers(texts):
    encoder = test_cached_encoding_is_the_tokenizers.encoder
    assert encoder.encode(texts) == encoder.whole(texts)


test_cached_encoding_is_the_tokenizers.encoder = Encoder(VOCABULARY)


def test_tricky_texts_twice():
    encoder = Encoder(VOCABULARY)
    for _ in range(2):
        assert encoder.encode(TRICKY) == encoder.whole(TRICKY)


def test_a_word_beside_white_space_lends_no_ids():
    encoder = Encoder(VOCABULARY)
    for texts in (["x \nword", "\tHowever", "a \u00a0b"], ["x \nword, y", "\tHowever, z", "a \u00a0b. c"]):
        assert encoder.encode(texts) == encoder.whole(texts)
    encoder.old, encoder.new = encoder.new, {}
    assert encoder.encode(["x \nword; y"]) == encoder.whole(["x \nword; y"])


def test_file_round_trip(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(reversed(TRICKY))] + [(100, None), (-5, "x y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'s' AS shard", "1 AS start").repartition(3)
    token_planes.write_ids(docs, str(tmp_path / "ids"), VOCABULARY, block_ids=16, chunk_ids=40)
    plain = Tokenizer.from_file(VOCABULARY)
    want, start = [], 0
    for doc_id, text in sorted(rows):
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 0]
        want.append((doc_id, start, len(ids), ids))
        start += len(ids)
    got = token_planes.read_documents(spark, str(tmp_path / "ids")).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == want
    got = token_planes.read_documents(spark, str(tmp_path / "ids"), digest=True).orderBy("doc_id").collect()
    assert [r["ids_crc32"] for r in got] == [zlib.crc32(np.array(w[3], "<u4").tobytes()) for w in want]


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    token_planes.write_ids(docs, str(tmp_path / "ids"), VOCABULARY)
    assert token_planes.read_documents(spark, str(tmp_path / "ids"), digest=True).count() == 0


def test_piece_cache_stays_small_over_many_different_words():
    e = Encoder(VOCABULARY)
    texts = [" ".join(f"q{i}" for i in range(at, at + 7000)) for at in range(0, 700_000, 7000)]
    for text in texts[:-1]:
        e.encode([text])
    assert e.encode(texts[-1:]) == e.whole(texts[-1:])
    assert len(e.new) + len(e.old) < 600_000  # two workers share what an executor has beside its heap


def test_texts_are_cut_into_the_runs_of_the_vocabulary():
    e = Encoder(VOCABULARY)
    words = ["naïve", "it's", "she'll", "12.5", "ab12cd", "x&&&", "(ok)", "!'s", "Łódź", "«a»", "end.\nNext", "a\n\nb", "m²", "漢字", "a\tb"]
    texts = [f"{a} {b}" for a in words for b in words] + ["\n a", "a\n", " a", "a ", "'s", "\n"]
    assert e.encode(texts) == e.encode(texts) == e.whole(texts)
    # A word that other marks follow is learned once, whatever follows it.
    e = Encoder(VOCABULARY)
    ends = [".", ",", "&&&", ").", ".\nAt", "'s", "-x"]
    assert e.encode([f"a verylongword{x}" for x in ends]) == e.whole([f"a verylongword{x}" for x in ends])
    assert not e.new and sum("verylongword" in r for r in e.runs) == 1
