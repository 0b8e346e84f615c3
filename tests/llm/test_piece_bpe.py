import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from shelfline.llm import tokens
from shelfline.llm.bpe import merge
from shelfline.llm.piece_bpe import Codec, PieceBpe, Vocabulary, encode_documents, with_digests
from shelfline.llm.queries import op11_piece_bpe

PATH = public_tokenizers.path("piece_bpe_32k.model")
SAMPLE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(PATH)


@pytest.fixture(scope="module")
def codec(vocabulary):
    return Codec(vocabulary, end=True)


ODD = [
    "", " ", "  ", "▁", "▁ ▁x", "  a", "a  b ", "\n", "\n\n \t x\r\n", "é▁x", "\x00a\x00", "</s> <s><unk>", "<0x0A>", "数字 漢字かな 한국어 हिन्दी", "😀👩‍👩‍👧 🇫🇷",
    "x" * 500, " " * 100 + "x", "a" + " " * 33, "1234.5,6 $$$ ###a_b_c", "don't", "aaaaaaaa" * 30 + " ababababab" * 3, "ñÑéÉß", "\u200b\ufeff\u2028", "http://a.b/c?d=e",
]


def test_against_the_library(library, codec):
    for text in ODD:
        ids = library.encode(text, add_eos=True)
        assert codec.encode(text) == ids, repr(text)
        assert codec.decode(ids) == library.decode(ids)
    assert codec.encode(None) == [2]


def test_random_texts_against_the_library(library, codec):
    draw = random.Random(8)
    letters = "aabcdeéth  \t.,'sSΣσ́\x1c\u0085漢1½</s>▁!&\n" + "".join(map(chr, range(0x20, 0x250)))
    for _ in range(2000):
        text = "".join(draw.choice(letters) for _ in range(draw.randrange(80)))
        assert codec.encode(text) == library.encode(text, add_eos=True), repr(text)


def test_every_code_point_against_the_library(library, codec):
    texts = [f"?a{chr(i)}b {chr(i)}?" for i in range(1, 0x110000) if not 0xD800 <= i < 0xE000 and not 0x30000 <= i < 0xE0000]
    for start in range(0, len(texts), 20_000):
        part = texts[start : start + 20_000]
        for text, ids in zip(part, library.encode(part, add_eos=True)):
            assert codec.encode(text) == ids, ascii(text)


def test_decoding_any_ids(library, codec):
    draw = random.Random(3)
    for _ in range(3000):
        # Bytes in any order are seldom a character.
        ids = [draw.choice([draw.randrange(32000), draw.randrange(262)]) for _ in range(draw.randrange(12))]
        assert codec.decode(ids) == library.decode(ids), ids


def test_two_pieces_fit_if_merging_gives_them(vocabulary, codec):
    draw = random.Random(5)
    spaces = [i for i in vocabulary.whole if not vocabulary.strings[i].strip("▁")]
    pairs = [(draw.choice(vocabulary.whole), draw.choice(vocabulary.whole)) for _ in range(20_000)]
    pairs += [(a, b) for a in spaces for b in [*spaces, *draw.sample(vocabulary.whole, 500)]]
    for left, right in pairs:
        letters = [vocabulary.letters[c] for c in vocabulary.strings[left] + vocabulary.strings[right]]
        assert codec._fits(left << 20 | right) == (merge(letters, vocabulary.ranks) == [left, right])


def test_backtracking_gives_what_merging_gives(vocabulary, codec):
    draw = random.Random(6)
    strings = [vocabulary.strings[i] for i in vocabulary.whole]
    for _ in range(2000):
        part = "".join(draw.choice(strings) for _ in range(draw.randrange(1, 8)))
        assert codec.backtrack(part) == merge([vocabulary.letters[c] for c in part], vocabulary.ranks)


def test_long_text_without_a_place_to_cut(library, codec):
    text = "".join(random.Random(7).choice("abcdefghij") for _ in range(200_000))
    assert codec.encode(text) == library.encode(text, add_eos=True)


def test_forgetting_changes_nothing(library, vocabulary, monkeypatch):
    monkeypatch.setattr(tokens, "WORDS_REMEMBERED", 3)
    monkeypatch.setattr(tokens, "PARTS_REMEMBERED", 2)
    codec = Codec(vocabulary)
    text = "one two three, four five. one two Three FOUR\n" * 5
    assert codec.encode(text) == library.encode(text)
    assert len(codec.of_word) <= 3 and len(codec.of_word.older) <= 3


def test_a_worker_keeps_few_codecs(monkeypatch):
    monkeypatch.setattr(tokens, "_codecs", type(tokens._codecs)())
    made = []
    for key in "aabacac":
        tokens.kept_by_worker(key, lambda key=key: made.append(key) or key)
    assert made == ["a", "b", "c"] and len(tokens._codecs) == tokens.CODECS


def test_texts_in_some_batches_of_characters(library, codec, monkeypatch):
    monkeypatch.setattr(tokens, "CHARS_AT_ONCE", 10)
    texts = [None, "", "one two", "a much longer text than that", None, "  x"]
    found = []
    for some in tokens._some(texts):
        ids, ends = tokens.words_to_ids(codec, some)
        found += [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]
    assert found == [library.encode(t or "", add_eos=True) for t in texts]


def test_query_on_the_samples(spark, library):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet").collect()
    df = op11_piece_bpe(spark, SAMPLE)
    assert df.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    found = {r.doc_id: r for r in df.collect()}
    assert len(found) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_eos=True)
        row = found[d.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_columns_rows_and_round_trip(spark, library):
    rows = [(1, "Hello  there"), (1, "Hello  there"), (None, None), (2, ""), (3, "long word\n" * 100_000)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, `n_tokens` int").withColumnRenamed("doc_id", "a.b")
    found = encode_documents(df, PATH)
    assert found.columns == ["a.b", "text", "n_tokens", "token_ids"]
    back = found.select("text", "n_tokens", "token_ids", PieceBpe(spark, PATH).decode(F.col("token_ids")).alias("decoded")).collect()
    expected = [(t, len(library.encode(t or "", add_eos=True)), t or "") for _, t in rows]
    assert Counter((r.text, r.n_tokens, r.decoded) for r in back) == Counter(expected)
    assert encode_documents(df.filter("false"), PATH).collect() == [] == with_digests(df.filter("false"), PATH).collect()
    assert Counter(r.n_tokens for r in with_digests(df, PATH).collect()) == Counter(n for _, n, _ in expected)
    assert [r.ids for r in spark.range(1).select(PieceBpe(spark, PATH).encode(F.lit("a b")).alias("ids")).collect()] == [library.encode("a b")]


def test_file_of_another_kind():
    with pytest.raises((ValueError, KeyError, IndexError, StopIteration, UnicodeDecodeError)):
        Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
