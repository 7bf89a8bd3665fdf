import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T
from tokenizers import Tokenizer

from quotewell.llm import bpe as module
from quotewell.llm.bpe import Encoder, bpe, bpe_stage, default_tokenizer

LIBRARY = Tokenizer.from_file(default_tokenizer())
OWN = Encoder(default_tokenizer())
TEXTS = [
    "", "   a  b\n\n c", " <|endoftext|>x<|endoftext|><|endoftext|>", "it's we'll I'D 　 x\x1cy\x85z", "a" * 3000, "ab" * 777, "日本語テキスト🙂🙂 ½²", "-" * 64,
    "    \t\t \r\n  x", "\x00\x01 ߿", "Ördnung überall, 12345 niños!", "aaaaaaaaaaab" * 40, "the the the then there",
]


def library(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", TEXTS)
def test_words(text):
    ids = OWN.encode([text])[0].tolist()
    assert (ids, OWN.decode(ids)) == library(text)


def test_every_token_of_the_vocabulary():
    texts = [t.decode() for t in OWN.ids if t.isascii()]
    assert [x.tolist() for x in OWN.encode(texts)] == [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(), st.text(alphabet="abeéthn ion'sd0\n")))
def test_any_text(text):
    ids = OWN.encode([text])[0].tolist()
    assert (ids, OWN.decode(ids)) == library(text)


class Asked(dict):
    def __contains__(self, key):
        raise AssertionError(f"{key} was looked up again")

    __getitem__ = get = __contains__


def test_steps_are_found_once(monkeypatch):
    texts = ["the then thereafter, thatched", "Ördnung überall, 12345 niños!", "日本語テキスト"]
    own = Encoder(default_tokenizer())
    ids = [x.tolist() for x in own.encode(texts)]
    own.known = {}
    monkeypatch.setattr(own, "ids", Asked(own.ids))
    assert [x.tolist() for x in own.encode(texts)] == ids == [library(t)[0] for t in texts]


def test_words_of_every_character():
    signs = [chr(i) for i in [*range(0xD800), *range(0xE000, 1 << 16), *range(0x1F600, 0x1F650), 0x10000, 0x10FFFF]]
    for shape in ("a{0}b {0}1{0} {0} {0}{0}, {0}", "{0}", "'{0}'s  {0}\n{0}'re "):
        for c in signs:
            assert [*OWN.words(shape.format(c))] == [module.WORDS.findall(shape.format(c))]


def test_vocabulary_without_some_bytes(tmp_path):
    path = tmp_path / "small.json"
    path.write_text('{"model": {"vocab": {"a": 0, "b": 1, "ab": 2, "aba": 3}, "merges": ["a b", "ab a"]}, "added_tokens": []}')
    own = Encoder(str(path))
    assert [x.tolist() for x in own.encode(["ababab", None, "aba"])] == [[2, 2, 2], [], [3]]
    with pytest.raises(ValueError):
        own.encode(["abc"])


def test_long_texts_and_forgetting(monkeypatch):
    monkeypatch.setattr(module, "_FINDALL_CHARS", 40)
    monkeypatch.setattr(module, "_PART_WORDS", 3)
    monkeypatch.setattr(module, "_KEEP_WORDS", 5)
    monkeypatch.setattr(module, "_KEEP_CHARS", 6)
    own = Encoder(default_tokenizer())
    for text in [*TEXTS, " ".join(TEXTS)]:
        assert own.encode([text, text])[1].tolist() == library(text)[0]


def test_tables(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), *(T.StructField(n, T.StringType()) for n in ("doc", "decoded", "token_ids"))])
    rows = [(i, t, "x", "y", "z") for i, t in enumerate([*TEXTS, None])] + [(None, "no id", "x", "y", "z")] * 2
    df = spark.createDataFrame(rows, schema)
    for r in bpe(df).collect():
        assert (r.token_ids, r.decoded) == library(r.doc.text)
    out = bpe_stage(df)
    assert out.count() == len(rows) and out.where("not round_trip").count() == 0
    assert bpe(df.limit(0)).count() == 0 and bpe_stage(df.limit(0)).columns == out.columns
