import numpy as np
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from quotewell.llm.bpe import default_tokenizer
from quotewell.llm.token_files import END_OF_DOCUMENT, file_entries, token_counts, write_token_files


def plain(stream):
    """Spans between separators, the last one unless empty."""
    ends = [i for i, t in enumerate(stream) if t == END_OF_DOCUMENT]
    starts = [0, *(e + 1 for e in ends)]
    spans = [(s, e - s, True) for s, e in zip(starts, ends)]
    return spans + ([(starts[-1], len(stream) - starts[-1], False)] if starts[-1] < len(stream) else [])


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64, 1 << 19])
def test_stitching(spark, tmp_path, block):
    random = np.random.default_rng(3)
    streams = {
        "a": random.choice([1, 80 * 256 + 196, 50257, END_OF_DOCUMENT], 300, p=[0.4, 0.3, 0.2, 0.1]), "b": np.full(50, 9), "c": np.full(6, END_OF_DOCUMENT),
        "d": np.array([1, 2, END_OF_DOCUMENT]), "e": np.array([END_OF_DOCUMENT, 1]), "f": np.array([], int),
    }
    for name, stream in streams.items():
        (tmp_path / name).write_bytes(stream.astype("<u2").tobytes())
    got = {}
    for r in token_counts(spark, str(tmp_path), block_tokens=block).orderBy("file", "ordinal").collect():
        got.setdefault(r.file, []).append((r.start, r.n_tokens, r.complete))
        assert len(got[r.file]) == r.ordinal + 1
    assert got == {name: plain(s.tolist()) for name, s in streams.items() if len(s)}


def test_written_files(spark, tmp_path):
    library = Tokenizer.from_file(default_tokenizer())
    library.encode_special_tokens = True
    texts = ["hello world", None, "", "a <|endoftext|> b", "PÄ \n PÄ", "long " * 5000, "same", "same"]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("kind", T.StringType()), T.StructField("seq", T.StringType())])
    df = spark.createDataFrame([(i if i != 4 else None, t, "x", "y") for i, t in enumerate(texts)], schema).repartition(3)
    write_token_files(df, str(tmp_path / "out"))
    counts = token_counts(spark, str(tmp_path / "out/kind=tokens"), block_tokens=64)
    entries = file_entries(spark, str(tmp_path / "out/kind=ids"))
    got = sorted((r.ident, r.n_tokens) for r in counts.join(entries, ["file", "ordinal"]).collect())
    assert got == sorted((str(i) if i != 4 else "", len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(texts))
    assert counts.where("not complete").count() == 0


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    write_token_files(df.repartition(1), str(tmp_path / "out"))
    (tmp_path / "none").mkdir()
    assert token_counts(spark, str(tmp_path / "none")).count() == 0
