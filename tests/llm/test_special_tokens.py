"""Strings of special tokens in texts, as the tokenizer file has them."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from tillbook.llm import queries, token_output
from tillbook.llm.queries import tokenizer_path

TEXTS = ["a <|endoftext|> b", "<|endoftext|>", "one<|endoftext|>two <|endoftext|>", "no special token"]


def expected():
    tokenizer, at, out = Tokenizer.from_file(tokenizer_path()), 0, []
    for i, text in enumerate(TEXTS):
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [token_output.END_ID], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_special_tokens_are_encoded_as_the_file_has_them(spark, tmp_path):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert sorted(map(tuple, queries.QUERIES["op7_token_output"](spark, str(tmp_path)).collect())) == expected()
    assert sorted(map(tuple, corpus_pipeline.token_stage(spark, docs, "").collect())) == expected()
    ids = token_output.Encoder(tokenizer_path(), special_as_text=False)(TEXTS[0])
    assert np.frombuffer(ids, "<u4").tolist() == [64, 220, 50256, 275]


def test_a_tokenizer_of_another_kind_encodes_whole_texts():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    encode, whole = token_output.Encoder(path, special_as_text=False), Tokenizer.from_file(path)
    for text in (*TEXTS, "Don't  stop, ÉTÉ\n42", ""):
        ids = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(text), "<u4").tolist() == ids


def test_a_tokenizer_without_special_tokens(tmp_path):
    import json

    file = json.load(open(tokenizer_path()))
    file["added_tokens"] = []
    path = tmp_path / "bare.json"
    path.write_text(json.dumps(file))
    encode, whole = token_output.Encoder(str(path)), Tokenizer.from_file(str(path))
    for text in TEXTS:
        assert np.frombuffer(encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("special_as_text", [True, False])
def test_batches_give_the_ids_of_the_whole_texts(file, special_as_text):
    import public_tokenizers

    path = public_tokenizers.path(file)
    encode, whole = token_output.Encoder(path, special_as_text), Tokenizer.from_file(path)
    whole.encode_special_tokens = special_as_text

    @settings(max_examples=60 if file[0] == "w" else 300, deadline=None)
    @given(
        st.lists(
            st.none()
            | st.text(st.sampled_from(list("abcDé'ßñ 　   \n\t.,!12中Ł<|>")), max_size=30)
            | st.sampled_from(["one two", "two one ", " one", "a<|endoftext|> b", "a  b", "two\none, two"]),
            max_size=6,
        )
    )
    def same(texts):
        ids, counts = encode.batch(pa.array(texts, pa.string()))
        want = [whole.encode(t or "", add_special_tokens=False).ids + [token_output.END_ID] for t in texts]
        assert ids.tolist() == [i for some in want for i in some]
        assert counts.tolist() == list(map(len, want))

    same()


def test_an_id_that_fills_many_ranges_is_cut_by_its_texts(spark):
    docs = spark.range(4000).selectExpr("IF(id % 2 = 0, NULL, id) AS doc_id", "CAST(id AS STRING) AS text")
    cuts = token_output.id_ranges(docs, "doc_id", 8)
    assert cuts == sorted(cuts, key=lambda c: (c[0], c[1] or 0, c[2])) and len(cuts) == 7
    rows = docs.selectExpr("doc_id", "xxhash64(text) AS h").collect()
    sizes = [0] * 8
    for doc_id, h in rows:
        sizes[token_output._part_of(doc_id is not None, doc_id, h, cuts)] += 1
    assert max(sizes) < 1000 and sum(sizes) == 4000
    assert token_output.id_ranges(docs.limit(0), "doc_id", 8) == []
