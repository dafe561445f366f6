import hashlib
import random

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from llm_fixtures import awkward, nothing  # noqa: F401
from tradewind.llm import sentence_pieces, word_table

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "a", "a ", " a", "  a  b\n\n c\t", "▁", "▁▁a ▁", "it's we'll", "<s>x</s> <unk> <0x41>", "naïve café 12345 ½",
       "日本語 テキスト", "\U0001F600\U0001F468‍\U0001F469 é", "a\x1cb\x85c\xa0d e　f", "\x00\x01 \x00", "ﬁ ① Å",
       " \n \n ", "a" * 3000, "x" + " " * 50 + "y", " " * 40, "﻿x", "a​b", "\r\n"]


def texts():
    rng = random.Random(2)
    letters = "ab '\n\t  ▁é½日\U0001F600‍\x1c\xa0.,!12<|>s"
    return ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 80))) for _ in range(400)]


@pytest.mark.parametrize("chars,buckets", [(word_table.BLOCK_CHARS, None), (500, 3), (1, 1)])
def test_ids_and_texts_equal_the_library(spark, chars, buckets):
    given = texts()
    docs = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string").repartition(5)
    model = SentencePieceProcessor(model_file=PATH)
    found = {r["doc_id"]: r for r in sentence_pieces.tokenize(docs, PATH, chars=chars, buckets=buckets).collect()}
    assert [found[n]["ids"] for n in range(len(given))] == [model.encode(t) for t in given]
    assert [found[n]["decoded"] for n in range(len(given))] == [model.decode(model.encode(t)) for t in given]


def test_whole_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = SentencePieceProcessor(model_file=PATH)
    found = {r["doc_id"]: r for r in sentence_pieces.tokenize(docs, PATH, sentence_pieces.digests()).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(found) == len(rows)
    for row in rows:
        ids = model.encode(row["text"] or "")
        hashes = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), model.decode(ids))]
        assert tuple(found[row["doc_id"]])[1:] == (len(ids), *hashes)


def test_a_word_is_encoded_once_in_a_bucket(spark):
    docs = spark.createDataFrame([(n, "same words again") for n in range(200)], "doc_id long, text string").repartition(4)
    real = sentence_pieces.codec(PATH)
    calls = spark.sparkContext.accumulator(0)

    def encoder():
        encode = real.encoder()

        def counted(words):
            calls.add(len(words))
            return encode(words)

        return counted

    counting = word_table.Codec(real.splitter, encoder, real.pieces, real.text)
    assert word_table.tokenize(docs, counting, chars=100).count() == 200 and calls.value == 3


def test_no_table_is_left(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    before = spark.sql("show tables").count()
    assert sentence_pieces.tokenize(docs, PATH).first()["decoded"] == "a b"
    assert spark.sql("show tables").count() == before


def test_pieces_that_cross_markers_are_refused(monkeypatch):
    class Crossing:
        def get_piece_size(self):
            return 1

        def id_to_piece(self, _):
            return "of▁the"

    monkeypatch.setattr(sentence_pieces, "_model", lambda path: Crossing())
    with pytest.raises(ValueError):
        sentence_pieces.codec("any")


def test_awkward_rows(spark, awkward, nothing):
    found = sentence_pieces.tokenize(awkward, PATH).collect()
    given = awkward.collect()
    assert sorted(r["decoded"] for r in found) == sorted(r["text"] or "" for r in given)
    assert sorted(map(str, (r["doc_id"] for r in found))) == sorted(str(r["doc_id"]) for r in given)
    assert sentence_pieces.tokenize(nothing, PATH).count() == 0
