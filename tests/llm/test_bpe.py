import hashlib
import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from llm_fixtures import awkward, nothing  # noqa: F401
from tradewind.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "a", "  a  b\n\n c\t", "it's we'll I'D can't", "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "<|endoftext", "naïve café 12345 ½",
       "日本語 テキスト", "\U0001F600\U0001F468\u200d\U0001F469 e\u0301", "a\x1cb\x85c\xa0d\u2028e\u3000f", "\x00\x01", "!!!???...", " \n \n ", "a" * 3000,
       "tab\tand  spaces   end   ", "\u0660\u0661 \u4e00 \u16ee"]


def expected(texts):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    out = []
    for text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        out.append((ids, tokenizer.decode(ids, skip_special_tokens=False)))
    return out


def odd_texts():
    rng = random.Random(1)
    letters = "ab '\n\t  é½日\U0001F600\u200d\x1c\xa0.,!12<|>s"
    return ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 80))) for _ in range(300)]


def test_ids_equal_the_library(spark):
    texts = odd_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    want = expected(texts)
    for chars, buckets in ((bpe.BLOCK_CHARS, None), (500, 3)):
        found = {r["doc_id"]: r for r in bpe.tokenize(docs, PATH, chars, buckets).collect()}
        assert [(list(found[n]["ids"]), found[n]["decoded"]) for n in range(len(texts))] == want
        assert [found[n]["decoded"] for n in range(len(texts))] == texts


def test_digests(spark):
    texts = ODD[:9]
    found = bpe.tokenize(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), PATH, result=bpe.digests()).collect()
    for row in found:
        ids, text = expected([texts[row["doc_id"]]])[0]
        assert tuple(row)[1:] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_decoding_by_join(spark):
    lists = [[15496, 995], [], None, [50256, 220], [15496, 995], [99999], [255 - 33]]
    frame = spark.createDataFrame([(n, x) for n, x in enumerate(lists)], "n long, ids array<int>")
    found = {r["n"]: r["decoded"] for r in bpe.decode(frame, PATH).collect()}
    assert [found[n] for n in range(6)] == ["Hello world", "", None, "<|endoftext|> ", "Hello world", ""] and len(found[6]) == 1


def test_awkward_rows(spark, awkward, nothing):
    found = bpe.tokenize(awkward, PATH).collect()
    texts = [r["text"] for r in awkward.collect()]
    assert sorted(r["decoded"] for r in found) == sorted(t or "" for t in texts)
    assert sorted(map(str, (r["doc_id"] for r in found))) == sorted(str(r["doc_id"]) for r in awkward.collect())
    assert bpe.tokenize(nothing, PATH).count() == 0
