import hashlib

import pytest
from tokenizers import Tokenizer

from loanmart.llm import queries
from loanmart.llm.bpe import TokenStore, encode, encode_digests, encode_rows, vocabulary
from tests.conftest import SF_MID

PATH = queries.tokenizer_path()
ODD = ["", "a", " ", "  ", "   x", "a  b", "a \n b", "foo\n \nbar", "x\n ", "\t a", "it's we'll  they're 's 'S", "''s", "x'", "'", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "<|endoftext", "a" * 40,
       "aaaaaaaaaaa aaaa", "日本 語 x 　y", "é" * 50, " lead", "trail ", "\n\n", "a\n\n b", "🙂🙂 x\r\n y", "١٢٣ 45", "x y", "x  y", "\x1c a", "a \x1c b", "\x85 \x85", "tab\tand  two", None]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_odd_texts_against_the_library(spark, library):
    df = spark.createDataFrame([(k, t, 1) for k, t in enumerate(ODD)] + [(None, "x y", 2), (3, "  ", 3)], "doc_id long, text string, ids int")
    for r, t in zip(encode(df, PATH, keep=("doc_id", "text")).collect(), [*ODD, "x y", "  "]):
        want = library.encode(t or "", add_special_tokens=False).ids
        assert r.ids == want, t
        assert r.decoded == library.decode(want, skip_special_tokens=False) == (t or "")
    assert encode_digests(df.limit(0), PATH).collect() == []


def test_query_against_the_library(spark, library):
    texts = dict(spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").collect())
    ids = list(texts)
    want = {i: e.ids for i, e in zip(ids, library.encode_batch([texts[i] or "" for i in ids], add_special_tokens=False))}
    got = queries.QUERIES["op9_bpe"](spark, SF_MID).collect()
    assert len(got) == len(ids)
    for r in got:
        raw = b"".join(x.to_bytes(4, "little") for x in want[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(want[r.doc_id]), hashlib.sha256(raw).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_a_hash_collision_is_mended(monkeypatch, library):
    import numpy as np
    import pyarrow as pa

    from loanmart.llm import bpe

    monkeypatch.setattr(bpe, "span_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64))
    texts = ["the cat and the dog", "one two six"]
    (_, ids, back), = encode_rows(pa.array(texts), TokenStore(vocabulary(PATH)))
    assert [x.tolist() for x in ids] == [library.encode(t).ids for t in texts] and [b.decode() for b in back] == texts
