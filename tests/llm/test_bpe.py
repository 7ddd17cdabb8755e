import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postlens.llm import bpe

from .helpers import SF, docs_of, edge_rows

PATH = public_tokenizers.path("byte_bpe_50k.json")
_BYTES = bpe.encoder(*bpe.load(PATH))


def ENCODE(text):
    return memoryview(_BYTES(text)).cast("i").tolist()


OTHER = Tokenizer.from_file(PATH)
ODD = ["", " ", "  a", "a  b\n\n c", "it's WE'LL 's", "<|endoftext|>", "x<|endoftext|> y<|endoftext|>", "日本語 テキスト", "😀👍🏽", "\x00\x01\x7f",
       "   x", "İKß", "12 345,6", "a" * 3000, "ab" * 400, "\t\r\n\x0b\x0c", "a\x1c b\x1d\x1e\x1f c", "a\x85b\xa0 c\u3000 d\u200b", "é", " x", "'S 'T"]


@pytest.fixture(scope="module")
def other():
    return Tokenizer.from_file(PATH)


def test_odd_texts(other):
    for text in ODD:
        assert ENCODE(text) == other.encode(text, add_special_tokens=False).ids, text[:20]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=("Cs",)), max_size=60))
def test_any_text(text):
    known = OTHER
    assert ENCODE(text) == known.encode(text, add_special_tokens=False).ids


def test_scan_and_heap_cut_alike():
    ids, merges, _ = bpe.load(PATH)
    words = bpe.Words(ids, merges)
    random.seed(5)
    for n in (1, 2, 7, 50, 300):
        for letters in ("ab", "theanoig", "aaaa", "xyz0"):
            word = "".join(random.choices(letters, k=n)).encode()
            parts = [words.single[b] for b in word]
            assert words.by_scan(list(parts)) == words.by_heap(list(parts))


def check(rows, result, other):
    want = []
    for i, text, *_ in rows:
        ids = other.encode(text or "", add_special_tokens=False).ids
        back = other.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in result]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_tables(spark, other):
    rows = edge_rows() + [(100 + i, t, "o") for i, t in enumerate(ODD)]
    docs = docs_of(spark, rows)
    check(rows, bpe.digests(docs, PATH).collect(), other)
    assert bpe.digests(docs.limit(0), PATH).count() == 0
    table = spark.read.parquet(f"{SF}/documents.parquet")
    check([(r.doc_id, r.text) for r in table.collect()], bpe.digests(table, PATH).collect(), other)


def test_other_columns_stay(spark):
    docs = docs_of(spark, [(1, "a b", "x"), (2, None, None)])
    assert bpe.encode(docs, PATH).columns == [*docs.columns, "ids"]
    assert [r.decoded for r in bpe.decode(bpe.encode(docs, PATH), PATH).orderBy("doc_id").collect()] == ["a b", ""]


def test_columns_of_the_same_name_are_replaced(spark):
    docs = docs_of(spark, [(1, "a b", "x"), (2, None, None)]).withColumn("ids", F.lit(1)).withColumn("decoded", F.lit(2))
    for made in (bpe.decode(bpe.encode(docs, PATH), PATH), bpe.round_trip(docs, PATH)):
        assert sorted(made.columns) == sorted(docs.columns)
        assert [(len(r.ids), r.decoded) for r in made.orderBy("doc_id").collect()] == [(2, "a b"), (0, "")]


def test_ids_that_are_no_text_and_null_ids(spark, other):
    ids, _, _ = bpe.load(PATH)
    half = [ids[bytes([b])] for b in "é".encode()]
    rows = [(1, half), (2, half[:1]), (3, [half[1], *half]), (4, []), (5, None), (6, [*half, half[0]])]
    table = spark.createDataFrame(rows, "doc_id long, ids array<int>").coalesce(1)
    got = {r.doc_id: r.decoded for r in bpe.decode(table, PATH).collect()}
    assert got == {i: other.decode(v or [], skip_special_tokens=False) for i, v in rows}
