import zlib

import cases
import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from cadenza.llm import packing
from cadenza.llm.suite import tokenizer_paths

TEXTS = ["", "plain words, and more.", "two  blanks \n and\ttabs ", " leading", "trailing ", "ünïcode ßtraße ñandú 漢字 😀", "a<|endoftext|>b", "<|endoftext|>", "<|endoftext|>x and y<|endoftext|>", "one <|endoftext|> two <|endoftext|><|endoftext|>  three", "cut <|endof text|>", "it's we'll", "x\0y", "a b  c", "no break   wide", "1234 56\r\n78", "ǅ İ"]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_known_words_give_the_tokenizers_ids(spark, plain):
    encode = packing.WordTokenizer(*tokenizer_paths()).encode
    for text in [*TEXTS, *(t or "" for t in cases.texts())]:
        assert np.frombuffer(encode(text), "<u4").tolist() == plain(text)


def test_ids_of_every_document_are_the_tokenizers(spark):
    def differing(batches):
        tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        encode = packing.WordTokenizer(*tokenizer_paths()).encode
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            same = [encode(t) == np.array(tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
            yield pa.RecordBatch.from_pydict({"n": [len(same)], "same": [sum(same)]}, pa.schema([("n", pa.int64()), ("same", pa.int64())]))

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").repartition(8)
    n, same = docs.mapInArrow(differing, "n long, same long").groupBy().sum("n", "same").first()
    assert n == same > 9_000


@pytest.mark.parametrize("group", [1 << 20, 3_000])
def test_pieces_cover_every_document_once(spark, plain, group):
    docs = cases.documents(spark, [*cases.texts(), *TEXTS]).repartition(3)
    rows = packing.pack(docs, *tokenizer_paths(), room=256, group=group).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        ids = np.array([*plain(texts[doc]), 1], dtype="<u4")
        copies = 2 if doc == 3 else 1
        covered = np.zeros(len(ids), dtype=int)
        for p in pieces:
            covered[p["start"] : p["start"] + p["length"]] += 1
            assert p["doc_tokens"] == len(ids) and p["ids_crc32"] == zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes())
        assert (covered == copies).all()
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 256
    tokens = sum(r["length"] for r in rows)
    assert len(by_sequence) == -(-tokens // 256)


def test_costs_are_balanced():
    rng = np.random.default_rng(1)
    lengths = rng.integers(20, 900, 400)
    count = int(lengths.sum()) // 2048
    rows = packing.pack_group(lengths, 2048, count)
    cost, tokens = np.zeros(count), np.zeros(count)
    for _, _, n, sequence, _ in rows:
        cost[sequence] += n + n * n / 512
        tokens[sequence] += n
    assert (tokens == 2048).all()
    assert cost.max() < 1.2 * cost.mean()


def test_no_documents(spark):
    assert packing.pack(cases.nothing(spark), *tokenizer_paths()).count() == 0
