import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import tiktoken

from playline.llm import bpe
from playline.llm.bpe import Encoder, PerfectHash, decode, digests, encode, load_ranks
from playline.llm.spans import mix


@pytest.fixture(scope="module")
def ranks():
    return load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def tokens(ranks):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def texts():
    pick = random.Random(5)
    parts = list("'stremvld aZé日٣½²_-\n\t\r   　\x1c\x85🙂0'’") + [
        "'s", "'re", "'ll ", " '", "  ", "the", " erre", "<|endoftext|>", "''ve", "\n\n",
    ]
    out = ["", " ", "  ", "a", "'", "'s", "x's 're'", "\n a", "a \n b  c\n\nd", " \n"]
    out += ["".join(pick.choice(parts) for _ in range(pick.randrange(1, 90))) for _ in range(800)]
    return out


def test_ids_equal_the_library(ranks, tokens):
    own, rows = Encoder(ranks), texts()
    assert [x.tolist() for x in own.encode(rows)] == [tokens.encode_ordinary(t) for t in rows]
    assert [own.decode(x) for x in own.encode(rows)] == [t.encode() for t in rows]


def test_long_texts_and_chunk_borders(ranks, tokens):
    own, pick = Encoder(ranks), random.Random(1)
    rows = [
        "".join(pick.choice(["the ", "er", " a", "\n", "  ", "'ll"]) for _ in range(600_000)),
        "no space " + "ab1" * 3000,
        "x" * 5000 + " " * 5000,
    ]
    for row, ids in zip(rows, own.encode(rows)):
        assert ids.tolist() == tokens.encode_ordinary(row)


def test_perfect_hash_is_minimal():
    keys = mix(np.arange(1, 5001, dtype=np.uint64))
    table = PerfectHash.build(keys)
    assert sorted(table.find(keys).tolist()) == list(range(5000))
    assert (table.find(keys + np.uint64(1)) == -1).all()


def test_frames(spark, ranks, tokens):
    rows = [(1, None), (2, ""), (2, "the ' s"), (None, "été"), (3, "a" * 70_000)]
    frame = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, ids int")
    encoded = encode(frame, ranks)
    got = sorted((str(r.doc_id), r.ids) for r in encoded.collect())
    assert got == sorted((str(i), tokens.encode_ordinary(t or "")) for i, t in rows)
    back = sorted((str(r.doc_id), bytes(r.utf8)) for r in decode(encoded, ranks).collect())
    assert back == sorted((str(i), (t or "").encode()) for i, t in rows)
    for r in digests(frame, ranks).collect():
        assert any(
            str(r.doc_id) == str(i)
            and r.n_tokens == len(tokens.encode_ordinary(t or ""))
            and r.ids_sha256
            == hashlib.sha256(" ".join(map(str, tokens.encode_ordinary(t or ""))).encode()).hexdigest()
            and r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
            for i, t in rows
        )
    assert digests(frame.limit(0), ranks).collect() == []


def test_a_worker_holds_the_values_of_few_rows(spark, monkeypatch):
    ranks = {bytes([b]): b for b in range(256)} | {b"er": 256}
    own, taken = bpe.Encoder(ranks), []

    class Noted:
        tokens, decode = own.tokens, staticmethod(own.decode)

        def encode(self, texts):
            taken.append(len(texts))
            return own.encode(texts)

    frame = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    monkeypatch.setattr(bpe, "encoder", lambda shared: Noted())
    monkeypatch.setattr(type(frame), "mapInArrow", lambda self, run, schema: run)
    rows = pa.RecordBatch.from_pydict(
        {"doc_id": list(range(2500)), "utf8": [f"over {i}".encode() for i in range(2500)]}
    )
    for operator in (bpe.encode, bpe.digests):
        parts = list(operator(frame, ranks)(iter([rows])))
        assert taken == [1000, 1000, 500]
        assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(2500))
        taken.clear()
