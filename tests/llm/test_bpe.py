import base64
import gc
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from shelfsense.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    frame = bpe.decode(bpe.encode(docs, PATH, public_tokenizers.PATTERN, **options), PATH)
    return {r.doc_id: (r.n_tokens, np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded)) for r in frame.collect()}


def test_chunks_are_stitched_as_if_read_at_once(spark, reference):
    pick = random.Random(7)
    words = ["the", " of", "  ", "\n", "\t\t", "'s", "'re", "naïve", "日本語", "🙂", "123", "4", "!!", " ...", "_", "I'll", " "]
    texts = ["".join(pick.choices(words, k=n)) for n in (0, 1, 5, 40, 200, 900, 900, 3000)]
    texts += ["a" * 500, "x" * 90 + " " * 300 + "y" * 90, " " * 400, "ab " * 200, "a" * 200 + " word" * 30 + "b" * 77, texts[6], None]
    for options in ({}, {"chunk": 40, "overlap": 16}, {"chunk": 64, "overlap": 5}):
        got = encoded(spark, texts, **options)
        for i, text in enumerate(texts):
            wanted = reference.encode_ordinary(text or "")
            assert got[i] == (len(wanted), wanted, (text or "").encode()), (options, text)


def test_long_pre_token(spark, reference):
    text = "".join(random.Random(1).choices("abcdeé", k=30_000))
    assert encoded(spark, [text], chunk=1000, overlap=100)[0][1] == reference.encode_ordinary(text)


def test_repeated_null_and_clashing(spark):
    rows = [(1, "a b", "x", 9), (1, "a b", "x", 9), (None, "c " * 50, None, 1), (None, "c " * 50, None, 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, n_tokens int")
    got = bpe.encode(docs, PATH, public_tokenizers.PATTERN, chunk=20, overlap=8).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 51), (0, 51), (1, 2), (1, 2)]
    assert bpe.encode(docs.limit(0), PATH, public_tokenizers.PATTERN).collect() == []


def mb_of(run, batch):
    """MB of Python objects a worker has at most while it sends on its results, and afterwards; the results themselves."""
    sent = pa.OSFile("/dev/null", "wb")
    tracemalloc.start()
    try:
        found = []
        for part in run(iter([batch])):
            with pa.RecordBatchStreamWriter(sent, part.schema) as out:
                out.write_batch(part)
            found.append(part)
        gc.collect()
        after, most = (x / 1e6 for x in tracemalloc.get_traced_memory())
        return most, after, pa.Table.from_batches(found)
    finally:
        tracemalloc.stop()


def test_memory_of_a_worker_is_bounded(spark, reference):
    shared = bpe._share(spark, PATH)
    shared.value  # read before anything is measured
    text = "some words " * 500
    batch = pa.RecordBatch.from_arrays([pa.array(range(1_600)), pa.array([text] * 1_600)], ["_key", "text"])
    most, _, coded = mb_of(bpe._encoder(shared, public_tokenizers.PATTERN, ["_key"]), batch)
    assert most < 4, "results of the whole batch were held"
    wanted = np.array(reference.encode_ordinary(text), "<u4").tobytes()
    assert coded["_key"].to_pylist() == list(range(1_600)) and set(coded["ids"].to_pylist()) == {wanted}

    coded = coded.combine_chunks().to_batches()[0]
    schema = coded.schema.append(pa.field("decoded", pa.binary()))
    most, _, plain = mb_of(bpe._decoder(shared, 2, schema), coded)
    assert most < 15, "results of the whole batch were held"  # the reversed ranks are some 5 of it
    assert plain["_key"].to_pylist() == list(range(1_600)) and set(plain["decoded"].to_pylist()) == {text.encode()}

    distinct = pa.array([" ".join(f"{chr(97 + i % 26)}{chr(97 + j % 26)}{'xyzw' * (j // 26)}" for j in range(400)) for i in range(26)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(26)), distinct], ["_key", "text"])
    _, after, _ = mb_of(bpe._encoder(shared, public_tokenizers.PATTERN, ["_key"]), batch)
    assert after < 0.5, "pre-tokens were kept for the worker's next task"
    memo = bpe._Memo(bpe.read_ranks(PATH))
    assert memo["x" * 5_000] == np.array(reference.encode_ordinary("x" * 5_000), "<u4").tobytes() and not memo


def test_slices_keep_every_row(spark):
    shared = bpe._share(spark, PATH)
    ids = [None, b"", np.array([65] * 300_000, "<u4").tobytes(), b"", None, np.array([66], "<u4").tobytes()]
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], ["ids"])
    schema = pa.schema([("ids", pa.binary()), ("decoded", pa.binary())])
    parts = list(bpe._decoder(shared, 0, schema)(iter([batch, batch.slice(0, 0), batch.slice(4)])))
    assert len(parts) == 3
    found = pa.Table.from_batches(parts, schema)
    assert found["ids"].to_pylist() == ids + ids[4:]
    tokens = {rank: token for token, rank in bpe.read_ranks(PATH).items()}
    a, b = tokens[65], tokens[66]
    assert found["decoded"].to_pylist() == [None, b"", a * 300_000, b"", None, b, None, b]
