import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from shelfsense.llm import simhash
from shelfsense.llm.graph import components


def brute_bits(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(bits, distance):
    """Least position reachable, by breadth-first search."""
    bits = np.array(bits, np.uint64)
    near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= distance
    least = {}
    for i in range(len(bits)):
        if i not in least:
            todo = [i]
            while todo:
                k = todo.pop()
                if k not in least:
                    least[k] = i
                    todo += np.flatnonzero(near[k]).tolist()
    return least


def test_fingerprints(spark):
    texts = ["", None, "one", "Two wOrds", "a b c", "ÄA b\x0bc d e", "x " * 300, "q w e r t y " * 40, "\t \n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: r.bits % 2**64 for r in simhash.fingerprints(docs).collect()}
    assert got == {i: brute_bits(t) for i, t in enumerate(texts)}
    same = docs.where("doc_id = 3").select(F.xxhash64(F.lit("two words")).alias("h")).first().h
    assert got[3] == same % 2**64


def test_groups_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LEAF", 16)
    pick = random.Random(5)
    bits = [0, 7, 2**64 - 1]
    for _ in range(300):
        base = pick.getrandbits(64)
        bits.append(base)
        for _ in range(pick.choice([0, 0, 1, 4])):
            for b in pick.sample(range(64), pick.choice([1, 2, 3, 4])):
                base ^= 1 << b
            bits.append(base)
    centre = pick.getrandbits(64)  # a large group, alike in most bits
    bits += [centre ^ sum(1 << b for b in pick.sample(range(64), pick.randrange(4))) for _ in range(400)]
    bits += [bits[5]] * 200
    rows = [(i, b - 2**64 if b >= 2**63 else b) for i, b in enumerate(bits)]
    frame = spark.createDataFrame(rows, "id long, bits long")
    for distance in (3, 1):
        got = {r.id: r.component_id for r in simhash.groups(frame, distance).collect()}
        assert got == brute_groups(bits, distance)


def test_keep_one(spark):
    rows = [(3, "a b c d e", "x"), (1, "a b c d e", "y"), (1, "a b c d e", "y"), (None, "A b c d e", "z"), (5, None, "n")]
    rows += [(None, "other words stand here", "m"), (None, "other words stand here", "m")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bits string")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.bits) for r in kept.collect()) == [(0, "m"), (1, "y"), (5, "n")]
    assert simhash.keep_one(docs.limit(0)).collect() == []


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (160, 159), (300, 200)]
    got = {r.a: r.b for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    wanted = {i: 0 for i in range(1, 61)} | {i: 100 for i in range(101, 161)} | {300: 200}
    assert got == wanted
