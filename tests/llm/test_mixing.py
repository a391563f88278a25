import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shelfsense.llm import mixing


def brute_targets(sizes):
    """sizes: {source: words}; reshare until no target is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, out, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        level = (total - sum(out.values())) / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not full:
            return out | {s: level * weight[s] for s in free}
        out |= {s: 2.0 * sizes[s] for s in full}
        free -= full
    return out


def rows(n, seed=2):
    pick = random.Random(seed)
    names = ["a"] * 12 + ["b", "c", "Z", "é", None, "dd", "tiny", *map("src{}".format, range(20))]
    out = []
    for i in range(n):
        s = pick.choice(names)
        k = pick.choice([0, 1, 3, 30, 200]) if s != "tiny" else 1
        out.append((i, pick.choice([" ", "\n", " \x0b "]).join(pick.choices(["w", "ö", "xx"], k=k)) if k else None, s))
    return [*out, (n, "x " * 3000, "b"), (n, "x " * 3000, "b"), (None, "p q", "c"), (None, "p q r", "c")]


@pytest.mark.parametrize("n", [3, 40, 900])
def test_targets_and_words_taken(spark, n):
    data = rows(n)
    docs = spark.createDataFrame([(*r, "t") for r in data], "doc_id long, text string, source string, target string")
    got = mixing.mix(docs.repartition(5)).collect()
    assert len(got) == len(data)
    sizes, taken = Counter(), Counter()
    for _, t, s in data:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    wanted = brute_targets(sizes)
    for r in got:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(wanted[r.source], rel=1e-9)
    for s, t in wanted.items():
        assert abs(taken[s] - t) <= 0.5, s
    again = mixing.mix(docs.repartition(3)).collect()
    assert Counter(again) == Counter(got)
    # the mix as rows holds just these words
    words = Counter()
    for r in mixing.repeated(docs).collect():
        words[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert all(abs(words[s] - taken[s]) <= 1 for s in taken)


def test_tree_parts_blocks_exactly(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "a b c", f"s{i % 3}") for i in range(600)], "doc_id long, text string, source string")
    monkeypatch.setattr(mixing, "BLOCKS", 90)
    shards, mean = 2**mixing.LEVELS, defaultdict(float)
    for seed in range(4):
        mixed = mixing.mix(docs, seed=100 * seed).cache()
        drawn = Counter((r.source, r.block) for r in mixed.where("shard IS NOT NULL").collect())
        owners = mixed.where("shard IS NOT NULL").select("source", "block", "shard").distinct().count()
        assert owners == len(drawn)  # disjoint
        got = mixing.quotas(mixed).collect()
        per_shard = Counter()
        for r in got:
            per_shard[r.shard] += r.blocks
            mean[r.source] += r.blocks / shards / 4
        assert max(per_shard.values()) - min(per_shard[i] for i in range(shards)) <= 1
        assert sum(per_shard.values()) == len(drawn)


def test_every_epoch_is_dealt_and_rows_stand_in_that_order(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"a{i} b c", f"s{i % 3}") for i in range(600)], "doc_id long, text string, source string")
    monkeypatch.setattr(mixing, "BLOCKS", 90)
    shards = 2**mixing.LEVELS
    mixed = mixing.mix(docs).cache()
    takings, wanted = {}, defaultdict(list)
    for r in mixed.collect():
        takings[r.id] = sum(x is not None for x in r.shards)
        assert takings[r.id] == sum(x is not None for x in r.places) >= -(-r.taken // 3)
        assert (r.shard, r.shuffled) == (r.shards[0], r.places[0])
        for turn in range(-(-r.taken // 3)):
            wanted[r.shards[turn]].append((r.places[turn], r.id, min(3, r.taken - 3 * turn)))
    # s0 is taken twice whole, s1 in part, s2 once whole and in part
    assert all(takings[i] == 2 for i in range(0, 600, 3)) and all(takings[i] >= 1 for i in range(2, 600, 3))
    for epoch in (0, 1):
        dealt = mixed.where(F.col("shards")[f"epoch{epoch}"].isNotNull()).select("source", "block").distinct().count()
        per_shard = Counter()
        for r in mixing.quotas(mixed, epoch).collect():
            per_shard[r.shard] += r.blocks
        assert sum(per_shard.values()) == dealt
        assert max(per_shard.values()) - min(per_shard[i] for i in range(shards)) <= 1
    partitions = mixing.repeated(docs).rdd.glom().collect()
    pieces = len(partitions) // shards
    assert len(partitions) == pieces * shards
    for shard in range(shards):
        rows = [(r.doc_id, len(r.text.split())) for part in partitions[shard * pieces : (shard + 1) * pieces] for r in part]
        assert rows == [(i, words) for _, i, words in sorted(wanted[shard])]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(docs).collect() == [] and mixing.repeated(docs).collect() == []
    bare = spark.createDataFrame([(1, None, None), (2, " ", "a")], docs.schema)
    assert [(r.size, r.target, r.taken) for r in mixing.mix(bare).collect()] == [(0, 0.0, 0)] * 2
    assert mixing.repeated(bare).collect() == []
    plan = mixing.mix(bare)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
