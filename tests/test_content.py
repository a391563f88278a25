import math
import random
from collections import Counter, defaultdict

import pytest

from shelfsense.operators import content, postings, strips


def products(spark, tags):
    rows = [(i, f"p{i}", "", "", t) for i, t in tags.items()]
    return spark.createDataFrame(rows, "productId bigint, name string, categories string, imageUrl string, tags string")


def brute_force(tags, k, include_zero=True, separator="|"):
    docs = {}
    for i, t in tags.items():
        docs[i] = Counter((t.replace(separator, " ") if separator else t).lower().split())
    df = Counter(w for d in docs.values() for w in d)
    vec = {
        i: {w: n * math.log((len(docs) + 1) / (df[w] + 1)) for w, n in d.items()} for i, d in docs.items()
    }
    norm = {i: math.sqrt(sum(x * x for x in v.values())) for i, v in vec.items()}
    out = {}
    for a in vec:
        if norm[a] == 0:
            continue
        sims = []
        for b in vec:
            if a != b and norm[b] > 0:
                s = sum(x * vec[b].get(w, 0.0) for w, x in vec[a].items()) / norm[a] / norm[b]
                if include_zero or s > 0:
                    sims.append((-round(s, 6) + 0.0, b))
        if sims:
            out[a] = [(b, -s + 0.0) for s, b in sorted(sims)[:k]]
    return out


def ranked(df):
    lists = defaultdict(list)
    for row in df.orderBy("productId", "rank").collect():
        lists[row.productId].append((row.rid, row.r))
    return dict(lists)


def catalogue(seed, n=120):
    """A third of the products are copies, one tag is in every product, some have repeats or no tags."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(25)]
    tags = {}
    for i in range(n):
        if i % 3 == 0:
            tags[i * 7] = "all|w1|w2|W3"
        elif i % 20 == 1:
            tags[i * 7] = rng.choice(["", "all", "all|all"])
        else:
            tags[i * 7] = "|".join(["all", *rng.choices(words, k=rng.randint(1, 5))])
    return tags


@pytest.mark.parametrize("include_zero", [True, False])
@pytest.mark.parametrize("head", [0, 3, 256])
def test_equals_brute_force(spark, monkeypatch, include_zero, head):
    monkeypatch.setattr(strips, "HEAD_TERMS", head)
    tags = catalogue(head)
    got = ranked(content.similar_by_content(products(spark, tags), 5, include_zero=include_zero))
    assert got == brute_force(tags, 5, include_zero)


def test_whole_tag_list_as_one_word(spark):
    tags = {1: "a|b", 2: "a|b", 3: "a|c", 4: "B|a"}
    got = ranked(content.similar_by_content(products(spark, tags), 5, separator=None, include_zero=False))
    assert got == {1: [(2, 1.0)], 2: [(1, 1.0)]}


def test_hashed_lists(spark):
    tags = catalogue(1)
    exact = brute_force(tags, 5)
    # with far more buckets than words there are no collisions, and hashing changes nothing
    got = ranked(content.similar_by_content(products(spark, tags), 5, hashed=True, buckets=1 << 14))
    assert got == exact
    few = ranked(content.similar_by_content(products(spark, tags), 5, hashed=True))
    for own, recs in few.items():
        scores = [r for _, r in recs]
        assert len(recs) == 5 and scores == sorted(scores, reverse=True) and own not in dict(recs)


def test_idf_golden(spark):
    docs = content.tag_words(products(spark, {1: "x", 2: "y", 3: "z|z"}))
    rows = {r.productId: (r.tf, r.df, round(r.weight, 6)) for r in content.tfidf_weights(docs).collect()}
    assert rows == {1: (1, 1, 0.693147), 2: (1, 1, 0.693147), 3: (2, 1, 1.386294)}


def test_only_common_words(spark):
    assert content.similar_by_content(products(spark, {1: "x", 2: "x"}), 5).collect() == []


@pytest.mark.parametrize("hashed", [True, False])
def test_products_without_tags_have_no_lists(spark, hashed):
    tags = {1: None, 2: "", 3: "a|b", 4: "a|c", 5: "d"}
    got = ranked(content.similar_by_content(products(spark, tags), 5, hashed=hashed, buckets=1 << 14))
    assert set(got) == {3, 4, 5}
    assert got[3][0][0] == 4 and got[5] == [(3, 0.0), (4, 0.0)]


def test_repeated_products_count_once(spark):
    once = products(spark, {1: "a|b", 2: "a|c", 3: "d"})
    twice = once.unionByName(once).unionByName(products(spark, {2: "z|z"}))
    assert ranked(content.similar_by_content(twice, 3)) == ranked(content.similar_by_content(once, 3))
    weights = [sorted(content.tfidf_weights(content.tag_words(p)).collect()) for p in (once, twice)]
    assert weights[0] == weights[1]


def pairs_read(spark, tags, k):
    """(pairs that a list of the best k compares, rows of the index)."""
    docs = content.tag_words(products(spark, tags))
    reps = content._distinct_vectors(content._keyed(docs), k)
    rows = content._exact_vectors(reps, docs, docs.count()).cache()
    first = postings.first_asked(rows, k)
    known = postings._best(postings._meet(first, rows, k, 256, 256), k)
    return postings.compared_pairs(first) + postings.compared_pairs(postings.then_asked(rows, known, k)), rows.count()


def test_index_reads_a_small_share_of_the_pairs(spark):
    """Words of falling frequency and one in a third of the products: that one is hardly ever asked."""
    rng = random.Random(3)
    words, shares = [f"w{i}" for i in range(800)], [1 / (i + 20) for i in range(800)]
    tags = {i: "|".join([*rng.choices(words, shares, k=6), *(["often"] if i % 3 == 0 else [])]) for i in range(3000)}
    pairs, n = pairs_read(spark, tags, 6)
    assert n > 2900 and pairs < n * n / 10


@pytest.mark.parametrize("strip_rows,chunk_rows", [(1, 1), (7, 3), (3, 1000)])
def test_frequent_terms_in_strips_and_chunks(spark, strip_rows, chunk_rows):
    tags = catalogue(8)
    docs = content.tag_words(products(spark, tags))
    reps = content._distinct_vectors(content._keyed(docs), 5)
    rows = content._exact_vectors(reps, docs, docs.count()).cache()

    def lists(df):
        return sorted(tuple(r) for r in df.where("r > 0").select("id", "rank", "rid", "r").collect())

    n = rows.count()
    every = strips.top_by_product(
        rows, rows, 6, ["terms", "weights"], strips.SparseStrip, n, n, above=0.0, skip_self=False
    )
    assert lists(postings.top_by_terms(rows, 6, n, strip_rows, chunk_rows)) == lists(every)
