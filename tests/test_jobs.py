import pytest

from shelfsense import schemas as S
from shelfsense.plans import jobs
from shelfsense.shared import run_dir
from shelfsense.sources.catalog import Catalog


def test_text_to_lists(spark):
    base = run_dir(spark, "test-jobs")
    products = [f"{i}^p{i}^1,2^c^img^a|b^{'red|round' if i % 2 else 'blue'}|tag{i % 5}" for i in range(20)]
    ratings = [f"{u},{(u * 7 + n * 3) % 20},{1 + (u + n) % 5},{1260759144 + u}" for u in range(30) for n in range(6)]
    spark.createDataFrame([(x,) for x in products], "value string").write.text(f"{base}/p")
    spark.createDataFrame([(x,) for x in ratings], "value string").write.text(f"{base}/r")
    catalog = Catalog(spark, f"{base}/db")
    jobs.load(catalog, f"{base}/p", f"{base}/r")
    jobs.statistics(catalog)
    jobs.item_lists(catalog)
    jobs.content_lists(catalog)
    jobs.factor_lists(catalog, user_k=4, item_k=3)
    assert catalog.read(S.PRODUCTS_COLLECTION).count() == 20
    assert catalog.read(S.RATING_COLLECTION).count() == 180
    counts = {r.productId: r["count"] for r in catalog.read(S.RATE_MORE_COLLECTION).collect()}
    assert sum(counts.values()) == 180
    assert {r.yearmonth for r in catalog.read(S.RATE_MORE_RECENTLY_COLLECTION).collect()} == {200912}
    assert catalog.read(S.AVERAGE_COLLECTION).count() == len(counts)
    for name, limit in ((S.ITEMCF_COLLECTION, 5), (S.CONTENT_COLLECTION, 5), (S.FACTOR_RECS_COLLECTION, 3)):
        rows = catalog.read(name).collect()
        assert rows and all(0 < len(r.recs) <= limit for r in rows), name
        assert all(r.productId not in [x.rid for x in r.recs] for r in rows)
    users = catalog.read(S.USER_RECS_COLLECTION).collect()
    assert len(users) == 30 and all(len(r.recs) <= 4 for r in users)


def test_updates_make_a_new_snapshot(spark, ratings_of):
    old, new = (Catalog(spark, run_dir(spark, "test-jobs")) for _ in range(2))
    old.overwrite(S.RATING_COLLECTION, ratings_of([(1, 2, 3.0, 4)]))
    updates = ratings_of([(1, 2, 5.0, 9), (1, 3, 1.0, 9)])
    jobs.apply_updates(old, updates, new)
    assert sorted(tuple(r) for r in new.read(S.RATING_COLLECTION).collect()) == [(1, 2, 5.0, 4), (1, 3, 1.0, 9)]
    with pytest.raises(ValueError):
        jobs.apply_updates(old, updates, old)
