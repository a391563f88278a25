import random
import re

import pytest

from shelfsense.llm import substrings


def brute(rows, width):
    """rows: (id, text), distinct -> {(id, text): (n_words, n_removed, kept)}."""
    words = {r: re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in rows}
    seen, out = set(), {}
    for r in sorted(words, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        gone = set()
        for i in range(len(words[r]) - width + 1):
            window = tuple(words[r][i : i + width])
            if window in seen:
                gone.update(range(i, i + width))
            seen.add(window)
        kept = [w for i, w in enumerate(words[r]) if i not in gone]
        out[r] = (len(words[r]), len(gone), " ".join(kept))
    return out


@pytest.mark.parametrize("chars", [10**9, 300])
def test_against_brute_force(spark, monkeypatch, chars):
    monkeypatch.setattr(substrings, "BUCKET_CHARS", chars)
    monkeypatch.setattr(substrings, "SHARD_CHARS", 2 * chars)
    pick = random.Random(3)
    passages = [pick.choices("abcdefgh", k=k) for k in (15, 20, 25, 40)]
    rows = {}
    for i in range(120):
        words = []
        for _ in range(pick.randrange(6)):
            words += pick.choice([pick.choice(passages), pick.choices("stuvwxyzé", k=pick.randrange(30))])
        rows[i * 3 - 50] = pick.choice([" ", "\n", " \t "]).join(words)
    rows = [*rows.items(), (1000, rows[-50]), (1001, "a " * 500), (1002, "a " * 500), (1003, "a b " * 100), (5000, None), (5001, "")]
    rows += [(i, " ".join(passages[3])) for i in range(2000, 2040)]  # a group of copies
    rows += [(7, " ".join(passages[3] + ["q"] * 30)), (7, " ".join(passages[2] * 2))]  # an id of two texts
    docs = spark.createDataFrame([(i, t, "kept?") for i, t in rows + rows[:5]], "doc_id bigint, text string, kept string")
    got = substrings.remove_repeats(docs).collect()
    wanted = brute(rows, 20)
    assert len(got) == len(rows) + 5
    for r in got:
        assert (r.n_words, r.n_removed, r.kept) == wanted[r.doc_id, r.text], r.doc_id


def test_null_ids_come_last_and_empty_tables(spark):
    text = " ".join(map(str, range(30)))
    docs = spark.createDataFrame([(None, text), (None, text + " x"), (4, text), (2, text)], "doc_id bigint, text string")
    got = sorted((r.doc_id or 99, r.n_removed) for r in substrings.remove_repeats(docs).collect())
    assert got == [(2, 0), (4, 30), (99, 30), (99, 30)]
    assert substrings.remove_repeats(docs.limit(0)).collect() == []
