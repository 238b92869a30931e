"""Spelling variants, hard negatives and sharding on small hand-made rows, against brute force in Python."""

import collections
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from salestax_spark.llm import negatives, sharding, spelling

# ---- Spelling variants --------------------------------------------------------------------------


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants_by_hand(counts):
    out = {}
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (counts[w], len(near[w]), form[w], counts[form[w]] if form[w] else None, root)
    return out


def found_variants(spark, counts):
    df = spark.createDataFrame(list(counts.items()) or [], "word string, n long").repartition(3)
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.spelling_variants(df).collect()}


def test_variants_equal_brute_force(spark):
    rng = random.Random(5)
    counts = {"".join(rng.choice("abé") for _ in range(rng.randint(5, 7))): 3 * 2 ** rng.randint(0, 6) for _ in range(300)}
    counts |= {"aaaaa": 3, "aaaaaa": 6, "aaaaaaa": 12, "aaaaaaaa": 24, "×÷ÿÀß": 7, "×÷ÿÀ": 7}
    assert found_variants(spark, counts) == variants_by_hand(counts)


def test_ties_go_to_the_first_word_by_code_points(spark):
    counts = {"worde": 3, "words": 8, "wordz": 8, "wordà": 8, "alone": 5}
    found = found_variants(spark, counts)
    assert found == variants_by_hand(counts)
    assert found["worde"][2:] == ("words", 8, "words") and found["alone"] == (5, 0, None, None, "alone")


def test_long_words_are_near_each_other(spark):
    long = "".join(random.Random(1).choice("abc") for _ in range(700))
    counts = {long: 20, long[:300] + long[301:]: 5, long[:-1] + "x": 5, "y" + long: 2, long[:40]: 3, long[:41]: 9, "z" * spelling.LONG: 4, "z" * (spelling.LONG + 1): 9}
    assert found_variants(spark, counts) == variants_by_hand(counts)


def test_a_chain_of_forms_ends_at_its_root(spark):
    """The longest possible kind of chain: every count twice the one before, words a letter longer each time."""
    counts = {"a" * (5 + k): 3 << k for k in range(50)}
    found = found_variants(spark, counts)
    assert {v[4] for v in found.values()} == {"a" * 54}


def test_runs_of_texts(spark):
    texts = [(1, "Straße STRASSE don't"), (2, None), (3, ""), (3, "Été été"), (None, "Éa"), (4, "a" * 5000), (5, "123 !")]
    texts += [(i, "hello") for i in range(1000, 1400)]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("word", F.lit("clash"))
    want = []
    for i, text in texts:
        for run in __import__("re").findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            want.append(run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run)
    got = [r.word for r in spelling.edited_runs(df).collect()]
    assert sorted(got) == sorted(want) and any(w != "hello" and len(w) == 4 for w in got)
    assert spelling.frequent_words(spelling.edited_runs(df)).where("word = 'hello'").first().n == want.count("hello")


def test_no_words(spark):
    assert found_variants(spark, {}) == {}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_variants(spelling.frequent_words(spelling.edited_runs(empty))).count() == 0


# ---- Hard negatives -----------------------------------------------------------------------------


def negatives_by_hand(rows, anchor):
    usable = [(k, i, label, [int(x) for x in v]) for k, (i, label, v) in enumerate(rows) if label is not None and v is not None and None not in v]
    order = lambda x: (-x[0], float("inf") if x[1] is None else x[1])
    out = collections.Counter()
    for k, i, label, v in usable:
        if i is None or not anchor(i):
            continue
        scored = [(sum(a * b for a, b in zip(v, w, strict=True)), j, other == label) for m, j, other, w in usable if m != k and len(v) == len(w)]
        for p, pid, _ in sorted([s for s in scored if s[2]], key=order)[:5]:
            hard = sorted([s for s in scored if not s[2] and 50 * p <= 100 * s[0] <= 95 * p], key=order)[:3]
            out.update((i, pid, r, n[1], p, n[0]) for r, n in enumerate(hard, 1))
    return out


def mined(spark, rows, every=5):
    df = spark.createDataFrame(rows, "vec_id long, label string, vector array<bigint>").withColumn("rank", F.lit(9)).repartition(3)
    return collections.Counter(tuple(r) for r in negatives.mine_hard_negatives(df, F.col("vec_id") % every == 0).collect())


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(negatives, "ROWS", 16)
    monkeypatch.setattr(negatives, "ANCHORS", 4)


@pytest.mark.parametrize("spread", [2, 40, 256])
def test_negatives_equal_brute_force(spark, small_blocks, spread):
    """Clustered vectors, so that the bounds rule pairs out; a small spread gives many equal scores."""
    rng = np.random.default_rng(spread)
    centres = rng.integers(-spread // 8, spread + 1, (6, 20))
    rows = [(i, "ab"[i % 2] if i % 3 else "c", [int(x) for x in centres[i % 6] + rng.integers(-2, 3, 20)]) for i in range(240)]
    found = mined(spark, rows)
    # Ids are unique, so ties have one answer.
    assert found == negatives_by_hand(rows, lambda i: i % 5 == 0) and found


def test_rows_that_take_no_part_and_odd_vectors(spark, small_blocks):
    rows = [(0, "a", [3, 4]), (1, "a", [3, 5]), (2, "b", [2, 2]), (3, "b", [9, None]), (4, None, [2, 2]), (5, "a", None), (6, "b", [2, 2, 2])]
    rows += [(10, "a", [3, 4]), (10, "a", [3, 4]), (None, "b", [2, 2]), (15, "e", []), (20, "e", []), (16, "f", []), (25, "z", [1]), (30, "b", [0, 0])]
    found = mined(spark, rows)
    assert found == negatives_by_hand(rows, lambda i: i % 5 == 0)
    assert (15, 20, 1, 16, 0, 0) in found and any(f[3] is None for f in found)
    assert mined(spark, []) == collections.Counter()


def test_copies_that_own_a_third_of_all_rows(spark, small_blocks):
    rng = np.random.default_rng(2)
    rows = [(i, "a", [5] * 8) for i in range(100)] + [(i, "bc"[i % 2], [int(x) for x in rng.integers(0, 6, 8)]) for i in range(100, 300)]
    assert mined(spark, rows, 25) == negatives_by_hand(rows, lambda i: i % 25 == 0)


def test_scores_beyond_exact_doubles(spark):
    big = 1 << 40
    rows = [(0, "a", [big, 1]), (1, "a", [1 << 20, 3]), (2, "b", [1 << 19, 2]), (3, "b", [1 << 19, 4]), (4, "b", [(1 << 20) - 1, 4])]
    assert mined(spark, rows) == negatives_by_hand(rows, lambda i: i % 5 == 0)
    top = (1 << 63) - 1
    found = mined(spark, [(0, "a", [top]), (1, "a", [top]), (2, "b", [1 << 20])])
    assert found == collections.Counter()


def test_bounds_hold_the_scores():
    rng = np.random.default_rng(0)
    for dim in (1, 3, 4, 17, 64):
        a, b = rng.integers(-300, 300, (7, dim)), rng.integers(-300, 300, (9, dim))
        scores, widths = negatives.exact_scores(a, b), []
        assert (scores == a @ b.T).all()
        for lower, upper in negatives._bounds(negatives.summarise(a), negatives.summarise(b), dim):
            assert (lower <= scores).all() and (scores <= upper).all()
            widths.append((upper - lower).mean())
        assert widths == sorted(widths, reverse=True)


def test_whole_components(spark):
    df = spark.createDataFrame([([0.5, -0.001],), ([float("nan")],), ([1.0, None],), (None,), ([],), ([float("inf")],)], "v array<double>")
    assert [r[0] for r in df.select(negatives.whole_components(F.col("v"))).collect()] == [[128, -1], None, None, None, [], None]


# ---- Sharding -----------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 5, 24, 25, 100, 1001])
def test_every_row_number_has_one_place_and_back(spark, n):
    there = sharding.place_of(spark.range(n).withColumnRenamed("id", "row_number"), n, shards=7, seed=n)
    back = sharding.row_at(there.withColumnRenamed("row_number", "was"), n, shards=7, seed=n).collect()
    assert all(r.row_number == r.was for r in back)
    slots = collections.defaultdict(list)
    for r in back:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[k]) for k in range(7)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == n


def test_the_shuffle_looks_random(spark):
    n = 4096
    rows = sharding.place_of(spark.range(n).withColumnRenamed("id", "row_number"), n, shards=16).collect()
    # Neighbours land in the same shard about as often as by chance.
    shard = {r.row_number: r.shard for r in rows}
    same = sum(shard[i] == shard[i + 1] for i in range(n - 1)) / (n - 1)
    assert abs(same - 1 / 16) < 0.02
    places = [r.slot * 16 + r.shard for r in sorted(rows)]
    assert abs(np.corrcoef(places, range(n))[0, 1]) < 0.06


def test_shards_do_not_depend_on_the_partitions(spark):
    rows = [(i % 150 if i % 3 else 7, f"t{i % 40}", i) for i in range(600)] + [(None, None, None)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, slot long")
    one, other = (
        sorted(map(tuple, sharding.shard_rows(df.repartition(k)).select("doc_id", "text", "row_number", "shard", "slot").collect()), key=repr) for k in (1, 9)
    )
    assert one == other and len(one) == 603
    assert sorted(r[2] for r in one) == list(range(603))
    assert sharding.shard_rows(df.limit(0)).count() == 0
    other_seed = sharding.shard_rows(df, seed=99).select("row_number", "shard", "slot").collect()
    assert {tuple(r) for r in other_seed} != {r[2:] for r in one}


def test_nested_and_extra_columns_stay(spark):
    df = spark.createDataFrame([(1, {"a": 1}, [1, 2], "x"), (2, None, None, "y" * 100_000)], "doc_id long, m map<string,int>, `a.b` array<int>, _part string")
    rows = sharding.shard_rows(df, shards=1).collect()
    assert sorted((r.doc_id, r.m, r["a.b"], len(r._part)) for r in rows) == [(1, {"a": 1}, [1, 2], 1), (2, None, None, 100_000)]
    assert sorted(r.slot for r in rows) == [0, 1] and set(itertools.chain(r.shard for r in rows)) == {0}
