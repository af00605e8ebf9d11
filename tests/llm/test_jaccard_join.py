import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leafmill.llm.graph import components
from leafmill.llm.jaccard_join import index_length, link_components, overlap_needed, probe_length


def shingles(text, n):
    words = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).split(" ") if w]
    if not words:
        return set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} or {tuple(words)}


def brute(rows, n, percent):
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    smallest = {}
    for i, (d, _) in enumerate(rows):
        smallest[find(i)] = min(smallest.get(find(i), d), d)
    return sorted((d, len(s), smallest[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


def corpus(seed, families=12, copies=30, loners=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    common = [rng.choices(vocabulary, k=15) for _ in range(3)]
    texts = []
    for _ in range(families):
        base = rng.choices(vocabulary, k=rng.randint(3, 150))
        for _ in range(rng.randint(1, copies)):
            words = list(base)
            for _ in range(rng.choice((0, 0, 1, 1, 2, 4))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words))
    for _ in range(loners):
        texts.append(" ".join(rng.choices(vocabulary, k=rng.randint(1, 80)) + rng.choice(common)))
    texts += ["", None, "   ", "One", "one", "a b c", "A  b\tc".replace("\t", " ")]
    rng.shuffle(texts)
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("seed", "n", "percent", "heavy"), [(1, 4, 85, 50), (2, 5, 80, 1000), (3, 4, 85, 0)])
def test_components_match_brute_force(spark, seed, n, percent, heavy):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = link_components(df, n=n, percent=percent, heavy_limit=heavy).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == brute(rows, n, percent)


def test_long_lists_are_cut_and_sharded(spark, monkeypatch):
    from leafmill.llm import jaccard_join

    monkeypatch.setattr(jaccard_join, "_BLOCK", 7)
    monkeypatch.setattr(jaccard_join, "_SMALL", 3)
    rows = corpus(9, families=6, copies=60, loners=20)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = link_components(df, n=4, percent=85, heavy_limit=20).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == brute(rows, 4, 85)


def test_wide_sketches_lose_no_link(spark, monkeypatch):
    from leafmill.llm import jaccard_join

    monkeypatch.setattr(jaccard_join, "_LARGE", 5)
    rows = corpus(13, families=5, copies=20, loners=20)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = link_components(df, n=4, percent=85, heavy_limit=50).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == brute(rows, 4, 85)


def test_empty_table_and_odd_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert link_components(df).collect() == []
    df = spark.createDataFrame([(5, "a b c d e f g", "x"), (5, "a b c d e f g", "y"), (None, "a b c d e f g", None)], "doc_id long, text string, size string")
    got = link_components(df).collect()
    assert [r.component_id for r in got] == [5, 5, 5]


@given(st.integers(1, 400), st.integers(1, 400), st.sampled_from([80, 85, 90]))
@settings(max_examples=200, deadline=None)
def test_lengths_are_safe(a, b, percent):
    need = overlap_needed(a, b, percent)
    assert 100 * need >= percent * (a + b - need) and 100 * (need - 1) < percent * (a + b - need + 1)
    small, large = sorted((a, b))
    if 100 * small >= percent * large:
        assert large - need + 1 <= probe_length(large, percent)
        assert small - need + 1 <= index_length(small, percent)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 130)} == {100}


@given(st.sets(st.integers(0, 2**64 - 1), max_size=60), st.sets(st.integers(0, 2**64 - 1), max_size=60), st.sets(st.integers(0, 2**64 - 1), max_size=60))
@settings(max_examples=200, deadline=None)
def test_sketches_never_overstate_the_difference(a, b, both):
    import numpy as np

    from leafmill.llm.jaccard_join import sketch

    a, b = a | both, b | both
    x, y = (sketch(np.array(sorted(s), dtype=np.uint64)) for s in (a, b))
    assert int(np.bitwise_count((x ^ y).view(np.uint64)).sum()) <= len(a ^ b)
