import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from leafmill.llm import decontaminate, substrings


@given(st.lists(st.integers(0, 1000), min_size=1, max_size=120), st.integers(1, 30))
@settings(max_examples=150, deadline=None)
def test_compact_windows_cover_every_run_once(values, least):
    values = np.array(values)
    found = list(zip(*(c.tolist() for c in substrings.compact_windows(values, [0], [len(values)], least)), strict=True))
    for lo in range(len(values) - least + 1):
        for hi in range(lo + least, len(values) + 1):
            hits = [(a, c, b) for a, c, b in found if a <= lo <= c < hi <= b]
            assert len(hits) == 1 and values[hits[0][1]] == values[lo:hi].min()
    both = substrings.compact_windows(np.concatenate([values, values]), [0, len(values)], [len(values), 2 * len(values)], least)
    assert sorted(zip(*(c.tolist() for c in both), strict=True)) == sorted([w for w in found] + [tuple(x + len(values) for x in w) for w in found])


def test_passages_find_the_shared_run():
    rng = np.random.default_rng(1)
    shared = rng.integers(0, 2**32, 80, dtype=np.uint32)
    a = np.concatenate([rng.integers(0, 2**32, 100, dtype=np.uint32), shared, rng.integers(0, 2**32, 50, dtype=np.uint32)])
    b = np.concatenate([shared, rng.integers(0, 2**32, 30, dtype=np.uint32)])
    assert substrings.passages(a, b, 46, 0.8) == [(100, 180, 0, 80, 1.0)]
    assert substrings.passages(a[:140], b, 46, 0.8) == []


@pytest.fixture(scope="module")
def passage_corpus():
    rng = random.Random(6)
    vocabulary = [f"v{i}" for i in range(3000)]
    text = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    shared = [text(60) for _ in range(4)]
    rows = []
    for i in range(120):
        words = text(rng.randint(0, 200))
        if i % 6 == 0:
            at = rng.randint(0, len(words))
            words = words[:at] + shared[i // 6 % 4] + words[at:]
        elif i % 6 == 1:  # a shared run that is too short
            words = words + shared[0][:30]
        rows.append((i, " ".join(words)))
    rows += [(200, rows[7][1]), (201, rows[12][1]), (202, None), (203, "")]
    return rows


def test_near_passages_find_planted_ones_only(spark, passage_corpus):
    got = substrings.near_passages(spark.createDataFrame(passage_corpus, "doc_id long, text string")).collect()
    ids = {r.doc_id for r in got} | {r.other_id for r in got}
    long7 = len(passage_corpus[7][1].split()) >= 50
    assert ids == {i for i in range(0, 120, 6)} | {201} | ({7, 200} if long7 else set())
    texts = dict(passage_corpus)
    for r in got:
        assert 50 <= r.end - r.start <= len(texts[r.doc_id].split()) and r.jaccard >= 0.8
    groups = {}
    for r in got:
        groups.setdefault(r.doc_id, set()).add(r.other_id)
        groups.setdefault(r.other_id, set()).add(r.doc_id)
    for k in range(4):  # all holders of one passage are connected
        want = {i for i in range(0, 120, 6) if i // 6 % 4 == k}
        seen, todo = set(), [min(want)]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += groups.get(x, ())
        assert want <= seen


def shared_line_corpus(seed, line=40, many=160, holders=40):
    """Pairs of texts that share 60 words of which `line` stand in all texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(5000)]
    text = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    common, rows, truth = text(line), [], set()
    for _ in range(holders):
        before = rng.randint(0, 60 - line)
        passage = text(before) + common + text(60 - line - before)
        truth.add((len(rows), len(rows) + 1))
        rows += [(len(rows) + i, " ".join(text(rng.randint(0, 150)) + passage + text(rng.randint(0, 150)))) for i in range(2)]
    rows += [(len(rows) + i, " ".join(text(60) + common + text(60))) for i in range(many - len(rows))]
    return rows, truth


@pytest.mark.parametrize("heavy", [512, 20])
def test_passages_around_a_common_line_match_brute_force(spark, heavy):
    rows, truth = shared_line_corpus(3)
    words = {i: t.split() for i, t in rows}
    runs = {i: {tuple(w[k : k + 50]) for k in range(len(w) - 49)} for i, w in words.items()}
    want = {(i, j) for i in runs for j in runs if i < j and runs[i] & runs[j]}
    assert want == truth
    got = substrings.near_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), heavy_count=heavy).collect()
    assert {(min(r.doc_id, r.other_id), max(r.doc_id, r.other_id)) for r in got} == want
    for r in got:
        x, y = words[r.doc_id][r.start : r.end], words[r.other_id][r.other_start : r.other_end]
        gx, gy = ({tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (x, y))
        assert len(x) >= 50 and r.jaccard == pytest.approx(len(gx & gy) / len(gx | gy)) and r.jaccard >= 0.8


def test_near_passages_are_found(spark):
    """Passages of 100 words with up to four words changed, inserted or left out: likeness of 5-grams 0.8 or a little more."""
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(5000)]
    text = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    rows, want = [], set()
    for _ in range(100):
        passage = text(100)
        other = list(passage)
        at = rng.randrange(10, 90)
        other[at : at + rng.choice([0, 1])] = text(rng.choice([1, 1, 2]))
        want.add((len(rows), len(rows) + 1))
        rows += [(len(rows), " ".join(text(rng.randint(0, 90)) + passage + text(rng.randint(0, 90)))), (len(rows) + 1, " ".join(text(rng.randint(0, 90)) + other))]
    got = substrings.near_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    found = {(min(r.doc_id, r.other_id), max(r.doc_id, r.other_id)) for r in got}
    assert len(found & want) >= 99 and found <= want


def test_all_places_and_runs_are_told():
    rng = np.random.default_rng(4)
    new = lambda n: rng.integers(0, 2**32, n, dtype=np.uint32)
    one, two = new(50), new(47)
    assert substrings.passages(one, np.concatenate([one[:10], new(30), one]), 46, 0.8) == [(0, 50, 40, 90, 1.0)]
    split = np.concatenate([one, new(6), two])
    assert [x[:2] for x in substrings.passages(split, np.concatenate([two, new(90), one]), 46, 0.8)] == [(0, 50), (56, 103)]
    twice = substrings.passages(one, np.concatenate([one, new(70), one]), 46, 0.8)
    assert [x[2:4] for x in twice] == [(0, 50), (120, 170)]
    assert substrings.passages(np.concatenate([one, two]), np.concatenate([two, new(60), one]), 46, 0.8) == [(0, 50, 107, 157, 1.0), (50, 97, 0, 47, 1.0)]


def test_equal_hashes_make_few_windows():
    found = substrings.compact_windows(np.zeros(80_000, np.int64), [0], [80_000], 46)
    assert len(found[0]) < 80_000 / 20
    assert substrings.segments(np.array([True, True, False, True, False, False, False, True]), -1.5) == [(0, 2), (3, 4), (7, 8)]
    assert substrings.segments(np.array([True] * 5 + [False] + [True] * 4), -1.5) == [(0, 10)]


def test_groups_over_the_limit_go_on(monkeypatch):
    """Parts of a group are linked with each other, whatever the limit."""
    rng = np.random.default_rng(2)
    n = 500
    text = rng.permutation(n).astype(np.int64)
    context = np.sort(rng.integers(1, 5, n)).astype(np.int64) << 48
    key = np.full(n, 7, np.int64)
    zero = np.zeros(n, np.int32)
    arrays = [pa.array(c) for c in (key, text, zero, zero + 20, zero + 60, context, context)]
    names = ["key", "text", "lo", "mid", "hi", "right", "left"]
    batches = [pa.RecordBatch.from_arrays([x.slice(i, 64) for x in arrays], names) for i in range(0, n, 64)]
    for limit in (50, 200_000):
        monkeypatch.setattr(substrings, "_LIMIT", limit)
        out = pa.Table.from_batches(list(substrings._meet(iter(batches)))).to_pandas()
        assert sorted(out[out.kind == 1].a) == sorted(text)
        links = {(a, b) for a, b in zip(out[out.kind == 0].a, out[out.kind == 0].b, strict=True)}
        assert all((min(x, y), max(x, y)) in links for x, y in zip(text, text[1:], strict=False))
    left = pa.Table.from_batches(list(substrings._left(iter(batches)))).to_pandas()
    assert all((min(x, y), max(x, y)) in set(zip(left.a, left.b, strict=True)) for x, y in zip(text, text[1:], strict=False))


def test_near_passages_odd_rows(spark):
    rng = random.Random(12)
    body = " ".join(f"w{rng.randrange(3000)}" for _ in range(80))
    rows = [(1, body, "a"), (1, body, "b"), (None, body, "c"), (2, "word " * 3000, "d"), (3, "word " * 2000 + body, "e"), (4, None, "f"), (5, "", "g"), (6, body[:40], "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string").withColumn("a", F.lit("clash"))
    got = [tuple(r) for r in substrings.near_passages(df).collect()]
    links = {(r[0], r[3]) for r in got}
    assert (None, 1) in links and ((1, 3) in links or (3, 1) in links)
    assert {x for pair in links for x in pair} == {None, 1, 2, 3}  # 2 and 3 share the repeated word


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert substrings.near_passages(empty).collect() == []
    assert decontaminate.leaks(empty, bench).collect() == []
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "x a b c d e f y"), (4, "x a b c d e f y"), (4, "a b c d e f")], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontaminate.leaks(odd, bench).collect()] == [(4, 1)]
    assert decontaminate.leaks(odd, bench.where("false")).collect() == []


ITEM = "A train leaves Boston at 60 km per hour and another leaves Denver at 45 km per hour. They meet after 3 hours. How far apart were they at 60 minutes before meeting?"
CASES = [
    (1, "intro. " + ITEM + " outro", True),
    (2, ITEM.replace("60", "72").replace("45", "50").replace("Boston", "Lisbon").replace("Denver", "Madrid"), True),
    (3, ITEM.replace("60", "72", 1).replace("45", "50"), False),  # 60 stands for 72 and for 60
    (4, "A train leaves at noon. Nobody knows how far apart they were after 3 hours of meeting.", False),
    (5, ITEM[: len(ITEM) // 2], False),
    (6, ITEM + " Later again. " + ITEM.replace("45", "46"), True),
]


def test_reparameterised_questions_leak(spark):
    docs = spark.createDataFrame([(i, t) for i, t, _ in CASES], "doc_id long, text string")
    bench = spark.createDataFrame([(7, ITEM), (8, "Short one"), (9, None)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()}
    assert got == {(i, 7) for i, _, leak in CASES if leak}


def test_leaks_match_brute_force(spark):
    rng = random.Random(2)
    vocabulary = ["alpha", "beta", "gamma", "delta", "12", "7.5", "km", "eps"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 14)))) for i in range(15)]
    docs = []
    for i in range(80):
        words = rng.choices(vocabulary, k=rng.randint(0, 25))
        if rng.random() < 0.4:
            words += rng.choice(items)[1].split()
        docs.append((i, " ".join(words)))

    units = set(decontaminate.UNITS)

    def canon(text):
        raw = text.split()
        out = []
        for i, w in enumerate(raw):
            out.append(("#", w) if w[0].isdigit() else ("u", w) if w in units and i and raw[i - 1][0].isdigit() else (w, None))
        return out

    want = set()
    for d, dt in docs:
        for j, it in items:
            a, b = canon(dt), canon(it)
            n = min(5, len(b))
            wins = [p for p in range(len(b) - n + 1) if 2 * sum(v is None for _, v in b[p : p + n]) > n]
            lines = {}
            for p in wins:
                for q in range(len(a) - n + 1):
                    if [x[0] for x in a[q : q + n]] == [x[0] for x in b[p : p + n]]:
                        lines.setdefault(q - p, set()).add(p)
            if not wins or len(set().union(*lines.values())) < 0.8 * len(wins):
                continue
            kept = set()
            for shift, ps in lines.items():
                span = range(min(ps), max(ps) + n)
                pairs = {(b[k][1], a[k + shift][1]) for k in span if b[k][1] and 0 <= k + shift < len(a) and a[k + shift][1]}
                if len(pairs) == len({x for x, _ in pairs}) == len({y for _, y in pairs}):
                    kept |= ps
            if len(kept) >= 0.8 * len(wins):
                want.add((d, j))
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == want and want


RUN = " ".join(f"{w} of {v} alone" for w in ("one", "two", "red", "blue", "old", "new") for v in ("ax", "bow", "cup", "dot"))
COPIES = [
    (1, "intro. " + ITEM.upper() + " OUTRO", True),
    (2, ITEM.lower(), True),
    (3, ITEM.replace(" ", "\n", 7).replace("Boston", "Boston\n\n") + "\n", True),
    (4, ITEM.upper().replace("60", "72").replace("45", "50"), True),
    (5, ITEM.upper().replace("60", "72", 1).replace("45", "50"), False),
    (6, ITEM.lower()[: len(ITEM) // 2], False),
]


def test_copies_in_another_case_or_wrapped_otherwise_leak(spark):
    more = [(11, "so 3 4 17.5 22 9 81 6 it is"), (12, "so 3 4 17.5 22 9 81 7 it is"), (13, RUN[: len(RUN) * 2 // 3]), (14, RUN[: len(RUN) // 3])]
    docs = spark.createDataFrame([(i, t) for i, t, _ in COPIES] + more, "doc_id long, text string")
    bench = spark.createDataFrame([(7, ITEM), (8, "3 4 17.5 22 9 81 6"), (9, RUN)], "item_id long, text string")
    found = decontaminate.leaks(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(i, 7) for i, _, leak in COPIES if leak} | {(11, 8), (13, 9)}
    assert len(found) == 6 and all(r.coverage == 1 for r in found if r.doc_id < 12)


def test_pipeline_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = docs.columns
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == names and 0 < docs.count() <= before
        before = docs.count()
    assert docs.where("text like '%AKIA%'").count() == 0
    mixed = corpus_pipeline.mix_sources(spark, docs, sf)
    assert mixed.count() == before
    empty = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0


def test_pipeline_stages_by_row(spark, tmp_path):
    """Rows with repeated ids, without ids and with a column named score, against plain versions of the stages."""
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(800)]
    base = [" ".join(rng.choices(vocabulary, k=80)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(3, base[3]), (3, base[3]), (50, base[4] + " more"), (None, base[5]), (None, "only here " + " ".join(rng.choices(vocabulary, k=60)))]
    rows += [(2, " ".join(rng.choices(vocabulary, k=70))), (60, ITEM), (None, "so. " + ITEM), (61, None), (62, ""), (61, None)]
    df = spark.createDataFrame([(d, t, "en", "s", len(t or ""), 99.0) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long, score double")

    def near(x, y):
        a, b = ({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for w in ((x or "").split(), (y or "").split()))
        return bool(a) and 100 * len(a & b) >= 80 * len(a | b)

    groups = []
    for row in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        mine = [g for g in groups if any(near(row[1], other[1]) for other in g)]
        groups = [g for g in groups if g not in mine] + [sum(mine, []) + [row]]
    want = sorted((g[0] for g in groups), key=str)
    kept = corpus_pipeline.drop_near_copies(spark, df, "")
    assert kept.columns == df.columns and sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == want

    spark.createDataFrame([(7, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    clean = corpus_pipeline.drop_leaks(spark, df, str(tmp_path))
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=str) == sorted([r for r in rows if ITEM not in (r[1] or "")], key=str)

    spark.createDataFrame([(i, 1, 0) for i in range(12)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    good = corpus_pipeline.quality_filter(spark, df, str(tmp_path))
    assert good.columns == df.columns and {r.score for r in good.collect()} == {99.0}
    assert good.count() == sum(t is not None for _, t in rows)
