"""Secrets, licences, pages and the classifier against plain models, with counted results and odd rows."""

import random
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leafmill.llm import html_text, licenses, quality, secrets

VALUE = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")


def plain_spans(text):
    """Base spans by walking over the text, without patterns."""
    out, i, low = [], 0, "".join(c.lower() if c.isascii() else c for c in text)
    while i < len(text):
        hit = None
        for word in ("password", "passwd", "secret", "token", "apikey", "api_key"):
            if not low.startswith(word, i):
                continue
            j = i + len(word)
            tails = {j}
            if text[j : j + 1] in ('"', "'"):
                tails.add(j + 1)
            for k in sorted(tails, reverse=True):
                while text[k : k + 1] == " ":
                    k += 1
                if text[k : k + 1] not in (":", "="):
                    continue
                k += 1
                while text[k : k + 1] == " ":
                    k += 1
                if text[k : k + 1] in ('"', "'"):
                    k += 1
                end = k
                while end < len(text) and text[end] in VALUE:
                    end += 1
                if end > k:
                    hit = (end, end - k)
                    break
            if hit:
                break
        if hit:
            if hit[1] >= 6:
                out.append(("assign", i, hit[0]))
            i = hit[0]
        else:
            i += 1
    for kind, start, chars, least in (("access", "AKIA", set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), 20), ("hex", "", set("0123456789abcdef"), 24)):
        i = 0
        while i < len(text):
            end = i + len(start)
            if text.startswith(start, i):
                while end < len(text) and text[end] in chars:
                    end += 1
            if end > i + len(start):
                if end - i >= least:
                    out.append((kind, i, end))
                i = end
            else:
                i += 1
    return sorted(out, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


@given(st.lists(st.sampled_from(["password", "Token", "API_KEY", "apikey", "secret", "s", "=", ":", " ", '"', "'", "x", "AKIA", "0123456789ABCDEF", "deadbeef", "0a1b2c3d4e5f", "hunter2", "\n", "-", "é", "ſ", "K"]), max_size=30))
@settings(max_examples=400, deadline=None)
def test_base_spans_match_a_walk(parts):
    text = "".join(parts)
    assert [s[:3] for s in secrets.find(text) if s[0] != "pair"] == plain_spans(text)


SOURCES = [
    ('import os\nDB = "Zx9-Qw3_Rt7!Lp2"\nconnect(host="h", db_password=DB)\n', ["Zx9-Qw3_Rt7!Lp2"]),
    ("export RAW='Zx9-Qw3_Rt7!Lp2'\nexport AUTH_PASSPHRASE=$RAW\n", ["Zx9-Qw3_Rt7!Lp2"]),
    ('raw: "Zx9-Qw3_Rt7!Lp2"\nservice:\n  credential: ${raw}\n', ["Zx9-Qw3_Rt7!Lp2"]),
    ('RAW = "Zx9-Qw3_Rt7!Lp2"\nlogin(my_pwd=os.environ["RAW"])\n', ["Zx9-Qw3_Rt7!Lp2"]),
    ('class C:\n    RAW = "Zx9-Qw3_Rt7!Lp2"\nlogin(my_pwd=C.RAW)\n', ["Zx9-Qw3_Rt7!Lp2"]),
    ('login(my_pwd=RAW)\nRAW = "Zx9-Qw3_Rt7!Lp2"\n', ["Zx9-Qw3_Rt7!Lp2"]),
    ('a = "Zx9-" + "Qw3_Rt7!Lp2"\nb = a\nc := b\n{"accessKey": c}\n', ['"Zx9-" + "Qw3_Rt7!Lp2"']),
    ('pwd = "changeme"\nmy_pwd = get_pwd()\nprivate_key = None\ncredential_count = 12\n', []),
    ("The credential: of a writer is the trust of readers.\n", []),
    ('name = "Zx9-Qw3_Rt7!Lp2"\ncolour = name\n# no credential here\n', []),
]


@pytest.mark.parametrize(("text", "want"), SOURCES)
def test_pairs_of_source_and_configuration_files(text, want):
    assert [text[s:e] for kind, s, e, _, _ in secrets.find(text) if kind == "pair"] == want


@pytest.mark.parametrize(
    "text",
    ["token: x " + "a" * 1_000_000, "token = " + "ab1." * 250_000, "token " + " " * 1_000_000, "token a" + ".b" * 500_000, "token: " + "a:" * 300_000, "token " + "x=y;" * 100_000, "token '" + "a' " * 200_000, "token x:" + " a|" * 200_000],
)
def test_long_words_and_runs_take_linear_time(text):
    began = time.time()
    secrets.find(text)
    assert time.time() - began < 5


def test_secret_rows(spark):
    rows = [(1, None, "k"), (2, "", "k"), (3, "token = abcdef12", "k"), (3, "token = abcdef12", "k"), (None, "x" * 100_000 + " passwd: abcdef", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string").withColumn("n_assign", F.lit(7))
    got = sorted(map(tuple, secrets.digest(secrets.scan(df)).select("doc_id", "n_assign", "spans").collect()), key=str)
    assert got == [(1, 0, ""), (2, 0, ""), (3, 1, "assign:0:16"), (3, 1, "assign:0:16"), (None, 1, "assign:100001:100015")]
    assert secrets.scan(df.where("false")).collect() == []


def whole(name):
    join = lambda *keys: "\n\n".join(" ".join(licenses.TEXTS[k][i].split()) for k, i in keys)
    return {
        "MIT": join(("mit-grant", 0), ("mit-cond", 0), ("as-is", 0), ("no-liability", 0)),
        "Apache-2.0": join(("apache-ref", 0), ("apache-comply", 0), ("apache-obtain", 0), ("apache-basis", 0), ("apache-terms", 0)),
        "BSD-2-Clause": join(("bsd-grant", 0), ("bsd-source", 0), ("bsd-binary", 0), ("as-is", 1), ("no-liability", 1)),
        "ISC": join(("isc-grant", 0), ("as-is", 2), ("no-liability", 2)),
        "GPL": join(("gpl-free", 1), ("gpl-hope", 0), ("gpl-copy", 0)),
    }[name]


@pytest.mark.parametrize("name", ["MIT", "Apache-2.0", "BSD-2-Clause", "ISC", "GPL"])
@pytest.mark.parametrize("width", [0, 72, 40])
def test_whole_licences_wrapped_at_any_width(name, width):
    text = whole(name)
    if width:
        lines = []
        for paragraph in text.split("\n\n"):
            line = ""
            for word in paragraph.split():
                if line and len(line) + 1 + len(word) > width:
                    lines.append(line)
                    line = word
                else:
                    line = f"{line} {word}".strip()
            lines += [line, ""]
        text = "\n".join(lines).strip()
    found = licenses.match(licenses.sentences("Read me.\n\n" + text + "\n\nMore."))
    assert [x[0] for x in found] == [name] and found[0][3] >= 3


def test_asides_do_not_break_a_rule():
    a, b, *rest = whole("Apache-2.0").split("\n\n")
    text = "\n\n".join([a, "Copyright 2020 Some One", b, *rest])
    assert [x[0] for x in licenses.match(licenses.sentences(text))] == ["Apache-2.0"]
    text = "Copyright 2020 Some One\nAll rights reserved.\n\n" + whole("MIT")
    assert [x[0] for x in licenses.match(licenses.sentences(text))] == ["Proprietary", "MIT"]
    assert all(licenses.identify(t) == name for name, texts in licenses.TEXTS.items() for t in texts)


def test_rules_match_a_search_of_all_choices():
    """The longest rule at each place, by trying all ways to take its sentences in order with asides between."""
    rng = random.Random(4)
    names = ["mit-grant", "mit-cond", "as-is", "no-liability", "copyright", "all-rights", "apache-ref", "apache-comply"]

    def plain(ids):
        out, used, i = [], set(), 0
        while i < len(ids):
            best = None
            for licence, rule in sorted(licenses.RULES, key=lambda r: -len(r[1])):
                at, j = [], i
                for want in rule:
                    while at and j < len(ids) and ids[j] != want and ids[j] in licenses.ASIDE:
                        j += 1
                    if j >= len(ids) or ids[j] != want:
                        break
                    at.append(j)
                    j += 1
                if len(at) == len(rule) and not used & set(at):
                    best = (licence, at)
                    break
            if best and i not in used:
                out.append((best[0], best[1][0], best[1][-1]))
                used |= set(best[1])
            i += 1
        return out

    for _ in range(300):
        ids = [rng.choice(names) for _ in range(rng.randint(0, 10))]
        got = licenses.match([(10 * i, 10 * i + 5, x) for i, x in enumerate(ids)])
        assert [(x[0], x[1] // 10, x[2] // 10) for x in got] == plain(ids)


def test_licence_rows(spark):
    rows = [(1, None), (2, ""), (3, "Released under the MIT License."), (3, "Released under the MIT License."), (None, "word " * 50_000 + "\nReleased under the MIT License.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("licenses", F.lit("clash"))
    got = [(r.doc_id, [(x.license, x.end - x.start) for x in r.licenses]) for r in licenses.scan(df).collect()]
    assert sorted(got, key=str) == sorted([(1, []), (2, []), (3, [("MIT", 31)]), (3, [("MIT", 31)]), (None, [("MIT", 31)])], key=str)


BODY = "".join(f"<p>Paragraph {i} of the article has a good many words in it, so that it is dense.</p>" for i in range(6))
WANT = "\n\n".join(f"Paragraph {i} of the article has a good many words in it, so that it is dense." for i in range(6))


@pytest.mark.parametrize(
    "page",
    [
        f'<div><a href="/a">One</a> <a href="/b">Two</a> <a href="/c">Three</a></div><div>{BODY}</div><div>Short note</div>',
        f'<div><span>Log</span> <span>in</span></div><div><div>{BODY}</div></div><div><ul><li><a href="/x">x</a><li><a href="/y">y</a></ul></div>',
        f"<table><tr><td><a href=/a>a</a><td><a href=/b>b</a></table><section>{BODY}</section><div><i>2020</i> <i>Someone</i></div>",
    ],
)
def test_density_finds_the_article_without_any_mark(page):
    assert html_text.main_text(f"<html><body>{page}</body></html>") == WANT


def test_marks_alone_would_not_do(monkeypatch):
    """Without the lists of marks the article is still found; without density the rest of the page would stay."""
    page = f'<body><div><a href="/a">One</a> <a href="/b">Two</a></div><div>{BODY}</div><div>Short note</div></body>'
    monkeypatch.setattr(html_text, "CUT_TAGS", frozenset())
    monkeypatch.setattr(html_text, "CUT_ROLES", frozenset())
    monkeypatch.setattr(html_text, "_is_cut_word", lambda value: False)
    assert html_text.main_text(page) == WANT
    assert html_text.blocks(html_text.parse(page)) != WANT.split("\n\n")


def test_words_in_attributes_and_slugs_cut_nothing():
    page = f'<article><h1>T</h1><h2 id="related-work">Related</h2><section id="social-impact"><p>Some text of impact.</p></section><p title="a hidden gem">gem</p><p data-hidden="false">shown</p>{BODY}</article>'
    assert html_text.main_text(page) == "T\n\nRelated\n\nSome text of impact.\n\ngem\n\nshown\n\n" + WANT
    for hidden in ("hidden", 'hidden=""', 'style="display: none"', 'aria-hidden="true"'):
        assert html_text.main_text(f"<article>{BODY}<p {hidden}>not shown to anyone</p></article>") == WANT
    assert html_text.main_text(f'<article>{BODY}</article><div class="comments"><p>I like it very much indeed, thank you for it</p></div>') == WANT


def test_parts_of_an_article_stay_together():
    half = BODY.index("<p>Paragraph 3")
    page = f'<body><div class="nav"><a href="/">x</a></div><div><h2>Head</h2><div>{BODY[:half]}</div><div>{BODY[half:]}</div></div></body>'
    assert html_text.main_text(page).startswith("Head\n\n") and html_text.main_text(page).count("Paragraph") == 6


@pytest.mark.parametrize("page", ["<div>" * 20_000 + "x", "<span>" * 20_000 + "<p>a</p>" * 2_000, "<div>" * 20_000 + "</b>" * 20_000 + "x", "<p>a" * 20_000, "<ul>" + "<li>a" * 20_000, "<p " + 'a="' * 100_000])
def test_deep_and_long_pages_take_linear_time(page):
    began = time.time()
    html_text.main_text(page)
    assert time.time() - began < 5


def test_page_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>a &amp; b"), (3, "u", "<p>a &amp; b"), (None, "u", "<p>" + "word " * 100_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit(-1))
    got = sorted(((r.page_id, r.url, len(r.text), r.n_chars) for r in html_text.extract(df).collect()), key=str)
    assert got == sorted([(1, "u", 0, 0), (2, None, 0, 0), (3, "u", 5, 5), (3, "u", 5, 5), (None, "u", 499_999, 499_999)], key=str)


def test_gradient_by_differences():
    rng = np.random.default_rng(3)
    sizes = [1, 4, 2, 3]
    x = rng.normal(size=(sum(sizes), quality.N_FEATURES))
    starts, y = np.cumsum([0, *sizes[:-1]]), np.array([1.0, 0.0, 1.0, 0.0])
    shape = {"We": (quality.N_FEATURES, 5), "be": (5,), "V": (5, 3), "U": (5, 3), "a": (3,), "c": (5,), "d": (1,)}
    model = quality.Model(None, None, {k: rng.normal(0, 0.5, s) for k, s in shape.items()})

    def loss():
        p = model.forward(x, starts)[0]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    found = quality.gradient(model, x, starts, y)
    for k, w in model.w.items():
        for at in [tuple(rng.integers(0, n) for n in w.shape) for _ in range(4)]:
            kept = w[at]
            w[at] = kept + 1e-5
            up = loss()
            w[at] = kept - 1e-5
            down = loss()
            w[at] = kept
            assert found[k][at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_attention_beats_mean_pooling():
    """One passage of many tells the label: its mean is drowned, attention finds it."""
    rng = np.random.default_rng(1)

    def bags(n):
        out, labels = [], np.arange(n) % 2
        for label in labels:
            bag = rng.normal(size=(30, quality.N_FEATURES))
            if label:
                bag[rng.integers(30), 2] += 6
            out.append(bag)
        return out, labels

    (x, y), (tx, ty) = bags(600), bags(400)
    right = lambda model, f: ((model.scores([f(b) for b in tx]) > 0.5) == ty).mean()
    alone = lambda b: b
    mean = lambda b: b.mean(0, keepdims=True)
    attention, pooled = right(quality.train(x, y), alone), right(quality.train([mean(b) for b in x], y), mean)
    assert attention > 0.9 and attention > pooled + 0.05


def test_classifier_rows(spark):
    docs = spark.createDataFrame([(1, "Good text. " * 30, 5), (1, "Good text. " * 30, 6), (2, None, 5), (None, "### $$$ " * 40, 5), (3, "", 5)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (1, None), (2, 0), (2, 0), (None, 1), (9, 0)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    rows = quality.score(docs, model).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 1}) == 1
    assert quality.fit(docs.where("false"), labels).constant == 0.5 and quality.fit(docs, labels.where("quality = 1")).constant == 1.0
    assert quality.score(docs, model, score_col="s").columns == ["doc_id", "text", "score", "s"]
