"""Ranked search, decontamination and whitening, against brute force and over edge rows."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablecheck.llm import decontamination, lexical, whitening
from tablecheck.llm.queries import QUERIES
from tablecheck.llm.words import word_places, words_of

from .conftest import LONG, TEXTS

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_words(text):
    return WORD.findall((text or "").translate(LOWER))


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_words_are_the_patterns(text):
    try:
        data = text.encode()
    except UnicodeEncodeError:
        return
    assert [w.decode() for w in words_of(data)] == plain_words(text)
    assert [data.lower()[a:b] for a, b in word_places(data)] == words_of(data)


# --- ranked search


def brute_search(docs, items, k):
    words = [(doc, plain_words(text)) for doc, text in docs]
    held = [(doc, Counter(w), len(w)) for doc, w in words if w]
    n, total = len(held), sum(x[2] for x in held)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(plain_words(text))
    frequency = Counter(t for _, c, _ in held for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * f + 1))) for t, f in frequency.items()}
    out = set()
    for item, terms in asked.items():
        found = []
        for doc, counts, length in held:
            m = 50 + 50 * length * n // total
            score = sum(
                weight[t] * (10**9 * counts[t] // (1000 * counts[t] + 20 * m)) for t in terms if t in counts
            )
            if score > 0:
                found.append((-score, doc is None, doc))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out |= {(item, r, doc, -s) for r, (s, _, doc) in enumerate(found[:k], 1)}
    return out


def answers(df):
    return {(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()}


@pytest.mark.parametrize("seed", range(2))
def test_search_is_exact_over_blocks_and_passes(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(60)]
    weights = [1 / (n + 1) for n in range(60)]  # a few very frequent, many rare terms
    docs = [
        (n, " ".join(rng.choices(vocabulary, weights, k=rng.choice([0, 1, 3, 8, 30, 80])))) for n in range(300)
    ]
    docs += [(1000 + n, docs[7][1] + " w59") for n in range(40)]  # equal scores
    items = [(n, " ".join(rng.choices(vocabulary, k=rng.randint(1, 14)))) for n in range(25)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(docs, 3), "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = lexical.search(df, asked, k=5, docs_per_block=50, terms_per_pass=40)
    assert answers(got) == brute_search(docs, items, 5)


@settings(max_examples=100, deadline=None)
@given(st.data())
def test_pair_bounds_hold_and_are_tighter(data):
    impacts = data.draw(
        st.lists(st.lists(st.integers(0, 9), min_size=5, max_size=5), min_size=1, max_size=8)
    )  # documents by terms, 0 where a term is not held
    maxima = {t: max(row[t] for row in impacts) for t in range(5)}
    pairs = data.draw(st.sets(st.sampled_from(list(itertools.combinations(range(5), 2)))))
    joint = {(a, b): max([r[a] + r[b] for r in impacts if r[a] and r[b]], default=0) for a, b in pairs}
    order = sorted(range(5), key=lambda t: (maxima[t], t))
    bound = lexical.Bounds(maxima, joint).rising(order)
    for at in range(6):
        assert max(sum(row[t] for t in order[:at]) for row in impacts) <= bound[at]
        assert bound[at] <= sum(maxima[t] for t in order[:at])
    assert bound == sorted(bound)


def test_search_leaves_lists_aside(spark):
    block = lexical.Block(
        {
            "size": 4, "terms": [0, 1, 2], "counts": [4, 2, 1],
            "places": np.array([0, 1, 2, 3, 1, 2, 2], "<u2").tobytes(),
            "impacts": np.array([3, 3, 3, 3, 4, 4, 9], "<i8").tobytes(),
            "maxima": [3, 4, 9], "kth": [0, 0, 0], "firsts": [0], "seconds": [1], "joint": [5], "pair_kth": [0],
        }
    )
    assert block.bounds.rising([0, 1, 2]) == [0, 3, 5, 14]  # 7 and 16 without the pair
    found, scores = block.search([0, 1, 2], [(0, 1)], 6)  # single bounds would keep place 1
    assert found.tolist() == [2] and scores.tolist() == [16]


def test_search_edges(spark, edges, nothing):
    items = [(1, "one B"), (1, "Plage"), (2, None), (3, "..."), (None, "mark"), (None, "12"), (4, "absent"),
             (5, "wort"), (5, "wort")]
    asked = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    assert answers(lexical.search(edges, asked)) == brute_search(TEXTS, items, 50)
    assert lexical.search(nothing, asked).count() == 0
    assert lexical.search(edges, asked.where("false")).count() == 0
    assert lexical.search(edges, asked).columns == ["item_id", "rank", "doc_id", "score"]


# --- decontamination


def brute_find(text, items, length, coverage):
    words = plain_words(text)
    hit, found = set(), set()
    for item, item_text in items:
        own = plain_words(item_text)
        if not own:
            continue
        need = min(length, max(1, math.ceil(coverage * len(own))))
        runs = {tuple(own[i : i + need]) for i in range(len(own) - need + 1)}
        for i in range(len(words) - need + 1):
            if tuple(words[i : i + need]) in runs:
                hit.update(range(i, i + need))
                found.add(item)
    return len(words), hit, sorted(str(i) for i in found if i is not None)


@pytest.mark.parametrize("length, coverage, size", [(3, 1.0, 10**6), (4, 0.5, 60), (10, 1.0, 90), (1, 1.0, 10**6)])
def test_passages_are_those_of_all_windows(spark, length, coverage, size):
    rng = random.Random(length)
    items = [(n % 30, " ".join(rng.choices("abcdefgh", k=rng.choice([1, 2, 3, 5, 9, 20])))) for n in range(40)]
    items += [(None, "a b c d e f g h a b c"), (50, None), (51, " . ")]
    docs = [(n, ". ".join(rng.choices("abcdefghijkl", k=rng.choice([0, 1, 5, 60])))) for n in range(60)]
    docs += [(100, "x " + items[5][1].upper() + " x"), (101, items[9][1] + " " + items[9][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.find_items(df, bench, length, coverage, words_per_automaton=size).collect()
    texts = dict(docs)
    assert sorted(r["row"]["doc_id"] for r in got) == sorted(texts)
    for r in got:
        n, hit, found = brute_find(texts[r["row"]["doc_id"]], items, length, coverage)
        assert (r["n_words"], r["n_hit"], list(r["items"])) == (n, len(hit), found)
        assert {p for s in r["spans"] for p in range(s["start"], s["end"])} == hit
    clean = decontamination.remove_items(df, bench, length, coverage, words_per_automaton=size)
    for doc, text in clean.collect():
        _, hit, _ = brute_find(texts[doc], items, length, coverage)
        assert plain_words(text) == [w for i, w in enumerate(plain_words(texts[doc])) if i not in hit]
        assert hit or text == texts[doc]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=9), max_size=5), st.text("abcd", max_size=30), st.integers(1, 4))
def test_matching_length_is_the_longest_suffix(texts, stream, need):
    automaton = decontamination.SuffixAutomaton()
    for n, text in enumerate(texts):
        automaton.add(str(n), min(need, len(text)), [c.encode() for c in text])
    spans, found = automaton.close().find(c.encode() for c in stream)
    hit, named = set(), set()
    for n, text in enumerate(texts):
        k = min(need, len(text))
        for i in range(len(stream) - k + 1):
            if stream[i : i + k] in text:
                hit.update(range(i, i + k))
                named.add(str(n))
    assert {p for a, b in spans for p in range(a, b)} == hit and found == named
    assert all(a[1] < b[0] for a, b in itertools.pairwise(spans))


def test_decontamination_edges(spark, edges, nothing):
    items = spark.createDataFrame(
        [(1, "A b c"), (1, "one"), (2, None), (None, "plage déjà"), (3, "wort " * 12)],
        "item_id long, text string",
    )
    rows = decontamination.find_items(edges, items).collect()
    assert len(rows) == len(TEXTS) and all(r["row"]["size"] == "x" for r in rows)
    by = {r["row"]["doc_id"]: r for r in rows if r["row"]["doc_id"] is not None}
    assert [by[1][c] for c in ("n_words", "n_hit", "items")] == [0, 0, []]
    assert by[5]["n_hit"] == by[6]["n_hit"] == 3 and by[4]["items"] == ["1"]
    assert by[7]["n_hit"] == 30_000 and len(by[7]["spans"]) == 1
    assert (by[8]["n_hit"], by[8]["items"]) == (2, [])  # an item without an id
    clean = decontamination.remove_items(edges, items)
    assert clean.columns == edges.columns and clean.count() == len(TEXTS)
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert texts[1] is None and texts[2] == "" and texts[5] == " d e f g h"
    assert texts[7].strip() == "x" * 50_000 and texts[9] == dict(TEXTS)[9]
    assert decontamination.find_items(nothing, items).count() == 0
    assert decontamination.find_items(edges, items.where("false")).where("n_hit > 0").count() == 0


def test_items_of_no_id_hit_but_are_not_named(spark):
    docs = spark.createDataFrame([(1, "x a b y")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "a b")], "item_id long, text string")
    row = decontamination.find_items(docs, items).first()
    assert (row["n_hit"], row["items"]) == (2, [])
    assert hashlib.sha256(b"").hexdigest() == hashlib.sha256(",".join(row["items"]).encode()).hexdigest()


# --- whitening


def spread(values, seed):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))
    a = q @ np.diag(values) @ q.T
    return (a + a.T) / 2


CASES = [
    [5.0], [2.0, 2.0], [9, 4, 1, 0.5, 0.1], [7] * 12, [3, 3, 3, 1, 1, 1e-3, 1e-3], list(range(40, 0, -1)),
    [1e8, 1, 1, 1, 1e-4], [1.0, 1.0 - 1e-9, 1.0 - 2e-9, 0.3], [4, 2, 0, 0, 0],
]


@pytest.mark.parametrize("values", CASES)
@pytest.mark.parametrize("rotated", [True, False])
def test_leading_vectors(values, rotated):
    matrix = spread(values, len(values)) if rotated else np.diag(np.array(values, float))
    got, vectors = whitening.leading(matrix, 16)
    want = np.linalg.eigvalsh(matrix)[::-1][: len(got)]
    assert len(got) == min(16, sum(v > 1e-12 * max(values) for v in values))
    assert np.allclose(got, want, rtol=0, atol=1e-13 * max(values))
    assert np.abs(vectors.T @ vectors - np.eye(len(got))).max() < 1e-13
    assert np.abs(matrix @ vectors - vectors * got).max() < 1e-13 * max(values) * len(values)


def test_sturm_counts():
    diagonal, off = np.array([2.0, -1.0, 0.5, 3.0]), np.array([1.0, 0.0, 0.25])
    full = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    at = np.array([-5, -1.2, 0, 0.5, 2.4, 9])
    want = [(np.linalg.eigvalsh(full) < x).sum() for x in at]
    assert whitening.counts_below(diagonal, off, at).tolist() == want


def brute_whitening(rows, k):
    x = {}
    for i, (_, v) in enumerate(rows):
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            x[i] = [math.floor(64 * c) + 1_000_000 for c in v]
    fit = sorted({tuple(v) for v in x.values()})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    out = {}
    for i, v in x.items():
        away = [n * c - s for c, s in zip(v, sums)]
        out[i] = sum(a * a for a in away), np.array(away) / n @ vectors / np.sqrt(values)
    return n, values, out


def test_whitening_is_the_eigenvectors(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), (rng.normal(size=20) * np.arange(1, 21)).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(300)]  # a hot vector counts once
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = whitening.whiten(df, 16).toPandas().sort_values(["vec_id", "component"])
    n, values, want = brute_whitening(rows, 16)
    assert len(got) == 16 * len(rows) and set(got["n"]) == {n} == {400}
    signs = None
    for i, (vec, _) in enumerate(rows):
        own = got[got["vec_id"] == vec]
        assert own["component"].tolist() == list(range(1, 17))
        assert set(own["deviation"]) == {want[i][0]}
        signs = np.sign(own["whitened"].to_numpy() * want[i][1]) if signs is None else signs
        assert np.allclose(own["whitened"], signs * want[i][1], atol=1e-9)
    total = np.array([r[1] for r in rows[:400]])
    x = np.floor(64 * total)
    trace = np.trace(np.cov(x.T, bias=True))
    first = got[got["vec_id"] == 0]
    assert np.allclose(first["explained"], values / trace, rtol=1e-9)
    assert got["identity_error"].nunique() == 1 and 0 <= got["identity_error"].iloc[0] < 1e-9


def test_whitening_query(spark):
    got = QUERIES["op11_whitening"](spark, SF_DIR).toPandas()
    white = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert white.shape[1] == 16 and got["identity_error"].iloc[0] < 1e-9
    assert np.abs(np.cov(white.T, bias=True) - np.eye(16)).max() < 1e-6  # no vector repeats
    assert got.groupby("component")["explained"].first().is_monotonic_decreasing


def test_whitening_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [1.0, 2.0, 0.0]), (1, [1.0, 2.0, 0.0]), (None, [0.5, -2.0, 1.0]), (3, None), (4, [None, 1.0, 2.0]),
        (5, [nan, 1.0, 1.0]), (6, [inf, 1.0, 1.0]), (7, []), (8, [1.0]), (9, [3.0, 0.0, 0.25]),
    ]
    df = spark.createDataFrame(
        [(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, n int, x string"
    )
    got = whitening.whiten(df).toPandas()
    assert len(got) == 4 * 2 and set(got["n"]) == {3}  # three distinct vectors span two directions
    assert got["identity_error"].iloc[0] < 1e-9 and got["vec_id"].isna().sum() == 2
    for odd in ("false", "vec_id = 1", "vec_id = 7", "vec_id = 3"):
        assert whitening.whiten(df.where(odd)).count() == 0
    far = spark.createDataFrame(
        [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 5.0])], "vec_id long, embedding array<double>"
    )
    wide = whitening.whiten(far).toPandas()
    assert wide["deviation"].isna().any() and np.isfinite(wide["whitened"]).all()


def test_long_texts_are_read_whole(spark, edges):
    items = spark.createDataFrame([(1, "x" * 50_000)], "item_id long, text string")
    found = decontamination.find_items(edges, items).where("n_hit > 0").collect()
    assert [r["row"]["doc_id"] for r in found] == [7] and LONG.endswith("x")
    assert {a[2] for a in answers(lexical.search(edges, items))} == {7}
