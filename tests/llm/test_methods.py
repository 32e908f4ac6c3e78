"""Operators against brute force, the given libraries, or held-out labels."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter
from unittest.mock import MagicMock

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as spark_entry
from tablecheck.llm import common, fingerprints, jaccard, lm, packing, sentencepieces, sharding, warc
from tablecheck.llm.queries import ORACLES, QUERIES
from tablecheck.llm.subwords import WORD_BPE, WordBpe

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "labels", "benchmark")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def documents(duck):
    return dict(duck.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    want = duck.execute(ORACLES[name])
    columns = sorted(d[0] for d in want.description)
    order = [[d[0] for d in want.description].index(c) for c in columns]
    rows = sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=repr)
    assert sorted(got.columns) == columns
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=repr) == rows


def test_registered():
    assert set(QUERIES) < set(spark_entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES if q[:2] == "op"}
    assert "pipeline" in spark_entry.queries()


ODD = [
    "it's don't I'LL 're ''s", "H̱ ẖ é. İstanbul ΣΑΣ café... naïve—yes!", "<|endoftext|> a<|EndOfText|>b",
    "a\x1cb\x1fc  x y \x85z", "12.5%% 3½ …! !… ́a !́", "x" * 500, "", " \n\t\x0b\x0c ",
    "中文字。abc \U0001f600!!", "a\x00b �", "æ!! ÿ?? ß.", "'a 'S it'Sx",
]


def test_word_ids_are_the_tokenizers(documents):
    library = Tokenizer.from_file(public_tokenizers.path(WORD_BPE))
    bpe = WordBpe.of()
    for text in ODD + list(documents.values()):
        ids = np.frombuffer(bpe.ids(text), "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_any_text_has_the_tokenizers_ids(text):
    ids = np.frombuffer(WordBpe.of().ids(text), "<u4").tolist()
    assert ids == WordBpe.of().tokenizer.encode(text, add_special_tokens=False).ids


def test_sentencepieces_without_dropout_are_the_librarys(documents):
    path = public_tokenizers.path(sentencepieces.PIECE_BPE)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = sentencepieces.Dropout(path, 0.0, 1, 1)
    dropping = sentencepieces.Dropout(path, 0.1, 1, 4)
    varied = 0
    for text in [t for t in ODD if "▁" not in t] + list(documents.values())[:60]:
        assert np.frombuffer(plain.encode(text, 3), "<i4").tolist() == library.encode(text)
        ids = np.frombuffer(dropping.encode(text, 3), "<i4")
        assert dropping.bpe.decode(ids) == text
        varied += ids.tolist() != library.encode(text)
    assert varied > 40
    again = sentencepieces.Dropout(path, 0.1, 1, 4)
    other = sentencepieces.Dropout(path, 0.1, 2, 4)
    text = max(documents.values(), key=len)
    assert again.encode(text, 3) == dropping.encode(text, 3) != other.encode(text, 3)
    assert dropping.encode(text, 3) != dropping.encode(text, 4)


def test_one_candidate_is_dropped_at_the_given_rate():
    path = public_tokenizers.path(sentencepieces.PIECE_BPE)
    dropping = sentencepieces.Dropout(path, 0.1, 1, 4)
    for word in "aIxbcdmn":  # each is one merge with its mark, so two ids if that is skipped
        ids = [np.frombuffer(dropping.encode(f"{word} {word}", key), "<i4") for key in range(3000)]
        assert sum(map(len, ids)) / len(ids) == pytest.approx(2 * 1.1, abs=0.03)


def test_any_segmentation_has_the_chance_of_its_skips():
    path = public_tokenizers.path(sentencepieces.PIECE_BPE)
    dropping = sentencepieces.Dropout(path, 0.1, 1, 4)

    def chances(word, skips=()):
        merges, ids = dropping.bpe.segment(word, skips)
        start = skips[-1] + 1 if skips else 0
        yield tuple(ids), 0.9 ** (merges - start)
        for n in range(start, merges):
            yield from ((x, 0.9 ** (n - start) * 0.1 * p) for x, p in chances(word, (*skips, n)))

    for word in ("of", "the", "people"):
        want, got = Counter(), Counter()
        for ids, chance in chances(sentencepieces.MARK + word):
            want[ids] += chance
        got.update(tuple(np.frombuffer(dropping.encode(word, key), "<i4")) for key in range(8000))
        assert sum(want.values()) == pytest.approx(1) and set(got) <= set(want)
        assert all(got[x] / 8000 == pytest.approx(want[x], abs=0.02) for x in want)


def test_long_words_skip_as_short_ones_do(monkeypatch):
    path = public_tokenizers.path(sentencepieces.PIECE_BPE)
    long = sentencepieces.Dropout(path, 0.1, 1, 4).encode("wordsofmany" * 20, 7)
    monkeypatch.setattr(sentencepieces, "LONGEST_KEPT", 10**6)
    assert sentencepieces.Dropout(path, 0.1, 1, 4).encode("wordsofmany" * 20, 7) == long


def test_packing_is_gapless_and_certified(spark):
    pdf = QUERIES["op2_packing"](spark, SF_DIR).toPandas().sort_values(["sequence_id", "offset"])
    filled = pdf.groupby("sequence_id")["length"]
    assert (pdf["offset"] == filled.cumsum() - pdf["length"]).all()
    assert filled.sum().max() <= 4096
    made = pdf["sequence_id"].nunique()
    assert made == pdf["sequences_made"].iloc[0] >= pdf["sequences_bound"].iloc[0]
    assert made <= math.ceil(pdf["length"].sum() / 4096) + 1


def test_no_task_packs_most_pieces(spark, monkeypatch):
    # no task is certified for pieces of such lengths, and all sequences have gaps
    monkeypatch.setattr(packing, "PIECES_PER_TASK", 300)
    rng = random.Random(2)
    rows = [(n, 0, 0, rng.randint(700, 1000), 0) for n in range(3000)]
    got = packing.pack(spark.createDataFrame(rows, packing.PIECE)).toPandas()
    assert sorted(got["doc_id"]) == list(range(3000))
    filled = got.groupby("sequence_id")["length"]
    assert filled.sum().max() <= 4096 and got["sequence_id"].nunique() == got["sequences_made"].iloc[0]
    assert (got.groupby(got["sequence_id"].to_numpy() // 2**24).size() < 2 * 300).all()
    alone = max(packing.best_fit_decreasing([row[3] for row in rows], 4096)) + 1
    assert got["sequences_made"].iloc[0] <= 1.02 * alone


def test_rows_of_one_id_are_dealt_to_all_tasks(spark, monkeypatch):
    monkeypatch.setattr(packing, "PIECES_PER_TASK", 500)
    rows = [(None, 0, 0, 1 + n % 900, 0) for n in range(2000)]
    got = packing.pack(spark.createDataFrame(rows, packing.PIECE)).toPandas()
    assert len(got) == 2000 and got["length"].sum() == sum(row[3] for row in rows)
    tasks = (got["sequence_id"].to_numpy() >> 24) & 0xFFFFFFFF
    level = got["sequence_id"].to_numpy() >> 56
    assert len(set(tasks[level == 0])) > 1


def test_bundles_are_read_by_a_task_each(spark):
    pages = spark.range(0, 400, 1, 6).selectExpr("id AS page_id", "'u' AS url", "repeat(sha(string(id)), 20) AS html")
    index = warc.write(pages)
    bundles = index.select("bundle").distinct().count()
    records = warc.read_back(spark, index)
    assert records.where("intact").count() == 400
    assert records.rdd.getNumPartitions() == bundles == 6


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=7))
def test_lower_bound_is_below_the_optimum(lengths):
    best = min(
        len(set(bins))
        for bins in itertools.product(range(len(lengths)), repeat=len(lengths))
        if max(Counter({b: sum(x for x, y in zip(lengths, bins) if y == b) for b in bins}).values()) <= 12
    ) if len(lengths) <= 5 else len(lengths)
    bound = packing.lower_bound(np.bincount(lengths, minlength=13), 12)
    chosen = packing.best_fit_decreasing(lengths, 12)
    assert bound <= best and bound <= max(chosen) + 1
    assert np.bincount(chosen, lengths).max() <= 12


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_the_tree_finds_the_tightest_bin(sizes):
    rooms, expected = [], []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [(r, b) for b, r in enumerate(rooms) if r >= sizes[i]]
        b = min(fits)[1] if fits else len(rooms)
        if not fits:
            rooms.append(50)
        rooms[b] -= sizes[i]
        expected.append((i, b))
    assert sharding.best_fit_decreasing(sizes, 50) == [b for _, b in sorted(expected)]


def test_shards_are_even(spark):
    pdf = QUERIES["op10_sharding"](spark, "/root/testdata/sf0.01").toPandas()
    sizes = pdf.groupby("shard")["size"].sum()
    assert len(sizes) == 8 and sizes.max() <= sizes.min() * 1.01


def brute_components(docs, size, threshold):
    sets, inverted, links = {}, {}, Counter()
    for doc, text in docs:
        words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
        width = min(size, len(words))
        sets[doc] = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()
        for x in sets[doc]:
            inverted.setdefault(x, []).append(doc)
    for members in inverted.values():
        links.update(itertools.combinations(sorted(members), 2))
    root = {doc: doc for doc in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), common in links.items():
        if 100 * common >= threshold * (len(sets[a]) + len(sets[b]) - common):
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    return {doc: (len(sets[doc]), top(doc)) for doc in sets}


@pytest.mark.parametrize("size, threshold", [(4, 85), (5, 80)])
def test_components_are_those_of_all_pairs(spark, documents, size, threshold):
    random.seed(4)
    rows = []
    for doc, text in list(documents.items())[:25]:
        words = text.split()[:400]
        rows.append((doc * 1000, " ".join(words)))
        for v in range(1, 20):
            copy = list(words)
            for _ in range(int(len(copy) * random.choice([0, 0.01, 0.02, 0.04, 0.08]))):
                copy[random.randrange(len(copy))] = f"q{random.randrange(10**6)}"
            if random.random() < 0.3:
                copy = copy[: int(len(copy) * random.uniform(0.7, 1))]
            rows.append((doc * 1000 + v, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: (r[1], r[2]) for r in jaccard.link_components(df, size, threshold).collect()}
    assert got == brute_components(rows, size, threshold)


@pytest.mark.parametrize("threshold", [50, 60, 70, 77])
def test_low_thresholds_link_across_bands(spark, threshold):
    rng, rows = random.Random(threshold), []
    for family in range(12):
        words = [f"f{family}w{n}" for n in range(rng.choice([3, 7, 10, 24, 60]))]
        for _ in range(12):  # nested sets, and sets that differ
            copy = words[: rng.randint(max(1, len(words) // 2), len(words))]
            for _ in range(rng.randrange(len(copy) // 4 + 1)):
                copy[rng.randrange(len(copy))] = f"q{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy)))
    rows += [(1000, " ".join("abcdefg")), (1001, " ".join("abcdefghij"))]  # 0.7 exactly
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: (r[1], r[2]) for r in jaccard.link_components(df, 1, threshold).collect()}
    assert got == brute_components(rows, 1, threshold)
    assert (got[1001][1] == 1000) == (threshold <= 70)


def test_unrelated_short_sets_seldom_share_a_key():
    def pairs(n):
        rng, members = np.random.default_rng(n), Counter()
        for _ in range(n):
            found = np.unique(rng.integers(0, 2**64, rng.integers(75, 90), np.uint64))
            members.update(set(jaccard.keys_of(found, 80).tolist()))
        return sum(m * (m - 1) // 2 for m in members.values())

    assert pairs(2_000) < 20 and pairs(8_000) < 80
    assert all(s < b / 2 for b, s in zip(*jaccard._bands(80)[1:]) if b > 60)


def test_a_worker_remembers_for_one_operator_and_in_bounds():
    mine, other = common.Memory("test-a", 10_000), common.Memory("test-b", 10_000)
    for n in range(1000):
        mine.keep(n, n)
        assert mine.used <= 10_000 and len(mine) <= 10_000 // common.Memory.ENTRY_BYTES
    other.keep("x", 1, 50)
    common.turn_of("test-a")
    assert mine and not other and other.used == 0


def words_by_place(low, high, count, tag):
    """Words whose hash, as a share of all hashes, is from low to high."""
    found = (f"{tag}{n}" for n in itertools.count())
    fits = (w for w in found if low <= int(jaccard.shingles(w, 1)[0]) / 2**64 < high)
    return list(itertools.islice(fits, count))


def test_links_between_blocks_with_other_leaders_are_found(spark):
    # y and z share their keys with a and b only, which lead them in two tasks and link nothing
    held = [w for n, high in enumerate((0.25, 0.5, 0.66)) for w in words_by_place(n / 4, high, 2, "k")]
    close = words_by_place(0.76, 1, 3, "c")
    far = [words_by_place(0.76, 1, n, tag) for tag, n in (("a", 4), ("b", 4), ("y", 1), ("z", 1))]
    a, b, y, z = (held + far[0], held + far[1], held + close + far[2], held + close + far[3])
    rows = [(1, " ".join(a)), (3, " ".join(y)), (2, " ".join(b)), (4, " ".join(z))]
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2), "doc_id long, text string")
    got = {r[0]: (r[1], r[2]) for r in jaccard.link_components(df, 1, 80).collect()}
    assert got == brute_components(rows, 1, 80) and got[4][1] == 3


def test_components_are_whole_over_many_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "KEYS_AT_ONCE", 1)
    rng = random.Random(9)
    families = []
    for family in range(40):
        words = [f"f{family}w{n}" for n in range(rng.choice([10, 14, 30, 60]))]
        families.append([])
        for _ in range(12):
            copy = list(words)
            for _ in range(rng.randrange(len(copy) // 3 + 1)):
                copy[rng.randrange(len(copy))] = f"q{rng.randrange(10**6)}"
            families[-1].append(" ".join(copy))
    # one of each family in each task
    rows = [(40 * n + f, families[f][n]) for n in range(12) for f in range(40)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 12), "doc_id long, text string")
    got = {r[0]: (r[1], r[2]) for r in jaccard.link_components(df, 1, 80).collect()}
    assert got == brute_components(rows, 1, 80)


def test_long_chains_are_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(99, 98)], "u long, v long")
    found = dict(jaccard.components(links).collect())
    assert {found[i] for i in range(61)} == {0} and found[99] == 98


def test_fingerprints(spark, documents):
    pdf = QUERIES["op7_fingerprints"](spark, SF_DIR).toPandas().set_index("doc_id")
    ordered = sorted(documents.items())
    for n, (doc, text) in enumerate(ordered):
        after = ordered[(n + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert pdf.loc[doc, "edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert pdf.loc[doc, "n_chars"] == len(text)
    assert (pdf["near_edited"] > pdf["near_next"]).mean() > 0.95


def test_fingerprints_mind_the_order(spark):
    words = [f"w{i}" for i in range(300)]
    moved = words[150:] + words[:150]
    shuffled = random.Random(1).sample(words, 300)
    rows = [(0, " ".join(words), " ".join(words)), (1, " ".join(words), " ".join(moved)),
            (2, " ".join(words), " ".join(shuffled))]
    df = spark.createDataFrame(rows, "n int, a string, b string")
    df = fingerprints.with_fingerprint(fingerprints.with_fingerprint(df, "a", "x"), "b", "y")
    near = [r[0] for r in df.orderBy("n").select(fingerprints.likeness("x", "y")).collect()]
    assert near[0] == 1 > near[1] > 0.2 > near[2]


def test_fingerprints_run_no_python(spark):
    plan = QUERIES["op7_fingerprints"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_frames_are_found_by_the_seek_table(spark, tmp_path):
    writer = warc.BundleWriter(f"file://{tmp_path}/x.warc.zst")
    data = {i: warc.record(i, "u", bytes([i]) * 400_000, "D", None) for i in range(9)}
    index = [row for i, d in data.items() for row in writer.add(i, d)] + writer.close()
    reader = warc.BundleReader(f"file://{tmp_path}/x.warc.zst")
    assert len(reader.starts) == 3
    for page, _, frame, start, size, offset, length in index:
        assert reader.starts[frame][:2] == (start, size)
        assert reader.frame(frame)[offset : offset + length] == data[page]


def test_base_scores(spark, documents):
    pdf = QUERIES["op4_lm"](spark, SF_DIR).toPandas().set_index("doc_id")
    words = {d: re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower()) + [None] for d, t in documents.items()}
    count = Counter(w for d, ws in words.items() if zlib.crc32(str(d).encode()) % 10 for w in ws)
    total, distinct = sum(count.values()), len(count)
    for doc, ws in words.items():
        base = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in ws)
        row = pdf.loc[doc]
        assert row["base_score"] == pytest.approx(base, rel=1e-9)
        assert (row["n_tokens"], row["n_known"]) == (len(ws), sum(count[w] > 0 for w in ws))
        assert row["train_tokens"] == total
        assert row["held_out"] == (zlib.crc32(str(doc).encode()) % 10 == 0)


def test_chances_of_words_sum_to_at_most_one():
    counts = np.array([5, 1, 1, 3], float)
    share = np.full(4, 0.7 / counts.sum())
    left = 0.3 + 0.7 * lm.DISCOUNT * len(counts) / counts.sum()
    spelled = np.log(np.array([0.4, 0.3, 0.2, 0.1]))
    assert (10 ** lm.mixed(counts, share, np.log(left) + spelled)).sum() == pytest.approx(1)


def test_rare_pairs_of_units_and_rare_words_count_like_frequent_ones(spark, monkeypatch):
    words = "grove Übung stone's river42 naïve quartz-like 中文字 lantern ember fjord".split()
    rows = [(n, " ".join(words[(n * k) % (2 + n % 9)] for k in range(1, 20 + n))) for n in range(60)]
    rows += [(n, text) for n, text in rows if n % 7 == 0] + [(None, "fjord of no id"), (99, None)]
    # more units than classes, so that pairs tell units of a class apart
    rows += [
        (1000 + n, " ".join(chr(97 + n % 26) + chr(97 + n * k % 26) + chr(97 + k % 26) for k in range(40)))
        for n in range(60)
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")

    def scores():
        found = lm.score(df).collect()
        return {(r["doc_id"], r["held_out"]): (r["score"], r["base_score"], r["n_known"]) for r in found}

    whole = scores()
    for pairs, known in ((40, 200_000), (0, 5)):
        monkeypatch.setattr(lm, "KNOWN_PAIRS", pairs)
        monkeypatch.setattr(lm, "KNOWN_WORDS", known)
        joined = scores()
        assert joined.keys() == whole.keys() and len(whole) == 122
        for key, values in joined.items():
            assert values == pytest.approx(whole[key], rel=1e-9)


def test_training_windows_keep_all_in_a_byte_a_unit():
    from tablecheck.llm import attention

    rng = np.random.default_rng(1)
    for size in (1, 31, 32, 33, 200):
        x, target = attention.windows(rng.integers(0, attention.CLASSES, size))
        data = [row.tobytes() for row in attention.packed(x, target)]
        assert all(len(row) == attention.SPAN + 1 for row in data)
        both = sorted(np.concatenate([x, target], axis=1).astype(np.int16).tolist())
        assert sorted(np.concatenate(attention.unpacked(data), axis=1).tolist()) == both


def _plain_loss(attention, w, bigram, x, target):
    """Mean loss of each target by softmax as written in books, in doubles; its log chances."""
    chances = []
    for row, wanted in zip(x, target):
        for step in range(attention.STEP):
            if wanted[step] < 0:
                continue
            place = attention.CONTEXT + step
            seen = [i for i in range(place + 1) if row[i] != attention.PAD_CLASS]
            query = w.embed[row[place]] @ w.query
            scores = [
                query @ (w.embed[row[i]] @ w.key) * attention.WIDTH**-0.5 + w.near[place - i]
                for i in seen
            ]
            shares = np.exp(scores) / np.exp(scores).sum()
            drawn = sum(s * (w.embed[row[i]] @ w.value) for s, i in zip(shares, seen))
            inner = np.tanh((w.embed[row[place]] + drawn) @ w.inner + w.inner_bias)
            logits = inner @ w.outer + w.outer_bias + bigram[row[place]]
            chances.append(logits[wanted[step]] - np.log(np.exp(logits).sum()))
    return -np.mean(chances), np.array(chances)


def test_network_and_its_gradient_by_tables_equal_the_plain_formulas():
    from tablecheck.llm import attention

    rng = np.random.default_rng(2)
    x, target = zip(*(attention.windows(rng.integers(0, attention.CLASSES, n)) for n in (0, 5, 40)))
    x, target = np.concatenate(x), np.concatenate(target)
    bigram = rng.normal(size=(attention.CLASSES + 2, attention.CLASSES)).astype(np.float32)
    flat = attention.Weights.fresh().flat() + rng.normal(0, 0.1, 6504).astype(np.float32)
    weights = attention.Weights.of(flat)
    loss, chances = _plain_loss(attention, weights, bigram, x, target)
    assert attention.log_chances(weights, bigram, x, target) == pytest.approx(chances, abs=1e-4)
    found = attention._gradients(weights, bigram, x, target, attention._Room())
    wide = flat.astype(np.float64)
    for _ in range(12):  # along a direction, as a difference of losses
        direction = rng.normal(size=len(flat)) * (rng.random(len(flat)) < 0.2)
        up, down = (
            _plain_loss(attention, attention.Weights.views(wide + s * direction), bigram, x, target)[0]
            for s in (1e-4, -1e-4)
        )
        assert (up - down) / 2e-4 == pytest.approx(found @ direction, abs=2e-3, rel=2e-3)


def _few_units(attention, number=5000, seed=5):
    """Counts of which units beyond the most frequent share classes, and their split."""
    counts = np.zeros(attention.UNITS)
    counts[:number] = 1e6 / np.random.default_rng(seed).permutation(np.arange(1, number + 1))
    return counts, attention.Split(attention.classes_of(counts))


def test_units_of_one_class_are_told_apart_by_the_network():
    from tablecheck.llm import attention

    counts, split = _few_units(attention)
    shared = np.flatnonzero(np.bincount(split.classes[:5000])[split.classes[:5000]] > 400)
    first = shared[split.classes[shared] == split.classes[shared[0]]][:4]
    a, b, c, d = first.tolist()
    rng = np.random.default_rng(0)  # after a comes c, after b comes d, all of the same class
    texts = [np.ravel([[(a, c), (b, d)][n] for n in rng.integers(0, 2, 60)]) for _ in range(400)]
    x, target = zip(*(attention.windows(t, attention.BEGIN, attention.PAD) for t in texts))
    x, target = np.concatenate(x), np.concatenate(target)
    bigram = np.zeros((attention.CLASSES + 2, attention.CLASSES), np.float32)
    weights, own, met, _ = attention.train(
        attention.Weights.fresh(), attention.Own.fresh(split, counts), split, bigram,
        x, target, 0.006, 1,
    )
    assert met[[a, b, c, d]].sum() == np.isin(x, first).sum() == (x < attention.BEGIN).sum()
    chances = {}
    for before in (a, b):
        for after in (c, d):
            row = np.array([a, c, b, d, before, after])
            windows = attention.windows(row, attention.BEGIN, attention.PAD)
            found = attention.unit_log_chances(weights, own, split, bigram, *windows)
            chances[before, after] = np.exp(found[1][-1])
    assert chances[a, c] > 0.75 and chances[b, d] > 0.75
    assert chances[a, d] < 0.1 and chances[b, c] < 0.1


def test_chances_of_all_units_sum_to_one_and_start_as_their_counts():
    from tablecheck.llm import attention

    counts, split = _few_units(attention)
    own = attention.Own.fresh(split, counts)
    weights = attention.Weights.fresh()
    rng = np.random.default_rng(1)
    bigram = rng.normal(size=(attention.CLASSES + 2, attention.CLASSES)).astype(np.float32)
    bigram[:, np.bincount(split.classes)[: attention.CLASSES] == 0] = -20  # never seen
    for noise in (0.0, 0.3):
        own.nodes += rng.normal(0, 1, own.nodes.shape).astype(np.float32) * np.float32(noise)
        own.embed += rng.normal(0, 1, own.embed.shape).astype(np.float32) * np.float32(noise)
        x, target = attention.windows(np.arange(40, 49), attention.BEGIN, attention.PAD)
        x = np.repeat(x, attention.UNITS, axis=0)
        target = np.full((attention.UNITS, attention.STEP), -1)
        target[:, 9] = np.arange(attention.UNITS)
        of_class, inside = attention.unit_log_chances(weights, own, split, bigram, x, target)
        assert np.exp(of_class + inside).sum() == pytest.approx(1, abs=1e-4)
        if not noise:
            classes = split.classes[: attention.UNITS]
            share = (counts + 0.01) / np.bincount(classes, counts + 0.01)[classes]
            assert np.exp(inside) == pytest.approx(share, rel=1e-2)


def test_the_gradient_of_what_is_a_units_own_is_that_of_the_loss():
    from tablecheck.llm import attention

    counts, split = _few_units(attention)
    rng = np.random.default_rng(2)
    units = rng.integers(0, 5000, 45)
    units[20:30] = units[:10]  # some more than once
    x, target = attention.windows(units, attention.BEGIN, attention.PAD)
    bigram = rng.normal(size=(attention.CLASSES + 2, attention.CLASSES)).astype(np.float32)
    weights, own = attention.Weights.fresh(), attention.Own.fresh(split, counts)
    own.embed += rng.normal(0, 0.3, own.embed.shape).astype(np.float32)
    own.nodes += rng.normal(0, 0.3, own.nodes.shape).astype(np.float32)
    flat, *found = attention._gradients(
        weights, bigram, x, target, attention._Room(), own, split
    )

    def loss(w, held):
        return -sum(attention.unit_log_chances(w, held, split, bigram, x, target)).mean()

    for number, name in enumerate(("embed", "nodes")):
        places, slope, times = found[number]
        assert len(places) > 20 and (times > 0).all() and len(set(places)) == len(places)
        for _ in range(6):
            direction = rng.normal(size=slope.shape).astype(np.float32)
            up, down = own.copy(), own.copy()
            getattr(up, name)[places] += np.float32(1e-2) * direction
            getattr(down, name)[places] -= np.float32(1e-2) * direction
            change = (loss(weights, up) - loss(weights, down)) / 2e-2
            assert change == pytest.approx((slope * direction).sum(), abs=3e-3, rel=1e-2)
    direction = rng.normal(size=len(flat)).astype(np.float32) * np.float32(1e-2)
    up, down = (attention.Weights.of(weights.flat() + s * direction) for s in (1, -1))
    assert loss(up, own) - loss(down, own) == pytest.approx(2 * flat @ direction, abs=1e-3, rel=2e-2)


def test_training_windows_keep_the_units_themselves():
    from tablecheck.llm import attention

    _, split = _few_units(attention)
    rng = np.random.default_rng(3)
    for size in (0, 1, 32, 33, 200):
        units = rng.integers(0, attention.UNITS, size)
        x, target = attention.windows(units, attention.BEGIN, attention.PAD)
        found = attention.unpacked(attention.packed_units(split, units), split)
        both = np.concatenate([x, target], axis=1).tolist()
        assert sorted(np.concatenate(found, axis=1).tolist()) == sorted(both)


def test_tasks_get_what_is_a_units_own_in_few_bytes_and_whole():
    import pickle

    from tablecheck.llm import attention

    counts, split = _few_units(attention)
    own = attention.Own.fresh(split, counts)
    own.embed[[3, attention.BEGIN]] = 0.5
    own.nodes[[5, 4000], :-1] = -0.25
    data = pickle.dumps(own)
    found = pickle.loads(data)
    assert (found.embed == own.embed).all() and (found.nodes == own.nodes).all()
    assert len(data) < 500_000 < own.embed.nbytes + own.nodes.nbytes


def test_what_tasks_learned_of_a_unit_is_averaged_over_those_that_met_it():
    width = lm.PARTS[1][1]
    values = np.zeros((4, width), np.float32)
    batches = []
    for row, (value, weight) in enumerate([(1.0, 3), (5.0, 1)]):
        values[2], values[row] = value, 10 + value
        met = np.array([row == 0, row == 1, 1, 0]) * weight
        batches.append(lm._rows_of(lm.PARTS[1][0], values, met))
    found = {}
    for batch in lm._means(iter(batches)):
        for part, rows, weight, means in lm._parts_of(batch):
            found |= {(part, row): mean[0] for row, mean in zip(rows.tolist(), means)}
    assert found == {(1, 0): 11.0, (1, 1): 15.0, (1, 2): 2.0}


def test_equal_words_are_cut_once_for_the_counts_of_units(spark, monkeypatch):
    from tablecheck.llm import attention

    texts = [" ".join(f"w{n % 7}é{k % 11}." for k in range(40)) for n in range(30)] + ["", "  "]
    df = spark.createDataFrame([(text,) for text in texts], "text string").coalesce(1)
    found = [lm.units_of(text, lm.WordBpe.of())[0] for text in texts]
    want = np.bincount(np.concatenate(found), minlength=attention.UNITS)
    for at_once in (lm.WORDS_AT_ONCE, 10):
        monkeypatch.setattr(lm, "WORDS_AT_ONCE", at_once)
        assert (lm._unit_counts(df) == want).all()
    monkeypatch.undo()
    taken, cut = [], lm._cut
    monkeypatch.setattr(lm, "_cut", lambda words, bpe: taken.extend(words) or cut(words, bpe))
    rows = MagicMock()
    lm._unit_counts(rows)
    run = rows.select.return_value.mapInArrow.call_args.args[0]
    (batch,) = run(iter([pa.RecordBatch.from_pydict({"text": texts})]))
    assert dict(zip(*batch.to_pydict().values())) == {u: want[u] for u in np.flatnonzero(want)}
    assert sorted(taken) == sorted({word for text in texts for word in text.encode().split()})


def test_slots_find_places_of_all_numbers_and_of_no_others():
    rng = np.random.default_rng(4)
    for size in (0, 1, 7, 5000):
        numbers = np.unique(rng.integers(0, 1 << 40, size))
        slots = sentencepieces._Slots(numbers)
        assert slots.places(numbers).tolist() == list(range(len(numbers)))
        others = np.setdiff1d(rng.integers(0, 1 << 40, 20_000), numbers)
        both = np.concatenate([others, numbers]).reshape(1, -1)
        want = [len(numbers)] * len(others) + list(range(len(numbers)))
        assert slots.places(both).tolist() == [want]


def test_attention_is_causal_and_scores_each_unit_once():
    from tablecheck.llm import attention

    rng = np.random.default_rng(0)
    weights = attention.Weights.fresh()
    bigram = rng.normal(size=(attention.CLASSES + 2, attention.CLASSES)).astype(np.float32)
    row = rng.integers(0, attention.CLASSES, 100)
    first = attention.log_chances(weights, bigram, *attention.windows(row))
    changed = row.copy()
    changed[70] = (changed[70] + 1) % attention.CLASSES
    second = attention.log_chances(weights, bigram, *attention.windows(changed))
    assert len(first) == 100 and np.allclose(first[:70], second[:70], atol=1e-5)
    assert not np.allclose(first[70:], second[70:], atol=1e-5)


def test_all_texts_give_unit_counts_and_training_windows(spark):
    from tablecheck.llm import attention

    texts = ["some words of one text " * n for n in range(1, 60)] + ["zebra " * 9000]
    rows = [(n, n * 7919, text) for n, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, row long, text string")
    bpe = lm.WordBpe.of()
    found = [lm.units_of(text, bpe)[0] for text in texts]
    counts = lm._unit_counts(df)
    assert (counts == np.bincount(np.concatenate(found), minlength=attention.UNITS)).all()
    finer = attention.classes_of(counts, lm.PRECEDING)
    gathered = lm._gathered(df, attention.classes_of(counts), finer)
    windows = sum(attention.windows_of(len(x)) for x in found)
    assert gathered.where(gathered["kind"] == lm.WINDOW).count() == windows


def test_held_out_quality(spark, duck):
    pdf = QUERIES["op9_quality"](spark, "/root/testdata/sf0.01").toPandas()
    labels = pd.read_parquet("/root/testdata/sf0.01/labels.parquet")
    both = pdf[pdf["held_out"]].merge(labels, on="doc_id")
    assert (both["predicted"] == both["quality"]).mean() > 0.9
    assert both.loc[both["quality"] == 1, "predicted"].mean() > 0.97


def test_languages(spark, duck):
    given_lang = dict(duck.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = QUERIES["op5_language"](spark, SF_DIR).collect()
    assert sum(given_lang[r["doc_id"]] == r["lang"] and r["accepted"] for r in rows) >= 0.97 * len(rows)
    pages = QUERIES["language_pages"](spark, SF_DIR).collect()
    assert sum(r["accepted"] for r in pages) >= 0.95 * len(pages)


def test_sentencepieces_over_arrays_are_those_over_a_heap(documents, monkeypatch):
    path = public_tokenizers.path(sentencepieces.PIECE_BPE)
    texts = list(documents.values())[:40]
    texts += [None, "", "漢字かな交じり文 ▁▁ x▁y\n\n  aa", "🙂🙂 abc\x00d é́", "wordsofmany" * 40]
    for rate in (0.1, 0.5, 1.0):
        together = list(sentencepieces.Dropout(path, rate, 1).encode_all(texts, range(len(texts))))
        with monkeypatch.context() as m:
            m.setattr(sentencepieces, "LONGEST_KEPT", 0)  # every word by itself
            alone = sentencepieces.Dropout(path, rate, 1)
            for key in [*range(0, len(texts) - 5, 40), *range(len(texts) - 5, len(texts))]:
                text = texts[key]
                assert together[key] == (None if text is None else alone.encode(text, key))


def test_sentencepieces_are_found_once_for_all_uses(spark):
    df = spark.createDataFrame([(1, "a text"), (2, None)], "doc_id long, text string")
    both = sentencepieces.decode(sentencepieces.encode(df))
    used = both.select(sentencepieces.ids_crc32(F.col("ids")).alias("crc"), "ids", "decoded")
    plan = used._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[ids(") == plan.count(" ids(") + 1 == 1, plan


def test_sentencepieces_forget_and_go_on(documents, monkeypatch):
    path = public_tokenizers.path(sentencepieces.PIECE_BPE)
    texts = list(documents.values())[:40]
    whole = list(sentencepieces.Dropout(path, 0.1, 1).encode_all(texts, range(len(texts))))
    monkeypatch.setattr(sentencepieces, "KEPT_BYTES", 20_000)
    monkeypatch.setattr(sentencepieces, "CHARS_AT_ONCE", 5_000)
    small = sentencepieces.Dropout(path, 0.1, 1)
    assert list(small.encode_all(texts, range(len(texts)))) == whole
    assert small.plain.used <= 20_000
