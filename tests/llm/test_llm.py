"""Training-data operators against brute force on small tables: nulls, empty and long texts, ties, repeats, empty tables, extra columns."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wavelake.llm import chat, common, langid, lmscore, mixing, neardup, packing, phrases, quality, secrets, topk

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block int, kind int, n_words long, label int"


def words_of(text):
    return SPACE.findall(text or "")


@pytest.fixture(scope="module")
def texts():
    """Documents with copies, near copies, shared passages, nulls, empty, odd white space and a long text."""
    draw = random.Random(5)
    vocabulary = ["".join(draw.choice("abcdefghié") for _ in range(draw.randint(1, 7))) for _ in range(300)]
    some = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    passage, base = some(60), some(200)
    out = [None, "", " \n\t ", "one", "a b c d", "a b c d", some(49), some(50)]
    out += [base, base, base + " end", " ".join("X" if i == 77 else w for i, w in enumerate(base.split())), base.replace(" ", "\n", 3)]
    out += [some(30) + " " + passage + " " + some(30) for _ in range(4)] + [passage + "\n" + passage]
    out += [some(8000), "x " * 300, "same line here\n" * 20, " wide space " * 40]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    # the other columns clash with names that operators use inside
    return spark.createDataFrame([(i, t, None if i % 5 == 0 else "en", f"s{i % 3}" if i % 7 else None, None, 1, 2, 3, 4) for i, t in enumerate(texts)], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_near_duplicates(docs, texts, spark):
    sets = {i: frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if (w := words_of(t)) else frozenset() for i, t in enumerate(texts)}
    links, root = collections.Counter(), {i: i for i in sets}
    for _ in sets:
        for i, a in sets.items():
            for j, b in sets.items():
                if i != j and a and b and 5 * len(a & b) >= 4 * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    for i, a in sets.items():
        links[i] = sum(i != j and bool(a and b) and 5 * len(a & b) >= 4 * len(a | b) for j, b in sets.items())
    got = {r.doc_id: (r.class_id, r.n_links) for r in neardup.joined(docs).collect()}
    assert got == {i: (root[i], links[i]) for i in sets}
    assert neardup.joined(empty(spark)).collect() == []


def test_near_duplicates_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 16)
    draw = random.Random(2)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(70):
        w = list(base)
        w[draw.randrange(120)] = f"edit{draw.randrange(30)}"
        rows.append((i, " ".join(w)))
    sets = [frozenset(tuple(t.split()[k : k + 5]) for k in range(116)) for _, t in rows]
    want = [sum(i != j and 5 * len(a & b) >= 4 * len(a | b) for j, b in enumerate(sets)) for i, a in enumerate(sets)]
    got = neardup.joined(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.n_links for r in got] == want and {r.class_id for r in got} == {0}


def test_repeated_rows_of_near_duplicates(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f")]
    rows += [(3, "p q r s t u"), (3, "v w x y z a"), (None, "v w x y z a"), (None, None), (None, "lonely words that are only here")]
    got = sorted(map(str, map(tuple, neardup.joined(spark.createDataFrame(rows, "doc_id long, text string")).collect())))
    assert got == sorted(map(str, [(1, 1, 3), (1, 1, 3), (2, 1, 3), (None, 1, 3), (3, 3, 0), (3, 3, 1), (None, 3, 1), (None, None, 0), (None, None, 0)]))


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (95, 100), (7, 7)]
    got = dict(map(tuple, neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}


@pytest.mark.parametrize("block_bytes", [1 << 23, 3000])
def test_passages(docs, texts, spark, block_bytes):
    first = {}
    for i, t in enumerate(texts):
        w = words_of(t)
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), i)
    want = {}
    for i, t in enumerate(texts):
        w = words_of(t)
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] < i:
                gone[k : k + 50] = [True] * 50
        want[i] = (len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest())
    got = {r.doc_id: tuple(r)[1:] for r in phrases.deduplicated(docs, block_bytes=block_bytes).collect()}
    assert got == want and sum(x[1] for x in want.values()) > 300
    assert phrases.deduplicated(empty(spark)).collect() == []


def test_passages_of_repeated_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(3, text), (3, text + " x"), (1, "y " + text), (None, text), (None, None), (4, "a " + text + " b " + text)]
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in phrases.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted([("3", 60, 60), ("3", 61, 60), ("1", 61, 0), ("None", 60, 0), ("None", 0, 0), ("4", 122, 120)])


def test_the_automaton_removes_the_words(docs, monkeypatch):
    class Deaf:
        def __init__(self, *_):
            self.known = {}

        def get(self, key, default):
            return self.known.get(key, default)

        def add_word(self, key, value):
            self.known[key] = value

        def make_automaton(self):
            pass

        def iter(self, text):
            return iter(())

    words = [b"w%d" % i for i in range(70)]
    low = np.arange(21) * 0 + 5
    assert phrases.Shard([(words, low)], 50, 20).removed([b"a", *words[3:], b"b"], 9).tolist() == [False, *[True] * 67, False]
    assert not phrases.Shard([(words, low)], 50, 20).removed(words, 5).any()
    assert not phrases.Shard([(words, low)], 50, 20).removed(words[:49], 9).any()
    monkeypatch.setattr(phrases, "BASE", 3)  # words of several characters
    assert phrases.Shard([(words, low)], 50, 20).removed([b"a", *words[3:], b"b"], 9).tolist() == [False, *[True] * 67, False]
    monkeypatch.setattr(phrases.ahocorasick, "Automaton", Deaf)
    assert not phrases.Shard([(words, low)], 50, 20).removed(words, 9).any()


@pytest.mark.parametrize("seed", range(4))
def test_passages_of_few_words(spark, seed):
    """Few words and short windows: periods, overlaps, passages within passages."""
    draw = random.Random(seed)
    rows = [(i, " ".join(draw.choice("ab" if i % 3 else "a b c d".split()) for _ in range(draw.randint(0, 60)))) for i in range(60)]
    rows += [(60 + i, rows[draw.randrange(60)][1] + " z " + rows[draw.randrange(60)][1]) for i in range(30)]
    first = {}
    for i, t in rows:
        w = t.split()
        for k in range(len(w) - 8):
            first.setdefault(tuple(w[k : k + 9]), i)
    want = {}
    for i, t in rows:
        w = t.split()
        want[i] = sum(any(k >= 0 and k + 9 <= len(w) and first[tuple(w[k : k + 9])] < i for k in range(j - 8, j + 1)) for j in range(len(w)))
    got = {r.doc_id: r.n_removed for r in phrases.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), window=9, phrase=3, piece=4, block_bytes=700).collect()}
    assert got == want and sum(want.values()) > 500


@pytest.mark.parametrize("group", [1 << 19, 1, 7, 100])
def test_word_hashes(monkeypatch, group):
    """Equal words have equal hashes, others have not, wherever they stand: against splitting."""
    monkeypatch.setattr(common, "GROUP", group)
    draw = random.Random(3)
    texts = [None, "", " ", "a", " a\tb\x0bc  d\n", "\u00a0x\u2003y é", "x" * 5000, "y" + "x" * 4999, "x" * 1024 + "y" + "x" * 1023, "x" * 2048, "\x1c\x85 z"]
    texts += [" ".join("".join(draw.choice("abé中") for _ in range(draw.randint(1, 5))) for _ in range(draw.randint(0, 60))) for _ in range(200)]
    known = {}
    for text, got in zip(texts, common.word_hashes(texts), strict=True):
        words = (text or "").encode().split()
        assert len(got) == len(words) and [len(w) for w in words_of(text)] == [len(w.decode()) for w in words]
        for w, h in zip(words, got.tolist()):
            assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known) > 900
    assert common.word_hashes([]) == []
    monkeypatch.setattr(common, "GROUP", 1 << 19)
    alone = common.word_hashes([texts[-1]])[0]
    assert alone.tolist() == common.word_hashes(texts)[-1].tolist()


def test_window_hashes():
    h = common.WordHashes().of([str(i).encode() for i in [*range(80), *range(80)]])
    long = common.long_grams(h, 50)
    assert (long[:31] == long[80:]).all() and len(set(long.tolist())) == 80
    assert common.sliding_min(np.array([5, 3, 4, 1, 2]), 3).tolist() == [3, 1, 1]


@pytest.mark.parametrize(("order", "slices"), [(1, 1), (2, 3), (3, 3), (4, 1)])
def test_language_model(docs, texts, spark, order, slices):
    words = [words_of(t) for t in texts]
    count = lambda w, k: collections.Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    every = [sum((count(w, k) for w in words), collections.Counter()) for k in range(order + 1)]
    total, used = sum(every[1].values()), collections.Counter()
    for r in lmscore.scored(docs, order, slices).collect():
        w = words[r.doc_id]
        own = [count(w, k) for k in range(order + 1)]
        score = backed = 0
        for i, x in enumerate(w):
            longest = min(i + 1, order)
            for k in range(longest, 0, -1):
                gram = tuple(w[i - k + 1 : i + 1])
                others = every[k][gram] - own[k][gram]
                if k == 1 or others > 0:
                    below = every[k - 1][gram[:-1]] - own[k - 1][gram[:-1]] if k > 1 else total - len(w) + 1
                    score += math.log(0.4 ** (longest - k) * max(1, others) / below)
                    backed += k < longest
                    used[k] += 1
                    break
        assert r.n_words == len(w) and r.n_backoff == backed and r.log_score == pytest.approx(score, rel=1e-9)
    assert all(used[k] > 10 for k in range(1, order + 1)), used
    assert lmscore.scored(empty(spark)).collect() == []


def test_language_model_in_small_blocks(spark, docs):
    def plain(df):
        return sorted((r.doc_id, r.n_words, r.n_backoff, round(r.log_score, 6)) for r in df.collect())

    two = docs.repartition(2, "doc_id")
    two.write.mode("overwrite").parquet(at := f"{common.shared_dir(spark)}/small-blocks")
    two = spark.read.parquet(at)
    whole = plain(lmscore.scored(two))
    assert plain(lmscore.scored(two, block=900)) == plain(lmscore.scored(two, block=1)) == whole
    assert sum(w > 0 for _, w, _, _ in whole) > 10


def test_flat_word_hashes():
    texts = ["", "a b", None, " \n", "b a", "ab", "\u00e9a  x\u0085y", "a", "w" * 3000, "z " * 300000 + "w" * 3000]
    for arrays in ([pa.array(texts)], [pa.array(["q", *texts]).slice(1, 4), pa.array(texts[4:])]):
        h, n = common.flat_word_hashes(arrays)
        words = [w for t in texts for w in words_of(t)]
        assert n.tolist() == [len(words_of(t)) for t in texts] and len(h) == len(words)
        known = {}
        assert all(known.setdefault(w, x) == x for w, x in zip(words, h.tolist(), strict=True)) and len(set(known.values())) == len(known)


def test_language_model_deals_n_grams_once(spark):
    """The count table and the join with it read the same shuffled rows; n is negative where documents of one block share the n-gram."""
    rows = [(0, 1, 2), (9, 1, 1), (0, 2, -3), (0, 3, 5), (9, 4, 1), (0, 4, -2), (7, 4, 1)]
    spark.createDataFrame(rows, lmscore.ddl(lmscore.EXPLODED)).write.mode("overwrite").parquet(at := f"{common.shared_dir(spark)}/exploded")
    got = lmscore.elsewhere(spark.read.parquet(at))
    assert sorted(map(tuple, got.collect())) == [(0, 1, 1), (0, 2, 0), (0, 4, 2), (7, 4, 3), (9, 1, 2), (9, 4, 3)]
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") == 1 and len(re.findall(r"Exchange hashpartitioning\(gram", plan)) == 2, plan


def test_ordered_keys():
    draw = np.random.default_rng(3)
    near = np.array([5, 4, 5, 7, 4, 5], np.uint64)  # alike but for the bits that give way to places
    for key in (near, near[:0], near[:1], draw.integers(0, 1 << 63, 900, np.uint64)[draw.integers(0, 900, 2000)] * np.uint64(2)):
        by, some, new = lmscore.ordered(key)
        assert by.tolist() == np.argsort(key, kind="stable").tolist() and some.tolist() == sorted(key.tolist())
        assert len(key) == 0 or some[new].tolist() == np.unique(key).tolist()


def test_language_model_of_repeated_and_null_ids(spark):
    rows = [(1, "a b c"), (1, "a b c"), (None, "a b c"), (None, None), (2, "z")]
    got = sorted(str((*r[:3], round(r[3], 9))) for r in lmscore.scored(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect())
    one = round(math.log(2 / 8), 9)  # each of the three is scored by the two others; every pair is certain
    assert got == sorted(map(str, [(1, 3, 0, one), (1, 3, 0, one), (None, 3, 0, one), (None, 0, 0, 0.0), (2, 1, 0, round(math.log(1 / 10), 9))]))


def test_quality(docs, texts, spark):
    got = {r.doc_id: r for r in quality.judge(docs, None).collect()}
    for i, t in enumerate(texts):
        w, r = words_of(t), got[i]
        windows = collections.Counter(zip(w, w[1:], w[2:]))
        covered = {j + k for j, x in enumerate(zip(w, w[1:], w[2:])) if windows[x] > 1 for k in range(3)}
        lines = [x for x in (t or "").split("\n") if words_of(x)]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and r.kept == (not r.base_failed)
    assert quality.fit(docs, spark.createDataFrame([], "doc_id long, quality int")) is None
    assert quality.judge(empty(spark), None).collect() == []


def test_quality_model_learns(spark):
    draw = random.Random(1)
    rows = [(i, " ".join((f"good{draw.randrange(40)}" if i % 2 else f"@@{draw.randrange(40)}$$") for _ in range(60))) for i in range(120)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, i % 2) for i in range(80)] + [(None, 1), (3, None)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    assert {r.doc_id for r in quality.judge(docs, model).where("kept").collect()} == set(range(1, 120, 2))
    assert {r.doc_id for r in quality.kept(docs, model).collect()} == set(range(1, 120, 2))


def test_quality_fit_against_plain_regression(spark):
    """The same features and steps in plain Python; the calibration is a minimum of its loss."""
    draw = random.Random(7)
    vocabulary = [f"w{k}" for k in range(30)]
    rows = [(i, " ".join(draw.choice(vocabulary[: 20 if i % 3 else 30]) for _ in range(draw.randint(3, 40)))) for i in range(60)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)], "doc_id long, quality int")
    folds = {r.doc_id: r.f for r in docs.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(5)).alias("f")).collect()}
    features, hashes = {}, common.WordHashes()
    for i, t in rows:
        word, char = quality.n_grams(t.encode(), t.encode().split(), hashes)
        f = collections.Counter()
        for part in (word.tolist(), char.tolist()):
            for x in part:
                f[x] += quality.SCALE / len(part)
        features[i] = f
    fit = [i for i in folds if folds[i] != 0]
    size = collections.Counter(i % 3 > 0 for i in fit)
    w, speed, b, b_speed = collections.Counter(), collections.Counter(), 0.0, 1e-8
    score = lambda i: b + sum(w[x] * v for x, v in features[i].items())
    for _ in range(quality.EPOCHS):
        gap = {i: (1 / (1 + math.exp(-score(i))) - (i % 3 > 0)) * 0.5 / size[i % 3 > 0] for i in fit}
        g = collections.Counter({x: 1e-7 * w[x] for x in w})
        for i in fit:
            for x, v in features[i].items():
                g[x] += gap[i] * v
        b_g = sum(gap.values())
        for x, v in g.items():
            speed[x] += v * v
            w[x] -= quality.RATE * v / math.sqrt(speed[x] + 1e-8)
        b_speed += b_g**2
        b -= quality.RATE * b_g / math.sqrt(b_speed)
    model = quality.fit(docs, labels)
    for i in folds:
        plain = sum(model["w"][x] * v for x, v in features[i].items()) + model["b"]
        assert plain == pytest.approx(score(i), abs=0.02)
    held = [i for i in folds if folds[i] == 0]
    z = {i: sum(model["w"][x] * v for x, v in features[i].items()) + model["b"] for i in held}
    parts = collections.Counter(i % 3 > 0 for i in held)

    def loss(slope, shift):
        out = 5e-4 * (slope - 1) ** 2
        for i in held:
            p = 1 / (1 + math.exp(-(slope * z[i] + shift)))
            out -= (40 if i % 3 else 20) / 60 / parts[i % 3 > 0] * math.log(p if i % 3 else 1 - p)
        return out

    best = loss(model["slope"], model["shift"])
    assert all(best <= loss(model["slope"] + x, model["shift"] + y) + 1e-9 for x in (-0.05, 0, 0.05) for y in (-0.05, 0, 0.05))
    for r in quality.judge(docs, model).collect():
        zi = sum(model["w"][x] * v for x, v in features[r.doc_id].items()) + model["b"]
        assert r.p_good == pytest.approx(1 / (1 + math.exp(-(model["slope"] * zi + model["shift"]))), abs=1e-4)


def test_language(spark):
    draw = random.Random(3)
    kinds = {"aa": ["lorem", "ipsum", "dolor"], "bb": ["zwei", "drei", "vier"]}
    rows = [(i, " ".join(draw.choice(kinds[k]) for _ in range(20)), k) for i in range(100) for k in [("aa", "bb")[i % 2]]]
    rows += [(200, None, "aa"), (201, "", "aa"), (202, "12 34!", "aa"), (203, "ЖЖ", None), (204, "zwei vier", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.learn(langid.training_rows(docs))
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert all(got[i].lang_pred == k for i, _, k in rows[:100]) and got[204].lang_pred == "bb"
    assert [(got[i].lang_pred, got[i].score) for i in (200, 201, 202)] == [("und", 0.0)] * 3 and got[203].lang_pred in kinds
    assert all(0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert {r.lang_pred for r in langid.predict(docs, None).collect()} == {"und"}


class PlainTree:
    """Prediction by partial matching in plain Python: method C with exclusions."""

    def __init__(self, texts):
        self.counts = collections.defaultdict(collections.Counter)
        for t in texts:
            padded = bytes(3) + t
            for i in range(len(t)):
                for k in range(4):
                    self.counts[padded[i + 3 - k : i + 3]][padded[i + 3]] += 1

    def probability(self, context, byte):
        below = (lambda b: self.probability(context[1:], b)) if context else (lambda b: 1 / 256)
        seen = self.counts.get(context)
        if not seen:
            return below(byte)
        total, left = sum(seen.values()), 1 - sum(below(b) for b in seen)
        escape = len(seen) / (total + len(seen)) if len(seen) < 256 and left > 1e-12 else 0
        return (1 - escape) * seen[byte] / total if byte in seen else escape * below(byte) / left

    def length(self, text):
        padded = bytes(3) + text
        return -sum(math.log2(self.probability(padded[i : i + 3], padded[i + 3])) for i in range(len(text)))


def test_code_lengths_against_plain_trees(spark, monkeypatch):
    draw = random.Random(6)
    kinds = {"aa": "lorem ipsum dolor sit".split(), "bb": "zwei drei vier größer".split(), "cc": ["сто", "лес"]}
    rows = [(i, " ".join(draw.choice(kinds[k]) for _ in range(draw.randint(1, 30))), k) for i in range(90) for k in [draw.choice(list(kinds))]]
    rows += [(200, "zwei ipsum", None), (201, "", None), (202, "Ärger über größere \u4e2d\u6587 lorem", None), (None, "vier", "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    plain = {k: PlainTree([t.encode() for i, t, x in rows if x == k and i is not None and not held(i)]) for k in kinds}
    model = langid.learn(langid.training_rows(docs))
    assert model["langs"] == sorted(kinds)
    texts = [t.encode() for _, t, _ in rows]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    want = np.array([[plain[k].length(t) for k in sorted(kinds)] for t in texts])
    for chunk, memory in ((1 << 19, 1 << 22), (7, 40)):  # texts across chunks, and a worker that forgets
        monkeypatch.setattr(langid, "CHUNK", chunk)
        monkeypatch.setattr(langid, "REMEMBERED", memory)
        assert langid.Trees(model).lengths(data, offsets) == pytest.approx(want, rel=1e-9, abs=1e-6)
    for r in langid.predict(docs, model).collect():
        if r.doc_id is not None:
            t = next(t for i, t, _ in rows if i == r.doc_id)
            bits = {k: plain[k].length(t.encode()) for k in sorted(kinds)}
            best = min(bits, key=bits.get) if t else "und"
            share = 1 / sum(2 ** (bits[best] - b) for b in bits.values()) if t else 0.0
            assert r.lang_pred == best and r.score == pytest.approx(share, abs=1e-9) and r.held_out == held(r.doc_id)
    some = plain["bb"]
    for context in (b"", b"z", b"zw", b"zwe", b"qqq"):
        assert sum(some.probability(context, b) for b in range(256)) == pytest.approx(1)


def test_secrets(docs, spark):
    rows = [
        (0, "é token = \"abcdefgh12\" and AKIA" + "Z9" * 8), (1, None), (2, ""), (3, "token:secret:abcdefghijkl"), (4, "PassWord:'x' API_KEY=hunter2hunter2"),
        (5, "0123456789abcdef" * 2 + " tail " + "f" * 31), (6, "AKIAAKIAAKIAAKIA AKIA1"), (7, "key Zk3vQ9xL7mB2tR8nW4yC6pH1sD5gJ0fA plain_words_in_a_snake_case_name"), (8, "token=" * 50 + "x" * 9),
    ]
    got = {r.doc_id: r for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).select("*", secrets.joined(F.col("secrets.base")).alias("b"), secrets.joined(F.col("secrets.spans")).alias("s"), secrets.redacted(F.col("text"), F.col("secrets.spans")).alias("r")).collect()}
    assign = re.compile(r"(?:" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key")) + r")[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    for i, text in rows:
        found = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(text or "") if len(m[1]) >= 8]
        found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 16]
        found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 32]
        assert got[i].b == ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(found)), i
        assert set(got[i].b.split(",")) - {""} <= set(got[i].s.split(","))
    assert got[7].s == "random:4:36" and got[7].r == "key [SECRET] plain_words_in_a_snake_case_name"
    assert got[0].r.startswith("é [SECRET]\" and [SECRET]") and got[1].r is None
    assert secrets.scan(empty(spark)).collect() == []


def test_secrets_of_long_texts(spark):
    """Many matches over several parts, and as many spans to redact; clashing columns stay."""
    for n in (63, 64, 65, 700):
        text = "é" + " - ".join(f"AKIA{k:016d}" if k % 3 else f"short AKIA{k}" for k in range(n)) + " end"
        rows = secrets.scan(spark.createDataFrame([(1, text, "x")], "doc_id long, text string, secrets string"))
        got = rows.select("secrets", F.col("secrets_.base").alias("base"), secrets.redacted(F.col("text"), F.col("secrets_.spans")).alias("r")).first()
        found = [m.span() for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        assert got.secrets == "x" and [(b.start, b.end) for b in got.base] == found
        assert got.r == re.sub("AKIA[0-9]{12,}", "[SECRET]", text)


def plain_tests(token):
    """The battery in plain Python: encoding, length, the three p-values against uniform draws, and the one against text."""
    tail = lambda z: math.erfc(z / math.sqrt(2)) / 2
    body = token.rstrip("=")
    if re.fullmatch("([0-9a-f]+([-_][0-9a-f]+)+|[0-9A-F]+([-_][0-9A-F]+)+)", body) and re.search("[a-fA-F]", body):
        body = re.sub("[-_]", "", body)
    pattern = {"digits": "[0-9]+", "hex": "[0-9a-f]+|[0-9A-F]+", "lower": "[a-z]+", "upper": "[A-Z]+", "base32": "[A-Z2-7]+", "alnum36": "[a-z0-9]+", "alnum62": "[A-Za-z0-9]+", "base64": ".*"}
    name = next(k for k, x in pattern.items() if re.fullmatch(x, body))
    alphabet = secrets.ALPHABETS[name]
    symbols = body.lower() if name == "hex" else body.replace("-", "+").replace("_", "/") if name == "base64" else body
    x, n, k = [alphabet.index(c) + 1 for c in symbols], len(symbols), len(alphabet)
    chi = sum((symbols.count(c) - n / k) ** 2 / (n / k) for c in alphabet)
    z = ((chi / (k - 1)) ** (1 / 3) - (1 - 2 / (9 * (k - 1)))) / math.sqrt(2 / (9 * (k - 1)))
    high = [v > k // 2 for v in x]
    low_n, high_n, runs = high.count(False), high.count(True), 1 + sum(a != b for a, b in zip(high, high[1:]))
    mean = 2 * low_n * high_n / n + 1
    spread = (mean - 1) * (mean - 2) / (n - 1)
    z_runs = abs(runs - mean) / math.sqrt(spread) if spread > 0 else 99
    over = n * sum(a * b for a, b in zip(x, x[1:] + x[:1])) - sum(x) ** 2
    under = n * sum(a * a for a in x) - sum(x) ** 2
    z_serial = abs(over / under + 1 / (n - 1)) * math.sqrt(n) if under > 0 else 99
    kind = lambda c: "l" if c.islower() else "u" if c.isupper() else "d" if c.isdigit() else "s"
    if name == "digits":
        p_text = secrets.DIGIT_RUN ** (n - 1)
    elif name in ("lower", "upper"):
        p_text = tail((sum(secrets.SURPRISE[ord(c) - 97] for c in symbols.lower()) - n * secrets.MEAN_SURPRISE) / (secrets.SURPRISE_SPREAD * math.sqrt(n)))
    else:
        changes = sum(kind(a) != kind(b) for a, b in zip(body, body[1:]))
        p_text = tail((changes - 0.5 - secrets.CHANGES * (n - 1)) / math.sqrt(secrets.CHANGES * (1 - secrets.CHANGES) * (n - 1)))
    return name, n, tail(z), 2 * tail(z_runs), 2 * tail(z_serial), max(p_text, 1e-300)


def plain_discoveries(tokens, fdr):
    """Benjamini and Hochberg's rule over distinct tokens with length weights, on p-values rounded up to bins."""
    tests = {t: plain_tests(t) for t in tokens}
    mean = sum(x[1] for x in tests.values()) / len(tests)

    def taken(p_of):
        bin_of = {t: math.floor((math.log10(x[1]) - math.log10(p_of(x))) * secrets.BINS_PER_UNIT) for t, x in tests.items()}
        ordered = sorted(bin_of.values(), reverse=True)
        good = [b for b in set(ordered) if len(ordered) * mean * 10 ** (-b / secrets.BINS_PER_UNIT) <= fdr * sum(x >= b for x in ordered)]
        return {t for t, b in bin_of.items() if good and b >= min(good)}

    return taken(lambda x: x[5]) - taken(lambda x: max(min(1.0, 3 * min(x[2:5])), 1e-300))


def test_battery_and_discovery_rule(spark):
    draw = random.Random(8)
    alphabets = [*secrets.ALPHABETS.values(), secrets.DIGITS + "abcdef-", "aeiourst", "ab", secrets.LOWER + "_"]
    tokens = ["".join(draw.choice(a) for _ in range(draw.choice([20, 24, 32, 40, 64, 128]))) for a in alphabets for _ in range(12)]
    tokens += ["international_characteristic_management", "x" * 30, "A1" * 20, "the-quick-brown-fox-jumps-over", "0123456789" * 3 + "==", "Zz" * 700]
    tokens = [t for t in dict.fromkeys(tokens) if re.fullmatch(secrets.TOKEN.replace("}+", "}"), t)]
    frame = spark.createDataFrame([(t,) for t in tokens], "t string")
    for r in frame.select("t", secrets.battery(F.col("t")).alias("b")).collect():
        name, n, *p = plain_tests(r.t)
        assert (r.b.encoding, r.b.n) == (name, n)
        assert [r.b.p_uniform, r.b.p_runs, r.b.p_serial, r.b.p_text] == pytest.approx(p, rel=2e-2, abs=1e-6), r.t
    # copies of a token are one test
    rows = [(i, f"a {t} b {t}") for i, t in enumerate(tokens)] + [(1000 + i, f"see {tokens[0]}") for i in range(300)]
    got = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id < 1000").select("doc_id", F.size(F.filter("secrets.spans", lambda s: s["kind"] == "random")).alias("n"), F.size("secrets.base").alias("base")).collect()
    want = plain_discoveries(tokens, secrets.FDR)
    assert {tokens[r.doc_id] for r in got if r.n} == {t for t in want if not any(tokens[r.doc_id] == t and r.base for r in got)}
    assert all(r.n in (0, 2) for r in got) and 20 < len(want) < len(tokens) - 20


def test_random_tokens_of_each_kind(spark):
    draw = random.Random(11)
    kinds = {"lower": secrets.LOWER, "upper": secrets.UPPER, "digits": secrets.DIGITS, "base32": secrets.UPPER + "234567", "alnum62": secrets.UPPER + secrets.LOWER + secrets.DIGITS}
    uuid = lambda: "-".join("".join(draw.choice("0123456789abcdef") for _ in range(n)) for n in (8, 4, 4, 4, 12))
    secret = [(k, "".join(draw.choice(a) for _ in range(28 if k == "digits" else 64))) for k, a in kinds.items() for _ in range(20)] + [("uuid", uuid()) for _ in range(20)]
    words = "internationalization the responsibility of characteristic management where nothing under standing between another government"
    plain = ["".join(draw.choice(words.split()) for _ in range(4)) for _ in range(60)] + ["_".join(draw.choice(words.split()) for _ in range(4)).upper() for _ in range(20)]
    plain += ["0" * 28, "12" * 14, "2024-01-02-2024-01-03", "0123456789" * 3]
    rows = [(i, f"see {t} there") for i, t in enumerate([t for _, t in secret] + plain)]
    got = {r.doc_id: r.s for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", secrets.joined(F.col("secrets.spans")).alias("s")).collect()}
    found = collections.Counter(k for i, (k, t) in enumerate(secret) if got[i] == f"random:4:{4 + len(t)}")
    assert all(found[k] >= 16 for k in (*kinds, "uuid")), found
    assert [t for i, t in enumerate(plain, len(secret)) if got[i]] == []


def test_chat(spark):
    rows = [
        (1, 0, 0, "message", "user", "hi </s>\\ [INST]"), (1, 1, 1, "message", "assistant", None), (1, 1, 2, "delta", "assistant", "par"), (1, 1, 3, "delta", "assistant", "tial"),
        (1, 1, 4, "regenerate", "assistant", None), (1, 1, 5, "delta", "assistant", "whole"), (1, 0, 6, "edit", "user", "<s>edited\\"), (None, 0, 0, "message", None, ""), (2, 0, 0, "delta", "assistant", "</s"),
    ]
    events = spark.createDataFrame(rows, "conv_id long, turn long, seq long, kind string, role string, text string")
    parts = chat.format_chats(events)
    formatted = {r.conv_id: r.formatted for r in parts.collect()}
    assert chat.parse(formatted[1]) == [("user", "<s>edited\\"), ("assistant", "whole")] and chat.parse(formatted[None]) == [("", "")]
    got = {r.conv_id: r for r in chat.read_back(parts).collect()}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert tuple(got[1])[1:5] == (2, digest("user\n<s>edited\\\nassistant\nwhole\n"), 5, digest("whole"))
    assert tuple(got[2])[3:5] == (3, digest("</s"))
    assert chat.format_chats(events.limit(0)).collect() == []


def test_streamed_events_fold_to_their_messages(spark):
    """Rows as the registered query has them: all ways of arriving, ties, repeats, nulls."""
    draw = random.Random(12)
    rows = [(c, t, draw.choice(["user", "assistant", None]), draw.choice([None, "", "é", "ab", "</s>\\x[INST]", f"text {c} {t} " * draw.randint(0, 9)])) for c in range(40) for t in range(draw.randint(1, 9))]
    rows += [(1, 0, "user", "tie b"), (1, 0, "user", "tie a"), (1, 0, "user", "tie a"), (None, None, "user", "lost")]
    events = chat.streamed(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert {r.kind for r in events.select("kind").distinct().collect()} == set(chat.KINDS)
    key = lambda x: (x is not None, x)
    want = collections.defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: [key(x) if x is not None else (False, 0 if i < 2 else "") for i, x in enumerate(r)]):
        want[c].append((role or "", text or ""))
    got = {r.conv_id: chat.parse(r.formatted) for r in chat.format_chats(events).collect()}
    assert got == want


@pytest.mark.parametrize("seed", range(30))
def test_escape(seed):
    draw = random.Random(seed)
    for _ in range(200):
        text = "".join(draw.choice(["<", "s", ">", "/", "[", "INST", "]", "\\", "</s>", "[INST]", "é", "\n", " "]) for _ in range(draw.randrange(12)))
        assert chat.unescape(chat.escape(text)) == text and not chat.CONTROL.search(chat.escape(text))


def test_chat_in_parts(spark, monkeypatch):
    messages = [(1, "assistant", "x" * 300), (1, "user", "y" * 300), (1, "assistant", "z")]
    monkeypatch.setattr(chat, "PART_CHARS", 100)
    parts = list(chat.render(iter(messages)))
    assert [p[1] for p in parts] == [0, 1, 2] and [t for p in parts for t in chat.parse(p[2])] == [m[1:] for m in messages]


def plain_best_fit(items, capacity, per_source):
    bins, out = [], []
    for size, cluster, source in items:
        fits = [(left, k) for k, (left, cs, ss) in enumerate(bins) if left >= size and (cluster is None or cluster not in cs) and (source is None or ss.count(source) < per_source)]
        if fits:
            left, k = min(fits)
        else:
            bins.append((capacity, [], []))
            left, k = capacity, len(bins) - 1
        out.append((k, capacity - left))
        bins[k] = (left - size, bins[k][1] + [cluster], bins[k][2] + [source])
    return out


@pytest.mark.parametrize("seed", range(20))
def test_best_fit(seed):
    draw = random.Random(seed)
    items = sorted(((draw.randint(1, 60), draw.choice([None, *range(6)]), draw.choice([None, "a", "b", "c"])) for _ in range(150)), key=lambda x: -x[0])
    assert packing.best_fit(*map(list, zip(*items)), 100, 2) == plain_best_fit(items, 100, 2)


@pytest.mark.parametrize(("capacity", "per_source", "shard_rows"), [(100, 4, 8), (60, 1, 1000), (100, 2, 30)])
def test_packing_against_plain_packing(spark, capacity, per_source, shard_rows):
    """Whole shards: order, pieces, bins, offsets and conflicts, with null and repeated rows."""
    draw = random.Random(capacity + per_source)
    rows = [(i if i % 9 else None, draw.choice([None, 0, *[draw.randint(1, 250)] * 3]), draw.choice([None, "a", "a", "b"]), draw.choice([None, *"uvwxyz"]), "x") for i in range(120)]
    rows += [(7, 30, "a", "u", "x"), (7, 30, "a", "u", "x")]
    got = collections.defaultdict(list)
    items = spark.createDataFrame(rows, "doc_id long, n_tokens long, source string, cluster string, shard string")
    shards = collections.defaultdict(list)
    for r in packing.pack(items, capacity, per_source, shard_rows).collect():
        shards[r.shard].append(r)
    for shard, found in shards.items():
        assert all(r.bin_id is None or r.bin_id >> 32 == shard for r in found)
        if any(r.doc_id is None for r in found) or 7 in {r.doc_id for r in found}:
            continue  # which of the rows without a name are here can't be told from the result
        mine = [(i, n or 0, s, c) for i, n, s, c, _ in rows if i in {r.doc_id for r in found}]
        mine.sort(key=lambda x: (-(x[1] % capacity), x[0]))
        want, bins = [], 0
        for i, n, _, _ in mine:
            for piece in range(n // capacity):
                want.append((i, piece, capacity, bins, 0))
                bins += 1
        some = [x for x in mine if x[1] % capacity]
        for (i, n, _, _), (k, at) in zip(some, plain_best_fit([(n % capacity, c, s) for _, n, s, c in some], capacity, per_source)):
            want.append((i, n // capacity, n % capacity, bins + k, at))
        want += [(i, 0, 0, None, None) for i, n, _, _ in mine if n == 0]
        have = [(r.doc_id, r.piece, r.piece_tokens, r.bin_id if r.bin_id is None else r.bin_id & 0xFFFFFFFF, r.bin_offset) for r in found]
        assert sorted(map(str, have)) == sorted(map(str, want))
        got[shard] = have
    assert got or shard_rows == 1000
    total = collections.Counter()
    for found in shards.values():
        for r in found:
            total[r.doc_id] += r.piece_tokens
    assert all(total[i] == sum(n or 0 for j, n, _, _, _ in rows if j == i) for i in total)


def test_packing(docs, texts, spark):
    got = packing.pack(packing.with_clusters(docs), capacity=100, shard_rows=8).collect()
    n = collections.Counter()
    for r in got:
        n[r.doc_id] += r.piece_tokens
    assert all(n[i] == len(words_of(t)) for i, t in enumerate(texts))
    by_bin = collections.defaultdict(list)
    for r in got:
        assert (r.bin_id is None) == (not words_of(texts[r.doc_id]))
        if r.bin_id is not None:
            by_bin[r.bin_id].append(r)
    for rows in by_bin.values():
        rows.sort(key=lambda r: r.bin_offset)
        assert [r.bin_offset for r in rows] == [sum(x.piece_tokens for x in rows[:k]) for k in range(len(rows))] and sum(r.piece_tokens for r in rows) <= 100
        assert len({texts[r.doc_id] for r in rows}) == len(rows)
    assert packing.pack(packing.with_clusters(empty(spark))).collect() == []


def test_mixing(docs, texts, spark):
    clashing = docs.withColumns({"mix": F.lit("m"), "prob": F.lit("p"), "kept": F.lit("k"), "n_tokens": F.lit("n"), "_keys": F.lit("x")})
    rows = mixing.sample(clashing).select("*", "mix_.prob", "mix_.kept").collect()
    assert len(rows) == len(texts) and all(r[-2] <= 1 for r in rows)
    assert {(r.mix, r[clashing.columns.index("prob")], r[clashing.columns.index("kept")], r["n_tokens"], r["_keys"]) for r in rows} == {("m", "p", "k", "n", "x")}
    cells = mixing.calibrated(mixing.rake(docs.select(mixing.keyed(docs).alias("k")).select("k.*"))).collect()
    kept, total = sum(c.prob * c.tokens for c in cells), sum(c.tokens for c in cells)
    assert kept == pytest.approx(total / 2, rel=1e-6) or all(c.prob == 1 for c in cells)
    assert mixing.sample(empty(spark)).collect() == []


def plain_raking(cells, target):
    """Iterative proportional fitting in plain Python: cells by (source, lang, topic), target shares by place of the key."""
    w = dict(cells)
    for _ in range(3000):
        for d in range(3):
            have = collections.Counter()
            for k, x in w.items():
                have[k[d]] += x
            w = {k: x * target[d][k[d]] / have[k[d]] for k, x in w.items()}
    return w


@pytest.mark.parametrize("given", [None, {"source": {"s1": 0.2, "s3": 0.3}, "lang": {"en": 0.5, "de": 0.25, "(none)": 0.25}}])
def test_mixing_against_plain_raking(spark, given):
    """Production settings on a sparse table: some sources have one language only."""
    draw, rows = random.Random(4), []
    for i in range(300):
        source = draw.choice(["s1", "s1", "s2", "s3", None])
        lang = "de" if source == "s3" and i % 5 else draw.choice(["en", "de", None, ""])
        rows.append((i, " ".join("w" for _ in range(draw.randint(0, 1500))), lang, source, draw.choice("ab")))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, topic string")
    cells = collections.Counter()
    for _, t, lang, source, form in rows:
        cells[source or "(none)", lang or "(none)", form] += len(t.split())
    cells = {k: n for k, n in cells.items() if n}
    target = []
    for d, name in enumerate(mixing.DIMS):
        have = collections.Counter()
        for k, n in cells.items():
            have[k[d]] += n
        some = (given or {}).get(name)
        open_tokens = sum(n for v, n in have.items() if v not in (some or {}))
        raw = {v: n ** mixing.POWERS[name] if not some else some[v] if v in some else (1 - sum(some.values())) * n / open_tokens for v, n in have.items()}
        target.append({v: x / sum(raw.values()) for v, x in raw.items()})
    w = plain_raking(cells, target)
    total, budget = sum(cells.values()), 0.5 * sum(cells.values())
    lo, hi = 0.0, 1e9
    for _ in range(200):  # the scale that spends the budget
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(cells[k], x * mid) for k, x in w.items()) < budget else (lo, mid)
    prob = {k: min(1.0, x * lo / cells[k]) for k, x in w.items()}
    for r in mixing.sample(docs, given).select("doc_id", "mix.*").collect():
        k = (r.source, r.lang, r.topic)
        assert r.prob == pytest.approx(prob.get(k, 0.0), abs=1e-6)
        share = int(hashlib.md5(f"{r.doc_id}:{mixing.SEED}".encode()).hexdigest()[:8], 16) / 2**32
        assert r.kept == (share < r.prob)
    assert total and len(prob) > 12


def test_raking_of_contradicting_targets_ends(spark):
    rows = [(0, "a b", "en", "s1", "x"), (1, "a b", "de", "s2", "x")]  # each source has one language
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, topic string")
    got = mixing.sample(docs, {"source": {"s1": 0.9, "s2": 0.1}, "lang": {"en": 0.1, "de": 0.9}}).select("mix.prob").collect()
    assert len(got) == 2 and all(0 <= r.prob <= 1 for r in got)


@pytest.mark.parametrize("seed", range(3))
def test_top_k(spark, seed, monkeypatch):
    monkeypatch.setattr(topk, "RING", 5)
    monkeypatch.setattr(topk, "BLOCK", 20)
    draw = np.random.default_rng(seed)
    v = draw.normal(size=(300, 6)).round(1)
    v[100:180] = v[100]  # one vector in many rows: ties
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(1000, None), (1100, [None] * 6), (1200, [float("nan")] * 6), (1300, [1.0]), (1400, []), (None, [0.0] * 6)]
    ints = np.floor(v * 1024).astype(int)
    want = {}
    for q in range(0, 300, 100):
        score = ints @ ints[q]
        want[q] = [(k + 1, i, int(score[i])) for k, i in enumerate(sorted((i for i in range(300) if i != q), key=lambda i: (-score[i], i))[:10])]
    vectors = topk.integers(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = collections.defaultdict(list)
    for r in topk.search(vectors, vectors.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect():
        got[r.query_id].append(tuple(r)[1:])
    assert got == want


def test_top_k_of_dimensions_and_repeats(spark):
    """Two dimensions, each searched; repeated ids with other vectors; extra columns."""
    draw = np.random.default_rng(9)
    rows = [(i, draw.normal(size=4 if i % 3 else 2).round(2).tolist(), 1, 2) for i in range(90)]
    rows += [(0, [3.0, -1.0], 1, 2), (0, [-2.0, 1.0], 1, 2), (7, [0.5] * 4, 1, 2), (7, [0.5] * 4, 1, 2)]
    ints = [(i, tuple(int(np.floor(1024 * x)) for x in v)) for i, v, _, _ in rows]
    got = collections.defaultdict(list)
    vectors = topk.integers(spark.createDataFrame(rows, "vec_id long, embedding array<double>, block int, kind int"))
    for r in topk.search(vectors, topk.asked(vectors, 10)).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    for q in range(0, 90, 10):
        v = min(x for i, x in ints if i == q)
        want = sorted(((-sum(a * b for a, b in zip(v, x)), i) for i, x in ints if i != q and len(x) == len(v)))[:10]
        assert got.pop(q) == [(i, -s) for s, i in want]
    assert not got


def test_top_k_of_few(spark):
    vectors = topk.integers(spark.createDataFrame([(0, [1.0, 2.0]), (7, [0.5, 0.0])], "vec_id long, embedding array<double>"))
    assert list(map(tuple, topk.search(vectors, vectors.where("vec_id = 0")).collect())) == [(0, 1, 7, 524288)]
    assert topk.search(vectors.limit(0), vectors.limit(0)).collect() == []
