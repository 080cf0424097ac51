"""The registered training-data queries at the smallest size, and the pipeline's stages."""

import collections
import hashlib
import os
import re

import duckdb
import pytest
from test_llm import plain_raking

import corpus_pipeline
from wavelake.llm import common, mixing, queries

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, duck, name):
    df = queries.QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    got = sorted(map(str, map(tuple, df.select(*columns).collect())))
    assert got
    if name in queries.ORACLES:
        rel = duck.execute(f"select {', '.join(columns)} from ({queries.ORACLES[name]()})")
        assert got == sorted(map(str, rel.fetchall()))


def test_languages_are_told_apart(spark):
    """Accuracy on held-out documents, whose language no training saw."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "lang")
    rows = queries.QUERIES["op10_langid"](spark, DIR).where("held_out").join(docs, "doc_id").collect()
    assert len(rows) > 20 and sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)


def test_quality_follows_the_labels(spark):
    labels = spark.read.parquet(f"{DIR}/labels.parquet").select("doc_id", "quality")
    rows = queries.QUERIES["op7_quality"](spark, DIR).where("not base_failed").join(labels, "doc_id").collect()
    assert sum(r.kept == (r.quality == 1) for r in rows) >= 0.9 * len(rows)


def plain_sample(rows):
    """The doc_ids that raking by source, language and form keeps, in plain Python."""
    def form(text):
        n = len(text.split())
        return "empty" if not n else "lines" if 10 * text.count("\n") >= n else "dense" if len(text) >= 9 * n else "note" if n < 100 else "long" if n >= 1000 else "prose"

    key = {r.doc_id: (r.source or "(none)", r.lang or "(none)", form(r.text)) for r in rows}
    cells = collections.Counter()
    for r in rows:
        cells[key[r.doc_id]] += len(r.text.split())
    cells = {k: n for k, n in cells.items() if n}
    target = []
    for d, name in enumerate(mixing.DIMS):
        have = collections.Counter()
        for k, n in cells.items():
            have[k[d]] += n
        raw = {v: n ** mixing.POWERS[name] for v, n in have.items()}
        target.append({v: x / sum(raw.values()) for v, x in raw.items()})
    w = plain_raking(cells, target)
    lo, hi = 0.0, 1e9
    for _ in range(200):  # the scale that spends the budget
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(cells[k], x * mid) for k, x in w.items()) < mixing.BUDGET * sum(cells.values()) else (lo, mid)
    share = lambda i: int(hashlib.md5(f"{i}:{mixing.SEED}".encode()).hexdigest()[:8], 16) / 2**32
    return {i for i, k in key.items() if k in cells and share(i) < min(1.0, w[k] * lo / cells[k])}


def test_pipeline_of_hard_rows(spark):
    """Nulls, repeats, ties, empty and long texts, names that stages use inside, and an empty table: no stage fails, and each keeps what it must."""
    text = lambda k, n=80: " ".join(f"word{k}x{i}" for i in range(n))
    rows = [(1, text(1)), (1, text(1)), (2, text(1)), (None, text(2)), (None, text(3)), (4, None), (5, ""), (None, None), (6, text(6, 9000)), (7, "short one"), (8, text(8) + " token = abcdefgh1234")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row long, kept string, mix int, secrets int, _row int, prob double"
    docs = spark.createDataFrame([(i, t, None if k % 2 else "en", None if k % 3 else "s", None, 1, "k", 2, 3, 4, 0.5) for k, (i, t) in enumerate(rows)], schema)
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda df: collections.Counter(r.doc_id for r in df.collect())
    good = stages["quality rules"](spark, docs, DIR)
    assert good.columns == list(corpus_pipeline.COLUMNS) and set(ids(good)) <= {1, 2, None, 6, 8}
    near = stages["near duplicates"](spark, docs, DIR)
    assert near.columns == list(corpus_pipeline.COLUMNS) and ids(near) == {1: 1, None: 3, 4: 1, 5: 1, 6: 1, 7: 1, 8: 1}
    clean = stages["secret scans"](spark, docs, DIR)
    assert ids(clean) == ids(docs) and clean.columns == list(corpus_pipeline.COLUMNS)
    assert clean.where("doc_id = 8").first().text == text(8) + " [SECRET]"
    mixed = stages["mixing"](spark, docs, DIR)
    assert set(ids(mixed)) <= set(ids(docs)) and mixed.columns == list(corpus_pipeline.COLUMNS)
    packed = collections.Counter()
    for r in stages["packing"](spark, docs, DIR).collect():
        packed[r.doc_id] += r.piece_tokens
    assert packed == {1: 160, 2: 80, None: 160, 4: 0, 5: 0, 6: 9000, 7: 2, 8: 83}
    for stage in stages.values():
        assert stage(spark, docs.limit(0), DIR).collect() == []


def test_shared_folder_is_empty_after_clearing(spark):
    common.staged(spark.range(3))
    folder = common.shared_dir(spark).removeprefix("file:")
    assert os.listdir(folder)
    queries.QUERIES["op5_neardup"](spark, DIR).collect()
    common.clear(spark)
    assert not os.path.exists(folder) or not os.listdir(folder)


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Session:
        class sparkContext:  # noqa: N801
            master = "spark://somewhere:7077"
            getCheckpointDir = staticmethod(lambda: None)

        class conf:  # noqa: N801
            get = staticmethod(lambda name, default=None: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session())


def test_reading_a_table_changes_no_setting(spark):
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    before = [spark.conf.get(n) for n in names]
    queries.QUERIES["op8_phrases"](spark, DIR).collect()
    assert [spark.conf.get(n) for n in names] == before


def test_pipeline(spark):
    docs = common.table(spark, DIR, "documents")
    seen = [{r.doc_id: r for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES:
        docs = common.staged(stage(spark, docs, DIR))
        if name != "packing":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
            seen.append({r.doc_id: r for r in docs.collect()})
    first, quality, near, secret, mixed = seen
    assert len(first) > len(quality) > len(near) == len(secret) > len(mixed)
    verdicts = {r.doc_id for r in queries.QUERIES["op7_quality"](spark, DIR).where("kept").collect()}
    assert set(quality) == verdicts
    sets = {i: frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) for i, r in quality.items() for w in [r.text.split()]}
    root = {i: i for i in sets}
    for _ in range(4):
        for i, a in sets.items():
            for j, b in sets.items():
                if 5 * len(a & b) >= 4 * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    assert set(near) == set(root.values())
    for i, r in secret.items():
        assert r.n_chars == len(r.text) and not re.search("[0-9a-f]{32}|AKIA[A-Z0-9]{12}", r.text)
        assert ("[SECRET]" in r.text) or r.text == near[i].text
    assert all(mixed[i].text == secret[i].text for i in mixed)
    assert set(mixed) == plain_sample(secret.values())
    words = collections.Counter()
    for r in docs.collect():
        words[r.doc_id] += r.piece_tokens
    assert words == {i: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for i, r in mixed.items()}
    assert corpus_pipeline.run(spark, DIR).count() == docs.count()


def test_near_duplicates_of_null_and_repeated_ids(spark):
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    near = lambda k: text(k) + " end"
    rows = [(None, text(1)), (None, text(2)), (None, near(2)), (9, text(1)), (5, text(3)), (5, text(3)), (5, text(3))]
    rows += [(6, None), (6, text(4)), (7, near(4)), (8, text(5)), (8, text(6)), (10, near(5)), (11, near(6))]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = collections.Counter((r.doc_id, r.text and r.text.split("x")[0], (r.text or "").endswith("end")) for r in corpus_pipeline.near_duplicates(spark, docs, DIR).collect())
    two = [k for k in got if k[0] is None]
    assert len(two) == 1 and two[0][1] == "w2" and got.pop(two[0]) == 1
    assert got == collections.Counter([(9, "w1", False), (5, "w3", False), (6, None, False), (6, "w4", False), (8, "w5", False), (8, "w6", False)])
