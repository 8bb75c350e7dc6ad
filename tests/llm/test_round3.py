"""Whitening, line runs and pair-bound search against brute force and on odd rows."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyroom.llm import line_runs, pair_search, whitening

DOCS = "doc_id bigint, text string, line int, doc string, part int"


# Whitening

def vectors(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, "x") for i, v in rows],
                                 f"vec_id bigint, embedding array<{kind}>, x string")


def test_whitened_vectors_have_unit_covariance(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 8)) @ rng.normal(size=(8, 8)) * 0.3
    x[100:300] = x[7]
    odd = [(900, None), (901, [math.nan] * 8), (902, []), (903, [None] * 8), (904, [math.inf] * 8),
           (905, [1e300] * 8), (7, [0.5] * 8), (None, [-0.0] * 8)]
    df = vectors(spark, list(enumerate(x.tolist())) + odd, "double")
    got = whitening.whiten_rows(df).collect()
    assert len(got) == 402 * 4
    whole = [(i, tuple(math.floor(256 * c) for c in v))
             for i, v in [*enumerate(x.tolist()), (7, [0.5] * 8), (None, [0.0] * 8)]]
    distinct = np.array(sorted({v for _, v in whole}))
    n, sums = len(distinct), distinct.sum(0)
    values, vecs = np.linalg.eigh(np.cov(distinct.T, bias=True))
    values, vecs = values[::-1], vecs[:, ::-1]
    deviation = Counter((i, sum((n * a - int(s)) ** 2 for a, s in zip(v, sums, strict=True)))
                        for i, v in whole)
    assert Counter((r.vec_id, r.deviation) for r in got if r.component == 1) == deviation
    sign = {}
    for r in got:
        assert r.n == n and r.identity_error < 1e-9
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum())
    for i, v in whole:
        if i in (7, None):
            continue
        for c in range(4):
            want = (np.array(v) - sums / n) @ vecs[:, c] / math.sqrt(values[c])
            have = next(r.whitened for r in got if r.vec_id == i and r.component == c + 1)
            sign.setdefault(c, np.sign(want * have))
            assert have * sign[c] == pytest.approx(want, abs=1e-9)


def test_copies_can_weigh(spark):
    rows = [(i, [float(i % 5), float(i % 3)]) for i in range(40)] + [(50, [4.0, 0.0])] * 9
    df = vectors(spark, rows)
    x = np.floor(256 * np.array([v for _, v in rows]))
    model = whitening.fit(whitening.distinct_vectors(df), 2, by_copies=True)
    assert model.n == 49 and np.allclose(model.mean, x.mean(0))
    assert np.allclose(model.values, np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1])
    got = whitening.whiten_rows(df, by_copies=True).collect()
    assert max(r.identity_error for r in got) < 1e-9


def test_flat_large_and_no_vectors(spark):
    one = whitening.whiten_rows(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error)
            for r in sorted(one)] == [(i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)]
    line = whitening.whiten_rows(vectors(spark, [(i, [float(i), 0.0]) for i in range(4)])).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in line)
    assert {r.explained for r in line if r.component == 1} == {1.0}
    far = whitening.whiten_rows(vectors(spark, [(1, [2.0**50]), (2, [0.0]), (3, [1.0, 1.0])],
                                        "double")).collect()
    assert {(r.vec_id, r.component, r.n) for r in far} == {(1, 1, 2), (2, 1, 2), (3, 1, 1), (3, 2, 1)}
    assert [r.deviation for r in far if r.vec_id == 1] == [None]
    none = vectors(spark, [])
    assert whitening.whiten_rows(none).count() == 0
    assert whitening.whiten_rows(none).columns == far[0].__fields__


# Line runs

def brute_lines(rows):
    def key(line):
        return re.sub(r"[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))

    order = lambda i: (i is None, i or 0)
    first = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(k := key(line)) >= 10 and (k not in first or order(i) < order(first[k])):
                first[k] = i
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stays = [x for x in lines if len(key(x)) < 10 or first[key(x)] == i]
        out.append((i, "\n".join(stays), len(lines), len(lines) - len(stays)))
    return sorted(out, key=str)


LINES = ["a common line of all", "  A COMMON line of all\t", "short", "", "ÄÖÜ äöü ÄÖÜ", "äöü äöü äöü",
         "the second line here", "nine char", "ten chars!", "only here 1", "　wide space line　"]


@pytest.fixture(scope="module")
def line_rows():
    rng = np.random.default_rng(2)
    rows = [(int(i), "\n".join(rng.choice(LINES, rng.integers(1, 12)))) for i in rng.permutation(60)]
    return rows + [(None, "a common line of all\nof the null rows only"), (None, "of the null rows only"),
                   (70, None), (71, ""), (72, "\n\n"), (3, "the second line here\nten chars!"),
                   (3, "the second line here\nten chars!"),
                   (80, "\n".join(["long and longer text"] * 20_000 + ["a common line of all", "x"])),
                   (81, "long and longer text\r\nLONG AND longer text")]


@pytest.mark.parametrize("batches, fan_out", [(1, 3), (4, 3), (7, 2)])
def test_lines_stay_in_their_first_document(spark, line_rows, batches, fan_out):
    docs = spark.createDataFrame([(i, t, 0, "d", 1) for i, t in line_rows], DOCS)
    got = line_runs.dedup_lines(docs, batches=batches, fan_out=fan_out)
    assert got.columns == ["id", "kept", "n_lines", "n_dropped"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_lines(line_rows)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_no_documents_have_no_lines(spark):
    assert line_runs.dedup_lines(spark.createDataFrame([], DOCS)).count() == 0


def test_runs_are_joined_without_moving_them(spark, capsys):
    docs = spark.createDataFrame([(i, f"line number {i % 7}\nline of document {i}", 0, "", 0)
                                  for i in range(40)], DOCS)
    lines = line_runs.hashed_lines(docs)
    runs = line_runs.LineRuns(spark, fan_out=2)
    try:
        for low in range(0, 40, 10):
            batch = lines.where((F.col("doc") >= low) & (F.col("doc") < low + 10))
            new = runs.fresh(batch)
            new.explain()
            plan = capsys.readouterr().out
            # One shuffle, of the batch; the runs come in their buckets.
            assert plan.count("Exchange") == 1 and "Python" not in plan and "Arrow" not in plan
            runs.add(batch)
        assert [len(level) for level in runs.levels] == [0, 0, 1]
        assert runs.seen().count() == 47
    finally:
        runs.close()


# Ranked search

def words_of(text):
    low = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute_ranks(docs, items, top=10):
    bags = [(i, words_of(t)) for i, t in docs]
    bags = [(i, w) for i, w in bags if w]
    n_docs, n_terms = len(bags), sum(len(w) for _, w in bags)
    held = [(i, len(w), Counter(w)) for i, w in bags]
    df = Counter(t for _, _, c in held for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(words_of(text))
    out = set()
    for item, terms in asked.items():
        scores = []
        for i, n, c in held:
            m = 100 - 90 + (90 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out |= {(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scores, key=lambda x: x[:3])[:top], 1)}
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(300)] + ["Grüße", "東京", "ΣΑΣ"]
    odds = 1 / np.arange(1, len(words) + 1)
    pick = lambda n: rng.choice(words, n, p=odds / odds.sum())
    docs = [(int(i), " ".join(pick(rng.integers(1, 120)))) for i in range(500)]
    docs += [(600, None), (601, ""), (602, "--- !!"), (None, "w7 w8 w9"), (603, "w7 W8 w9"), (5, "w7,w8;w9"),
             (604, " ".join(pick(20_000))), (605, docs[3][1]), (606, docs[3][1])]
    items = [(i, " ".join(pick(25))) for i in range(30)] + [(40, None), (41, "unheard of"), (42, "w7 w8 w9"),
                                                            (0, "w200 W201"), (None, "w250 w1")]
    return docs, items


@pytest.mark.parametrize("shard_bytes, block", [(1 << 30, 2000), (6000, 2000), (20_000, 7)])
def test_ranks_are_those_of_all_scores(spark, corpus, shard_bytes, block):
    docs, items = corpus
    got = pair_search.rank_documents(
        spark.createDataFrame([(i, t, 0, "d", 1) for i, t in docs], DOCS).repartition(3),
        spark.createDataFrame(items, "item_id bigint, text string"),
        shard_bytes=shard_bytes, block_items=block)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == brute_ranks(docs, items)


def test_pair_bounds_look_at_fewer_postings(spark, corpus):
    docs, items = corpus
    index = pair_search.build_index(
        spark.createDataFrame([(i, t, 0, "d", 1) for i, t in docs], DOCS).coalesce(1), shard_bytes=20_000)
    texts = [(i, set(words_of(t))) for i, t in items]
    texts = [(i, {w.encode() for w in words}) for i, words in texts]
    counts = pair_search.collection(index, set().union(*(w for _, w in texts)))
    queries = pair_search.Queries.of(texts, counts)
    rows = [r.asDict() for r in pair_search.weigh(index, queries, counts).collect()]
    looked = {}
    for pairs in (False, True):
        seen, best = 0, {}
        for shard in map(pair_search.Shard, rows):
            for i, found in enumerate(queries.lists):
                least = best.get(i, [1])[-1] if len(best.get(i, [])) == 10 else 1
                bounds = shard.bounds(found, pairs)
                assert all(a <= b for a, b in zip(bounds, shard.bounds(found, False), strict=True))
                docs_, scores, n = shard.search(found, 10, least, pairs)
                seen += n
                best[i] = sorted(best.get(i, []) + scores.tolist(), reverse=True)[:10]
        looked[pairs] = seen, best
    assert looked[True][1] == looked[False][1] and looked[True][0] < looked[False][0]


def test_nothing_to_rank(spark):
    none = spark.createDataFrame([], DOCS)
    items = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert pair_search.rank_documents(none, items).count() == 0
    some = spark.createDataFrame([(1, "a b", 0, "", 0)], DOCS)
    assert pair_search.rank_documents(some, items.where("item_id > 5")).count() == 0
    # Every document holds the term: its weight is floor(1000 ln(4/3)).
    assert [tuple(r) for r in pair_search.rank_documents(some, items).collect()] == [
        (1, 1, 1, 2 * 287 * (1000000000 // (1000 + 800)))]


# Rows that are odd in some way, through the stages of the pipeline

@pytest.fixture(scope="module")
def odd_docs(spark):
    """Bytes that are no UTF-8, null and repeated ids, long texts, columns with clashing names."""
    rng = np.random.default_rng(9)
    prose = lambda n: " ".join(f"w{i}" for i in rng.integers(0, 400, n))
    rows = [(i, prose(60), "en", "a", 1, 10 * i, 20 * i, i, "t") for i in range(40)]
    rows += [(5, rows[5][1], "en", "a", 1, 51, 52, 53, "t")] * 3
    rows += [(5, prose(60), "en", "a", 1, 6, 7, 8, "t"), (None, prose(60), None, None, None, 1, 2, 3, "t"),
             (None, prose(60), None, "b", None, 1, 2, 3, "t"), (60, None, "en", "a", 1, 1, 2, 3, "t"),
             (61, "", "en", "a", 1, 1, 2, 3, "t"), (62, rows[7][1] + " more", "en", "b", 1, 1, 2, 3, "t"),
             (63, "x" * 300_000 + " " + prose(100), "en", "b", 1, 1, 2, 3, "t")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, "
                                       "n_chars bigint, __place int, __of int, __gone int, __Copy string")
    bad = docs.where("doc_id = 9").withColumn(
        "text", F.expr("cast(concat(cast(text as binary), x'FFFE') as string)")).withColumn(
        "doc_id", F.lit(64).cast("bigint"))
    return docs.unionByName(bad)


def test_odd_rows_pass_all_stages(spark, odd_docs, tmp_path):
    import corpus_pipeline

    labels = spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(40)] + [(None, 1, 1)],
                                   "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd_docs, str(tmp_path))
        assert out.schema.names == odd_docs.columns and out.dtypes == odd_docs.dtypes
        extra = odd_docs.columns[4:]
        assert out.select(*extra).distinct().exceptAll(odd_docs.select(*extra).distinct()).count() == 0
        if name == "near-duplicates":
            ids = Counter(r.doc_id for r in out.collect())
            # 62 is a near copy of 7; equal rows of 5 stay once, its other text as well.
            assert ids[62] == 0 and ids[5] == 2 and ids[None] == 2 and ids[64] == 0 and ids[9] == 1
            assert ids[60] == ids[61] == ids[63] == 1
    tokens = corpus_pipeline.STAGES[-1][1](spark, odd_docs, str(tmp_path)).collect()
    assert len(tokens) == odd_docs.count()


@pytest.mark.parametrize("same", ["null", "one"])
def test_targets_are_met_without_ids_to_tell_rows_apart(spark, same):
    from tallyroom.llm import mixing

    rows = [(None if same == "null" else 1, f"a{i} b c d e f g h i j", "big") for i in range(2000)]
    rows += [(i, "x y z w v u t s r q", "small") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    plan = mixing.mix_plan(docs)
    for r in (plan.groupBy("source").agg(F.first("target").alias("target"),
                                         F.sum(F.col("size") * F.col("copies")).alias("taken"))
              .collect()):
        if r.source == "big":
            assert r.taken == pytest.approx(r.target, rel=0.1)


def test_a_long_text_without_spaces_takes_linear_time():
    import time

    from tallyroom.llm import bpe

    coder = bpe.WordEndBpe.from_file(bpe.default_vocabulary())
    text = "".join("abc1,x.y-2"[i % 10] for i in range(1_000_000))
    start = time.process_time()
    ids = coder.encode(text)
    assert time.process_time() - start < 10 and len(ids) > 100_000


# Class model

@pytest.mark.parametrize("known, parts", [(10_000, 3), (40, 5), (0, 2)])
def test_the_grid_is_that_of_the_classes_of_all_words(spark, known, parts):
    """Whichever words are known: every word has a class, and steps and sizes follow from them."""
    from tallyroom.llm import class_lm

    rng = np.random.default_rng(3)
    words = [f"w{i}{'abcdef'[i % 6]}" for i in range(200)] + ["w7 w7 w7", "x" * 100 + " x", "Ä"]
    odds = 1 / np.arange(1, len(words) + 1)
    texts = [" ".join(rng.choice(words, rng.integers(0, 60), p=odds / odds.sum())) for _ in range(80)]
    docs = spark.createDataFrame([(i, t, 0, "", 0) for i, t in enumerate(texts)], DOCS).repartition(3)
    model = class_lm.learn(docs, core_words=10, classes=5, known_words=known, parts=parts)
    of = {bytes(r["word"] or b""): r["cls"] for r in model.counts.collect()}
    line = [b"", *[w for t in texts for w in [*t.encode().lower().split(), b""]]]
    count = Counter(line[1:])
    assert {bytes(r["word"] or b""): r["n"] for r in model.counts.collect()} == count
    k = len(model.steps)
    grid = np.zeros((k, k))
    np.add.at(grid, ([of[w] for w in line[:-1]], [of[w] for w in line[1:]]), 1)
    want = np.log10((grid + 0.1) / (grid.sum(1, keepdims=True) + 0.1 * k))
    assert np.allclose(model.steps, want)
    assert model.class_tokens.tolist() == [sum(n for w, n in count.items() if of[w] == c) for c in range(k)]
    assert model.class_words.tolist() == [sum(of[w] == c for w in count) for c in range(k)]


def test_moved_words_keep_the_grid_exact():
    from tallyroom.llm import class_lm

    rng = np.random.default_rng(8)
    line = np.r_[0, rng.integers(0, 30, 3000), 0]
    pairs = np.zeros((30, 30))
    np.add.at(pairs, (line[:-1], line[1:]), 1)
    of = rng.integers(0, 5, 30)
    member = np.eye(5)[of]
    grid = member.T @ pairs @ member
    for w in range(30):
        # One word at a time, whose neighbours are up to date.
        m = np.eye(5)[of]
        near, mine = np.hstack([pairs[w:w + 1] @ m, pairs[:, w:w + 1].T @ m]), of[w:w + 1].copy()
        before = class_lm.likelihood(grid)
        class_lm.move_words(grid, near, mine, pairs[w, w][None])
        of[w] = mine[0]
        m = np.eye(5)[of]
        assert np.allclose(grid, m.T @ pairs @ m) and class_lm.likelihood(grid) >= before - 1e-6


# Search on vectors of any magnitude

@pytest.mark.parametrize("kind", ["huge", "tiny", "outlier", "dense", "lengths"])
def test_recall_holds_whatever_the_magnitudes(spark, kind):
    from tallyroom.llm import graph_search

    rng = np.random.default_rng(4)
    x = rng.normal(size=(6000 if kind == "dense" else 1000, 64 if kind == "dense" else 16))
    if kind == "huge":
        x *= 1e20
    elif kind == "tiny":
        x *= 1e-25
    elif kind == "outlier":
        x[5] *= 1e6
    elif kind == "lengths":
        x *= 10.0 ** rng.uniform(-6, 6, size=(len(x), 1))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(20, x[20].tolist())] * 3,
                               "vec_id bigint, embedding array<double>")
    index = graph_search.build_index(df, shards=1 if kind == "dense" else 2)
    got = graph_search.search_index(index, df.where("vec_id % 20 = 0"), 1 if kind == "dense" else 2).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, set()).add(r.vec_id)
    queries = range(0, len(x), 20)
    assert set(found) == set(queries) and all(len(f) == 20 for f in found.values())
    hit = 0
    for q in queries:
        scores = x @ x[q]
        scores[q] = -np.inf
        hit += len(found[q] & set(np.argsort(-scores)[:20].tolist()))
    assert hit / (20 * len(found)) >= 0.95
