"""The corpus operators against brute force, and on nulls, empty, repeated and clashing rows."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyroom.llm import (bpe, class_lm, graph_search, license_scan, mixing, quality_lines,
                           setsketch, token_lengths, toxicity, warc)

DOCS = "doc_id bigint, text string, source string, kept int, score string"
WORDS = [f"w{i}" for i in range(400)]


def prose(seed, n=120):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Null and repeated rows, empty and long texts, columns with names the operators use."""
    rows = [(1, prose(1), "a", 0, "x"), (1, prose(1), "a", 0, "x"), (2, None, None, 0, None),
            (3, "", "b", 0, "x"), (4, " \n\t ", "b", 0, "x"), (None, prose(4), "c", 0, "x"),
            (5, "one two", "c", 0, "x"), (6, prose(6, 30_000), "c", 0, "x"),
            (7, "Grüße ΣΑΣ 東京 \u0000 x", None, 0, "x"), (8, prose(1) + " more", "a", 0, "x")]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def by_id(df, key="id"):
    return {r[key]: r for r in df.collect()}


# Quality lines

def brute_repeats(words, width=5):
    grams = [tuple(words[i:i + width]) for i in range(len(words) - width + 1)]
    count = Counter(grams)
    return len({i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(width)})


def test_measures_are_those_of_the_whole_text():
    rng = random.Random(3)
    for n in (0, 3, 5, 6, 40, 400):
        words = [rng.choice(["a", "b", "cé"]) for _ in range(n)]
        text = "\n".join(" ".join(words[i:i + 7]) for i in range(0, n, 7)) + "\n \n"
        m = quality_lines.measure(text.encode())
        lines = [x for x in text.split("\n") if x.split()]
        assert m.n_words == n and m.word_chars == sum(map(len, words))
        assert m.n_dup_lines == len(lines) - len(set(lines))
        assert m.n_repeat_words == brute_repeats(words)


def test_viterbi_is_the_best_of_all_labellings():
    rng = np.random.default_rng(0)
    for n in range(1, 8):
        model = quality_lines.LineModel(step=rng.normal(size=(2, 2)), first=float(rng.normal()))
        scores = rng.normal(size=n).tolist()

        def total(labels, model=model, scores=scores):
            return (model.first * labels[0] + sum(s for s, x in zip(scores, labels, strict=True) if x)
                    + sum(model.step[a, b] for a, b in zip(labels, labels[1:], strict=False)))

        every = [[(k >> i) & 1 for i in range(n)] for k in range(1 << n)]
        assert total(quality_lines.viterbi(scores, model)) == pytest.approx(max(map(total, every)))


def test_lines_are_learned_from_document_labels(spark, odd, none):
    good = [(i, "\n".join(prose(i * 50 + k, 12) + "." for k in range(6)), "s", 0, "") for i in range(60)]
    bad = [(100 + i, "\n".join(prose(i * 70 + k, 8).upper().replace(" ", "!! ") for k in range(6)),
            "s", 0, "") for i in range(60)]
    docs = spark.createDataFrame(good + bad, DOCS)
    labels = spark.createDataFrame([(i, int(i < 100)) for i, *_ in good + bad] + [(1, 0)],
                                   "doc_id bigint, quality int")
    model = quality_lines.train_lines(docs, labels)
    got = by_id(quality_lines.label_lines(docs, model))
    assert all(r["kept"] == (i < 100) for i, r in got.items())
    assert quality_lines.keep_good(docs, model).columns == docs.columns
    assert {r["doc_id"] for r in quality_lines.keep_good(docs, model).collect()} == set(range(60))
    plain = quality_lines.train_lines(docs, labels.where("quality > 5"))
    assert not plain.trained
    found = quality_lines.label_lines(odd, plain).collect()
    assert len(found) == 10 and all(r["base_failed"] for r in found if r["id"] in (2, 3, 4, 5))
    assert quality_lines.label_lines(none, plain).count() == 0


# Search

def test_search_finds_the_largest_products(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 16)) * rng.uniform(0.5, 2, size=(1500, 1))
    x[100:160] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (None, [1.0] * 16),
             (2003, []), (7, [9.0] * 16), (2004, [None] * 16)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    index = graph_search.build_index(df, shards=3)
    got = graph_search.search_index(index, df.where("vec_id % 20 = 0"), 3).collect()
    x[7] = min(x[7].tolist(), [9.0] * 16)
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append((r["rank"], -r["score"], r["vec_id"]))
    assert set(found) == set(range(0, 1500, 20))
    hit = 0
    for q, rows_ in found.items():
        rows_.sort()
        assert [r[0] for r in rows_] == list(range(1, 21))
        assert [r[1:] for r in rows_] == sorted(r[1:] for r in rows_)
        exact = sorted((-float((x[i] * x[q]).sum()), i) for i in range(1500) if i != q)[:20]
        hit += len({i for _, i in exact} & {r[2] for r in rows_})
        assert all(r[1] == pytest.approx(-float(x[r[2]] @ x[q])) for r in rows_)
    assert hit / (20 * len(found)) >= 0.95


def test_search_of_few_and_of_no_vectors(spark):
    few = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(4)] + [(20, [1.0, 1.0])],
                                "vec_id bigint, embedding array<float>")
    index = graph_search.build_index(few)
    got = graph_search.search_index(index, few.where("vec_id % 20 = 0"), 8).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == [
        (0, 1, 1), (0, 2, 2), (0, 3, 3), (0, 4, 20), (20, 1, 3), (20, 2, 2), (20, 3, 1), (20, 4, 0)]
    empty = few.where("vec_id < 0")
    assert graph_search.search_index(graph_search.build_index(empty), empty, 8).count() == 0


# Scores

def test_base_scores_and_counts_are_exact(spark, odd, none):
    model = class_lm.learn(odd, core_words=50, classes=6)
    texts = [(r["doc_id"], (r["text"] or "")) for r in odd.collect()]
    tokens = [[*t.encode().lower().split(), None] for _, t in texts]
    count = Counter(w for ws in tokens for w in ws)
    n, v = sum(count.values()), len(count)
    assert (model.tokens, model.distinct) == (n, v)
    base = sorted(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws) for ws in tokens)
    got = class_lm.score_texts(odd, model).collect()
    assert sorted(r["base_score"] for r in got) == pytest.approx(base)
    assert sorted(r["n_known"] for r in got) == sorted(map(len, tokens))
    unseen = spark.createDataFrame([(1, "new words " + WORDS[0], "", 0, "")], DOCS)
    assert class_lm.score_texts(unseen, model).first()["n_known"] == 2
    empty = class_lm.learn(none)
    assert empty.tokens == 0 and class_lm.score_texts(odd, empty).count() == 10


def test_probabilities_of_a_class_add_up(spark, odd):
    model = class_lm.learn(odd, core_words=50, classes=6)
    assert (10.0 ** model.steps).sum(1) == pytest.approx(np.ones(len(model.steps)))
    assert model.class_tokens.sum() == model.tokens and model.class_words.sum() == model.distinct


def test_exchange_only_raises_the_likelihood():
    rng = np.random.default_rng(2)
    pairs = np.zeros((12, 12))
    line = np.array([rng.integers(0, 6) + 6 * (i % 2) for i in range(4000)])
    np.add.at(pairs, (line[:-1], line[1:]), 1)

    def likelihood(of):
        m = np.eye(2)[of]
        g = m.T @ pairs @ m
        f = lambda x: float((x * np.log(np.maximum(x, 1e-300))).sum())
        return f(g) - f(g.sum(0)) - f(g.sum(1))

    of = class_lm.exchange(pairs, 2)
    assert len(set(of[:6])) == len(set(of[6:])) == 1 and of[0] != of[6]
    assert likelihood(of) >= max(likelihood(rng.integers(0, 2, 12)) for _ in range(50))


# Near-duplicates

def brute_components(texts, width, percent):
    sets = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        n = min(width, len(w))
        sets[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set()
    label = {i: i for i in sets}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    return sets, label


def test_components_are_those_of_all_pairs(spark, odd, none):
    rng = random.Random(5)
    texts = []
    for g in range(12):
        words = prose(1000 + g, 150).split()
        for _ in range(rng.choice([1, 2, 9])):
            own = list(words)
            for _ in range(rng.choice([0, 1, 3, 6, 9])):
                own[rng.randrange(len(own))] = rng.choice(WORDS)
            texts.append((len(texts) + 10, " ".join(own)))
    texts += [(900, None), (901, ""), (902, "a b"), (903, "A  b")]
    docs = spark.createDataFrame([(i, t, "", 0, "") for i, t in texts], DOCS)
    for width in (4, 5):
        sets, label = brute_components(texts, width, 80)
        got = by_id(setsketch.near_duplicates(docs, width=width))
        assert {i: r["component_id"] for i, r in got.items()} == label
        assert all(r["n_shingles"] == len(sets[i]) and r["kept"] == (label[i] == i)
                   for i, r in got.items())
    strange = setsketch.near_duplicates(odd).collect()
    assert len(strange) == 10
    assert {r["id"]: r["component_id"] for r in strange} == {
        1: 1, 2: 2, 3: 3, 4: 4, None: None, 5: 5, 6: 6, 7: 7, 8: 1}
    assert setsketch.near_duplicates(none).count() == 0
    assert sorted(r["doc_id"] or 0 for r in setsketch.keep_one(odd).collect()) == [
        0, 1, 2, 3, 4, 5, 6, 7]


def test_rows_of_one_id_are_one_node(spark):
    rows = [(5, prose(1), "", 0, ""), (5, prose(2), "", 0, ""), (3, prose(2), "", 0, "")]
    got = setsketch.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert {(r["id"], r["component_id"], r["kept"]) for r in got} == {(5, 3, False), (3, 3, True)}


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 900).astype(np.uint64)
    one, two, both = setsketch.sketch([a[:600], a[300:], a])
    assert (np.maximum(one, two) == both).all()
    assert abs((one == two).mean() - 1 / 3) < 0.12
    near = setsketch.sketch([a, np.concatenate([a[:850], a[:1] + np.uint64(9)])])
    sizes = np.array([900.0]), np.array([851.0])
    assert setsketch.likely(near[:1], near[1:], *sizes, 0.8)[0] > 0
    sizes = np.array([600.0]), np.array([600.0])
    assert setsketch.likely(one[None], two[None], *sizes, 0.2)[0] > 0
    assert setsketch.likely(one[None], two[None], *sizes, 0.6)[0] < 0


# Mixing, archive, tokens

def test_mix_reaches_targets_with_whole_documents(spark, odd, none):
    rows = [(i, prose(i, 20), "abcd"[min(3, i % 13)], 0, "") for i in range(2000)]
    docs = spark.createDataFrame(rows, DOCS)
    plan = mixing.mix_plan(docs).collect()
    for source in "abcd":
        own = [r for r in plan if r["source"] == source]
        taken = sum(r["size"] * r["copies"] for r in own)
        assert abs(taken - own[0]["target"]) < 0.15 * own[0]["target"]
        assert own[0]["target"] <= 3 * own[0]["source_size"] + 1e-6
        assert all(r["copies"] in (math.floor(r["rate"]), math.floor(r["rate"]) + 1) for r in own)
    assert sum({r["source"]: r["target"] for r in plan}.values()) == pytest.approx(40_000)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["copies"] for r in plan)
    strange = mixing.mix_plan(odd).collect()
    assert len(strange) == 10 and all(r["copies"] * r["size"] <= 3 * r["size"] for r in strange)
    assert mixing.mix_plan(none).count() == 0 and mixing.mix(none).count() == 0


def test_archive_gives_back_every_record(spark, tmp_path):
    rows = [(3, "http://x/\r\nWARC-Type: fake", "<p>é</p>", 0), (1, None, "<p>é</p>", 0),
            (1, None, "<p>é</p>", 0), (2, "u", None, 0), (4, "u", "", 0), (None, "n", "<p>é</p>", 0)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, payload int")
    warc.write_archive(pages, str(tmp_path / "a"))
    got = warc.read_archive(spark, str(tmp_path / "a")).collect()
    assert spark.read.parquet(str(tmp_path / "a" / "payloads")).count() == 2
    said = sorted((r["page_id"] or 99, r["record_type"], r["refers_to"] or 0) for r in got)
    assert said == [(1, "response", 0), (1, "revisit", 1), (2, "response", 0), (3, "revisit", 1),
                    (4, "revisit", 2), (99, "revisit", 1)]
    names = [x for r in got for x in bytes(r["record"]).split(b"\r\n") if x.startswith(b"WARC-Record-ID")]
    assert len(set(names)) == len(names)
    for r in got:
        record = bytes(r["record"])
        head, _, block = record.partition(b"\r\n\r\n")
        length = int(dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])[b"Content-Length"])
        assert block[:length] + b"\r\n\r\n" == block
        if r["record_type"] == "response":
            assert block[:length].partition(b"\r\n\r\n")[2] == bytes(r["payload"])
        import base64
        assert r["payload_digest"] == base64.b32encode(
            hashlib.sha1(bytes(r["payload"])).digest()).decode()
    warc.write_archive(pages.where("page_id > 99"), str(tmp_path / "b"))
    assert warc.read_archive(spark, str(tmp_path / "b")).count() == 0


def test_tokens_are_those_of_the_library(spark, odd, none):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_vocabulary())
    extra = ["<|startoftext|>Hi<|endoftext|>", "x" * 3000, "ab" * 700 + "'ll", "a\x1cb\x85c",
             "İstanbul ΣΑΣ ﬁ don't I'LL 4½", "<|STARTOFTEXT|>", "　x"]
    docs = odd.unionByName(spark.createDataFrame([(50 + i, t, "", 0, "") for i, t in enumerate(extra)],
                                                 DOCS))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in bpe.decode(bpe.encode(docs)).collect():
        ids = library.encode(texts[r["id"]], add_special_tokens=False).ids
        assert np.frombuffer(bytes(r["token_ids"]), "<u4").tolist() == ids
        assert r["n_tokens"] == len(ids)
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False)
    both = [bpe.round_trip(docs), bpe.decode(bpe.encode(docs))]
    assert both[0].exceptAll(both[1]).count() == both[1].exceptAll(both[0]).count() == 0
    assert bpe.decode(bpe.encode(none)).count() == bpe.round_trip(none).count() == 0


def test_the_heap_merges_like_the_array():
    coder = bpe.WordEndBpe.from_file(bpe.default_vocabulary())
    rng = random.Random(1)
    for _ in range(200):
        piece = "".join(rng.choice("abcdehinorst") for _ in range(rng.randrange(1, 60)))
        assert coder.merge_long(coder._symbols(piece)) == coder.merge(piece)


def test_length_answers_are_those_of_all_lengths(spark, none):
    rng = random.Random(2)
    lengths = [rng.choice([0, 1, 7, 4095, 4096, 9000, rng.randrange(20_000)]) for _ in range(300)]
    counts = spark.createDataFrame(list(Counter(lengths).items()), "length bigint, n_docs bigint")
    for r in token_lengths.suffix_sums(counts).collect():
        at = r["length"]
        assert r["n_docs"] == lengths.count(at) and r["tokens"] == sum(lengths)
        assert r["docs_longer"] == sum(x > at for x in lengths)
        assert r["tokens_longer"] == sum(x for x in lengths if x > at)
        assert r["truncated_tokens"] == sum(min(x, at) for x in lengths)
        assert r["share"] == pytest.approx(sum(x <= at for x in lengths) / 300)
    limits = [0, 5, 4096, 10**6]
    for r in token_lengths.answer_limits(counts, limits).collect():
        assert r["truncated_tokens"] == sum(min(x, r["limit"]) for x in lengths)
        assert r["docs_longer"] == sum(x > r["limit"] for x in lengths)
    ordered = sorted(lengths)
    for r in token_lengths.quantiles(counts, [0.1, 0.5, 1.0]).collect():
        assert r["length"] == ordered[math.ceil(r["share"] * 300) - 1]
    nothing = token_lengths.length_counts(none)
    assert token_lengths.suffix_sums(nothing).count() == 0
    assert token_lengths.answer_limits(nothing, [5]).first()["tokens"] == 0


# Licences, toxicity

def test_templates_accept_exactly_their_wording():
    scanner = license_scan.Scanner({"t": ["a [[b [[c]]]] {{x:2}} d"]}, {})
    accepts = lambda text: [(a, b) for a, b, _ in scanner.scan(text.encode())[2]]
    assert accepts("a d") == [(0, 2)] and accepts("A, b: d!") == [(0, 3)]
    assert accepts("a b c q r d") == [(0, 6)] and accepts("a b c") == []
    assert accepts("a q r s d") == [] and accepts("x a z d a d") == [(1, 4), (4, 6)]
    for wrong in ("[[a]]", "a [[b", "a ]] b"):
        with pytest.raises(ValueError):
            license_scan.compile_template("t", wrong)


def test_licences_of_documents(spark, none):
    rows = [(1, "x Released under the MIT License. cc by-nc", "", 0, ""),
            (2, "Licensed under the GNU General Public License, version 3", "", 0, ""),
            (3, None, "", 0, ""), (4, "mit license under", "", 0, ""),
            (5, "Apache License, Version 2 under the MIT license under the mit license", "", 0, "")]
    got = by_id(license_scan.scan_licenses(spark.createDataFrame(rows, DOCS)))
    base = {i: [(p["start"], p["label"]) for p in r["base_places"]] for i, r in got.items()}
    assert base == {1: [(2, "mit"), (6, "cc-by-nc")], 2: [], 3: [], 4: [],
                    5: [(0, "apache-2"), (4, "mit"), (8, "mit")]}
    assert {p["label"] for p in got[2]["template_places"]} == {"gpl"}
    assert got[3]["score"] == got[4]["score"] == 0.0 and got[2]["score"] == 1.0
    assert license_scan.scan_licenses(none).count() == 0


def test_toxic_words_are_learned_and_found(spark, odd, none):
    rng = random.Random(7)

    def text(i, toxic):
        words = prose(5000 + i, 120).split()
        for _ in range(6 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["blorgheads", "snarkweasel", "gruntfool"]))
        return " ".join(words)

    docs = spark.createDataFrame([(i, text(i, i % 4 == 0), "", 0, "") for i in range(600)], DOCS)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(600)] + [(1, 1), (None, 1)],
                                   "doc_id bigint, toxic int")
    learns = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
    model = toxicity.train(docs, labels, usable=learns)
    held = [r for r in toxicity.score_toxicity(docs, model).collect()
            if zlib.crc32(str(r["id"]).encode()) % 4 == 2]
    right = sum(r["predicted"] == (r["id"] % 4 == 0) for r in held)
    assert right / len(held) >= 0.95 and all(0 <= r["score"] <= 1 for r in held)
    assert toxicity.drop_toxic(docs, model).columns == docs.columns
    assert toxicity.score_toxicity(odd, model).count() == 10
    assert toxicity.score_toxicity(none, model).count() == 0
    assert not toxicity.train(docs, labels.where("toxic = 0")).trained
    assert toxicity.score_toxicity(odd, toxicity.ToxicityModel()).agg(F.max("score")).first()[0] == 0


# Every word clustered for itself

def test_all_words_are_clustered_not_only_the_core(spark):
    """Rare words of equal ending take turns: two words a class, though none is in the core."""
    rng = random.Random(11)
    left, right = [f"l{i}zz" for i in range(40)], [f"r{i}zz" for i in range(40)]
    rows = [(i, " ".join(rng.choice(left) + " " + rng.choice(right) for _ in range(60)), "", 0, "")
            for i in range(60)]
    docs = spark.createDataFrame(rows, DOCS)
    model = class_lm.learn(docs, core_words=2, classes=3)
    of = {bytes(r["word"] or b"").decode(): r["cls"] for r in model.counts.collect()}
    assert len({of[w] for w in left}) == len({of[w] for w in right}) == 1
    assert of[left[0]] != of[right[0]]

    # No single word may still gain, and scores are those of the model word by word.
    docs_words = [[*t.split(), ""] for _, t, *_ in rows]
    line = ["", *[w for ws in docs_words for w in ws]]
    count = Counter(line[1:])

    def fit(of):
        g = np.zeros((3, 3))
        np.add.at(g, ([of[w] for w in line[:-1]], [of[w] for w in line[1:]]), 1)
        return class_lm.likelihood(g)

    reached = fit(of)
    assert all(fit({**of, w: c}) <= reached + 1e-3 for w in of for c in range(3))
    got = by_id(class_lm.score_texts(docs, model))
    size = model.class_tokens + model.smoothing * (model.class_words + 1)
    for i, ws in enumerate(docs_words):
        want = sum(model.steps[of[a], of[b]] + math.log10((count[b] + model.smoothing) / size[of[b]])
                   for a, b in zip(["", *ws], ws, strict=False))
        assert got[i]["score"] == pytest.approx(want)


def test_rare_words_are_scored_like_frequent_ones(spark, odd, monkeypatch):
    """Counts and classes that come by joins give the scores that the broadcast gives."""
    whole = class_lm.learn(odd, core_words=20, classes=4)
    asked = odd.unionByName(spark.createDataFrame([(70, "new " + prose(1) + " w3 newer", "", 0, "")],
                                                  DOCS))
    want = sorted(r["score"] for r in class_lm.score_texts(asked, whole).collect())
    whole.rare = whole.counts.where("word is not null")
    whole.frequent, whole.frequent_counts = whole.frequent[:5], whole.frequent_counts[:5]
    whole.frequent_classes = whole.frequent_classes[:5]
    got = sorted(r["score"] for r in class_lm.score_texts(asked, whole).collect())
    assert got == pytest.approx(want)


def test_gains_are_exact():
    rng = np.random.default_rng(4)
    words, k = 15, 4
    line = np.r_[0, rng.integers(0, words, 300), 0]
    n = np.zeros((words, words))
    np.add.at(n, (line[:-1], line[1:]), 1)
    of = rng.integers(0, k, words)
    member = np.eye(k)[of]
    near = np.hstack([n @ member, n.T @ member])
    who, at = np.nonzero(near)
    first = np.searchsorted(who, np.arange(words))
    gain = class_lm.gains(member.T @ n @ member, at, near[who, at], first, of, np.diag(n))
    start = class_lm.likelihood(member.T @ n @ member)
    for w in range(words):
        for c in range(k):
            other = np.eye(k)[np.r_[of[:w], c, of[w + 1:]]]
            assert gain[w, c] == pytest.approx(class_lm.likelihood(other.T @ n @ other) - start)


# Queries in blocks

def test_a_search_task_holds_one_block_of_queries(spark):
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(400, 8)))],
                               "vec_id bigint, embedding array<double>")
    assert graph_search.block_count(5_000_000) == 100
    index = graph_search.build_index(df, shards=2)
    whole = graph_search.search_index(index, df, 2)
    cut = graph_search.search_index(index, df, 2, blocks=7)
    assert whole.exceptAll(cut).count() == cut.exceptAll(whole).count() == 0
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(shard" in plan and "block" in plan.split("FlatMapCoGroups")[1]


# Samples of repeated ids

def test_samples_are_bounded_in_rows_not_only_in_ids(spark):
    docs = spark.createDataFrame(
        [(i, f"{prose(i, 10)}.\n{prose(i + 50, 10)}.", "", 0, "") for i in range(8)]
        + [(k, f"{prose(k, 10)}.\n{prose(900 + i, 10)}.", "", 0, "") for k in (0, 1)
           for i in range(300)], DOCS)
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(8)],
                                   "doc_id bigint, quality int, toxic int")
    got, share = toxicity._sample(docs, labels, "doc_id", "text", "toxic", None, 50)
    assert len(got) == 8 and share == 0.5
    least = min(bytes(r["text"], "utf8") for r in docs.where("doc_id = 0").collect())
    assert (0, least) in got
    lines = quality_lines._sample(docs, labels, "doc_id", "text", "quality", 0, 50)
    assert len(lines) == 8
    again = quality_lines._sample(docs.repartition(7), labels, "doc_id", "text", "quality", 0, 50)
    assert all((a[1] == b[1]).all() and a[0] == b[0] for a, b in zip(lines, again, strict=True))


def test_the_toxicity_sample_is_bounded_in_bytes(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "word " * (20 + i), "", 0, "") for i in range(40)], DOCS)
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)],
                                   "doc_id bigint, quality int, toxic int")
    args = docs, labels, "doc_id", "text", "toxic", None, 50
    whole, share = toxicity._sample(*args)
    assert len(whole) == 40
    monkeypatch.setattr(toxicity, "SAMPLE_TOTAL", 1000)
    cut, same = toxicity._sample(*args)
    assert same == share and 0 < len(cut) < 20
    for label in (0, 1):
        mine = [t for k, t in cut if k == label]
        assert sum(map(len, mine)) <= 1000
        # The first of the label in the order of the hash.
        assert mine == [t for k, t in whole if k == label][:len(mine)]


def test_words_count_once_for_each_new_pair_of_neighbours():
    rng = np.random.default_rng(4)
    texts = [b" ".join(rng.choice([b"a", b"B", b"b", b"cc", b"\xff"], rng.integers(0, 9)))
             for _ in range(300)] + [b"", b" \n "]
    for some in (texts, texts[:1], [], [b""], [b"a"]):
        seen, want = set(), {}
        for text in some:
            w = [b"", *text.lower().split(), b""]
            new = {w[i - 1:i + 2].__str__(): w[i] for i in range(1, len(w) - 1)}
            for word in {x for k, x in new.items() if k not in seen}:
                want[word] = want.get(word, 0) + 1
            seen |= set(new)
        assert dict(toxicity._document_counts(some)) == want


# The address of the Apache licence

def test_the_apache_notice_is_found_with_either_address(spark):
    text = ("You may not use this file except in compliance with the License. You may obtain "
            "a copy of the License at {}://www.apache.org/licenses/LICENSE-2.0")
    rows = [(i, text.format(x), "", 0, "") for i, x in enumerate(("http", "https"))]
    got = license_scan.scan_licenses(spark.createDataFrame(rows, DOCS)).collect()
    assert [[p["label"] for p in r["template_places"]] for r in got] == [["apache-2"]] * 2
    assert [r["score"] for r in got] == [1.0, 1.0]
