import itertools
import math
import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from beadloom.llm import crf, language, quality, toxicity, words


def brute_marginals(scores, transition):
    n, k = scores.shape
    out = np.zeros((n, k))
    for y in itertools.product(range(k), repeat=n):
        w = np.exp(transition[:, y[0]]).sum() * np.exp(sum(scores[i, y[i]] for i in range(n)) + sum(transition[y[i - 1], y[i]] for i in range(1, n)))
        for i in range(n):
            out[i, y[i]] += w
    return out / out.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("block", [1, 2, 3, 64])
def test_marginals_against_brute_force(block):
    rng = np.random.default_rng(0)
    lengths = np.array([1, 5, 3, 7, 2])
    scores, transition = 2 * rng.normal(size=(lengths.sum(), 3)), rng.normal(size=(3, 3))
    expected = np.concatenate([brute_marginals(scores[e - n : e], transition) for e, n in zip(np.cumsum(lengths), lengths)])
    assert np.allclose(crf.marginals(scores, lengths, transition, block), expected)


@pytest.mark.parametrize("block", [1, 2, 64])
def test_gradient_by_differences(block):
    rng = np.random.default_rng(1)
    lengths, gold = np.array([3, 4]), rng.integers(0, 2, 7)
    scores, transition = rng.normal(size=(7, 2)), rng.normal(size=(2, 2))

    def loss(s, t):
        total = 0
        for e, n in zip(np.cumsum(lengths), lengths):
            z = {y: np.log(np.exp(t[:, y[0]]).sum()) + sum(s[e - n + i, y[i]] for i in range(n)) + sum(t[y[i - 1], y[i]] for i in range(1, n)) for y in itertools.product(range(2), repeat=n)}
            total += np.logaddexp.reduce(list(z.values())) - z[tuple(gold[e - n : e])]
        return total

    g_s, g_t = crf._gradient(scores, gold, lengths, transition, block)
    for grad, which in ((g_s, 0), (g_t, 1)):
        for at in np.ndindex(grad.shape):
            d = [np.zeros_like(scores), np.zeros_like(transition)]
            d[which][at] = 1e-5
            assert abs((loss(scores + d[0], transition + d[1]) - loss(scores - d[0], transition - d[1])) / 2e-5 - grad[at]) < 1e-6


def test_word_hashes_and_runs():
    texts = ["It's 12 cafés, no?!", "", "a\tb\n“c” 中文"]
    data, begin = words.joined([t.encode() for t in texts])
    raw = data.tobytes()
    got = [raw[s:e].decode() for s, e in zip(*words.class_runs(data))]
    assert got == ["It's", "12", "cafés", ",", "no", "?!", "a", "b", "“c”", "中文"]
    got = [raw[s:e].decode() for s, e in zip(*words.letter_runs(data))]
    assert got == ["It", "s", "cafés", "no", "a", "b", "c", "中文"]
    h = words.hashes(data, *words.letter_runs(data))
    assert len(set(h.tolist())) == 8 and begin.tolist() == [0, *np.cumsum([len(t.encode()) + 1 for t in texts]).tolist()]
    index = words.Index(4)
    many = words.mix(np.arange(1, 5000, dtype=np.uint64))
    index.add(many)
    assert index.find(many).tolist() == list(range(4999)) and index.find(words.mix(np.array([10**6], np.uint64))).tolist() == [-1]


LANGS = {"aa": ["bado", "lumi", "tesk", "grom", "pilda"], "bb": ["quiex", "zhann", "ooliv", "yyrth", "wexo"]}


def sentences(rng, lang, n):
    return " ".join(rng.choice(LANGS[lang]) + rng.choice(["", "s", "en"]) for _ in range(n))


def test_language_of_words_and_documents(spark):
    rng = random.Random(1)
    model = language.train([(sentences(rng, g, 40), g) for g in LANGS for _ in range(60)])
    docs = [(k, sentences(rng, g, 30), g) for k, g in enumerate(["aa", "bb"] * 10)]
    odd = [(100, None, None), (101, "", "aa"), (102, "12 %% 3", "aa"), (103, sentences(rng, "aa", 30_000), "aa"), (None, sentences(rng, "bb", 5), "bb")]
    df = spark.createDataFrame([(*d, 1.0) for d in docs + odd], "doc_id bigint, text string, lang string, score double")
    got = {r["doc_id"]: r for r in language.predict(df, model).collect()}
    assert all(got[k]["lang_pred"] == g for k, _, g in docs)
    assert [got[k]["lang_pred"] for k in (100, 101, 102, 103, None)] == ["und", "und", "und", "aa", "bb"]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert language.predict(df.limit(0), model).count() == 0
    assert {r["lang_pred"] for r in language.predict(df, None).collect()} == {"und"}
    switched = sentences(rng, "aa", 8) + " " + sentences(rng, "bb", 8)
    tags = language.tag_words(spark.createDataFrame([(1, switched)], ["doc_id", "text"]), model).first()["tags"]
    assert [t["lang"] for t in tags] == ["aa"] * 8 + ["bb"] * 8


def test_long_runs_are_read_whole(spark):
    rng = random.Random(5)
    model = language.train([(sentences(rng, g, 40), g) for g in LANGS for _ in range(60)] + [("bado" * 6, "aa"), ("quiex" * 6, "bb")])
    inner = "".join(rng.choice(LANGS["bb"]) for _ in range(200))
    texts = ["badolumitesk" + inner + "grombado", "badolumitesk" + "lumi" * 200 + "grombado"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert [r["lang_pred"] for r in language.predict(df, model).orderBy("doc_id").collect()] == ["bb", "aa"]
    word = texts[0]
    got, parts = list(language.long_features(word)), list(language.long_features(word, 7))
    assert sorted(np.concatenate(got)) == sorted(np.concatenate(parts)) and sum(map(len, got)) == 2 * len(word) - 3 + 1


def test_more_features_than_slots():
    rng = np.random.default_rng(6)
    ones, weights, rows = rng.integers(0, 9, (4, 12)), rng.normal(size=(9, 2)), np.array([2, 0, 2, 3])
    whole, split = crf.Sparse(ones, 9), crf.Sparse(np.hstack([ones[:, :5], np.full((4, 0), 9)]), 9, {k: ones[k, 5:] for k in range(4)})
    assert np.allclose(whole.scores(weights, rows), split.scores(weights, rows))
    g = rng.normal(size=(4, 2))
    assert np.allclose(whole.gradient(rows, g), split.gradient(rows, g))


def test_held_out_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.op1_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id")
    assert got.count() == docs.count()
    held = got.filter("held_out")
    assert held.filter("lang = lang_pred").count() >= 0.98 * held.count()
    assert held.filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1).count() == 0


def test_held_out_quality(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality.op5_quality_classifier(spark, "/root/testdata/sf0.01")
    assert got.count() == 1000
    held = got.filter("held_out").join(labels, "doc_id")
    assert held.filter("predicted = quality").count() >= 0.95 * held.count()


def test_quality_edges(spark):
    good = [(" ".join(f"word{k % 7}{c}" for c in "abcdef") + ".\n" + "another line of plain words here", 1) for k in range(40)]
    bad = [("\n".join("| ".join(f"w{k}{c}" for c in "abcdef") for _ in range(3)), 0) for k in range(40)]
    model = quality.train(good + bad)
    df = spark.createDataFrame([(1, good[0][0], 9), (2, bad[0][0], 9), (3, None, 9), (4, " \n ", 9), (5, good[1][0] + "\n" + "x " * 200_000, 9)], "doc_id bigint, text string, lines int")
    got = {r["doc_id"]: r for r in quality.predict(df, model).collect()}
    assert got[1]["score"] > 0.5 > got[2]["score"] and got[3]["score"] == got[4]["score"] == 0 and got[1]["lines"] == 2
    assert {r["doc_id"] for r in quality.kept(df, model).filter("doc_id < 5").collect()} == {1}
    assert quality.train(good) is None and quality.predict(df.limit(0), model).count() == 0
    assert {r["score"] for r in quality.predict(df, None).collect()} == {0.0, 0.5}


def test_a_bad_block_within_a_good_document(spark):
    """Real lines: blocks of lines of bad documents set into good ones, and the other way round, none of them trained on."""
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").orderBy("doc_id").select("text", "quality").collect()
    lines = [[line for line in r["text"].split("\n") if len(line) > 60] for r in docs]
    good, bad = ([x for x, r in zip(lines, docs) if r["quality"] == q and len(x) >= 4] for q in (1, 0))
    model = quality.train([(r["text"], r["quality"]) for k, r in enumerate(docs) if k % 4])
    held_good, held_bad = ([x for x, (k, r) in zip(lines, enumerate(docs)) if k % 4 == 0 and r["quality"] == q and len(x) >= 4] for q in (1, 0))
    rng = random.Random(19)
    texts, gold = [], []
    for _ in range(60):
        for outer, inner, label in ((held_good, held_bad, 0), (held_bad, held_good, 1)):
            a, b = rng.choice(outer)[:8], rng.choice(inner)[-3:]
            at = rng.randint(1, len(a) - 1)
            texts.append("\n".join([*a[:at], *b, *a[at:]]))
            gold.append([1 - label] * at + [label] * len(b) + [1 - label] * (len(a) - at))
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate([*texts, None, " \n"])], "doc_id bigint, text string, lines string")
    got = {r["doc_id"]: r["lines"] for r in quality.label_lines(df, model).collect()}
    assert got[len(texts)] == got[len(texts) + 1] == []
    right = [[(x["good"] >= 0.5) == bool(y) for x, y in zip(got[k], own, strict=True)] for k, own in enumerate(gold)]
    assert "\n".join(x["line"] for x in got[0]) == texts[0]
    for k in (0, 1):
        assert np.mean([x for own in right[k::2] for x in own]) > 0.9
    both = [{x["good"] >= 0.5 for x in got[k]} == {True, False} for k in range(len(texts))]
    assert np.mean(both) > 0.9 and len(good) and len(bad)


def brute_quality(model, text):
    """Marginals by summing over all labellings, then the length-weighted mean and the curve."""
    features, size, counts = quality.line_features([text])
    if not len(features):
        return 0.0
    scores = quality._x(features, model.mean, model.scale) @ model.weights
    p = brute_marginals(scores, model.transition)[:, 1]
    return 1 / (1 + np.exp(-(model.slope * (p * size).sum() / size.sum() + model.shift)))


def test_quality_scores_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = [r for r in docs.collect()]
    model = quality.train([(r["text"], labels[r["doc_id"]]) for r in rows if r["doc_id"] in labels])
    some = [r for r in rows if r["text"] and r["text"].count("\n") < 9][:150]
    got = {r["doc_id"]: r["score"] for r in quality.predict(docs.filter(F.col("doc_id").isin([r["doc_id"] for r in some])), model).collect()}
    assert all(abs(got[r["doc_id"]] - brute_quality(model, r["text"])) < 1e-9 for r in some)


def test_language_scores_against_brute_force(spark):
    """Marginals of short texts by summing over all labellings, weighted by the words' bytes."""
    rng = random.Random(20)
    model = language.train([(sentences(rng, g, 40), g) for g in LANGS for _ in range(40)])
    texts = [sentences(rng, rng.choice(list(LANGS)), rng.randint(1, 4)) + " " + sentences(rng, rng.choice(list(LANGS)), rng.randint(1, 4)) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(df, model).collect()}
    table = np.vstack([model.weights, np.zeros(2)])
    for k, t in enumerate(texts):
        found = t.split()
        p = brute_marginals(table[language.word_features(found, model.lexicon, 2)].sum(axis=1), model.transition)
        total = p.T @ np.array([len(w) for w in found])
        assert got[k][0] == model.langs[total.argmax()] and abs(got[k][1] - total.max() / total.sum()) < 1e-5


def test_held_out_toxicity(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = toxicity.op3_toxicity(spark, "/root/testdata/sf0.1")
    held = got.filter("held_out").join(labels, "doc_id")
    assert got.count() == 10_000
    assert held.filter("predicted = toxic").count() >= 0.96 * held.count()
    assert held.filter("toxic = 0 AND predicted = 1").count() <= 0.02 * held.count()


def test_toxicity_edges(spark):
    rng = random.Random(2)
    base = [f"w{chr(97 + k)}{c}" for k in range(20) for c in "xyz"]
    clean = [" ".join(rng.choice(base) for _ in range(40)) for _ in range(300)]
    toxic = [c + " vilewort" + rng.choice(["", "s", "ing"]) for c in clean[:40]]
    model = toxicity.train(toxic[:30], clean[40:] + toxic[:30], 0.1)
    df = spark.createDataFrame([(1, toxic[35]), (2, clean[60]), (3, None), (4, ""), (5, clean[61] + " " + " ".join(base * 3000) + " VILEWORTing")], "doc_id bigint, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.predict(df, model).collect()}
    assert got[1] >= 0.3 and got[5] >= 0.3 and max(got[2], got[3], got[4]) < 0.3 and got[3] == got[4]
    assert toxicity.train([], clean, 0.1) is None and toxicity.predict(df.limit(0), model).count() == 0
    assert {r["score"] for r in toxicity.predict(df, None).collect()} == {0.0}


def test_toxicity_from_ten_labels():
    rng = random.Random(4)
    base = [f"w{chr(97 + k)}{c}" for k in range(20) for c in "xyz"]
    clean = [" ".join(rng.choice(base) for _ in range(12)) for _ in range(150)]
    toxic = [c + (" vilewort" if k % 2 else " foulwort") for k, c in enumerate(clean[:10])]
    model = toxicity.train(toxic, clean[10:] + toxic, 0.1)
    found = toxicity.scores(model, ["a fine day", "such vilewort", "such foulwort", *base])
    assert found[0] < toxicity.THRESHOLD <= min(found[1:3]) and sum(found[3:] >= toxicity.THRESHOLD) <= 2
    hits = [math.comb(9, k) * 0.03**k * 0.97 ** (9 - k) for k in range(10)]
    for k in range(1, 10):
        if k / 9 > 0.03:
            surprise = 9 * 0.03 * ((k / 9 / 0.03) * math.log(k / 9 / 0.03) - k / 9 / 0.03 + 1)
            d = toxicity.chance(np.array([0.03]), 9, surprise)[0]
            assert abs(d + 0.03 - k / 9) < 1e-6 and sum(hits[k:]) <= 1.000001 * math.exp(-surprise)


def test_features_of_texts():
    texts = ["Réeuxment né né", "", "idiots scum 12 ab"]
    text, h, kind = toxicity.text_features(texts)
    expected = [(0, "réeuxment", 0), *((0, "réeuxment"[:n], n) for n in range(3, 9)), (0, "né", 0), (2, "idiots", 0), *((2, "idiots"[:n], n) for n in range(3, 7)), (2, "scum", 0), (2, "scu", 3), (2, "scum", 4), (2, "ab", 0)]
    assert sorted(zip(text.tolist(), kind.tolist())) == sorted((k, n) for k, _, n in expected) and len(set(h.tolist())) == len(h)
    again = toxicity.text_features(["ab né idiotic scummy"])[1]
    assert len(set(again.tolist()) & set(h.tolist())) == 2 + 3 + 2  # ab, né; idi, idio, idiot; scu, scum


def test_scores_against_plain_sums(spark):
    rng = random.Random(18)
    vocabulary = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 11))) for _ in range(200)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    model = toxicity.train([t + " vile vilest" for t in texts[:40]], texts, 0.2)

    def plain(text):
        own = {(0, w) for w in text.split()} | {(n, w[:n]) for w in text.split() for n in range(3, 9) if len(w) >= n}
        h = {int(x) for k, w in own for x, n in zip(*toxicity.text_features([w])[1:]) if n == k}
        return 1 / (1 + math.exp(-model.bias - sum(w for f, w in zip(model.features.tolist(), model.weights.tolist()) if f in h)))

    df = spark.createDataFrame([(k, t, 0.5) for k, t in enumerate([*texts, "vile", None])], "doc_id bigint, text string, score double")
    got = {r["doc_id"]: r["score"] for r in toxicity.predict(df, model).collect()}
    assert all(abs(got[k] - plain(t)) < 1e-9 for k, t in enumerate([*texts, "vile", ""])) and len(model.features) > 0


def test_class_prior_is_estimated():
    rng = np.random.default_rng(5)
    for prior in (0.05, 0.3):
        s_p = rng.normal(3, 1, 400)
        s_u = np.where(rng.random(4000) < prior, rng.normal(3, 1, 4000), rng.normal(0, 1, 4000))
        assert abs(toxicity.prior_of(s_p, s_u) - prior) < 0.35 * prior + 0.01  # the assumed prior has a say
    assert 0 < toxicity.prior_of(np.zeros(3), np.zeros(10)) <= 0.9


def test_toxicity_of_a_small_table(spark):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    got = toxicity.op3_toxicity(spark, "/root/testdata/sf0.001").join(labels, "doc_id")
    assert got.filter("toxic = 1 AND predicted = 1").count() >= 5
    assert got.filter("toxic = 0 AND predicted = 1").count() == 0


def test_risk_estimator_stays_non_negative():
    rng = np.random.default_rng(3)
    x_p = [np.array([0])] * 20 + [np.array([k]) for k in range(1, 10)]
    x_u = [np.array([0]) if rng.random() < 0.1 else np.array([], np.int64) for _ in range(400)]
    p, u = (toxicity.Columns(np.repeat(np.arange(len(x)), [len(r) for r in x]), np.concatenate(x).astype(int), len(x), 10) for x in (x_p, x_u))
    w, b = toxicity.nnpu(p, u, 0.1, np.full(10, 1e-3))
    assert w[0] > 1 and 1 / (1 + np.exp(-b)) < 0.1
    # its derivatives are those of the risk where the second part isn't negative, and raise that part where it is
    g_p, g_u = rng.normal(size=6), rng.normal(size=9)
    value, d_p, d_u = toxicity.risk(g_p, g_u, 0.2)
    for g, d, which in ((g_p, d_p, 0), (g_u, d_u, 1)):
        for k in range(len(g)):
            more = [g_p.copy(), g_u.copy()]
            more[which][k] += 1e-6
            assert abs((toxicity.risk(*more, 0.2)[0] - value) / 1e-6 - d[k]) < 1e-5
    value, d_p, d_u = toxicity.risk(np.full(6, 9.0), np.full(9, -9.0), 0.2)
    assert value < 1e-3 and (d_p > 0).all() and (d_u < 0).all()


def test_toxicity_sums_by_pieces_equal_whole_ones(monkeypatch):
    monkeypatch.setattr(toxicity, "PAIRS", 7)
    rng = np.random.default_rng(4)
    row, feature = np.sort(rng.integers(0, 20, 500)).astype(np.int32), rng.integers(0, 30, 500).astype(np.int32)
    w, g, c = rng.normal(size=31), rng.normal(size=21), toxicity.Columns(row, feature, 21, 31)
    assert (c.sums(w) == np.bincount(row, w[feature], 21)).all() and (c.gradient(g) == np.bincount(feature, g[row], 31)).all()
    assert (c.counts() == np.bincount(feature, minlength=31)).all()


def test_toxicity_training_takes_few_bytes_a_pair(monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 3)
    rng = random.Random(3)
    pool = ["".join(rng.choices("abcdefghij", k=8)) for _ in range(5000)]
    texts = [" ".join(rng.sample(pool, 1000)) for _ in range(600)]
    tracemalloc.start()
    try:
        assert toxicity.train(texts[:200], texts, 0.1).features.size
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 45 * sum(len(toxicity.text_features(part)[0]) for part in (texts[:200], texts))
