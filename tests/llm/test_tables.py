import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from beadloom.llm import line_dedup, media, mixing, packing, topk, url_filter


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


# --- packing ---


def test_encoder_equals_the_tokenizer():
    rng = random.Random(5)
    encoder = packing.Encoder(packing.default_tokenizer())
    plain = Tokenizer.from_file(packing.default_tokenizer())
    assert packing._tokenizer(packing.default_tokenizer()).encode_special_tokens is False
    alphabet = [chr(c) for c in (*range(1, 0x250), *range(0x300, 0x340), 0x3A3, 0x130, 0x2028, 0x3000, 0x200B, 0x1F600, 0x4E2D, 0x1100, 0x1161, 0xB2, 0xFB01)] + [" "] * 60 + list("'s't're<|endoftext|>..,,!-×–é")
    names = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", "<|", "|>"]
    texts = ["", " ", "It's the café's 12.5%!!", "J̌ À²", *names, "a<|endoftext|>b é", "x <|startoftext|><|endoftext|>\n", "<|EndOfText|> Σ"]
    texts += [" ".join(rng.choice([*names, "word", "é", "É.", "<", ">"]) for _ in range(6)) for _ in range(200)] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 50))) for _ in range(600)]
    for text, got in zip(texts, encoder.encode(texts)):
        assert got == np.asarray(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)
    assert 49407 in np.frombuffer(encoder.encode(["a <|endoftext|> b"])[0], "<u4")


def best_place(count, size, capacity):
    """All sums of squares tried out."""
    options = []
    for gap in range(size, capacity):
        if count[gap]:
            c = count.copy()
            c[gap] -= 1
            if gap > size:
                c[gap - size] += 1
            options.append((sum(v * v for v in c.values()), 0, gap))
    c = count.copy()
    if size < capacity:
        c[capacity - size] += 1
    options.append((sum(v * v for v in c.values()), 1, capacity))
    return min(options)


def test_sum_of_squares_against_trying_out():
    rng = random.Random(6)
    for capacity in (1, 7, 20):
        sizes = [rng.randint(1, capacity) for _ in range(120)]
        bins, offsets = packing.sum_of_squares(np.array(sizes), capacity)
        count, fill, used = Counter(), {}, 0
        for size, bin_, offset in zip(sizes, bins.tolist(), offsets.tolist()):
            _, _, gap = best_place(count, size, capacity)
            assert capacity - fill.get(bin_, 0) == gap and offset == fill.get(bin_, 0)
            if gap < capacity:
                count[gap] -= 1
            fill[bin_] = offset + size
            if fill[bin_] < capacity:
                count[capacity - fill[bin_]] += 1


def test_packed_pieces(spark):
    long = " ".join(f"word{k}" for k in range(30_000))
    df = spark.createDataFrame([(1, "Hello, world"), (2, None), (3, ""), (3, ""), (4, long), (None, "x")], "doc_id bigint, text string").withColumn("offset", F.lit("clash"))
    got = packing.packed_documents(df).collect()
    encoder = packing.Encoder(packing.default_tokenizer())
    whole = {k: np.append(encoder._whole(t), 0).astype("<u4") for k, t in ((1, "Hello, world"), (2, ""), (3, ""), (4, long), (None, "x"))}
    by_sequence = defaultdict(list)
    for r in got:
        assert r["ids_crc32"] == zlib.crc32(whole[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes()) and r["start"] == 2048 * r["piece"]
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(r["length"] for r in got) == sum(map(len, whole.values())) + 1
    assert packing.packed_documents(df.limit(0)).count() == 0
    ids = packing.tokenised_pieces(df.filter("doc_id = 1"), packing.default_tokenizer(), with_ids=True).first()["ids"]
    assert ids == whole[1].tobytes()
    clash = spark.createDataFrame([(k, 1 + k % 7, "a", "b", "c") for k in range(50)], ["doc_id", "length", "shard", "_shard", "_shard_"])
    placed = packing.pack(clash, 8, shard_rows=20)
    assert placed.columns == [*clash.columns, "sequence_id", "offset"] and placed.filter("shard = 'a' AND _shard = 'b' AND _shard_ = 'c'").count() == 50
    with pytest.raises(Exception, match="can be packed"):
        packing.pack(spark.createDataFrame([(1, None)], "k int, length bigint"), 8).collect()
    with pytest.raises(Exception, match="can be packed"):
        packing.pack(spark.createDataFrame([(1, 9)], ["k", "length"]), 8).collect()


def test_packing_is_tight(spark):
    got = packing.op7_best_fit_packing(spark, "/root/testdata/sf0.01")
    used, total = got.agg(F.countDistinct("sequence_id"), F.sum("length")).first()
    assert used <= math.ceil(total / 2048 * 1.02) + 1


# --- media ---


def test_media_against_a_plain_version(spark):
    texts = ["", None, "abc", "x" * 576, "é" * 300, "long " * 20_000, "abc"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("media", F.lit(1))
    got = media.digests(media.read_wav(media.store_wav(df))).orderBy("doc_id").collect()
    for r, text in zip(got, texts):
        raw = (text or "").encode()
        payload = raw + b"\xff" * (max(576, -(-len(raw) // 576) * 576) - len(raw))
        wav = media.to_wav(payload)
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest())
        assert (r["tail_crc32"], r["media_bytes"], r["media_sha256"]) == (zlib.crc32(payload[-32:]), len(wav), hashlib.sha256(wav).hexdigest())
        assert r["feature"].split("-")[0] == str(len(media.fingerprint(payload)))
    assert got[2]["feature"] == got[6]["feature"] and got[0]["feature"] == got[1]["feature"] != got[5]["feature"]
    assert media.store_wav(df.limit(0)).count() == 0


def test_peaks_against_a_plain_transform():
    rng = np.random.default_rng(7)
    samples = rng.integers(0, 256, 576 * 3).astype(np.uint8)
    found = media.peaks(samples)
    assert len(found) == 5
    for k, own in enumerate(found):
        frame = (samples[k * 288 : k * 288 + 576].astype(np.float32) - 128) * media._WINDOW
        mag = np.round(np.abs(np.fft.rfft(frame)) * 16).astype(int)
        top = sorted(((-mag[b], b) for b in range(1, len(mag) - 1) if mag[b] > mag[b - 1] and mag[b] >= mag[b + 1]))[:3]
        assert own.tolist() == [b for _, b in top]
    code = media.fingerprint(samples.tobytes())
    assert (np.diff(code) >= 0).all() and ((code & 255) <= media.AHEAD).all()


def plain_pairs(payload):
    """Peaks by a transform written out, and every pair of them within a frame or up to two frames on."""
    data = [255] * 288 + list(payload) + [255] * 288
    found = []
    for at in range(0, len(data) - 575, 288):
        frame = (np.array(data[at : at + 576], np.float32) - 128) * np.hanning(576).astype(np.float32)
        mag = np.round(np.abs(np.fft.rfft(frame)) * 16).astype(int).tolist()
        top = sorted((-m, b) for b, m in enumerate(mag) if 0 < b < len(mag) - 1 and m > mag[b - 1] and m >= mag[b + 1] and m > 0)
        found.append([b for _, b in top[:3]])
    out = []
    for f, own in enumerate(found):
        out += [f << 32 | a << 20 | b << 8 for a in own for b in own if a < b]
        for ahead in (1, 2):
            out += [f << 32 | a << 20 | b << 8 | ahead for a in own for b in (found[f + ahead] if f + ahead < len(found) else [])]
    return sorted(out)


def test_fingerprints_against_plain_pairs(spark):
    rng = random.Random(17)
    texts = ["", None, "abc", "A short text.", "é" * 400, "".join(rng.choice("abcde \n") for _ in range(3000)), "x" * 5000]
    df = spark.createDataFrame([(k, t, "p", "f") for k, t in enumerate(texts)], "doc_id bigint, text string, payload string, fingerprint string")
    stored = media.store_wav(df).withColumns({"payload": F.lit(1), "fingerprint": F.lit(2), "Media_": F.lit(3)})
    for r, text in zip(media.digests(media.read_wav(stored)).orderBy("doc_id").collect(), texts):
        raw = (text or "").encode()
        assert r["fingerprint"] == plain_pairs(raw + b"\xff" * (max(576, -(-len(raw) // 576) * 576) - len(raw)))
    assert media.read_wav(stored.limit(0)).count() == 0
    nulls = media.digests(media.read_wav(stored.limit(1).withColumn("media", F.lit(None).cast("binary")))).first()
    assert nulls["payload_sha256"] is None and nulls["fingerprint"] is None


def test_short_texts_have_fingerprints_of_their_own(spark):
    texts = ["", None, "A.", "This.", "That one.", "The last letter of a text of one whole frame counts. " * 11 + "end.", "A short text of one frame.", "A short text of one frame!", "long " * 200]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = [r["feature"] for r in media.digests(media.read_wav(media.store_wav(df))).orderBy("doc_id").collect()]
    assert got[0] == got[1] and len(set(got[1:])) == len(texts) - 1
    assert [k for k, f in enumerate(got) if f.startswith("0-")] == [0, 1]


# --- top-k ---


def test_top_k_against_all_pairs(spark):
    rng = random.Random(8)
    vectors = [(k, [rng.choice([-0.5, 0.0, 0.25, rng.uniform(-1, 1)]) for _ in range(6)]) for k in range(300)]
    vectors += [(300, None), (301, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (304, []), (305, [0.0] * 6), (306, [1.0, 2.0]), (307, [3.0, -2.0]), (None, [0.5] * 6)]
    df = spark.createDataFrame([(i, v, 1) for i, v in vectors], "vec_id bigint, embedding array<double>, rank int")
    fine = {i: [math.floor(256 * x) for x in v] for i, v in vectors if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    for shard, seeds in ((None, 0), (37, 0), (37, 20), (100, 150)):
        got = topk.top_k(df, df.filter("vec_id % 5 = 0 OR vec_id > 300"), 4, shard_rows=shard, seeds=seeds)
        expected = []
        for q in (i for i in fine if i % 5 == 0 or i > 300):
            near = sorted((-sum(a * b for a, b in zip(fine[q], v)), i) for i, v in fine.items() if i != q and len(v) == len(fine[q]))[:4]
            expected += [(q, k, i, -s) for k, (s, i) in enumerate(near, 1)]
        assert rows(got, "query_id", "rank", "vec_id", "score") == sorted(expected, key=str)
    assert topk.top_k(df.limit(0), df).count() == 0


def test_top_k_of_large_components(spark):
    """Exact beyond 2^53; held at the ends of a long beyond them; left out where 256 * x isn't finite."""
    rng = random.Random(16)
    vectors = [(k, [rng.choice([0.0, 1e6 + k, -3e7, 2.0**40, 1e17, -1e30, 1e30]) for _ in range(3)]) for k in range(60)]
    vectors += [(60, [1e307, 0.0, 0.0]), (61, [2.0**27 + 1, 1.0, 0.0]), (62, [2.0**27, 1.0, 0.0])]
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>")
    fine = {i: [math.floor(256 * x) for x in v] for i, v in vectors if i != 60}
    top = (1 << 63) - 1
    expected = []
    for q, own in fine.items():
        near = sorted((-min(max(sum(a * b for a, b in zip(own, v)), -top), top), i) for i, v in fine.items() if i != q)[:5]
        expected += [(q, k, i, -s) for k, (s, i) in enumerate(near, 1)]
    for shard, seeds in ((None, 0), (11, 20)):
        assert rows(topk.top_k(df, df, 5, shard_rows=shard, seeds=seeds), "query_id", "rank", "vec_id", "score") == sorted(expected, key=str)


def test_threshold_stops_early():
    rng = np.random.default_rng(9)
    vectors = rng.integers(-3, 4, (4000, 3))
    vectors[:5] = 200
    lists = topk.Lists(np.arange(4000), vectors)
    seen = []
    scores_of = lists._scores
    lists._scores = lambda at, query: seen.extend(at.tolist()) or scores_of(at, query)
    at, scores = lists.search(-1, np.array([1, 2, 3]), 5)
    assert at.tolist() == [0, 1, 2, 3, 4] and set(scores.tolist()) == {1200} and len(seen) < 400
    seen.clear()
    assert len(lists.search(-1, np.array([1, 1, 1]), 9, least=100)[0]) >= 5 and len(seen) < 400


# --- URL rules ---


def plain_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (not h or host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_url_rules(spark, monkeypatch):
    rng = random.Random(10)
    hosts = ["org", "example.org", "a.example.org", "xexample.org", "Example.ORG", "com", "b.com", "org.com", "net", ""]
    urls = [f"{rng.choice(['http', 'https', 'ftp'])}://{rng.choice(hosts)}{rng.choice(['', '/', '/es/', '/es/x', '/en/1', '/en/12?q', '/fr/#a', '/de/y', '?/es/', '#://b.com/fr/'])}" for _ in range(300)] + [None, "", "no scheme", "://", "http://"]
    rules = [*url_filter.RULES, ("a.example.org", "/", "allow"), ("org", "/es/x", "allow")]
    df = spark.createDataFrame([(k, u, "x") for k, u in enumerate(urls)], "page_id bigint, url string, verdict string")
    expected = sorted(((k, *plain_verdict(u, rules)) for k, u in enumerate(urls)), key=str)
    columns = ("page_id", "host", "path", "rule", "verdict")
    assert rows(url_filter.apply_rules(df, rules), *columns) == expected
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    assert rows(url_filter.apply_rules(df, table), *columns) == expected
    for urls_a_range in (200_000, 17):
        monkeypatch.setattr(url_filter, "RANGE_URLS", urls_a_range)
        assert rows(url_filter.apply_rules(df, table, max_broadcast=0), *columns) == expected
        assert url_filter.apply_rules(df.limit(0), table, max_broadcast=0).count() == 0
    assert url_filter.apply_rules(df.limit(0), rules).count() == 0


def test_url_rules_over_many_ranges(spark, monkeypatch):
    """A hot host, rules that span ranges, columns that could clash, null and repeated rows."""
    monkeypatch.setattr(url_filter, "RANGE_URLS", 40)
    rng = random.Random(14)
    labels = ["a", "b", "B", "é", "com", "org"]
    hosts = [".".join(rng.choice(labels) for _ in range(rng.randint(1, 4))) for _ in range(40)]
    urls = [f"http://{'hot.com' if rng.random() < 0.4 else rng.choice(hosts)}/{rng.choice(['', 'x', 'x/y', 'y', 'é/'])}{rng.randrange(5)}" for _ in range(500)] + [None, "http://a.com/x1", "http://a.com/x1"]
    rules = [(rng.choice([*hosts, "com", "org", "", "hot.com", "HOT.com"]), rng.choice(["", "/", "/x", "/x/", "/y1"]), rng.choice(["allow", "block"])) for _ in range(90)]
    extra = ("_host", "_rest", "range", "key", "kind", "row", "salt", "rule", "Verdict")
    df = spark.createDataFrame([(k, u, *extra) for k, u in enumerate(urls)], ["page_id", "url", *extra])
    by = url_filter.prepared(rules)
    plain = [(text[: len(text) - len(path)], path, verdict) for _, path, text, verdict in by]
    expected = sorted(((k, *plain_verdict(u, plain)) for k, u in enumerate(urls)), key=str)
    table = spark.createDataFrame([*rules, (None, "/", "block"), rules[0]], "host string, path string, verdict string")
    for limit in (0, 8 << 20):
        got = url_filter.apply_rules(df, table, max_broadcast=limit)
        assert rows(got, "page_id", "host", "path", "rule", "verdict") == expected
        assert got.columns == ["page_id", "url", "_host", "_rest", "range", "key", "kind", "row", "salt", "host", "path", "rule", "verdict"]
        assert got.filter("_host <> '_host' OR row <> 'row' OR salt <> 'salt'").count() == 0


def test_url_rules_are_the_same_by_both_paths(spark):
    urls = ["http://b.com/x", "http://a.b.com/y/1", "http://net/x", "http://net./x", "http:///x", "no scheme", None, "http://c.org/"]
    rules = [("", "/x", "block"), ("", "/", "review"), ("B.com", "/y", "block"), ("b.com", "/y", "allow"), ("c.org", "/", "block"), ("C.ORG", "/", "zap"), ("C.org", "/", "allow")]
    df = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id bigint, url string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    swept = rows(url_filter.apply_rules(df, table), "page_id", "rule", "verdict")
    assert rows(url_filter.apply_rules(df, table, max_broadcast=0), "page_id", "rule", "verdict") == swept
    assert [(r, v) for _, r, v in swept] == [("/x", "block"), ("b.com/y", "allow"), ("/x", "block"), ("/x", "block"), ("/x", "block"), (None, "allow"), (None, "allow"), ("c.org/", "allow")]


# --- lines ---


def plain_dedup(docs, sites, chars):
    where = defaultdict(lambda: (set(), set(), []))
    for i, text, site in docs:
        for pos, line in enumerate(text.split("\n") if text is not None else []):
            if len(line.strip(" ")) >= chars and site is not None:
                s, t, at = where[line.strip(" ")]
                s.add(site), t.add(text), at.append((i if i is not None else -1, pos))
    gone = {(i, pos) for s, t, at in where.values() if len(s) >= sites and len(t) >= sites for i, pos in at if (i, pos) != min(at)}
    return [(i, None if text is None else "\n".join(line for pos, line in enumerate(text.split("\n")) if (i if i is not None else -1, pos) not in gone)) for i, text, _ in docs]


def test_lines_against_a_plain_version(spark):
    rng = random.Random(11)
    shared = [f"a line that comes again and again {k}" for k in range(6)]
    docs = [(k, "\n".join(rng.choice([rng.choice(shared), f"own line of document {k} {rng.random()}", "short", "", "  "]) for _ in range(rng.randint(0, 12))), f"s{rng.randrange(9)}") for k in range(120)]
    docs += [(k, docs[3][1], f"s{k % 9}") for k in range(200, 230)] + [(300, None, "s1"), (301, "", "s2"), (302, shared[0], None), (303, "\n".join(shared) * 300, "s3")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id bigint, text string, source string, n_removed int")
    for sites in (3, 5, 9):
        got = line_dedup.dedup_lines(df, sites, 20)
        assert rows(got, "doc_id", "text") == sorted(plain_dedup(docs, sites, 20), key=str)
    copies = [(k, shared[0] + "\n" + shared[1], f"s{k}") for k in range(9)]
    kept = line_dedup.dedup_lines(spark.createDataFrame(copies, "doc_id bigint, text string, source string"), 3, 20)
    assert kept.filter("n_removed > 0").count() == 0
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_hot_lines_are_dealt_into_pieces(spark, monkeypatch):
    """The same result for any number of pieces, and with a band so wide that all candidates are counted exactly."""
    rng = random.Random(15)
    docs = [(k, "\n".join(["everywhere", *(f"line {rng.randrange(30)}" for _ in range(rng.randint(0, 9))), f"own {k}"]), f"s{rng.randrange(12)}") for k in range(150)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    results = []
    for pieces, band in ((4096, 0.35), (3, 0.35), (1, 0.0), (50, 0.9)):
        monkeypatch.setattr(line_dedup, "PIECES", pieces)
        monkeypatch.setattr(line_dedup, "BAND", band)
        results.append(rows(line_dedup.dedup_lines(df, 5)))
    assert results[0] == results[1] == results[2] == results[3] and sum(r[-1] for r in results[0]) > 200
    assert sorted(((r[0], r[1]) for r in results[0]), key=str) == sorted(plain_dedup(docs, 5, 1), key=str)


def test_line_dedup_keeps_columns_of_any_name(spark):
    docs = [(k, f"Read more\nown {k}", f"s{k}") for k in range(20)]
    extra = ("h", "g", "p", "k", "n", "t", "id", "pos", "row_id", "row_t", "gone_id", "gone_t", "gone", "_row_id_", "GONE_", "_gone", "_id")
    df = spark.createDataFrame([(*d, *extra) for d in docs], ["doc_id", "text", "source", *extra])
    got = line_dedup.dedup_lines(df)
    assert got.columns == [*df.columns, "n_lines", "n_removed"] and got.agg(F.sum("n_removed")).first()[0] == 19
    assert all(got.filter(F.col(c) != c).count() == 0 for c in extra[:4])


def test_short_lines_are_judged_by_spread(spark):
    docs = [(k, f"Own line {k}\nRead more\n \n\t\r\n}}\nNot on many sites {k // 3}", f"s{k % 9}") for k in range(40)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(df).collect()}
    assert got[0]["text"] == docs[0][1] and got[0]["n_removed"] == 0
    assert all(got[k]["text"] == f"Own line {k}\n \n\t\r\nNot on many sites {k // 3}" and got[k]["n_removed"] == 2 for k in range(1, 40))
    assert line_dedup.dedup_lines(df, min_chars=20).filter("n_removed > 0").count() == 0
    assert {r["text"] for r in corpus_pipeline.dedup_lines(spark, df.withColumn("n_chars", F.length("text")), "").collect()} == {r["text"] for r in got.values()}


# --- mixing ---


def n_words(text):
    return len(re.findall(r"[^ \t\n\x0b\f\r]+", text or ""))


def test_exponents(spark):
    sizes = [1000.0, 100.0, 10.0, 10.0]
    src = spark.createDataFrame([(int(n),) for n in sizes] + [(0,)], ["n"])
    a = mixing.exponent(src, max_repeats=3.0)
    assert abs((1000 / 10) ** (1 - a) - 3) < 1e-7
    h = lambda a: (lambda w: -sum(x / sum(w) * math.log(x / sum(w)) for x in w))([n**a for n in sizes])
    assert abs(h(mixing.exponent(src, entropy=1.0)) - 1.0) < 1e-8
    assert mixing.exponent(src, entropy=2.0) < 1e-9 and mixing.exponent(src, max_repeats=1000.0) == 0 and mixing.exponent(src, entropy=0.0) == 1
    b = mixing.exponent(src, max_repeats=2.0, budget=500)
    z = sum(n**b for n in sizes)
    assert abs(max(n ** (b - 1) / z * 500 for n in sizes) - 2) < 1e-6
    c = mixing.exponent(src, evenness=0.5)
    assert abs(h(c) - (h(1.0) + math.log(4)) / 2) < 1e-8
    assert mixing.exponent(src, max_repeats=3.0, evenness=0.5) == max(a, c)
    assert mixing.exponent(src.filter("n = 0"), evenness=0.5) == 1 and mixing.exponent(spark.createDataFrame([(7,), (7,)], ["n"]), evenness=0.5) == 0
    for few in (0.99, 1.01):  # sources of nearly one size: the exponent lies inside all the same
        near = spark.createDataFrame([(int(1e6 * few**k),) for k in range(6)], ["n"])
        assert 0.5 < mixing.exponent(near, max_repeats=1.5, evenness=0.5) < 0.9


def test_the_exponent_binds_in_the_query(spark):
    for sf in ("sf0.01", "sf0.1"):
        docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
        sizes = docs.groupBy("source").agg(F.sum(mixing.tokens()).alias("n"))
        assert 0.1 < mixing.exponent(sizes, mixing.MAX_REPEATS, evenness=mixing.EVENNESS) < 0.99


@pytest.mark.parametrize("evenness", [None, 0.5])
def test_mixture(spark, monkeypatch, evenness):
    rng = random.Random(12)
    docs = [(k, rng.choice([" ", "  ", "\r\n", "\x0b"]).join("w" * rng.randint(1, 9) for _ in range(rng.randint(1, 40))), f"s{min(rng.randrange(9), 3)}") for k in range(600)]
    docs += [(700, None, "s0"), (701, "", None), (702, "a b", None), (703, "x " * 50_000, "s1"), (704, " \n", "s2"), (None, "a b c", "s2"), (5, docs[5][1], docs[5][2])]
    extra = ("n", "s", "i", "p", "k", "hot", "quota", "full", "rest", "cut", "_cut", "mix_s", "mix_i", "mix_p", "mix_plan", "Mix_s_", "plan")
    df = spark.createDataFrame([(*d, 7, *extra) for d in docs], ["doc_id", "text", "source", "epoch", *extra])
    have = Counter()
    for _, t, s in docs:
        have[s] += n_words(t)
    src = spark.createDataFrame([(n,) for n in have.values()], ["n"])
    for sorted_ in (20_000, 10):
        monkeypatch.setattr(mixing, "SORTED", sorted_)
        mixed = mixing.mix(df, max_repeats=1.5, evenness=evenness)
        assert mixed.columns == ["doc_id", "text", "source", *extra, "epoch", "position"]
        got = mixed.collect()
        took, times = Counter(), Counter()
        for r in got:
            took[r["source"]] += n_words(r["text"])
            times[r["doc_id"]] += 1
        assert all(times[i] >= 1 for i, _, _ in docs) and times[700] == times[701] == times[704] == 1
        a, top = mixing.exponent(src, 1.5, evenness=evenness), max(have.values())
        for s, n in have.items():
            quota = round(n**a * top ** (1 - a))
            assert took[s] <= quota and quota - took[s] <= max(n_words(t) for _, t, x in docs if x == s)
        assert all(0 <= r["position"] < 2 and r["s"] == "s" and r["quota"] == "quota" and r["Mix_s_"] == "Mix_s_" for r in got)
    half = mixing.mix(df, max_repeats=1.0, budget=sum(have.values()) // 2).collect()
    assert sum(n_words(r["text"]) for r in half) <= sum(have.values()) // 2 + 10
    few = Counter(r["doc_id"] for r in mixing.mix(df, max_repeats=1.0, budget=100).collect())
    assert few[700] == few[701] == few[704] == 1
    assert mixing.mix(df.limit(0)).count() == 0
    assert sorted((r["doc_id"], r["epoch"]) for r in mixing.mix(df.filter("doc_id IN (700, 701, 704)")).collect()) == [(700, 0), (701, 0), (704, 0)]


def test_mixing_is_native(spark):
    df = spark.createDataFrame([(1, "a b", "s"), (2, "c", "t")], "doc_id bigint, text string, source string")
    plan = mixing.mix(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
