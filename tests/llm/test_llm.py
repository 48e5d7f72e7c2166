"""Each operator of the subpackage against brute force on small rows, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import chat, extraction, jaccard, language, mixing, packing, quality, search, tokens, warc

WS = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    words = ["alpha", "Beta", "gamma", "délta", "ε", "the", "of", "and", "x²", "don't", "1234", "foo_bar", "日本語", "🙂", "naïve"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = text(300)
    out = [(1, None), (2, ""), (3, " \t\n"), (4, text(3)), (5, base), (6, base), (7, base + " tail"), (8, base.upper()), (9, text(60_000)), (10, "a<|endoftext|>b  c\r\n d"), (10, "a<|endoftext|>b  c\r\n d"), (None, text(80)), (12, "12 34 ###"), (13, "y" * 5000)]
    return out + [(100 + i, text(rng.randint(1, 120))) for i in range(40)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    """The columns of documents and some whose names the operators use inside."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.withColumn("lang", F.lit("en")).withColumn("source", F.when(F.col("doc_id") % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("s"), F.col("doc_id") % 2)))
    clash = ("t", "i", "id", "n", "size", "count", "copies", "kept", "piece", "component", "target", "value", "d", "l", "h")
    return df.select("*", F.length("text").cast("long").alias("n_chars"), *[F.lit(1).alias(c) for c in clash]).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def test_token_counts(docs, rows, none):
    t = tokens.tokenizer(tokens.TOKENIZER)
    want = Counter((i, len((x or "").encode()), n := len(t.encode(x or "", add_special_tokens=False).ids), n > 1024) for i, x in rows)
    assert Counter(tuple(r) for r in tokens.token_counts(docs).collect()) == want
    assert tokens.token_counts(none).count() == 0
    sp = tokens.tokenizer("piece_bpe_32k.model")
    got = tokens.token_counts(docs.where("doc_id < 9"), name="piece_bpe_32k.model").collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {i: len(sp.encode(x or "")) for i, x in rows if i and i < 9}


SCRIPTS = ["Съешь ещё этих мягких булок, да выпей же чаю: 2-й раз!", "Ξεσκεπάζω την ψυχοφθόρα βδελυγμία.", "نص حكيم له سرّ قاطع وذو شأن ١٢٣", "天地玄黃，宇宙洪荒。日月盈昃　辰宿列張", "いろはにほへと ちりぬるを", "다람쥐 헌 쳇바퀴에 타고파", "ऋषियों को सताने वाले दुष्ट", "เป็นมนุษย์สุดประเสริฐ", "x² + Ⅷ = ½, 全角１２３ e\u0301 naïve's 🙂🚀 it's\u00a0so \u200d ok", "Привет\n\n  мир \t"]


def test_texts_of_all_scripts_go_through_the_tiers(spark, monkeypatch):
    t = tokens.tokenizer(tokens.TOKENIZER)
    unsure, _ = tokens.wide()
    sure = [c for c in map(chr, [*range(0xD800), *range(0xE000, 0x10000)]) if not unsure.search(c)]
    assert 30_000 < len(sure) < 60_000 and not {"\x1c", "\x85", "\u180e", "\u200b", "\u2028"} & set(sure)
    rng = random.Random(8)
    drawn = ["".join(rng.choice(sure) + rng.choice(["", "", " ", "a", "'s", "1", "\n"]) for _ in range(60)) for _ in range(400)]
    drawn += ["".join(sure[k : k + 50]) for k in range(0, len(sure), 50)]
    for x in SCRIPTS + drawn:
        pieces = tokens.pre_tokens(x)
        assert "".join(pieces) == x and sum(tokens.lengths(tokens.TOKENIZER, pieces)) == len(t.encode(x, add_special_tokens=False).ids), x
    assert tokens.pre_tokens("new letter \ua7c2") is None
    rows = list(enumerate([*SCRIPTS, "я" * 5_000, "new letter \ua7c2", *SCRIPTS]))
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.token_counts(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()}
    assert got == {k: len(t.encode(x, add_special_tokens=False).ids) for k, x in rows}


def test_plain_texts_split_as_the_tokenizer_does(sf, duck):
    t = tokens.tokenizer(tokens.TOKENIZER)
    fast = tokens.fast_encoder(tokens.TOKENIZER)
    for (x,) in duck.sql("SELECT text FROM documents").fetchall():
        ids = t.encode(x, add_special_tokens=False).ids
        assert fast.encode_ordinary(x) == ids
        if not tokens.PLAIN.search(x):
            assert sum(tokens.lengths(tokens.TOKENIZER, tokens.PRE_TOKEN.findall(x))) == len(ids)


def test_packing(docs, rows, none):
    t = tokens.tokenizer(tokens.TOKENIZER)
    got = packing.pack(docs, with_ids=True).collect()
    want = Counter()
    for i, x in rows:
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 1024 or 1024
        edges = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, z) in enumerate(zip(edges, edges[1:])):
            raw = np.array(ids[a:z], "<u4").tobytes()
            want[i, k, a, z - a, zlib.crc32(raw), raw] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], bytes(r["ids"])) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 1024
    assert len(bins) <= -(-sum(r["length"] for r in got) // 1024) + 1
    assert packing.pack(none).count() == 0


def test_fullest_is_a_best_subset_sum():
    rng = random.Random(2)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 4) for _ in range(rng.randint(1, 6))}
        room = rng.randint(0, 90)
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1) if s + n * k <= room}
        chosen = packing.fullest(dict(counts), room)
        assert sum(n * k for n, k in chosen.items()) == max(sums)
        assert all(k <= counts[n] for n, k in chosen.items())


def test_mixing(spark, docs, none, duck):
    got = mixing.mix_rates(docs).collect()
    sizes = defaultdict(int)
    for r in docs.select("source", "text").collect():
        sizes[r["source"]] += len(re.findall(WS, r["text"] or ""))
    total = sum(sizes.values())
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    target, capped = {}, set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        target = {s: 3 * sizes[s] if s in capped else left * weight[s] / sum(weight[x] for x in weight if x not in capped) for s in weight}
        more = {s for s in weight if s not in capped and target[s] > 3 * sizes[s]}
        if not more:
            break
        capped |= more
    seen = {r["source_size"]: r["target"] for r in got}
    assert seen == pytest.approx({sizes[s]: t for s, t in target.items()})
    assert all(0 <= r["copies"] <= 3 for r in got) and len(got) == docs.count()
    again = mixing.mix_rates(docs.repartition(5)).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["copies"])
    assert sorted(map(key, got)) == sorted(map(key, again))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in got)
    assert mixing.mix(none).count() == 0


def test_top_k(spark):
    rng = np.random.default_rng(3)
    vecs = [(int(i), [float(x) for x in rng.normal(size=8)]) for i in range(300)]
    vecs += [(i, vecs[5][1]) for i in range(300, 340)] + [(400, None), (401, [1.0, float("nan")] * 4), (402, [None] + [1.0] * 7), (None, [1.0] * 8), (403, [2.0]), (5, vecs[5][1]), (404, [])]
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<double>").withColumn("id", F.lit(0)).repartition(4)
    q = df.where("vec_id % 100 = 0 or vec_id = 5")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in search.top_k(df, q, block=3, tile=50).collect()}
    ints = {i: [int(np.floor(1024 * x)) for x in v] for i, v in vecs if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = {}
    for a in [i for i in ints if i % 100 == 0 or i == 5]:
        s = sorted((-sum(x * y for x, y in zip(ints[a], ints[b])), b) for b in ints if b != a)
        want |= {(a, k + 1): (b, -v) for k, (v, b) in enumerate(s[:10])}
    assert got == want
    assert search.top_k(df.where("false"), q.where("false")).count() == 0


def test_quality_measures(docs, rows, none):
    def slow(x):
        x = x or ""
        w = re.findall(WS, x)
        lines, dup = [], 0
        for line in x.split("\n"):
            if re.search(WS, line):
                dup += line in lines
                lines.append(line)
        n = Counter(zip(w, w[1:], w[2:]))
        hit = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if n[g] > 1 for k in range(3)}
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), dup, len(hit)

    got = quality.assess(docs, None).collect()
    want = Counter((i, *(m := slow(x)), m[0] < 50 or 100 * m[4] > 50 * m[0]) for i, x in rows)
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got) == want
    assert all(r["kept"] == (not r["base_failed"]) for r in got)
    assert quality.assess(none, None).count() == 0
    assert quality.repeated_words(b"a b c a b c a".split()) == 7 and quality.repeated_words(b"a a a".split()) == 0


def test_quality_ratio_tells_junk(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    ratio, threshold = quality.fit(docs, labels)
    out = quality.assess(docs, ratio, threshold).where("not base_failed").join(labels, "doc_id")
    n = {(r["quality"], r["kept"]): r["n"] for r in out.groupBy("quality", "kept").agg(F.count("*").alias("n")).collect()}
    assert n.get((1, False), 0) <= 0.02 * n[1, True]
    assert n.get((0, True), 0) <= 0.2 * sum(v for k, v in n.items() if k[0] == 0)
    good = quality.keep_good(docs, ratio, threshold)
    assert good.columns == docs.columns and good.count() == quality.assess(docs, ratio, threshold).where("kept").count()
    assert quality.fit(docs, labels.where("false")) == (None, 0.0)


def test_quality_ratio_and_threshold_of_brute_force(spark, docs, rows, monkeypatch):
    """Bucket counts, ratio, threshold and verdicts against plain loops; a document labelled both ways isn't trusted, and repeated label rows count once."""
    rng = random.Random(6)
    more = [(500 + k, " ".join(rng.choice(["trust", "worthy", "prose", "of", "some", "length"]) for _ in range(rng.randint(60, 90)))) for k in range(30)] + [(600, "#$% " * 70 + "x y z")]
    every = rows + more
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    labels = [(500 + k, 1) for k in range(30)] * 2 + [(5, 1), (5, 0), (6, 0), (100, 0), (101, 0), (None, 1), (9, None), (999, 1)]
    good = {500 + k for k in range(30)}

    def grams(x):
        b = (x or "").encode()
        return [((((b[k] * 257 + b[k + 1]) * 257 + b[k + 2]) * 0x9E3779B97F4A7C15) % 2**64) >> 50 for k in range(len(b) - 2)]

    fold = {r["i"]: r["f"] for r in spark.createDataFrame([(g,) for g in good], "i long").select("i", quality.fold(F.col("i")).alias("f")).collect()}
    raw, trusted = Counter(), [Counter() for _ in range(quality.FOLDS)]
    sum_of = lambda but: sum((c for k, c in enumerate(trusted) if k != but), Counter())
    for i, x in every:
        raw.update(grams(x))
        if i in good:
            trusted[fold[i]].update(grams(x))

    def ratio(c, b):
        share = sum(c.values()) / sum(raw.values())
        return np.log((c[b] + quality.PRIOR * share) / (raw[b] + quality.PRIOR) / share)

    mean = lambda c, x: float(np.mean([ratio(c, b) for b in grams(x)] or [0.0]))
    every_good = sum_of(None)
    got, threshold = quality.fit(df, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert got == pytest.approx([ratio(every_good, b) for b in range(1 << quality.BITS)])
    passes = lambda x: len((x or "").split()) >= 50 and 100 * quality.repeated_words(x.encode().split()) <= 50 * len(x.split())
    held = [mean(sum_of(fold[i]), x) for i, x in more[:30] if passes(x)]
    poor = [mean(every_good, x) for i, x in every if i in (6, 100, 101) and passes(x)]
    assert held and poor
    errors = lambda t: sum(h < t for h in held) / len(held) + sum(p >= t for p in poor) / len(poor)
    assert errors(threshold) == pytest.approx(min(errors(t + d) for t in held + poor for d in (-1e-7, 1e-7)))
    low, mid = np.quantile(held, quality.LOW), np.quantile(held, 0.5)
    assert quality.cut(np.array(held), np.array([])) == pytest.approx(low - quality.WIDE * (mid - low))
    assert quality.cut(np.array([1.0, 2.0, 3.0]), np.array([-3.0, 0.0])) == 0.5 and quality.cut(np.array([]), np.array([])) == 0.0
    seen = {r["doc_id"]: r for r in quality.assess(df, got, threshold).collect()}
    for i, x in every:
        assert seen[i]["log_ratio"] == pytest.approx(mean(every_good, x), abs=1e-9)
        assert seen[i]["kept"] == (not seen[i]["base_failed"] and seen[i]["log_ratio"] >= threshold)


def test_language(spark, sf, docs, none):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    langs, p = language.train(d)
    assert np.allclose(p.sum(axis=0), 1, atol=1e-3)
    out = language.identify(d, langs, p).join(d.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in out) >= 0.97 * len(out)
    edge = {r["doc_id"]: r for r in language.identify(docs, langs, p).collect()}
    assert all(edge[i]["lang_pred"] == "und" and edge[i]["score"] == 0 for i in (1, 2, 3, 12))
    assert all(0 <= r["score"] <= 1 for r in edge.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in edge.items() if i is not None)
    assert language.identify(none, langs, p).count() == 0 and language.train(none)[0] == []
    assert language.identify(docs, [], np.zeros((1, 0))).where("lang_pred <> 'und'").count() == 0


def test_forward_sums_all_segmentations(monkeypatch):
    pieces = language.Pieces(["▁", "▁a", "a", "b", "ab", "▁ab", "aba"])
    p = np.array([[1e-7], *[[x] for x in (0.1, 0.2, 0.15, 0.05, 0.3, 0.12, 0.08)]])
    prob = {t: p[i + 1, 0] for i, t in enumerate(pieces.pieces)}

    def total(s):
        return 1.0 if not s else sum(prob[s[:k]] * total(s[k:]) for k in range(1, len(s) + 1) if s[:k] in prob)

    for w in ("a", "ab", "abab", "abaab"):
        assert np.exp(language.log_scores([w], p, pieces)[0, 0]) == pytest.approx(total("▁" + w))
    counts = language.expected_counts(["abab", "b"], np.array([2.0, 1.0]), p[:, 0], pieces)
    monkeypatch.setattr(language, "LONG", 0)
    assert language.expected_counts(["abab", "b"], np.array([2.0, 1.0]), p[:, 0], pieces) == pytest.approx(counts)
    monkeypatch.setattr(language, "COLUMNS", 3)
    assert np.exp(language.log_scores(["abaabab", "ab"], p, pieces)[:, 0]) == pytest.approx([total("▁abaabab"), total("▁ab")])

    def segs(s):
        return [[]] if not s else [[s[:k], *r] for k in range(1, len(s) + 1) if s[:k] in prob for r in segs(s[k:])]

    want = Counter()
    for w, n in (("▁abab", 2.0), ("▁b", 1.0)):
        for seg in segs(w):
            for t in seg:
                want[t] += n * np.prod([prob[x] for x in seg]) / total(w)
    assert counts[1:] == pytest.approx([want[t] for t in pieces.pieces])


def brute_components(rows, words, percent):
    sets = {}
    for i, x in rows:
        w = re.findall(WS, re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))
        sets[i] = frozenset(tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))) if w else frozenset()
    comp = {i: i for i in sets}
    for a in sorted(sets):
        for b in sets:
            if a < b and sets[a] and sets[b] and comp[a] != comp[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                lo, hi = sorted((comp[a], comp[b]))
                comp = {k: lo if v == hi else v for k, v in comp.items()}
    return {i: (len(sets[i]), comp[i]) for i in sets}


@pytest.mark.parametrize(("words", "percent", "leaf"), [(4, 85, 1024), (5, 80, 8)])
def test_jaccard(spark, docs, rows, none, words, percent, leaf):
    rng = random.Random(4)
    vocab = [f"w{k}" for k in range(400)]
    more = []
    for g in range(12):
        base = [rng.choice(vocab) for _ in range(rng.choice([6, 20, 70, 200]))]
        for k in range(14):
            c = list(base)
            for _ in range(rng.randint(0, max(1, len(c) // 12))):
                c[rng.randrange(len(c))] = rng.choice(vocab)
            more.append((1000 + 20 * g + k, " ".join(c)))
    all_rows = [r for r in rows if r[0] is not None] + more
    df = docs.where("doc_id is not null").select(*docs.columns).unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(df, words=words, percent=percent, leaf=leaf).collect()}
    assert got == brute_components(all_rows, words, percent)
    assert jaccard.jaccard_components(none).count() == 0


def test_jaccard_null_id(docs):
    r = jaccard.jaccard_components(docs).where("doc_id is null").collect()
    assert len(r) == 1 and r[0]["component_id"] is None and r[0]["n_shingles"] > 0


def test_warc_round_trip(spark, tmp_path):
    evil = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(1, "http://a/", "same"), (2, "http://b/", "same"), (3, None, "other é 🙂"), (4, "http://c\r\nX: y", evil), (5, "u", None), (6, "u", ""), (None, "v", "null id"), (7, "w", "same"), (7, "w", "same"), (8, "z", "q" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("first", F.lit(1)).withColumn("sha", F.lit("?")).repartition(3)
    warc.write_archives(pages, str(tmp_path / "w"))
    got = warc.with_referred(warc.assemble(warc.read_records(spark, str(tmp_path / "w"))))
    seen = Counter((r["page_id"], r["response"]["payload_bytes"], r["response"]["stated_digest"], r["response"]["type"], r["refers_to"], r["request"] is not None) for r in got.collect())
    top = {}
    for i, _, h in rows:
        top[h or ""] = max(top.get(h or "", -1), -1 if i is None else i)
    want = Counter()
    for i, _, h in rows:
        b = (h or "").encode()
        main = i == top[h or ""] or (i is None and top[h or ""] == -1)
        want[i, len(b), "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if main else "revisit", None if main else top[h or ""], True] += 1
    assert seen == want
    assert all(r["payload_digest"] == r["response"]["stated_digest"][5:] and r["intact"] == (None if r["response"]["type"] == "revisit" else True) for r in got.collect())
    records = warc.read_records(spark, str(tmp_path / "w")).collect()
    ids = Counter(r["record_id"] for r in records)
    assert max(ids.values()) == 1 and all(r["refers_to"] in ids for r in records if r["type"] == "revisit")
    of = {r["record_id"]: r for r in records}
    assert all(of[r["refers_to"]]["type"] == "response" and of[r["refers_to"]]["stated_digest"] == r["stated_digest"] for r in records if r["type"] == "revisit")
    warc.write_archives(pages, str(tmp_path / "long"), least=10)
    small = warc.read_records(spark, str(tmp_path / "long")).where("type = 'revisit'").count()
    assert small == 0
    warc.write_archives(pages.where("false"), str(tmp_path / "none"))


def test_warc_tells_a_corrupt_payload(spark, tmp_path):
    """The digest is that of the payload as read, and files are cut by bytes."""
    head, request, meta = warc.capture_records(1, "http://a/", "payload", "A" * 32, 1, False, "0.0")[1], *warc.capture_records(1, "http://a/", "x", "A" * 32, 1, False, "0.0")[::2]
    (tmp_path / "x.warc").write_bytes("".join(r + warc.END for r in (request, head, meta)).encode())
    row = warc.with_referred(warc.assemble(warc.read_records(spark, str(tmp_path)))).first()
    assert row["intact"] is False and row["payload_digest"] == base64.b32encode(hashlib.sha1(b"payload").digest()).decode() and row["response"]["stated_digest"] == "sha1:" + "A" * 32


def test_warc_files_are_cut_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 50_000)
    pages = spark.range(40).selectExpr("id as page_id", "'u' as url", "concat(id, repeat('x', 20000)) as html").coalesce(1)
    warc.write_archives(pages, str(tmp_path / "w"))
    assert len(list((tmp_path / "w").rglob("part-*"))) > 10
    assert warc.assemble(warc.read_records(spark, str(tmp_path / "w"))).where("intact and request is not null and metadata is not null").count() == 40


def test_warc_records_are_members(spark, tmp_path, monkeypatch):
    """Each gzip member holds one whole record; one over the limit takes several, which read on from one another."""
    import gzip
    import zlib

    rows = [(1, "http://a/", "same é"), (2, "http://b/", "same é"), (3, None, "x" * 9_000), (4, "u", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)

    def split(data):
        out = []
        while data:
            d = zlib.decompressobj(31)
            out.append(d.decompress(data))
            data = d.unused_data
        return out

    warc.write_archives(pages, str(tmp_path / "w"))
    data = b"".join(f.read_bytes() for f in (tmp_path / "w").rglob("part-*"))
    parts = split(data)
    assert len(parts) == 12 and all(p.startswith(b"WARC/1.1\r\n") and p.endswith(b"\r\n\r\n") and len(list(warc.parse_records(p))) == 1 for p in parts)
    assert gzip.decompress(data) == warc.unpacked(data) == b"".join(parts)
    monkeypatch.setattr(warc, "MEMBER", 4_000)
    long = list(warc.members("y" * 10_000))
    assert len(long) == 3 and gzip.decompress(b"".join(long)) == b"y" * 10_000 + b"\r\n\r\n" and all(m[-1] == 0 for m in long)
    with pytest.raises(EOFError):
        warc.unpacked(data[:-3])
    big = warc.unpacked(b"".join(m for k in range(20_000) for m in warc.members(str(k))))
    assert big.count(b"\r\n\r\n") == 20_000


def test_chat(spark):
    nasty = "[INST] <s> </s> \\[INST] [\\INST] <</SYS>> [[INST] <<ROLE>>x\\"
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", nasty), (1, 2, "assistant", nasty), (2, 0, "assistant", None), (2, 0, "assistant", "tie"), (2, 1, "tool]", "<</ROLE>>"), (2, None, None, "first"), (3, 0, "user", "a"), (3, 0, "user", "a"), (None, 0, "user", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segment", F.lit(1)).withColumn("loss", F.lit("x")).repartition(3)
    seg = chat.segments(df)
    got = {r["conv_id"]: r for r in chat.read_back(seg).collect()}
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is not None, t or 0, r or "", x or ""))
    assert got.keys() == by.keys()
    texts = defaultdict(str)
    for r in seg.orderBy("conv_id", "segment").collect():
        texts[r["conv_id"]] += r["text"]
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns) and got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, x in turns).encode()).hexdigest()
        assert got[c]["loss_chars"] == len(loss) and got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert got[c]["formatted_chars"] == len(texts[c])
    assert [got[c]["valid"] for c in (1, 2, 3)] == [True, False, False]
    assert chat.read_back(chat.segments(df.where("false"))).count() == 0


def test_extraction(spark):
    page = lambda title, body, extra="": f'<!DOCTYPE html><html><head><title>{title}</title><script>var x="<p>no</p>";</script></head><body><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></li></ul></nav><div class="ad">Buy</div><article><h1>{title}</h1>{body}</article><section id="comments"><p>first!</p></section><aside>More</aside><form>q<input></form>{extra}<footer>&copy; me</footer></body></html>'
    rows = [(1, "http://h/1", page("One", "<p>a &amp;\n  b<p>c<br>d</p><div class='share'>Share</div>")), (2, "http://h/2", page("Two", "<p>x <b>bold</b>er</p><ul><li>i</li><li>j</li></ul>")), (3, None, None), (4, "http://k/", ""), (5, "http://k/", "just &lt;text&gt;"), (6, "http://k/", "<div><p>Some running text that is long enough to be the main text.</p></div><nav>menu</nav>"), (1, "http://h/1", page("One", "<p>a &amp;\n  b<p>c<br>d</p><div class='share'>Share</div>"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(0)).withColumn("n", F.lit(0)).withColumn("part", F.lit(0))
    got = Counter((r["page_id"], r["text"], r["n_chars"]) for r in extraction.extract(df).collect())
    want = [(1, "One\na & b\nc\nd"), (2, "Two\nx bolder\ni\nj"), (3, ""), (4, ""), (5, "just <text>"), (6, "Some running text that is long enough to be the main text."), (1, "One\na & b\nc\nd")]
    assert got == Counter((i, t, len(t)) for i, t in want)
    assert extraction.extract(df.where("false")).count() == 0


def brute_template(htmls):
    """Text lines of valid classes of one host by definition: whole occurrence vectors, orders and slots compared over all different pages."""
    pages = {}
    for h in htmls:
        page = extraction.Page(h)
        inner, lines = extraction.lines_of(page)
        if any(x.article for x in lines):
            pages.setdefault(inner, {})[tuple(x.text for x in lines if x.article)] = (page, lines)
    out = set()
    for layout in pages.values():
        found = [list(extraction.tokens(*x).items()) for x in layout.values()]
        vector = {t: tuple(dict(f).get(t, 0) for f in found) for t in {t for f in found for t, _ in f}}
        vector = {t: v for t, v in vector.items() if max(v) == 1 and sum(v) >= extraction.SHARED and sum(v) * 2 >= len(v)}
        every = (1,) * len(found)

        def large(v):
            size = Counter(v.values())
            return {t: x for t, x in v.items() if x == every or size[x] >= extraction.LARGE}

        vector = large(vector)
        for limit in (1, 0):
            places, slots = defaultdict(set), defaultdict(set)
            for f in found:
                for t, _ in f:
                    if t in vector:
                        before = [u for u, _ in f[: [u for u, _ in f].index(t)]]
                        places[t].add(sum(vector.get(u) == vector[t] for u in before))
                        slots[t].add(sum(vector.get(u) == every for u in before))
            vector = {t: v for t, v in vector.items() if max(places[t]) - min(places[t]) <= limit}
            vector = large(vector) if limit else vector
        for v in set(vector.values()):
            own = [t for t in vector if vector[t] == v]
            if v == every or len(own) >= extraction.LARGE and len(set.union(*(slots[t] for t in own))) == 1:
                out |= {t for t in own if t & 1}
    return out


def main_texts(spark, htmls):
    df = spark.createDataFrame([(n, "http://h/", h) for n, h in enumerate(htmls)], "page_id long, url string, html string").repartition(3)
    return [r["text"] for r in extraction.extract(df).orderBy("page_id").collect()]


def test_template_is_that_of_brute_force(spark):
    """Random hosts with shared, moving, optional and repeated parts: the same template lines as whole vectors give."""
    rng = random.Random(5)
    rows = []
    for host in range(4):
        for n in range(rng.choice([3, 9, 30])):
            parts = [f"<p>Text {host} {n} {k}</p>" for k in range(rng.randint(1, 4))]
            if rng.random() < 0.7:
                parts.insert(0, "<div class=promo><p>Join us</p><p>Now</p></div>")
            if rng.random() < 0.8:
                parts.append("<div class=box2>Always at the end</div>")
            parts.insert(rng.randint(0, len(parts)), "<h4>Moving line</h4>")
            if rng.random() < 0.6:
                parts.insert(rng.randint(0, len(parts)), "<section class=wanders><p>Some</p><p>where</p></section>")
            if host % 2:
                parts += ["<p>Twice</p>"] * 2
            rows.append((len(rows), f"http://h{host}/", f"<html><body><nav>m</nav><article><h1>Title {n % 20}</h1><h5>Rules</h5>{''.join(parts)}<p>The end</p></article></body></html>"))
            if rng.random() < 0.2:
                rows.append((len(rows), f"http://h{host}/", rows[-1][2]))
    df = spark.createDataFrame(rows, "page_id long, host string, html string").repartition(5)
    got = {r["host"]: set(r["fixed"]) for r in extraction.templates(df).collect()}
    want = {h: brute_template([x for _, u, x in rows if u == h]) for h in {r[1] for r in rows}}
    assert got == {h: t for h, t in want.items() if t} and len(got) >= 2


def test_mixed_hosts_and_names(spark):
    """A notice of neutral class on all pages of a host goes and one on three of them stays; class words that only contain a listed name, pages without article and hosts with one page keep their text."""
    pages = [f"<html><body><article><h1>T{n}</h1><div class='x1'><p>Please read the house rules</p></div><p class='period'>P{n}</p></article></body></html>" for n in range(20)]
    pages += [f"<html><body><div class=post><p>Plain {n}</p></div></body></html>" for n in range(3)]
    got = main_texts(spark, pages)
    assert got == [f"T{n}\nP{n}" for n in range(20)] + [f"Plain {n}" for n in range(3)]
    assert main_texts(spark, pages[:3]) == [f"T{n}\nPlease read the house rules\nP{n}" for n in range(3)]
    assert main_texts(spark, pages[:1]) == ["T0\nPlease read the house rules\nP0"]


def test_names_are_whole_values(spark):
    """A class that only contains a listed name keeps its text; one made of such names and of neutral words doesn't."""
    page = "<article><h1>T</h1><div class='toolbar-demo'><p>Body</p></div><p class='notice-period'>Three months</p><div class='share-buttons x'>Share</div><div id=comments_2><p>first!</p></div><ul class='ad-slot'><li>Buy</li></ul></article>"
    assert main_texts(spark, [page]) == ["T\nBody\nThree months"]


def test_deep_nesting_takes_linear_time():
    import time

    began = time.time()
    html = "<div>" * 16_000 + "deep" + "</b>" * 16_000 + "</div>" * 16_000 + "<b>" * 2000 + "x" + "</i>" * 2000
    assert [x.text for x in extraction.lines_of(extraction.Page(html))[1]] == ["deep", "x"]
    assert time.time() - began < 2


@pytest.mark.parametrize("part", ["<a ", '<a b="c ', "<!-", "<!--", "</script ", "<script ", "<a b='\">", "<", '<a "> ', "<a '>\" "])
@pytest.mark.parametrize("end", ["", ">", '">', "x"])
def test_unclosed_tags_take_linear_time(part, end):
    import time

    html = part * (1_000_000 // len(part)) + end
    began = time.time()
    assert sum(1 for _ in extraction.scan(html)) <= len(html)
    assert time.time() - began < 1


def test_scan_reads_tags_as_they_are():
    html = "a<!-- <p> -->b<P class='x>y' id=\"1\">c<br/>d</p >e < f<3 g<script>if (a<b) {}</SCRIPT >h<!DOCTYPE html>i<a href=x"
    assert list(extraction.scan(html)) == [
        ("a", "", ""), ("b", "", ""), ("", "p", " class='x>y' id=\"1\""), ("c", "", ""), ("", "br", "/"), ("d", "", ""), ("", "/p", " "), ("e ", "", ""),
        ("<", "", ""), (" f", "", ""), ("<", "", ""), ("3 g", "", ""), ("h", "", ""), ("i<a href=x", "", ""),
    ]


@pytest.mark.parametrize("n", [7, 8, 30])
def test_shared_headings_with_own_text_stay(spark, n):
    """However many pages share them; a shared line without own text behind it is template text."""
    page = lambda k: f"<html><body><div class=x9><p>Welcome to the site</p></div><article><h1>Dish {k}</h1><h2>Ingredients</h2><ul><li>item {k}</li></ul><h2>Method</h2><p>Cook {k}.</p><p>Visit us</p></article></body></html>"
    foot = ["Visit us"] if n < 8 else []
    assert main_texts(spark, [page(k) for k in range(n)]) == ["\n".join([f"Dish {k}", "Ingredients", f"item {k}", "Method", f"Cook {k}.", *foot]) for k in range(n)]


def test_template_sees_lines_that_names_would_hide(spark):
    """Lines outside the article are tokens too: a menu without a telling name goes with its neighbours, and support is the caller's."""
    page = lambda k: f"<html><body><nav><a>Home</a></nav><div class=q1><p>Top stories</p><p>Sport</p></div><div class=q2><p>Story {k}</p></div></body></html>"
    assert main_texts(spark, [page(k) for k in range(9)]) == [f"Story {k}" for k in range(9)]
    html = page(1)
    assert any(not x.article and x.text == "Home" for x in extraction.lines_of(extraction.Page(html))[1])
    df = spark.createDataFrame([(k, "http://h/", page(k)) for k in range(4)], "page_id long, url string, html string")
    assert {r["text"] for r in extraction.extract(df, support=4).collect()} == {f"Story {k}" for k in range(4)}


def test_registered_queries_match_sql(spark, sf, duck):
    from conftest import same

    from strandline.llm import registry

    for name, sql in registry.oracle_sql().items():
        same(registry.queries()[name](spark, sf).toPandas(), duck.sql(sql).df())


def test_pipeline_stages(spark, sf, rows):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    cols = docs.columns
    assert [n for n, _ in cp.STAGES][2] == "n-gram Jaccard join"
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = None
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == cols
        before, after = Counter(r["doc_id"] for r in docs.collect()), Counter(r["doc_id"] for r in out.collect())
        if "mixing" not in name:
            assert not after - before
        if "Jaccard" in name:
            comp = brute_components([(i, text[i]) for i in before], 5, 80)
            assert set(after) == {i for i, (_, c) in comp.items() if c == i}
        docs = out
        kept = after
    packed = cp.STAGES[-1][1](spark, docs, sf).where("piece = 0").groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in packed} == dict(kept)
    empty = spark.read.parquet(f"{sf}/documents.parquet").where("false")
    for _, stage in cp.STAGES:
        assert stage(spark, empty, sf).count() == 0


def test_pipeline_stages_bear_awkward_rows(spark, sf, docs, rows):
    """Null ids, texts, languages and sources, repeated rows, long texts and clashing columns: each stage keeps the columns and gives what its docstring says."""
    import corpus_pipeline as cp

    ids = Counter(i for i, _ in rows)
    count = lambda df: Counter(r["doc_id"] for r in df.collect())
    out = {}
    for name, stage in cp.STAGES[:-1]:
        df = stage(spark, docs, sf)
        assert df.columns == docs.columns
        out[name] = count(df)
    assert not out["language ID"] - ids and not {1, 2, 3, 12} & set(out["language ID"])  # no letter, no language
    assert not out["quality rules"] - ids and not {1, 2, 3, 4, 13} & set(out["quality rules"])  # under 50 words
    comp = brute_components([(i, x) for i, x in rows if i is not None], 5, 80)
    assert out["n-gram Jaccard join"] == Counter({i: ids[i] if not comp[i][0] else 1 for i in comp if comp[i][1] == i}) + Counter({None: 1})
    sizes = mixing.mix_rates(docs).collect()
    assert out["mixing sources to target weights"] == sum((Counter({r["doc_id"]: r["copies"]}) for r in sizes), Counter())
    packed = cp.STAGES[-1][1](spark, docs, sf).collect()
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == ids


def test_copies_of_a_page_keep_their_text(spark):
    page = "<html><body><nav>menu</nav>{}<h1>Same title</h1><p>The same long text on every page of the host.</p>{}</body></html>"
    for wrap in (("<article>", "</article>"), ("<div>", "</div>")):
        assert set(main_texts(spark, [page.format(*wrap)] * 20)) == {"Same title\nThe same long text on every page of the host."}


def test_template_decides_inside_articles(spark):
    """A line that a host's different pages share at one place is template text, also inside an article; a line that returns at other places is text."""
    page = lambda n: f"<html><body><article><h1>Title {n}</h1><p>Text of page {n}.</p>{'<p>Refrain</p>' if n % 2 else ''}<p>End of {n}.</p><div class=box>Follow us</div><p>Read our rules</p></article></body></html>"
    want = {n: "\n".join([f"Title {n}", f"Text of page {n}.", *(["Refrain"] if n % 2 else []), f"End of {n}."]) for n in range(120)}
    rows = [(n, "http://h/", page(n)) for n in want]
    got = extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
    assert main_texts(spark, [rows[n][2] for n in range(3)])[1].endswith("Follow us\nRead our rules")  # three pages tell no template


def test_pages_without_article_keep_their_text(spark):
    """Article elements count page by page, and short lines stay however long the others are."""
    post = "<html><body><nav>menu</nav><article><h1>A</h1><p>post</p></article></body></html>"
    plain = f"<html><body><nav>menu</nav><div class=post><h2>Short title</h2><p>Lead</p><p>{'long ' * 200}</p><p>A <b>bold</b> end</p></div></body></html>"
    want = "Short title\nLead\n" + " ".join(["long"] * 200) + "\nA bold end"
    assert main_texts(spark, [post, plain]) == ["A\npost", want]
    assert main_texts(spark, [plain]) == [want]


def test_top_k_with_many_copies_of_a_near_row(spark):
    """More than k copies of an id in one partition take one place, also when their vectors differ and only their scores are equal."""
    rows = [(0, [1.0, 0.0])] + [(1, [9.0, 0.0])] * 30 + [(2, [8.0, float(n)]) for n in range(30)] + [(n, [float(8 - n), 0.0]) for n in range(3, 8)]
    base = spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1)
    got = search.top_k(base, base.where("vec_id = 0"), k=4).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(1, 9 * 1024**2), (2, 8 * 1024**2), (3, 5 * 1024**2), (4, 4 * 1024**2)]


def test_every_language_keeps_its_words(spark):
    """A language with few documents beside a large one learns its own words, and more than 64 languages are learned."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(n, " ".join(letters[k] * 3 for k in range(12)), "large") for n in range(60)] + [(100 + n, "zyz zyz zyz", "small") for n in range(6)]
    rows += [(1000 + 5 * m + n, f"{letters[m % 26]}q{letters[m // 26]}q", f"l{m:02}") for m in range(68) for n in range(5)]
    langs, p = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(langs) == 70 and "small" in langs
    got = language.scorer(langs, p)(["zyz zyz zyz zyz", "aaa bbb ccc ddd aaa bbb"])[0]
    assert got == ["small", "large"]


def plain_log_score(word, q, known):
    """Sum over all segmentations of the marked word, place by place."""
    s = "▁" + word
    alpha = [0.0] + [-np.inf] * len(s)
    for e in range(1, len(s) + 1):
        ways = [alpha[e - k] + np.log(q[known[s[e - k : e]] + 1]) for k in range(1, e + 1) if s[e - k : e] in known]
        if s[e - 1] not in known:
            ways.append(alpha[e - 1] + np.log(q[0]))
        alpha[e] = np.logaddexp.reduce(ways)
    return alpha[-1]


def test_training_and_scores_of_a_plain_loop(spark):
    """The registered model on small rows: EM, scores and predictions without batches, tables or scaling."""
    rng = random.Random(9)
    letters = {"x": "abcdé", "y": "bcdeñ", "z": "漢字仮名"}
    rows = [(n, " ".join("".join(rng.choice(letters[lang]) for _ in range(rng.choice([1, 2, 5, 9, 70]))) for _ in range(12)), lang) for n in range(40) for lang in letters]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    langs, p = language.train(df)
    pieces = language.vocabulary()
    known = {t: i for i, t in enumerate(pieces.pieces)}
    assert len(known) > 31_000 and langs == ["x", "y", "z"]
    for j, lang in enumerate(langs):
        counts = Counter(w for n, t, x in rows if x == lang and zlib.crc32(str(n).encode()) % 5 for w in t.split())
        q = np.full(len(known) + 1, 1 / (len(known) + 1))
        for _ in range(language.ROUNDS):
            c = np.full(len(q), 0.1)
            for w, times in counts.items():
                s = "▁" + w
                ways = [(a, e, known.get(s[a:e], -1) + 1) for e in range(1, len(s) + 1) for a in range(max(0, e - pieces.longest), e) if s[a:e] in known or e - a == 1]
                left, right = np.full(len(s) + 1, -np.inf), np.full(len(s) + 1, -np.inf)
                left[0] = right[-1] = 0
                for a, e, i in ways:
                    left[e] = np.logaddexp(left[e], left[a] + np.log(q[i]))
                for a, e, i in reversed(ways):
                    right[a] = np.logaddexp(right[a], right[e] + np.log(q[i]))
                for a, e, i in ways:
                    c[i] += times * np.exp(left[a] + np.log(q[i]) + right[e] - left[-1])
            q = np.maximum(c / c.sum(), language.FLOOR)
        assert p[:, j] == pytest.approx(q, rel=1e-4)
    texts = [t for _, t, _ in rows[:9]] + ["漢" * 700, "abc" * 300 + " bcd", "", None, "12 ?!"]
    preds, scores = language.scorer(langs, p)(texts)
    for text, pred, score in zip(texts, preds, scores):
        words = re.findall(r"[^\s\d!-/:-@\[-`{-~]+", text or "") if any(map(str.isalpha, text or "")) else []
        if not words:
            assert (pred, score) == ("und", 0)
            continue
        total = np.array([sum(plain_log_score(w, p[:, j], known) for w in words) for j in range(3)])
        assert pred == langs[int(total.argmax())] and score == pytest.approx(1 / np.exp(total - total.max()).sum(), rel=1e-5)


def test_memory_of_scoring_is_bounded(monkeypatch):
    """Many languages: few words at a time, the same sums."""
    rng = np.random.default_rng(2)
    pieces = language.Pieces(["▁", "a", "b", "ab", "ba", "aba"])
    p = rng.random((7, 40))
    words = ["".join(rng.choice(list("ab"), n)) for n in rng.integers(1, 300, 60)]
    whole = language.scorer([str(k) for k in range(40)], p)
    assert max(len(x) for x in language.batches_of(words, 4, 1000)) <= language.CELLS // 4000
    want = language.log_scores(words, p, pieces)
    monkeypatch.setattr(language, "CELLS", 2000)
    assert language.log_scores(words, p, pieces) == pytest.approx(want)
    texts = [" ".join(words[k : k + 9]) for k in range(0, 54, 9)]
    monkeypatch.setattr(language, "vocabulary", lambda: pieces)
    a = language.scorer([str(k) for k in range(40)], p)(texts)
    monkeypatch.setattr(language, "CACHED", 20)
    monkeypatch.setattr(language, "PORTION", 4)
    assert language.scorer([str(k) for k in range(40)], p)(texts)[0] == a[0] and callable(whole)


def test_pieces_whose_slot_is_taken_are_found(monkeypatch):
    monkeypatch.setattr(language, "_BITS", 9)
    names = [a + b for a in "abcdefghijklmnopqrst" for b in "abcdefghijklmnopqrst"]  # 400 in 512 slots
    size, found = language.Pieces(names).find(names)
    assert [int(found[1][n, 2]) for n in range(400)] == list(range(400)) and (found[0][:, :3] == -1).all()


def family(rng, n, base, changes, vocab):
    out = []
    for _ in range(n):
        c = list(base)
        for _ in range(rng.randint(0, changes)):
            c[rng.randrange(len(c))] = rng.choice(vocab)
        out.append(" ".join(c))
    return out


def test_jaccard_regions_recurse(spark):
    """Regions far beyond the leaf, of documents that link and of documents that only meet, are split by new pivots and by rings: links connect what brute force connects."""
    rng = random.Random(7)
    vocab = [f"w{k}" for k in range(3000)]
    texts = [t for _ in range(6) for t in family(rng, 25, [rng.choice(vocab) for _ in range(60)], 4, vocab)]
    rows = list(enumerate(texts))
    likeness = jaccard.Likeness(80)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sets = jaccard.shingle_sets(docs, docs.selectExpr("doc_id as doc"), "doc_id", "text", 2, likeness).cache()
    one = jaccard.measured(sets.selectExpr("0L as pivot", "doc"), sets, likeness).withColumnRenamed("pivot", "region").cache()
    assert one.where("not linked").count() > 100
    split, _ = jaccard.recursed(one, sets, likeness, 16, 10**6)
    sizes = [r["m"] for r in jaccard.sizes(split).collect()]
    assert len(sizes) > 6 and max(sizes) < 150
    links = [(r["a"], r["b"]) for r in jaccard.region_links(one, sets, likeness, 16, 10**6).collect()] + [(0, r["doc"]) for r in one.where("linked").collect()]
    at = list(range(len(rows)))
    for a, b in links:
        lo, hi = sorted((at[a], at[b]))
        at = [lo if x == hi else x for x in at]
    assert dict(enumerate(at)) == {i: c for i, (_, c) in brute_components(rows, 2, 80).items()}


def test_jaccard_hot_cells_and_giant_component(spark, monkeypatch):
    """A large family of different near copies and a passage that most documents hold: cells of a third of all sets take their pivot from a broadcast, and components stay exact."""
    rng = random.Random(8)
    vocab = [f"w{k}" for k in range(3000)]
    passage = [rng.choice(vocab) for _ in range(50)]
    rows = list(enumerate(family(rng, 300, [rng.choice(vocab) for _ in range(90)], 3, vocab)))
    rows += [(1000 + k, " ".join(passage + [rng.choice(vocab) for _ in range(rng.randint(1, 60))])) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    seen = []
    monkeypatch.setattr(jaccard, "hot_cells", lambda real, f=jaccard.hot_cells: seen.append(f(real, 1)) or seen[0])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(docs, leaf=32).collect()}
    assert seen[0].count() > 0
    assert got == brute_components(rows, 4, 85)


def test_sketches_never_differ_by_more_than_sets():
    rng = np.random.default_rng(9)
    for percent in (60, 80, 85):
        like = jaccard.Likeness(percent)
        for n in (1, 5, 16, 33, 200, 1000):
            a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            b = np.unique(np.r_[a[: max(1, int(len(a) * rng.uniform(0.6, 1)))], rng.integers(0, 2**63, n // 10, dtype=np.uint64)])
            both = jaccard.overlap(a, b)
            if like.linked(both, len(a) + len(b) - both):
                assert len(a) + len(b) - 2 * both <= like.apart(len(a), len(b))
                cs = set(like.classes(len(a))) & set(like.classes(len(b)))
                assert cs
                x, y = (dict(zip(like.classes(len(s)), np.split(np.frombuffer(like.sketch(s), np.uint8), [1 << like.classes(len(s))[0]]))) for s in (a, b))
                for c in cs:
                    assert (x[c] != y[c]).sum() <= like.apart(len(a), len(b))
