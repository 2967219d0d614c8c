"""Operators on texts, held against plain versions of the same rules."""

import hashlib
import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from orefold.llm import decontaminate, jaccard, langid, linear, pieces, quality, secrets, toxicity

ODD = [None, "", " ", "\n\t", "é", "a" * 5000, "word " * 3000, "🙂 mixed ÀÉ 12", "a b c", "퟿"]


def frame(spark, texts, **more):
    rows = [(i, t, *[v[i] for v in more.values()]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string" + "".join(f", {k} string" for k in more))


# decontamination


def plain_hits(doc, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    d, hit, found = words(doc), set(), set()
    for item, text in items:
        w = words(text)
        k = min(13, len(w))
        for j in range(len(w) - k + 1 if w else 0):
            for i in range(len(d) - k + 1):
                if d[i : i + k] == w[j : j + k]:
                    hit.update(range(i, i + k))
                    found.add(str(item))
    return len(d), len(hit), sorted(found)


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_decontamination(spark, block_bytes):
    r = random.Random(5)
    vocabulary = ["alpha", "Beta", "gamma", "delta9", "é"]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(n))) for i, n in enumerate([20, 13, 12, 3, 1, 0, 25, 25])] + [(8, None), (9, "Solo!")]
    items.append((10, items[0][1]))
    docs = [" ".join(r.choice(vocabulary) for _ in range(60)) + " x " + items[k % 8][1] + ", end" for k in range(24)] + ["solo", *ODD]
    bench = spark.createDataFrame(items, "item_id long, text string")
    twice = frame(spark, docs, row=docs).unionByName(frame(spark, docs, row=docs).where("doc_id < 3"))
    rows = decontaminate.with_verdict(decontaminate.find_overlaps(twice, bench, block_bytes=block_bytes)).collect()
    got = {row.doc_id: row for row in rows}
    assert len(got) == len(docs) and len(rows) == len(docs) + 3
    same = spark.createDataFrame([(1, docs[0], {"a": 1}), (1, "clean words", None), (None, docs[0], None), (None, "clean words", None)], "doc_id long, text string, row map<string,int>")
    assert sorted(r.text for r in decontaminate.remove_contaminated(same, bench, block_bytes=block_bytes).collect()) == ["clean words"] * 2
    assert decontaminate.find_overlaps(same.limit(0), bench, block_bytes=block_bytes).count() == 0
    for i, d in enumerate(docs):
        n, hit, found = plain_hits(d, items)
        assert (got[i].n_words, got[i].n_hit, got[i].n_items) == (n, hit, len(found)), i
        assert got[i].items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
        assert got[i].contaminated == (hit > 0 and 20 * hit >= n)


def test_longest_match_and_removal(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = frame(spark, ["pre " + text + " post", "clean words only"], source=["a", "b"])
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    m = decontaminate.find_overlaps(docs, bench).where("doc_id = 0").first().matches
    assert [(x.start, x.item_start, x.length) for x in m] == [(1, 0, 40)]
    assert [r.doc_id for r in decontaminate.remove_contaminated(docs, bench).collect()] == [1]
    assert decontaminate.remove_contaminated(docs, bench.limit(0)).count() == 2


def test_matches_are_maximal(monkeypatch):
    r = random.Random(8)
    for pairs in (1, 7, 1 << 20):
        monkeypatch.setattr(decontaminate, "PAIRS", pairs)
        items = [(str(k), " ".join(r.choice("ab") for _ in range(n)).encode()) for k, n in enumerate((9, 4, 2, 6))]
        docs = [" ".join(r.choice("abx") for _ in range(40)).encode() for _ in range(4)] + [b"a " * 30]
        got = decontaminate.TestSuffixes(items, 3).search(docs)
        for d, (_, _, matches, _) in zip(docs, got, strict=True):
            w, want = d.split(), set()
            for item, text in items:
                v = text.split()
                for i, j in itertools.product(range(len(w)), range(len(v))):
                    n = 0
                    while i + n < len(w) and j + n < len(v) and w[i + n] == v[j + n]:
                        n += 1
                    if n >= min(3, len(v)) and not (i and j and w[i - 1] == v[j - 1]):
                        want.add((item, i, j, n))
            assert {tuple(m) for m in matches} == want and len(matches) == len(want)


def test_one_word_over_and_over():
    got = decontaminate.TestSuffixes([("i", b"spam " * 500)]).search([b"spam " * 50_000, b"ham"])
    assert got[0][1] == [[0, 50_000]] and len(got[0][2]) == 50_000 + 500 - 2 * 13 + 1 and got[1][1] == []


# secrets


def test_secret_spans_and_ownership(spark):
    live, shared = "Zx9Qw7Lk3Vb5Nm1Tr8Yp2Hs6", "Aa1Bb2Cc3Dd4Ee5Ff6Gg7Hh8"
    texts = [f"password = 'Hunter22x' {live}", f"TOKEN: {shared}", f"token={shared}", f"secret:{shared}", f"api_key: {shared}", "AKIA" + "B" * 16, "AKIA" + "B" * 15, "0123456789abcdef01234567", "passwd=short", *ODD]
    owner = [f"o{i}" for i in range(len(texts))]
    docs = frame(spark, texts, source=owner)
    got = {r.doc_id: r for r in secrets.digests(secrets.find_secrets(docs, owner="source", repo="source")).collect()}
    assert (got[0].n_assign, got[0].spans) == (1, "assign:0:21,opaque:23:47")
    assert [got[i].n_copied for i in (1, 2, 3, 4)] == [1] * 4
    assert (got[5].n_access, got[6].n_access, got[7].n_hex, got[8].n_assign) == (1, 0, 1, 0)
    assert got[9].base_sha256 == hashlib.sha256(b"").hexdigest() and len(got) == len(texts)
    clean = {r.doc_id: r.text for r in secrets.redact(docs, owner="source", repo="source").collect()}
    assert clean[0] == "[secret]' [secret]" and clean[1] == texts[1] and clean[9] is None and clean[14] == texts[14]


def test_secrets_of_an_empty_table(spark):
    assert secrets.find_secrets(frame(spark, ["x"], source=["s"]).limit(0), owner="source", repo="source").count() == 0


# Jaccard join


def plain_components(docs, size, share):
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    sets = []
    for t in docs:
        w = words(t)
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= share * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in range(len(docs))}


def near_copies(seed, families, copies):
    r = random.Random(seed)
    out = []
    for f in range(families):
        base = [f"v{r.randrange(400)}" for _ in range(r.randrange(5, 90))]
        for _ in range(copies):
            w = list(base)
            for _ in range(r.randrange(0, 4)):
                w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
            out.append(" ".join(w) if f % 3 else " ".join(w).upper() + "\n")
    return out


@pytest.mark.parametrize("size,share,short", [(4, 85, 64), (5, 80, 64), (4, 85, 3)])
def test_components_equal_brute_force(spark, monkeypatch, size, share, short):
    monkeypatch.setattr(jaccard, "SHORT", short)
    monkeypatch.setattr(jaccard, "LEAST_CHUNK", 8)
    docs = near_copies(size + short, 12, 14) + ["same words here", "Same  words\there", *ODD]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.cluster(frame(spark, docs), size=size, share=share).collect()}
    assert got == plain_components(docs, size, share)


@pytest.mark.parametrize("share", [80, 85])
def test_classes_of_long_lists_are_kept_for_any_partner(spark, share):
    needed = lambda m, n: -(-(m + n) * share // (100 + share)) - -(-max(m, n) * share // 100) + 1
    rows, able = [], set()
    for n in range(1, 130):
        for most in range(n, n * 100 // share + 1):
            least = min(needed(n, p) for p in range(n, most + 1))
            for long in range(1, least + 1):
                rows.append((len(rows), n, n, most, long))
            able.add(len(rows) - 1)
    known = spark.createDataFrame(rows, "class long, n int, least int, most int, long int").withColumn("classes", F.lit(65)).withColumn("pivot", F.col("class"))
    assert able <= {r["class"] for r in jaccard._among_long(known, share).collect()}


@pytest.mark.parametrize("seed", [0, 1])
def test_passages_with_a_few_words_more_equal_brute_force(spark, seed):
    r = random.Random(seed)
    passage = " ".join(f"p{seed}x{i}" for i in range(20))
    docs = [passage + "".join(f" u{r.getrandbits(40)}" for _ in range(1 + i % 3)) for i in range(75)]
    got = {a.doc_id: (a.n_shingles, a.component_id) for a in jaccard.cluster(frame(spark, docs), size=4, share=85).collect()}
    assert got == plain_components(docs, 4, 85)


def test_one_of_each_group_stays(spark):
    docs = frame(spark, ["a b c d e f g", "a b c d e f g", "z", None, ""]).withColumnRenamed("doc_id", "doc_id")
    twice = docs.unionByName(docs.where("doc_id = 4"))
    assert sorted(r.doc_id for r in jaccard.keep_one(twice).collect()) == [0, 2, 3, 4]
    assert jaccard.cluster(docs.limit(0)).count() == 0 and jaccard.keep_one(docs.limit(0)).count() == 0
    odd = [(1, "h i j k l m n", "x"), (1, "a b c d e f g", "x"), (5, "a b c d e f g", "x"), (None, "a b c d e f g", "x"), (None, None, "x"), (1, "a b c d e f g", "y"), (7, "", None), (7, None, None)]
    got = jaccard.keep_one(spark.createDataFrame(odd, "doc_id long, text string, body string")).collect()
    assert sorted(((r.doc_id or 0), r.text or "") for r in got) == [(0, ""), (0, "a b c d e f g"), (1, "a b c d e f g"), (1, "h i j k l m n"), (7, "")]


def test_divide_skip_finds_all_links():
    r = random.Random(3)
    base = [r.getrandbits(60) for _ in range(80)]
    sets = [np.unique(np.array(r.sample(base, r.randrange(60, 80)) + [r.getrandbits(60) for _ in range(r.randrange(4))], np.uint64)) for _ in range(40)]
    root = {i: i for i in range(40)}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in jaccard.search(list(range(40)), sets, 70):
        assert 100 * len(np.intersect1d(sets[a], sets[b])) >= 70 * len(np.union1d(sets[a], sets[b]))
        root[max(find(a), find(b))] = min(find(a), find(b))
    for i in range(40):
        for j in range(i):
            if 100 * len(np.intersect1d(sets[i], sets[j])) >= 70 * len(np.union1d(sets[i], sets[j])):
                assert find(i) == find(j)


# SentencePiece


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


def test_round_trip_and_chunks(vocabulary):
    r = random.Random(1)
    texts = ["a  b", " lead", "tail ", "x▁y ▁▁ z", "a\nb\tc\n\n d", "日本 𝔘 \U0010fffe", "    " * 20, "ab" * 90, *[t for t in ODD if t]]
    texts += ["".join(r.choice("aetion  \n▁sé日") for _ in range(r.randrange(1, 120))) for _ in range(60)]
    for t in texts:
        ids = vocabulary.encode(t)
        assert vocabulary.decode(ids) == t
        if len(t) > 600:
            continue
        whole = vocabulary.mask(t)
        assert ids == vocabulary.solve(whole, 0, len(whole))[0]
        for chunk in (16, 23):
            parts = pieces.chunks(vocabulary, t, chunk)
            matrices = [vocabulary.transfer(s, n, k * chunk)[0] for k, s, n in parts]
            states = pieces.combine(matrices)
            assert ids == [i for (k, s, n), (a, b) in zip(parts, states, strict=True) for i in vocabulary.chunk_path(s, n, k * chunk, a, b)]
            half = len(matrices) // 2
            if half:  # any bracketing gives one product
                left, right = pieces.scan(matrices[:half])[-1], pieces.scan(matrices[half:])[-1]
                assert pieces.product(left, right)[0, 0] == pieces.scan(matrices)[-1][0, 0]
                (_, middle), _ = pieces.combine([left, right])
                assert pieces.combine(matrices[:half], 0, middle) + pieces.combine(matrices[half:], middle, 0) == states


def test_best_of_all_segmentations():
    r = random.Random(4)
    letters = "ab" + pieces.SPACE
    named = sorted({"".join(r.choice(letters) for _ in range(k)) for k in (1, 1, 2, 2, 2, 3, 3, 3, 4) for _ in range(3)} | {"a", "b", pieces.SPACE})
    small = pieces.Vocabulary([(f"<0x{b:02X}>", 0.0, "byte") for b in range(256)] + [(p, -r.randrange(1, 9) / 2, "piece") for p in named])
    sums = lambda ps: sum(round(small.pieces[small.ids[p]][1] * 1000) for p in ps)
    for _ in range(40):
        text = "".join(r.choice("ab ") for _ in range(r.randrange(1, 9)))
        s = small.mask(text)
        cuts = [[s[a:b] for a, b in zip((0, *c), (*c, len(s)), strict=True)] for k in range(len(s)) for c in itertools.combinations(range(1, len(s)), k)]
        best = max(sums(c) for c in cuts if all(p in small.ids for p in c))
        got = [small.pieces[i][0] for i in small.encode(text)]
        assert "".join(got) == s and sums(got) == best


def test_words_forgotten_and_met_again(vocabulary):
    r = random.Random(2)
    few = pieces.Vocabulary(vocabulary.pieces)
    few.memo.most = 20
    for _ in range(30):
        texts = [" ".join("".join(r.choice("aeioé𝔘 日tn") for _ in range(r.randrange(1, 6))) for _ in range(8)) for _ in range(3)]
        ids, counts = few.encode_texts(texts)
        assert [list(x) for x in np.split(ids, np.cumsum(counts)[:-1])] == [vocabulary.encode(t) for t in texts]
        assert few.decode_all(ids, counts) == texts


def test_encoding_in_spark(spark, vocabulary):
    from pyspark.sql import functions as F

    docs = frame(spark, [*ODD, "giant text, " * 50])
    rows = pieces.decode(pieces.encode(docs, vocabulary, F.col("doc_id"), giant=100, chunk=64), vocabulary).collect()
    assert {r.doc_id: r.decoded for r in rows} == {i: t or "" for i, t in enumerate([*ODD, "giant text, " * 50])}
    assert {r.doc_id: r.ids for r in rows} == {i: vocabulary.encode(t) for i, t in enumerate([*ODD, "giant text, " * 50])}
    both = pieces.encode(docs, vocabulary, F.col("doc_id"), giant=100, chunk=64, decoded="back").collect()
    assert {r.doc_id: (r.ids, r.back) for r in both} == {r.doc_id: (r.ids, r.decoded) for r in rows}
    with pytest.raises(ValueError):
        pieces.encode(docs, vocabulary, F.col("doc_id").alias("ids"))
    assert pieces.encode(docs.where("false"), vocabulary, F.col("doc_id").alias("row")).collect() == []
    none = spark.createDataFrame([(1, None), (2, [None, -5, 10**6]), (3, [])], "row long, ids array<int>")
    assert [r.decoded for r in pieces.decode(none, vocabulary).orderBy("row").collect()] == ["", "", ""]


def test_many_chunks_in_several_levels(spark, vocabulary, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(pieces, "FAN", 3)
    texts = ["no gaps at all".replace(" ", "") * 60, "some words, some " * 40 + "x" * 300, "short"]
    got = pieces.encode(frame(spark, texts), vocabulary, F.col("doc_id"), giant=50, chunk=32).collect()
    assert {r.doc_id: r.ids for r in got} == {i: vocabulary.encode(t) for i, t in enumerate(texts)}


# language


def test_kneser_ney_sums_to_one():
    texts = ["abracadabra", "banana band", "cabana"]
    keys, _ = langid.keys_of(texts)
    model = langid.Model(["x"], [np.unique(keys, return_counts=True)])
    letters = np.unique(keys & np.uint64(0xFFFF))
    for context in np.unique(keys >> np.uint64(16))[:10]:
        p = np.exp(model._log((context << np.uint64(16)) | letters, 4)).sum()
        assert 0.8 < p <= 1.0001  # the rest is for letters never seen


def test_hash_array_finds_all():
    keys = np.random.default_rng(0).integers(0, 1 << 62, 5000).astype(np.uint64)
    table = langid.HashArray(keys)
    at = table.find(keys)
    assert (table.hashes[at] == langid.mix(keys)).all() and (table.find(keys + np.uint64(1)) == -1).all()


def test_rare_grams_of_large_languages_stay(spark):
    rows = spark.range(600).selectExpr("'l' as lang", "repeat('common words of it ', 200) as text").unionByName(spark.sql("select 'l' as lang, 'xyzq' as text"))
    model = langid.train(rows, sample=10)
    keys, _ = langid.keys_of(["xyzq"])
    assert (model.tables[langid.ORDER - 1][0].find(keys) >= 0).all()


def test_copies_of_a_text_do_not_flood_calibration(spark, monkeypatch):
    rows = spark.range(4000).selectExpr("'l' as lang", "'one and the same text' as text")
    seen = []
    monkeypatch.setattr(np, "quantile", lambda own, q: seen.append(len(own)) or 0.0)
    langid.train(rows, sample=400)
    assert seen and 200 < seen[0] < 600


def plain_kneser_ney(texts, alphabet):
    """Probability of a character after three others, by recursion over counts in dictionaries."""
    grams = {4: defaultdict(int)}
    for t in texts:
        s = "   " + re.sub(r"[\W\d_]+", " ", t.lower())
        for i in range(3, len(s)):
            grams[4][s[i - 3 : i + 1]] += 1
    for n in (3, 2, 1):
        grams[n] = defaultdict(int)
        for g in grams[n + 1]:
            grams[n][g[1:]] += 1
    cut = {n: langid.discount(sum(c == 1 for c in g.values()), sum(c == 2 for c in g.values())) for n, g in grams.items()}

    def p(g):
        if not g:
            return 1 / (alphabet + 1)
        table = grams[len(g)]
        after = {k: c for k, c in table.items() if k[:-1] == g[:-1]}
        total = sum(after.values())
        return p(g[1:]) if not total else max(table.get(g, 0) - cut[len(g)], 0) / total + cut[len(g)] * len(after) / total * p(g[1:])

    return p


def test_entropies_equal_plain_kneser_ney_in_both_ways(spark, monkeypatch):
    of = {"aa": ["abracadabra", "Banana-band 7", "a cabana"], "bb": ["the other one", "then, others"]}
    counts = [np.unique(langid.keys_of(t)[0], return_counts=True) for t in of.values()]
    alphabet = len({c for ts in of.values() for t in ts for c in re.sub(r"[\W\d_]+", " ", t.lower())})
    plain = [plain_kneser_ney(t, alphabet) for t in of.values()]
    tests = ["banana", "other cab", "zzz", "The q", "", "12 !", None]
    want = []
    for t in tests:
        s = "   " + re.sub(r"[\W\d_]+", " ", (t or "").lower())
        has = bool(s.strip())
        want.append([-sum(np.log(p(s[i - 3 : i + 1])) for i in range(3, len(s))) / (len(s) - 3) if has else 0.0 for p in plain])
    small = langid.Model(list(of), counts)
    assert np.allclose(small.entropies(tests)[0], want, rtol=1e-5)
    rows = [(k, int(g), int(n)) for k, (gs, ns) in zip(of, counts, strict=True) for g, n in zip(gs.view(np.int64), ns, strict=True)]
    large = langid.Joined(list(of), spark.createDataFrame(rows, "lang string, gram long, n long"))
    got = {r.row: r.h for r in large.table(spark.createDataFrame(list(enumerate(tests)), "row long, text string")).collect()}
    assert set(got) == {0, 1, 2, 3} and all(np.allclose(got[i], want[i], rtol=1e-9) for i in got)


def test_broadcast_and_joined_models_predict_alike(spark):
    r = random.Random(9)
    texts = [" ".join("".join(r.choice(p) for _ in range(4)) for _ in range(9)) for p in ("abcde", "cdefg", "efghi") for _ in range(60)]
    docs = frame(spark, [*texts, *ODD], lang=["xyz"[i // 60] for i in range(180)] + [None] * len(ODD), row=["r"] * (180 + len(ODD)), score=["s"] * (180 + len(ODD)))
    both = []
    for cells in (langid.CELLS, 0):
        model = langid.train(docs, id_col="doc_id", cells=cells)
        assert isinstance(model, langid.Joined) == (cells == 0)
        got = langid.identify(docs.unionByName(docs.where("doc_id = 3")), model, keep=(F.col("doc_id"), F.col("row")))
        assert got.columns == ["doc_id", "row", "lang_pred", "score", "rejected"] and langid.identify(docs.limit(0), model).count() == 0
        both.append(sorted(got.collect()))
    assert len(both[0]) == len(both[1]) == 181 + len(ODD)
    for a, b in zip(*both, strict=True):
        assert (a.doc_id, a.lang_pred, a.rejected) == (b.doc_id, b.lang_pred, b.rejected) and abs(a.score - b.score) < 1e-4


def test_language_of_held_out_documents(spark):
    r = random.Random(2)
    make = lambda parts: " ".join("".join(r.choice(parts) for _ in range(3)) for _ in range(20))
    texts = [make(["the", "ing", "and"] if i % 2 else ["der", "ich", "ung"]) for i in range(120)]
    docs = frame(spark, [*texts, *ODD], lang=["en" if i % 2 else "de" for i in range(120)] + [None] * len(ODD))
    model = langid.train(docs.where("doc_id < 80"))
    from pyspark.sql import functions as F

    got = {x.doc_id: x for x in langid.identify(docs, model, keep=(F.col("doc_id"),)).collect()}
    assert all(got[i].lang_pred == ("en" if i % 2 else "de") for i in range(80, 120)) and all(0 <= x.score <= 1 for x in got.values())
    assert got[120].lang_pred == got[121].lang_pred == "und" and len(got) == len(texts) + len(ODD)
    empty = langid.train(docs.limit(0))
    assert langid.identify(docs, empty, keep=(F.col("doc_id"),)).where("lang_pred <> 'und'").count() == 0


# classifiers


def test_dual_descent_separates():
    r = np.random.default_rng(0)
    rows = [np.array([0, 2 + k % 3]) if k % 2 else np.array([1, 2 + k % 3]) for k in range(60)]
    y = np.array([1.0 if k % 2 else -1.0 for k in range(60)])
    for logistic in (False, True):
        w, b, _ = linear.descend(rows, np.ones(5), y, np.ones(60), logistic=logistic, rounds=50)
        assert all(np.sign(w[x].sum() + b) == t for x, t in zip(rows, y, strict=True))
    del r


@pytest.mark.parametrize("logistic", [False, True])
def test_dual_descent_reaches_the_minimum(logistic):
    r = np.random.default_rng(3)
    rows = [np.flatnonzero(r.random(12) < 0.4) for _ in range(80)]
    y, values = np.where(r.random(80) < 0.4, 1.0, -1.0), r.normal(size=12)
    cost = np.where(y > 0, 1.5, 0.7)
    w, b, alpha = linear.descend(rows, values, y, cost, logistic=logistic)
    x = np.zeros((80, 13))
    for i, own in enumerate(rows):
        x[i, own], x[i, 12] = values[own], 1
    z = (y[:, None] * x) @ np.append(w, b)
    primal = (w @ w + b * b) / 2 + (cost * (np.logaddexp(0, -z) if logistic else np.maximum(0, 1 - z))).sum()
    u = (alpha * y) @ x
    entropy = (alpha * np.log(alpha / cost) + (cost - alpha) * np.log1p(-alpha / cost)).sum() if logistic else -alpha.sum()
    dual = -(u @ u) / 2 - entropy  # the least value of the one is the greatest of the other
    assert np.allclose(u, np.append(w, b)) and 0 <= primal - dual < 2e-3 * abs(primal)
    again = linear.descend(rows, values, y, cost, logistic=logistic, start=alpha, seed=5)[0]
    assert np.allclose(again, w, atol=2e-2)


def test_features_equal_plain_counts(spark):
    r = random.Random(6)
    words = ["table", "river", "stone", "cloud", "green", "Loud!!"]
    rows = [(" ".join(r.choice(words[k % 2 : 4 + k % 3]) for _ in range(9)), k % 2) for k in range(60)]
    size, n = np.array([30, 30]), defaultdict(lambda: [0, 0])
    for t, label in rows:
        for c in set(quality.cells([t])[1].tolist()):
            n[c][label] += 1
    want = {}
    for c, (bad, good) in n.items():
        sd = ((bad + good) * 0.25 * (1 - (bad + good) / 61)) ** 0.5
        if bad + good >= 3 and abs(good - (bad + good) / 2) / max(sd, 1e-9**0.5) >= linear.CLEARLY:
            want[c] = np.log((good + 1) / 32) - np.log((bad + 1) / 32)
    chosen, ratio = linear.features(spark.createDataFrame(rows, "text string, y int").repartition(3), quality.cells, size, 3)
    assert dict(zip(chosen.tolist(), ratio.tolist(), strict=True)) == pytest.approx(want) and want


@pytest.mark.parametrize("module", [toxicity, quality])
def test_classifier_learns_and_takes_odd_texts(spark, module):
    r = random.Random(4)
    words = ["table", "river", "stone", "cloud", "green"]
    texts = [" ".join(r.choice(words) for _ in range(30)) + (" you vile scumbag SHOUT!! SHOUT!!" if i % 3 == 0 else "") for i in range(200)]
    docs = frame(spark, [*texts, *ODD])
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(150)], "doc_id long, y int")
    from pyspark.sql import functions as F

    model = module.train(docs.where("doc_id < 150"), labels, label_col="y")
    got = {x.doc_id: x for x in module.score(docs, model, F.col("doc_id"), at=0.5).collect()}
    assert all(got[i].predicted == int(i % 3 == 0) for i in range(150, 200))
    assert len(got) == len(texts) + len(ODD) and all(0 <= x.score <= 1 for x in got.values())
    assert module.score(docs.limit(0), model, F.col("doc_id")).count() == 0
    clash = docs.where("doc_id < 2").select("doc_id", "text", F.lit("x").alias("score_of"), F.lit(1).alias("y"), F.lit("z").alias("row"))
    assert module.score(clash, model, F.col("doc_id"), F.col("row")).columns == ["doc_id", "row", "score", "predicted"]
    assert module.train(docs.limit(0), labels, label_col="y").margins(["a b c"]).tolist() == [0.0]
    none = module.train(docs, labels.limit(0), label_col="y")
    assert 0 < module.score(docs, none, F.col("doc_id")).first().score < 1


def test_each_of_many_expressions_counts(spark):
    word = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(4))
    r, n = random.Random(5), 4500  # of 9,000 words, 4,500 stand in bad texts only, each in 12 of them
    texts, of = [], []
    for label in (0, 1):
        places = [2 * i + label for i in range(n) for _ in range(12)]
        r.shuffle(places)
        for a in range(0, len(places), 30):
            texts.append(" ".join(word(37 * i) for i in places[a : a + 30]))
            of.append(label)
    labels = spark.createDataFrame(list(enumerate(of)), "doc_id long, quality int")
    model = quality.train(frame(spark, texts), labels)
    got = model.margins([word(37 * i) for i in range(2 * n)]) - model.bias
    assert np.mean(got != 0) > 0.95


def test_cells_of_one_text_do_not_depend_on_its_neighbours():
    for module in (toxicity, quality):
        texts = ["One two!!", "", "three", None, "four FIVE five"]
        by = defaultdict(set)
        for d, c in zip(*module.cells(texts), strict=True):
            by[int(d)].add(int(c))
        for i, t in enumerate(texts):
            assert by[i] == set(module.cells([t])[1].tolist())


def test_an_index_grows_with_its_block(spark):
    import tracemalloc

    r = np.random.default_rng(4)
    words = np.array([f"w{i}".encode() for i in range(20_000)])
    items = [(str(k), b" ".join(words[r.integers(0, len(words), 150)])) for k in range(2_000)]
    shard = [b" ".join(words[r.integers(0, len(words), 300)]) + b" " + items[k][1] for k in range(50)]
    sizes, peaks = [], []
    for n in (1_000, 2_000):
        tracemalloc.start()
        index = decontaminate.TestSuffixes(items[:n])
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        sizes.append(index.nbytes())
        assert index.nbytes() <= decontaminate.WORD_BYTES * (len(index.flat) + len(index.vocab))
        assert [f[3] for f in index.search(shard)] == [[str(k)] for k in range(50)]
    assert sizes[1] <= 2.1 * sizes[0] and peaks[1] <= 2.2 * peaks[0] and peaks[1] <= 6 * sizes[1]
    bench = spark.createDataFrame([(k, t.decode()) for k, t in items], "item_id string, text string")
    assert len(decontaminate.blocks_of(bench, "item_id", "text", decontaminate.BLOCK_BYTES)) == 1
    assert len(decontaminate.blocks_of(bench, "item_id", "text", 4 << 20)) == 1 + 2_000 * (150 * decontaminate.WORD_BYTES + 64) // (4 << 20)


def test_text_without_white_space_is_no_dearer():
    import random
    import time

    v, r = pieces.load(), random.Random(1)
    prose = " ".join("".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 9))) for _ in range(200_000))[:1_000_000]
    ideographs = "".join(chr(r.randint(0x4E00, 0x9FFF)) for _ in range(1_000_000))
    packed = "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(1_000_000))
    times = []
    for text in (prose, ideographs, packed):
        start = time.process_time()
        ids, counts = v.encode_texts([text])
        times.append(time.process_time() - start)
        assert v.decode_all(ids, counts) == [text]
        own = text[:3000]
        assert v.encode(own) == v.solve(v.mask(own), 0, len(own) + 1)[0]
        s = v.mask(text)[:16_384 + v.longest - 1]
        start = time.process_time()
        matrix, first, last, _ = v.transfer(s, 16_384, 0)
        assert first >= 0 and last > 16_000 and time.process_time() - start < 1.0 and len(matrix) <= v.longest**2
    assert max(times[1:]) <= 5 * times[0]
