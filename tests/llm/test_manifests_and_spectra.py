"""Merkle manifest, Lempel-Ziv fingerprints and whitening, each against a plain version, with odd rows."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orefold.llm import lempelziv, merkle, queries, whitening
from tests import sqlcheck

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# merkle


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves):
    """Levels of digests, the leaves first."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i : i + 2])) for i in range(0, len(last), 2)])
    return levels


def siblings(levels, at):
    out = []
    for level in levels[:-1]:
        other = at ^ 1
        out.append((level[other] if at % 2 else "", level[other] if at % 2 == 0 and other < len(level) else ""))
        at //= 2
    return out


def plain_manifest(docs):
    """(leaf, subroot, root, path) of each document, in the order of groups and leaves."""
    groups = {}
    for d in docs:
        i, text, lang, source, n = d
        groups.setdefault(lang, []).append((i is not None, i or 0, h("".join(encoded(v) for v in (i, source, lang, n, text))), d))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in order]
    top = tree([t[-1][0] for t in trees])
    out = []
    for k, g in enumerate(order):
        for at, x in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            out.append((x[3], x[2], trees[k][-1][0], top[-1][0], siblings(trees[k], at) + siblings(top, k)))
    return out


ODD = [(None, "a", None, "s", 1), (None, "b", None, "s", None), (7, None, "", None, None), (7, None, "", None, None), (8, "", "é", "", 0), (9, "ä€", "z", "s", 9223372036854775807)]


def proved(spark, docs, more=""):
    df = spark.createDataFrame([(*d, *([1, 2] if more else [])) for d in docs], DOCS + more)
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    return merkle.build(df, fields, F.col("lang"), F.col("doc_id"), doc_id=F.col("doc_id"))


@pytest.mark.parametrize("n", [0, 1, 2, 257, 700])
def test_manifest_equals_plain_trees(spark, n):
    docs = ODD[: n and len(ODD)] + [(i * 3 % 1000, f"text {i}", "en" if i % 10 else "fr", None, i) for i in range(n)]
    m = proved(spark, docs, ", at int, leaf int" if n == 2 else "")
    got = merkle.prove(m).select("doc_id", "leaf", "reached", "subroot", "root", "path", merkle.folded(F.col("leaf"), F.col("path")).alias("fold")).collect()
    assert all(r.leaf == r.reached and r.fold == r.root for r in got)
    want = [] if not docs else plain_manifest(docs)
    key = lambda x: (str(x[0]), x[1], x[2], x[3], tuple(x[4]))
    assert sorted([(r.doc_id, r.leaf, r.subroot, r.root, [tuple(s) for s in r.path]) for r in got], key=key) == sorted([(d[0], *rest) for d, *rest in want], key=key)


def test_records_lead_from_the_root_to_every_leaf(spark):
    docs = [(i, f"t{i % 50}", "en", None, None) for i in range(300)]
    m = proved(spark, docs)
    children = {r.digest: r.children for r in m.records().collect()}
    assert all(h("".join(c)) == k for k, c in children.items())
    reached, todo = [], [m.groups.first().head]
    while todo:
        now = todo.pop()
        if now in children:
            todo.extend(reversed(children[now]))
        else:
            reached.append(now)
    assert reached == [r.leaf for r in m.leaves.sort("at").collect()]


def test_requests_for_single_leaves(spark):
    docs = [(i, f"t{i}", "en" if i % 3 else "fr", None, None) for i in range(1000)]
    m = proved(spark, docs)
    asked = m.leaves.where("doc_id in (0, 1, 999, 500)").select("group", "at", F.col("doc_id").alias("which"))
    got = {r.which: r.reached for r in merkle.prove(m, asked).collect()}
    assert got == {r.doc_id: r.leaf for r in m.leaves.collect() if r.doc_id in (0, 1, 999, 500)}


def test_manifest_query_equals_sql_and_finds_what_was_changed(spark, data, tmp_path):
    sqlcheck.assert_equal(queries.op13_merkle_manifest(spark, data), sqlcheck.connect(data), queries.OP13_SQL)
    docs = [*ODD] + [(i, "x", "en", "s", i if i % 2 else None) for i in range(40)]
    spark.createDataFrame(docs, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op13_merkle_manifest(spark, str(tmp_path)).collect()
    chosen = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 0
    numbers = {d[0]: d[4] for d in docs}
    assert {r.doc_id for r in got if not r.verified} == {i for i, n in numbers.items() if chosen(i) and n is not None}
    want = {(d[0], leaf): h("".join(a + b for a, b in path)) for d, leaf, _, _, path in plain_manifest(docs)}
    assert {(r.doc_id, r.leaf) for r in got} == set(want) and all(r.proof_sha256 == want[r.doc_id, r.leaf] for r in got if r.doc_id not in (None, 7))


# lempel-ziv


def plain_phrases(text):
    seen, out, start = set(), [], 0
    while start < len(text):
        end = start + 1
        while end < len(text) and text[start:end] in seen:
            end += 1
        seen.add(text[start:end])
        out.append(text[start:end])
        start = end
    return out


def plain_print(text, size=lempelziv.SIZE):
    values = {int(lempelziv.hashes("<" + p, np.array([1]), np.array([len(p) + 1]))[0]) for p in plain_phrases(text)}
    return np.array(sorted(values)[:size], np.uint32)


@settings(deadline=None, max_examples=150)
@given(st.text("abé", max_size=80), st.text("ab", max_size=40), st.sampled_from([3, 128]))
def test_fingerprints_equal_plain_parsing(text, tail, size):
    now = lempelziv.Parsed(text, len(text) - len(text) // 3, size)
    assert now.print.tolist() == plain_print(text, size).tolist()
    edited, made = now.edited(tail)
    assert edited == text[: len(text) - len(text) // 3] + tail and made.tolist() == plain_print(edited, size).tolist()


def test_likeness():
    a, b = np.arange(0, 20, 2, dtype=np.uint32), np.arange(0, 20, 4, dtype=np.uint32)
    none = np.zeros(0, np.uint32)
    assert lempelziv.likeness(a, b) == 0.5 and lempelziv.likeness(a, a) == 1 and lempelziv.likeness(none, none) == 1 and lempelziv.likeness(a, none) == 0
    assert lempelziv.likeness(a, b, 3) == len({0, 4} & set(a[:3].tolist())) / 3
    rng = np.random.default_rng(3)
    big = rng.integers(0, 1 << 32, 6000, dtype=np.uint32)
    assert abs(lempelziv.likeness(lempelziv.least(big[:4000]), lempelziv.least(big[2000:])) - 1 / 3) < 0.13
    assert lempelziv.read(lempelziv.shown(a)).tolist() == a.tolist()


def plain_neighbours(rows):
    """{row: (edited sha, prints...)} for distinct (id, text)."""
    import hashlib as _h

    out = {}
    for k, (i, t) in enumerate(rows):
        t, n = t or "", rows[(k + 1) % len(rows)][1] or ""
        edited = t[: len(t) - len(t) // 3] + n[: len(t) // 3]
        p = [plain_print(x) for x in (t, edited, n)]
        out[i, t] = (len(t), _h.sha256(edited.encode()).hexdigest(), lempelziv.shown(p[0]), lempelziv.shown(p[1]), lempelziv.likeness(p[0], p[1]), lempelziv.likeness(p[0], p[2]))
    return out


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_next_documents_equal_a_sorted_list(spark, block):
    texts = ["", None, "a", "ab ab ab", "the cat sat on the mat " * 40, "é€" * 7, "the cat sat on the mat " * 40]
    rows = [(i, texts[i % len(texts)]) for i in range(40)]
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], "doc_id long, text string, `order` string, block int").repartition(3)
    got = lempelziv.with_next(df, block=block).collect()
    want = plain_neighbours(rows[::-1])
    assert len(got) == 40 and {(r.doc_id, r.n_chars): tuple(r)[1:] for r in got} == {(i, len(t)): v for (i, t), v in want.items()}
    assert all(r.near_edited == 1 for r in got if r.n_chars < 3)


def test_odd_neighbours(spark):
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    assert lempelziv.with_next(frame([])).count() == 0
    one = lempelziv.with_next(frame([(5, "abcabc")])).first()
    assert one.near_next == 1 and one.edited_sha256 == h("abcaab")
    same = lempelziv.with_next(frame([(1, "xyz")] * 6 + [(None, "q"), (None, "r")]), block=2).collect()
    assert len(same) == 8 and sorted(r.n_chars for r in same) == [1, 1, 3, 3, 3, 3, 3, 3]
    texts = lempelziv.fingerprints(frame([(1, None), (2, "aab")]), F.col("doc_id")).collect()
    assert {r.doc_id: r.fingerprint for r in texts} == {1: "", 2: lempelziv.shown(plain_print("aab"))}


def test_copies_are_nearer_than_other_texts(spark, data):
    got = queries.op12_lz_fingerprint(spark, data).toPandas()
    assert (got.near_edited > got.near_next).mean() > 0.95 and got.near_edited.between(0, 1).all() and len(got) == 200


# whitening


@settings(deadline=None, max_examples=60)
@given(st.integers(1, 9), st.integers(1, 25), st.sampled_from([1, 3, 40]), st.integers(0, 10**6))
def test_spectra_equal_a_dense_solution(size, n, spread, seed):
    rng = np.random.default_rng(seed)
    x = np.floor(rng.normal(size=(n, size)) * spread)
    whole, a, b = (whitening.Spectrum(size) for _ in range(3))
    for k, r in enumerate(x):
        whole.add(r)
        (a if k % 3 else b).add(r)
    a.merge(b)
    scatter = (x - x.mean(0)).T @ (x - x.mean(0))
    for s in (whole, a):
        assert s.n == n and np.allclose(s.mean, x.mean(0))
        assert np.abs(s.vectors @ np.diag(s.values) @ s.vectors.T - scatter).max() <= 1e-9 * max(1, np.abs(scatter).max())
        assert np.abs(s.vectors.T @ s.vectors - np.eye(size)).max() < 1e-9


def plain_whitening(rows, most=16):
    good = {i: np.floor(64 * np.array(v, float)).astype(int) + 1_000_000 for i, v in rows if v and all(e is not None and np.isfinite(e) for e in v)}
    fit = np.unique(np.array(list(good.values())), axis=0)
    n, total = len(fit), fit.sum(0)
    c = (n * fit - total) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    k = min(most, int((e > 1e-12 * e[0]).sum()))
    return n, {i: (int(sum(int(v) ** 2 for v in n * x - total)), ((n * x - total) / n) @ u[:, :k] / np.sqrt(e[:k])) for i, x in good.items()}, e[:k] / e.sum()


@pytest.mark.parametrize("size, n", [(3, 40), (20, 300), (6, 4)])
def test_whitening_equals_a_dense_solution(spark, size, n, monkeypatch):
    monkeypatch.setattr(whitening, "VECTORS", 20)
    rng = np.random.default_rng(size)
    rows = [(i, (rng.normal(size=size) * np.arange(1, size + 1)).astype(np.float32).tolist()) for i in range(n)]
    rows += [(n, rows[0][1]), (n + 1, None), (n + 2, [1.0, None] + [0.0] * (size - 2)), (n + 3, [float("nan")] * size), (n + 4, [float("inf")] * size), (n + 5, rows[0][1])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, x int, n int")
    got = whitening.components(df, whitening.fit(df, "embedding", scale=64, shift=1_000_000), "embedding", F.col("vec_id")).toPandas()
    count, want, explained = plain_whitening(rows)
    k = len(explained)
    assert len(got) == len(want) * k and set(got.vec_id) == set(want) and (got.n == count).all()
    table = got.pivot(index="vec_id", columns="component", values="whitened")
    for c in range(k):
        mine, his = table[c + 1].to_numpy(), np.array([want[i][1][c] for i in table.index])
        assert np.abs(mine - np.sign(mine @ his) * his).max() < 1e-7
    assert {(i, d) for i, d in zip(got.vec_id, got.deviation, strict=True)} == {(i, v[0]) for i, v in want.items()}
    assert np.allclose(got.groupby("component").explained.first(), explained, rtol=1e-6) and got.identity_error.max() < 1e-8


def test_nothing_to_whiten(spark):
    frame = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for rows in ([], [(1, [1.0, 2.0])] * 3, [(1, None)], [(1, [])]):
        df = frame(rows)
        got = whitening.components(df, whitening.fit(df, "embedding"), "embedding", F.col("vec_id"))
        assert got.count() == 0 and got.columns[0] == "vec_id"
    mixed = frame([(i, [float(i), float(i * i)]) for i in range(5)] + [(9, [1.0, 2.0, 3.0])])
    got = whitening.components(mixed, whitening.fit(mixed, "embedding"), "embedding", F.col("vec_id"))
    assert {r.vec_id for r in got.collect()} == set(range(5))


def test_deviations_beyond_64_bits_are_exact():
    x, total = np.array([[1 << 40, 5], [7, 9]]), np.array([3, 1 << 50])
    assert whitening.deviation(x, 11, total) == [sum((11 * int(v) - int(t)) ** 2 for v, t in zip(r, total, strict=True)) for r in x]
