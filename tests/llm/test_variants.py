"""Spelling variants, whitening and Grace hashing against plain versions."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import gracehash, queries, spelling, whitening
from tests.llm.helpers import awkward, clashing, nothing, plain

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


# --- spelling ---------------------------------------------------------------------------------


def slow_words(docs):
    counts = Counter()
    for own, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{own}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2 and len(w) >= 7}


def slow_near(words):
    """Words that share a form with one code point left out; equal lengths must agree on its place."""
    holes = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i] + w[i + 1 :]].add((w, i))
    near = defaultdict(set)
    for short, group in holes.items():
        if short in words:
            for w, _ in group:
                near[w].add(short)
                near[short].add(w)
        by_place = defaultdict(set)
        for w, i in group:
            by_place[i].add(w)
        for same in by_place.values():
            for w in same:
                near[w] |= same - {w}
    return near


def slow_variants(docs):
    words = slow_words(docs)
    near = slow_near(words)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def test_op11(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = slow_variants(docs)
    assert rows_of(queries.op11_spelling(spark, SF)) == want
    assert any(r[1] for r in want)


@pytest.mark.parametrize("alphabet, seed, few", [("ab", 1, 3), ("abcdefgh", 2, 1), ("aéz÷", 3, 256)])
def test_neighbours_of_crowded_words(spark, alphabet, seed, few):
    """Few letters: words with very many neighbours, shared prefixes, words that are prefixes of others."""
    dice = random.Random(seed)
    words = {"".join(dice.choice(alphabet) for _ in range(dice.randint(7, 10))) for _ in range(400)}
    words |= {w + dice.choice(alphabet) for w in list(words)[:80]} | {"a" * n for n in range(7, 12)}
    near = slow_near(words)
    got = spelling.neighbours(spark.createDataFrame([(w,) for w in words], "word string").repartition(5), few).collect()
    assert sorted(map(tuple, got)) == sorted((w, v) for w in near for v in near[w])


@pytest.mark.parametrize("few", [1, 256])
def test_walks_look_for_each_pair_from_one_side(spark, few):
    dice = random.Random(6)
    words = {"".join(dice.choice("abé") for _ in range(dice.randint(7, 9))) for _ in range(300)}
    paths = spelling.oriented(spark.createDataFrame([(w,) for w in words], "word string")).cache()
    half = F.floor((F.length("path") - 1) / 2).cast("int") + 1
    frontier = paths.select("path", half.alias("position"), F.xxhash64(F.substring("path", F.lit(1), half)).alias("node"))
    found = spelling._advance(frontier, spelling.edges(paths, few)).where("near is not null").collect()
    assert found and all((len(r.path), r.path) < (len(r.near), r.near) for r in found)


def test_very_long_words_take_few_levels(spark):
    dice = random.Random(4)
    base = "".join(dice.choice("abcdefgh") for _ in range(60_000))
    words = [base, base[:50_000] + "X" + base[50_001:], base[1:], base[:-1], base + "z", base[:30_000] + "yz" + base[30_002:]]
    got = spelling.neighbours(spark.createDataFrame([(w,) for w in words], "word string")).collect()
    at = {w: i for i, w in enumerate(words)}
    assert sorted((at[r.word], at[r.near]) for r in got) == [(0, 1), (0, 2), (0, 3), (0, 4), (1, 0), (2, 0), (3, 0), (4, 0)]


def test_chains_of_forms(spark):
    text = " ".join(["variant"] * 2000 + ["variants"] * 200 + ["variantsx"] * 20 + ["variantsxy"] * 2 + ["varianty"] * 200)
    got = {r.word: (r.form, r.root, r.form_n) for r in spelling.variants(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()}
    if zlib.crc32(b"1:variant") % 31 and zlib.crc32(b"1:variants") % 31 and zlib.crc32(b"1:variantsx") % 31 and zlib.crc32(b"1:variantsxy") % 31:
        assert got["variantsxy"] == ("variantsx", "variant", 20)
        assert got["variants"] == ("variant", "variant", 2000) and got["variant"] == (None, "variant", None)


def test_awkward_texts(spark):
    rows = rows_of(spelling.variants(awkward(spark)))
    assert rows == slow_variants([("" if r.doc_id is None else r.doc_id, r.text) for r in awkward(spark).collect()])
    assert rows_of(spelling.variants(clashing(spark))) == rows
    assert spelling.variants(nothing(spark)).count() == 0


# --- whitening --------------------------------------------------------------------------------


def slow_whiten(vectors):
    x = {tuple(int(np.floor(np.float64(c) * 64)) + 1_000_000 for c in v) for v in vectors}
    fit = sorted(x)
    n, dims = len(fit), len(fit[0])
    sums = [sum(v[i] for v in fit) for i in range(dims)]
    exact = [[Fraction(n * sum(v[i] * v[j] for v in fit) - sums[i] * sums[j], n * n) for j in range(dims)] for i in range(dims)]
    values, basis = np.linalg.eigh(np.array([[float(c) for c in row] for row in exact]))
    return n, sums, values[::-1], basis[:, ::-1], float(sum(exact[i][i] for i in range(dims)))


def check_whitened(rows, held, fit=(), most=16):
    """Rows by id against the plain version; components up to sign. ``fit`` are further rows of the fit list."""
    n, sums, values, basis, trace = slow_whiten([v for _, v in [*held, *fit]])
    found = defaultdict(list)
    for r in rows:
        found[r.vec_id].append(r)
    used = min(most, len(values))
    signs = {}
    for own, vector in held:
        x = [int(np.floor(np.float64(c) * 64)) + 1_000_000 for c in vector]
        away = [n * a - s for a, s in zip(x, sums, strict=True)]
        mine = sorted(found[own], key=lambda r: r.component)
        assert [r.component for r in mine] == list(range(1, used + 1))
        for k, r in enumerate(mine):
            want = float(np.dot([a / n for a in away], basis[:, k])) / values[k] ** 0.5
            signs.setdefault(k, np.sign(want * r.whitened))
            assert abs(r.whitened * signs[k] - want) < 1e-6
            assert (r.n, r.deviation, r.deviation_digits) == (n, sum(a * a for a in away), str(sum(a * a for a in away)))
            assert abs(r.explained - values[k] / trace) < 1e-9 and r.identity_error < 1e-9


def test_op12(spark):
    held = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check_whitened(queries.op12_whitening(spark, SF).collect(), held)


def test_sums_are_exact_for_any_long():
    dice = np.random.default_rng(5)
    rows = np.vstack([dice.integers(-(2**61), 2**61, (70, 3)), [[2**62 - 1, -(2**62), 0]]])
    rows = np.hstack([rows, dice.integers(-40, 40, (71, 2)), np.full((71, 1), 7)])
    sums, products = whitening.cross_products(rows)
    exact = [[int(v) for v in r] for r in rows]
    assert list(sums) == [sum(r[i] for r in exact) for i in range(6)]
    assert all(products[i, j] == sum(r[i] * r[j] for r in exact) for i in range(6) for j in range(i, 6))
    assert np.array_equal(whitening.decode(whitening.encode(rows), 6), rows)
    for value in (0, 1, -1, 2**200 + 3, -(2**130) - 5):
        assert sum(int(v) << 60 * k for k, v in enumerate(whitening._limbs(value))) == value


def test_sums_of_many_tasks(spark):
    dice = np.random.default_rng(6)
    vectors = [v.tolist() for v in dice.normal(0, 0.2, (3000, 5))] + [[1e12, -1e12, 0.5, 3.0, -2.0]]
    frame = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>").repartition(7)
    rows, dims = whitening._usable(frame, "vec_id", "embedding")
    count, sums, products = whitening.totals(whitening.fit_list(rows, dims), dims)
    z = [[int(np.floor(c * 64)) for c in v] for v in {tuple(np.floor(np.array(v) * 64) / 64) for v in vectors}]
    assert count == len(z) and list(sums) == [sum(v[i] for v in z) for i in range(5)]
    assert all(products[i, j] == sum(v[i] * v[j] for v in z) for i in range(5) for j in range(5))


def test_vectors_of_every_kind(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(v) for v in np.random.default_rng(i).normal(0, 1, 3)]) for i in range(40)]
    odd = [(100, None), (101, [nan, 1.0, 1.0]), (102, [inf, 1.0, 1.0]), (103, [None, 1.0, 1.0]), (104, [1.0, 2.0]), (105, []), (106, [1e300, 0.0, 0.0])]
    again = [(0, good[0][1]), (None, good[1][1]), (200, good[2][1])]
    schema = "vec_id long, embedding array<double>"
    frame = spark.createDataFrame(good + odd + again, schema)
    rows = whitening.whiten(frame).collect()
    assert Counter(r.vec_id for r in rows) == Counter({**{i: 3 for i, _ in good}, 0: 6, None: 3, 200: 3})
    check_whitened([r for r in rows if r.vec_id not in (0, None)], [h for h in good if h[0]] + [(200, good[2][1])], fit=good)
    wide = frame.selectExpr("*", "1 AS id", "2 AS vector", "3 AS key", "4 AS component", "5 AS white", "6 AS at", "7 AS n")
    assert plain(whitening.whiten(wide).collect()) == plain(rows)
    assert whitening.whiten(frame.limit(0)).count() == 0
    alone = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)
    assert whitening.whiten(alone).count() == 0
    flat = spark.createDataFrame([(i, [float(i), 5.0]) for i in range(9)], schema)
    assert {r.component for r in whitening.whiten(flat).collect()} == {1}
    huge = whitening.whiten(spark.createDataFrame([(1, [1e15]), (2, [-1e15]), (3, [0.0])], schema)).collect()
    assert {r.vec_id: (r.deviation, r.deviation_digits) for r in huge}[1] == (None, str((3 * 64 * 10**15) ** 2))


# --- exact dedup ------------------------------------------------------------------------------


def slow_groups(held):
    groups = defaultdict(list)
    for own, text in held:
        groups[re.sub("[\x20\x09-\x0D]+", " ", text or "")].append(own)
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        stays = ids.index(keep)
        out += [(i, keep, len(ids), k == stays, digest) for k, i in enumerate(ids)]
    return sorted(out, key=str)


def grouped(frame, **more):
    rows = gracehash.exact_groups(frame, **more).collect()
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.sha).hex()) for r in rows), key=str)


@pytest.mark.parametrize("more", [{}, {"table_bytes": 2000}, {"table_bytes": 700, "fanout": 3}])
def test_grace_hashing_at_every_table_size(spark, more):
    """Small tables close early: records are spilled, dealt anew, and parted into portions."""
    dice = random.Random(7)
    texts = ["", None, " ", "\n\t", "a", "a ", " a", "a  b", "a\tb", "a b", "naïve   x", "naïve    x", "y" * 5000]
    texts += [f"text  {dice.randint(0, 60)}\n end" for _ in range(300)] + ["copy"] * 200 + ["x\n" * 900] * 2
    held = [(i if dice.random() < 0.97 else None, t) for i, t in enumerate(texts)]
    held.sort(key=lambda r: (r[0] is None, r[0] or 0))
    frame = spark.createDataFrame(held, "doc_id long, text string").repartition(6)
    got = grouped(frame, **more)
    assert [(*r[:3], r[4]) for r in got if r[0] is not None] == [(*r[:3], r[4]) for r in slow_groups(held) if r[0] is not None]
    assert sum(r[3] for r in got) == len({r[4] for r in got}) and all(r[0] == r[1] for r in got if r[3])


def test_grace_hashing_of_awkward_rows(spark):
    rows = grouped(awkward(spark))
    assert sorted((*r[:3], r[4]) for r in rows if r[0]) == sorted((*r[:3], r[4]) for r in slow_groups([(r.doc_id, r.text) for r in awkward(spark).collect()]) if r[0])
    assert sum(r[3] for r in rows) == len({r[4] for r in rows})
    assert grouped(clashing(spark)) == rows
    assert gracehash.exact_groups(nothing(spark)).count() == 0
    named = spark.createDataFrame([("b", "t"), ("a", "t")], "doc_id string, text string")
    assert [r[:4] for r in grouped(named)] == [("a", "a", 2, True), ("b", "a", 2, False)]


def test_table_probes_past_equal_hashes():
    table = gracehash.Table(1000)
    assert [table.find(5, b"x"), table.find(5, b"y"), table.find(5, b"x"), table.find(1029, b"y")] == [0, 1, 0, 2]
    assert table.find(7, b"z" * 2000) == 3 and table.closed and table.find(8, b"w") == -1 and table.find(5, b"y") == 1
    many = gracehash.Table(1 << 30)
    assert [many.find(k % 7, b"%d" % k) for k in range(3000)] == list(range(3000)) == [many.find(k % 7, b"%d" % k) for k in range(3000)]
