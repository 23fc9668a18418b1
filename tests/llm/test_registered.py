"""The registered queries on the smallest tables, against SQL or a plain version."""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from sluice.llm import bpe, queries
from tests.llm.test_operators import slow_cut

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def texts(duck):
    return {i: t or "" for i, t in duck.execute("SELECT doc_id, text FROM documents").fetchall()}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    frame = queries.queries()[name](spark, SF)
    columns = sorted(frame.columns)
    cursor = duck.execute(queries.oracle_sql()[name])
    order = sorted(range(len(cursor.description)), key=lambda i: cursor.description[i][0])
    assert [cursor.description[i][0] for i in order] == columns
    want = sorted(repr(tuple(r[i] for i in order)) for r in cursor.fetchall())
    assert sorted(repr(tuple(r)) for r in frame.select(*columns).collect()) == want


def test_op2(spark, texts):
    want = dict(slow_cut([(i, t.encode()) for i, t in texts.items()]))
    for r in queries.op2_suffixes(spark, SF).collect():
        raw = texts[r.doc_id].encode()
        assert (r.n_bytes, r.n_removed) == (len(raw), len(raw) - len(want[r.doc_id]))
        assert r.kept_sha256 == hashlib.sha256(want[r.doc_id]).hexdigest()
        assert (r.n_spans == 0) == (r.n_removed == 0)


def test_op3(spark, texts):
    rows = queries.op3_pii(spark, SF).collect()
    assert len(rows) == len(texts) and any(r.changed for r in rows)
    for r in rows:
        assert r.changed == (r.text != texts[r.doc_id])
        assert not re.search(r"@mail\d|\(\d{3}\) 555-\d{4}.*\(\d{3}\) 555-\d{4}", r.text)


def test_op4_recall(spark, duck):
    found = duck.execute("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall()
    ids = np.array([f[0] for f in found])
    vectors = np.array([f[1] for f in found], np.float32).astype(float)
    got = defaultdict(dict)
    for r in queries.op4_postings(spark, SF).collect():
        got[r.query_id][r["rank"]] = (r.vec_id, r.score)
    hits = 0
    queried = np.flatnonzero(ids % 20 == 0)
    assert set(got) == {int(ids[i]) for i in queried}
    for i in queried:
        score = (vectors * vectors[i]).sum(1)
        score[i] = -np.inf
        best = ids[np.lexsort((ids, -score))[:20]]
        mine = got[ids[i]]
        assert sorted(mine) == list(range(1, 21))
        hits += len({v for v, _ in mine.values()} & set(best.tolist()))
    assert hits >= 0.9 * 20 * len(queried)


def test_op5_tells_labelled_documents_apart(spark, duck):
    """On 1,000 documents: the 200 of the smallest tables are too few to train on."""
    larger = "/root/testdata/sf0.01"
    quality = dict(duck.execute(f"SELECT doc_id, quality FROM '{larger}/labels.parquet'").fetchall())
    kept = Counter((quality.get(r.doc_id), r.kept) for r in queries.op5_perplexity(spark, larger).collect())
    assert kept[1, True] >= 0.97 * (kept[1, True] + kept[1, False])
    assert kept[0, False] >= 0.8 * (kept[0, True] + kept[0, False])


def test_op6(spark, texts):
    def fingerprint(text):
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
        runs = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        counts = [0] * 64
        for run in runs:
            h = xxhash.xxh64_intdigest(run, 42)
            for i in range(64):
                counts[i] += h >> i & 1
        return sum(1 << i for i in range(64) if 2 * counts[i] > len(runs))

    prints = {i: fingerprint(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in texts:
        for b in texts:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    rows = queries.op6_simhash(spark, SF).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in rows) == sorted((i, f"{prints[i]:016x}", find(i)) for i in texts)


def test_op7(spark, texts):
    kinds = {
        "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 8),
        "access": ("AKIA[A-Z0-9]+", 0, 0, 16),
        "hex": ("[0-9a-f]+", 0, 0, 32),
    }
    for r in queries.op7_secrets(spark, SF).collect():
        spans = sorted(
            (m.start(), place, f"{kind}:{m.start()}:{m.end()}")
            for place, (kind, (pattern, flags, group, least)) in enumerate(kinds.items())
            for m in re.finditer(pattern, texts[r.doc_id], flags)
            if len(m.group(group)) >= least
        )
        assert r.base_sha256 == hashlib.sha256(",".join(s[2] for s in spans).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[1] == k for s in spans) for k in range(3)]


def test_op8(spark, texts):
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = queries.op8_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def check_packing(rows, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(texts)
    for i, text in texts.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    padding = total = 0
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
        total += at
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert padding <= 0.02 * total + 1024


def test_op10(spark, texts):
    check_packing(queries.op10_packing(spark, SF).collect(), texts)


def test_pipeline(spark):
    """Each stage against its plain version, on what the stage before it kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        kept = {r.doc_id: r for r in docs.collect()}
        assert all(r.n_chars == len(r.text) for r in kept.values())
        if name == "quality rules":
            verdict = {r.doc_id: r.kept for r in queries.op1_quality(spark, SF).collect()}
            assert set(kept) == {i for i in held if verdict[i]}
        if name == "near duplicates":
            sets = {i: five_words(r.text) for i, r in held.items()}
            groups = {i: i for i in held}
            for a in sorted(held):
                for b in sorted(held):
                    if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                        groups = {i: groups[a] if g == groups[b] else g for i, g in groups.items()}
            assert set(kept) == {min(i for i in groups if groups[i] == g) for g in set(groups.values())}
        if name == "suffix-array dedup":
            want = dict(slow_cut([(i, r.text.encode()) for i, r in held.items()]))
            assert {i: r.text for i, r in kept.items()} == {i: t.decode("utf-8", "ignore") for i, t in want.items()}
        held = kept
    check_packing(corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect(), {i: r.text for i, r in held.items()})


def five_words(text):
    words = text.encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
