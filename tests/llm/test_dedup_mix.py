"""Decontamination, SimHash groups and mixing against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from corpus_cases import EDGE, docs_df, random_docs

from lexisift.llm import decontaminate as D
from lexisift.llm import mixing as M
from lexisift.llm import simhash as S
from lexisift.llm.common import components


# ------------------------------------------------------------------ op5 --
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_decon(rows, items):
    low = lambda t: WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    out = []
    for i, t, *_ in rows:
        w, hit, found = low(t), set(), set()
        for item, bt in items:
            b = low(bt)
            for k in range(max(0, len(b) - 13 + 1)) if len(b) >= 13 else ([0] if b else []):
                win = b[k:k + 13]
                for s in range(len(w) - len(win) + 1):
                    if w[s:s + len(win)] == win:
                        hit.update(range(s, s + len(win)))
                        found.add(str(item))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), sha, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [200_000, 7])
def test_decontamination_equals_brute_force(spark, block):
    r = random.Random(3)
    rows = random_docs(60, seed=1, vocab=8)
    items = [(i, " ".join(r.choice(["w0", "w1", "w2", "w3"]) for _ in range(r.choice([0, 1, 2, 13, 14, 20])))) for i in range(25)]
    items += [(99, rows[5][1]), (100, rows[5][1].upper()), (101, None), (102, "!!"), (99, rows[5][1])]
    rows += [(200, "x " * 50 + rows[5][1] + "," + rows[5][1], "en", "a", 0)] + EDGE
    got = D.decontaminate(docs_df(spark, rows), spark.createDataFrame(items, "item_id long, text string"), block_windows=block)
    assert sorted([tuple(x) for x in got.collect()], key=repr) == brute_decon(rows, items)


def test_drop_contaminated_keeps_columns_and_clean_rows(spark):
    rows = [(1, "a b c", "en", "s", 3, 1), (2, "clean text here", None, None, None, 2), (3, None, None, None, None, 3)]
    d = docs_df(spark, rows, ", dirty int")
    b = spark.createDataFrame([(1, "A b")], "item_id long, text string")
    out = D.drop_contaminated(d, b)
    assert out.columns == d.columns and sorted(x.doc_id for x in out.collect()) == [2, 3]
    empty = spark.createDataFrame([], "item_id long, text string")
    assert D.drop_contaminated(d, empty).count() == 3
    assert D.decontaminate(d.limit(0), b).count() == 0


def test_blocks_of_windows_give_the_same_rows(spark):
    """Many blocks meet by digest: copies, overlapping blocks, extra columns
    with the names of the results, a text over a megabyte."""
    passage = " ".join(f"p{i}" for i in range(40))
    rows = random_docs(50, seed=4, vocab=8)
    rows = [(i, t and (t + " " + passage if i % 3 == 0 else t), lang, s, n) for i, t, lang, s, n in rows]
    rows += [rows[0]] * 20 + [(900, "long " * 250_000 + passage, "en", "a", 1), (901, passage, None, None, None)] + EDGE
    d = docs_df(spark, rows, "").selectExpr("*", "1 AS digest", "'x' AS n_hit", "2 AS dirty")
    items = [(i, " ".join(f"p{j}" for j in range(a, b))) for i, (a, b) in enumerate([(0, 20), (10, 40), (5, 9), (30, 31)])]
    b = spark.createDataFrame(items, "item_id long, text string")
    want = brute_decon(rows, items)
    for block in (200_000, 5):
        got = D.decontaminate(d, b, block_windows=block)
        assert sorted([tuple(x) for x in got.collect()], key=repr) == want
        kept = D.drop_contaminated(d, b, block_windows=block)
        assert kept.columns == d.columns
        assert sorted(repr(x.doc_id) for x in kept.collect()) == sorted(repr(x[0]) for x in want if not x[5])


# ------------------------------------------------------------------ op8 --
def brute_print(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", low) if x]
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(prints, bits=3):
    n, top = len(prints), list(range(len(prints)))
    def root(i):
        while top[i] != i:
            i = top[i]
        return i
    for i in range(n):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= bits:
                a, b = sorted((root(i), root(j)))
                top[b] = a
    return [root(i) for i in range(n)]


def test_simhash_equals_brute_force(spark):
    rows = random_docs(120, seed=5)
    r = random.Random(9)
    for k in range(40):
        i = r.randrange(120)
        w = rows[i][1].split()
        if len(w) > 3:
            w[r.randrange(len(w))] = "changed"
        rows.append((1000 - k, " ".join(w), "en", "s", 0))
    rows += EDGE
    out = S.near_duplicates(docs_df(spark, rows)).collect()
    assert len(out) == len(rows)
    prints = [brute_print(x[1]) for x in rows]
    comp = brute_groups(prints)
    ids = {}
    for i, c in enumerate(comp):
        if rows[i][0] is not None:
            ids[c] = min(ids.get(c, rows[i][0]), rows[i][0])
    want = sorted((repr(rows[i][0]), f"{prints[i]:016x}", ids.get(comp[i])) for i in range(len(rows)))
    assert sorted((repr(x.doc_id), x.fingerprint, x.component_id) for x in out) == want
    # the row that stays of each group
    kept = S.keep_one(docs_df(spark, rows).selectExpr("*", "1 AS fp_", "2 AS row_"))
    assert kept.columns == [*docs_df(spark, rows).columns, "fp_", "row_"]
    got = sorted(repr(x.doc_id) for x in kept.collect())
    assert got == sorted(repr(ids.get(c)) for c in set(comp))


def clustered_prints(n, seed):
    r = np.random.default_rng(seed)
    base = r.integers(0, 1 << 63, n // 4, dtype=np.uint64) * np.uint64(2) + r.integers(0, 2, n // 4, dtype=np.uint64)
    out = [base]
    for _ in range(3):
        x = base.copy()
        for _ in range(int(r.integers(1, 5))):
            x ^= np.uint64(1) << r.integers(0, 64, len(x)).astype(np.uint64)
        out.append(x)
    return np.unique(np.concatenate(out))


@pytest.mark.parametrize("code", S.CODES)
def test_every_close_pair_shares_an_anchor(code):
    assert sum(code) == 64
    r = np.random.default_rng(1)
    x = r.integers(0, 1 << 63, 200, dtype=np.uint64)
    y = x.copy()
    for _ in range(3):
        y ^= np.uint64(1) << r.integers(0, 64, 200).astype(np.uint64)
    ri, rk, rn = S.anchors_of(x, code)
    qi, qk, qn = S.anchors_of(y, code)
    for i in range(200):
        near = set(rk[(ri == i) & rn].tolist()) & set(qk[qi == i].tolist())
        assert near
        assert len(set(rk[ri == i].tolist())) == (ri == i).sum()


@pytest.mark.parametrize("split,code", [(100_000, None), (20, None), (20, 1), (50, 3)])
def test_links_give_all_components(spark, split, code, monkeypatch):
    fp = clustered_prints(240, 4)
    hot = np.unique(fp[0] ^ (np.uint64(1) << np.random.default_rng(2).integers(0, 8, 300).astype(np.uint64)) ^ (
        np.uint64(1) << np.random.default_rng(3).integers(0, 8, 300).astype(np.uint64)))
    fp = np.unique(np.concatenate([fp, hot]))
    if code is not None:
        monkeypatch.setattr(S, "choose_code", lambda n: S.CODES[code])
    df = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp long")
    found = {r.node: r.root for r in components(S.links(df, split_rows=split)).collect()}
    mine = [found.get(int(x), int(x)) for x in fp.view(np.int64)]
    want = brute_groups([int(x) for x in fp])
    pair = {}
    for a, b in zip(mine, want):
        assert pair.setdefault(a, b) == b
    assert len(set(mine)) == len(set(want))


def test_forest_of_a_large_run_equals_roots():
    r = np.random.default_rng(0)
    fp = np.unique(np.uint64(77) ^ r.integers(0, 1 << 12, 3000, dtype=np.uint64))
    near = np.ones(len(fp), bool)
    i, j = S.forest(fp, near, 3)
    from lexisift.llm.common import roots
    assert len(set(roots(i, j, len(fp)).tolist())) == 1


def test_components_on_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 300)] + [(500, 400), (5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[i] == 100 for i in range(100, 300)) and got[500] == 400
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ------------------------------------------------------------------ op9 --
def brute_targets(sizes, share=1.5, cap=2):
    keys = sorted((k for k in sizes if k is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {k: (3, 1, 2)[i % 3] for i, k in enumerate(keys)}
    left, done, out = share * sum(sizes.values()), set(), {}
    while True:
        free = [k for k in keys if k not in done]
        tot = sum(w[k] for k in free)
        over = [k for k in free if w[k] * left / tot >= cap * sizes[k]] if tot else []
        if not over:
            out.update({k: w[k] * left / tot for k in free} if tot else {})
            return out
        for k in over:
            out[k] = cap * sizes[k]
            left -= out[k]
            done.add(k)


def test_mix_targets_and_taken(spark):
    rows = random_docs(900, seed=2, length=60) + EDGE + [(5000 + i, "z " * 10, "en", "tiny", 0) for i in range(3)]
    df = docs_df(spark, rows, "").selectExpr("*", "1 AS size", "2 AS target")
    out = M.mix(df, shards=8).collect()
    assert len(out) == len(rows)
    sizes, taken, biggest, src = {}, {}, {}, {}
    for i, t, _, s, _ in rows:
        n = len((t or "").split())
        sizes[s] = sizes.get(s, 0) + n
        src.setdefault((i, n), []).append(s)
        biggest[s] = max(biggest.get(s, 0), n)
    want = brute_targets(sizes)
    for r in out:
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.size * r.copies and len(r.shards) == r.copies
        assert all(0 <= x < 8 for x in r.shards)
        s = src[(r.doc_id, r.size)].pop()
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        taken[s] = taken.get(s, 0) + r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= biggest[s] / 2 + 1e-6
    again = M.mix(df.repartition(5), shards=8).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, out))
    assert M.mix(df.limit(0)).count() == 0


def test_splitting_tree_margins():
    rng = np.random.default_rng(0)
    counts = np.array([5, 0, 100, 17])
    room = np.diff([counts.sum() * j // 7 for j in range(8)])
    m = M.split_tree(counts, room, rng)
    assert (m.sum(axis=1) == counts).all() and (m.sum(axis=0) == room).all() and (m >= 0).all()


def test_materialised_mix_has_every_copy(spark):
    rows = random_docs(300, seed=8)
    df = docs_df(spark, rows)
    mixed = M.mix(df, shards=4)
    n = sum(r.copies for r in mixed.collect())
    out = M.materialise(df, mixed)
    assert out.count() == n and "shard" in out.columns


def test_hash_sample_equals_the_plain_order(spark):
    from pyspark.sql import functions as F

    from lexisift.llm.common import hash_sample
    df = spark.range(20_000)
    for n in (1, 50, 3000, 30_000):
        want = [r.id for r in df.orderBy(F.xxhash64("id"), "id").limit(n).collect()]
        assert [r.id for r in hash_sample(df, ["id"], n, 20_000).collect()] == want
