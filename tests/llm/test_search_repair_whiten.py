"""Nearest neighbours, conversation repair and whitening against brute force."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest

from lexisift.llm import conversations as C
from lexisift.llm import lsh_search, whitening

SF = "/root/testdata/sf0.01"


# ----------------------------------------------------------------- nearest --
def brute_nearest(ids, x, every, top):
    out = []
    for q in np.flatnonzero(ids % every == 0):
        s = np.zeros(len(x))
        for d in range(x.shape[1]):
            s += x[q, d] * x[:, d]
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != ids[q]][:top]
        out += [(int(ids[q]), r + 1, int(ids[i]), s[i]) for r, i in enumerate(order)]
    return out


def test_nearest_recall_and_exact_scores(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = e.toPandas()
    x, ids = np.array(rows.embedding.tolist(), float), rows.vec_id.to_numpy()
    want = brute_nearest(ids, x, 20, 20)
    found = lsh_search.search(e)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    got = found.collect()
    truth = spark.createDataFrame([(q, i) for q, _, i, _ in want], "query_id long, vec_id long")
    assert len(got) == len(want) and lsh_search.recall(found, truth) >= 0.9
    at = {int(i): v for i, v in zip(ids, x)}
    assert all(g.score == pytest.approx(float(at[g.query_id] @ at[g.vec_id]), rel=1e-12, abs=1e-14) for g in got)
    by = {}
    for g in sorted(got, key=lambda g: (g.query_id, g["rank"])):
        by.setdefault(g.query_id, []).append((-g.score, g.vec_id))
    assert all(v == sorted(v) and len(v) == 20 for v in by.values())


def test_nearest_with_copies_ties_and_few_candidates_is_exact(spark):
    # many copies of one vector, exact ties, norms of many sizes: every query finds its true neighbours or is compared with all rows
    r = np.random.default_rng(0)
    x = np.concatenate([np.tile([1.0, 2.0, 0.0], (60, 1)), r.integers(-2, 3, (60, 3)) * 1.0])
    x[(x == 0).all(axis=1)] = [0, 0, 1]
    rows = [(i, v.tolist(), 1, "c") for i, v in enumerate(x)]
    odd = [(1000, None, 1, "n"), (1020, [0.0, 0.0, 0.0], 1, "z"), (1040, [1.0, None, 2.0], 1, "h"), (1060, [float("nan"), 1.0, 1.0], 1, "x"),
           (1080, [float("inf"), 1.0, 1.0], 1, "i"), (1100, [], 1, "e"), (None, [1.0, 1.0, 1.0], 1, "k"), (1120, [3.0, 4.0], 1, "two"), (0, x[0].tolist(), 1, "again")]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, node int, score string")
    got = [tuple(g) for g in lsh_search.search(df, top=5, target=1.0).collect()]
    want = brute_nearest(np.arange(120), x, 20, 5)
    assert sorted((q, s) for q, _, _, s in got) == sorted((q, s) for q, _, _, s in want)
    copies = {q: [i for qq, _, i, _ in got if qq == q] for q in (0, 20, 40)}
    same = {q: [i for qq, _, i, _ in want if qq == q] for q in (0, 20, 40)}
    assert copies == same
    assert not {1000, 1020, 1040, 1060, 1080, 1100, 1120} & {g[0] for g in got}       # unusable, or alone with its length
    assert lsh_search.search(df.limit(0)).count() == 0
    three = df.filter("vec_id in (0, 1, 65)")
    assert sorted((g["rank"], g.vec_id) for g in lsh_search.search(three).collect())[0][1] in (1, 65)
    assert lsh_search.search(three).count() == 2 and lsh_search.search(df.filter("vec_id = 0")).count() == 0
    huge = spark.createDataFrame([(i, [1e300 * (i + 1), -1e300]) for i in range(40)], "vec_id long, embedding array<double>")
    assert lsh_search.search(huge).count() == 40


def test_a_query_with_poor_cells_is_compared_with_all_rows(spark):
    r = np.random.default_rng(3)
    df = spark.createDataFrame([(i, r.normal(size=6).tolist()) for i in range(200)], "vec_id long, embedding array<double>")
    x = np.array([v.embedding for v in df.orderBy("vec_id").collect()])
    got = {(g.query_id, g.vec_id) for g in lsh_search.search(df, target=0.01).collect()}
    assert len(got) == 200          # ten queries, twenty each, however few cells they visit
    exact = {(q, i) for q, _, i, _ in brute_nearest(np.arange(200), x, 20, 20)}
    assert len({q for q, _ in got}) == 10 and len(got & exact) > 100


def test_cells_are_visited_in_order_and_within_reach():
    t = lsh_search.Tables(8, 1.0)
    r = np.random.default_rng(0)
    x = r.normal(size=(300, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    t.k, t.reach = 3, 1.5
    rows, q = t.rows(x), t.queries(x[:20])
    for table in range(lsh_search.TABLES):
        own, cell, cost = t.visits(q, table)
        cells = t.cells(rows, table)
        for i in range(20):
            mine = cost[own == i]
            assert (np.diff(mine) >= 0).all() and mine[0] == 0 and mine[-1] <= 1.5
            near = t.scores(np.tile(q[i], (300, 1)), rows, table)[:, 2] <= 1.5
            assert set(cells[near]) <= set(cell[own == i])


# ------------------------------------------------------------------ repair --
CHAR = "[^\x20\x09-\x0D]"


def damaged(rows):
    out = []
    for c, t, r, x in rows:
        c_, t_, r, x = (" " if v is None else str(v) for v in (c, t, r, x))
        k = zlib.crc32(f"{c_}:{t_}".encode()) % 20
        x = "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x
        out += [(t, "user" if k == 4 else r, x)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def brute_repair(rows):
    """Cheapest repair by trying every edit, audits kept as whole strings."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5((r[1] + "\0" + r[2]).encode()).digest()))
    seen, fault = set(), []
    for _, r, x in rows:
        chars = re.findall(CHAR, x)
        fault.append("b" if not chars else "d" if (r, x) in seen else "t" if chars[-1] not in ".!?" else "")
        seen.add((r, x))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    heap, least = [(0, "", 0, "", ())], {}
    while True:
        cost, audit, i, state, out = heapq.heappop(heap)
        if least.setdefault((i, state), (cost, audit)) < (cost, audit):
            continue
        if i == len(rows) and state in ("", "a"):
            break
        follow = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        new = "assistant" if state == "u" else "user"
        heapq.heappush(heap, (cost + 2, audit + "I", i, new[0], (*out, (new, ""))))
        if i < len(rows):
            _, r, x = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, out))
            if fault[i] not in ("b", "d"):
                late = int(fault[i] == "t")
                if r[:1] and r[:1] in follow:
                    heapq.heappush(heap, (cost + late, audit + "K", i + 1, r[:1], (*out, (r, x))))
                heapq.heappush(heap, (cost + 2 + late, audit + "R", i + 1, new[0], (*out, (new, x))))
    text = "\n".join(f"{r}:{x}" for r, x in out)
    return (gaps, fault.count("b"), fault.count("d"), fault.count("t"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def wild(n, seed=0):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(r.randrange(1, 8)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = r.choice(["Yes.", "No!", "What?", "open end", " \t", "", None, f"Long {t}. ", f"ends {c}"])
            rows.append((c, r.choice([t, t, t, 2 * t, None]), role, text))
    return rows


CONV = "conv_id long, turn long, role string, text string"


def test_repair_equals_brute_force(spark):
    rows = wild(250)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], CONV + ", cost int, audit string")
    got = {r.conv_id: tuple(r)[1:] for r in C.repair(df).collect()}
    plain = {r.conv_id: tuple(r)[1:] for r in C.repair(df, damaged=False).collect()}
    assert set(got) == set(range(250))
    for c in range(250):
        own = [r for r in rows if r[0] == c]
        assert got[c] == brute_repair(damaged(own)), own
        assert plain[c] == brute_repair([(t, " " if r is None else r, " " if x is None else x) for _, t, r, x in own]), own


def test_long_conversations_are_joined_from_pieces(spark):
    # the hot conversation lies in many tasks; pieces of every length give the same repair
    r = random.Random(5)
    hot = [(7, t, r.choice(["user", "assistant"]), r.choice(["Yes.", f"text {t}.", f"cut {t}", ""])) for t in range(600)]
    rows = hot + [(c, t, "user" if t % 2 == 0 else "assistant", f"t {c} {t}.") for c in range(20) for t in range(4) if c != 7]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {x.conv_id: tuple(x)[1:] for x in C.repair(spark.createDataFrame(rows, CONV).repartition(5)).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    for c in range(20):
        assert got[c] == brute_repair(damaged([x for x in rows if x[0] == c])), c


def test_pieces_combine_to_the_whole():
    r = random.Random(1)
    for _ in range(60):
        rows = [(r.choice("suaxu a"), r.randrange(2), r.choice([0, 0, 0, 2])) for _ in range(r.randrange(1, 12))]
        cost, audit, _ = C.derive(rows, C.GOOD_ENDS)[C.NEW]
        cut = sorted(r.sample(range(len(rows) + 1), min(2, len(rows))))
        parts = [rows[a:b] for a, b in zip([0, *cut], [*cut, len(rows)])]
        assert C.combine([C.piece(p) for p in parts]) == (cost, C.spell(audit), C.plan_of(audit, rows))
    assert C.combine([]) == (0, "", "")


def test_repair_edge_rows(spark):
    rows = [(None, 0, "user", "Hi."), (None, 1, "assistant", "Yes."), (1, None, None, None), (2, 0, "user", "w " * 50_000 + "."), (3, 0, "user", "Hi.")] + [(4, 0, "user", "Hi.")] * 3
    df = spark.createDataFrame(rows, CONV)
    got = {r.conv_id: tuple(r)[1:] for r in C.repair(df).collect()}
    assert set(got) == {None, 1, 2, 3, 4}
    for c in got:
        assert got[c] == brute_repair(damaged([r for r in rows if r[0] == c]))
    assert C.repair(df.limit(0)).count() == 0
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert tuple(C.repair(spark.createDataFrame([(gone, 0, "user", "Hi.")], CONV)).first()) == (
        gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


# --------------------------------------------------------------- whitening --
def brute_white(x, weights=None):
    u, at, n = np.unique(x, axis=0, return_inverse=True, return_counts=True)
    w = np.ones(len(u)) if weights is None else n.astype(float)
    mean = (u * w[:, None]).sum(axis=0) / w.sum()
    e, v = np.linalg.eigh(((u - mean) * w[:, None]).T @ (u - mean) / w.sum())
    e, v = e[::-1], v[:, ::-1]
    total = int(w.sum())
    s = [int(a) for a in (u.astype(object) * w.astype(int)[:, None].astype(object)).sum(axis=0)]
    return total, [sum((total * int(a) - b) ** 2 for a, b in zip(r, s)) for r in x], (x - mean) @ v / np.sqrt(e), e / e.sum()


def grid(v):
    return np.floor(64 * np.asarray(v, float)).astype(np.int64) + 1_000_000


def check_white(rows, x, ids, by_count=None):
    n, dev, white, share = brute_white(x, by_count)
    for c in range(min(16, x.shape[1])):
        own = rows[rows.component == c + 1].set_index("vec_id").loc[ids]
        sign = np.sign((own.whitened.to_numpy() * white[:, c]).sum())
        assert np.allclose(own.whitened, sign * white[:, c], atol=1e-7) and (own.n == n).all() and own.deviation.tolist() == dev
        assert own.explained.iloc[0] == pytest.approx(share[c], rel=1e-9) and (own.identity_error < 1e-9).all()


def test_whitening_equals_numpy(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = e.toPandas()
    check_white(whitening.whiten(e).toPandas(), grid(rows.embedding.tolist()), rows.vec_id)


def test_whitening_with_copies_weights_and_odd_rows(spark):
    r = np.random.default_rng(0)
    good = [(i, r.normal(size=5).tolist()) for i in range(40)] + [(100 + i, [0.5, 1.0, -2.0, 300.0, 1e6]) for i in range(30)]
    odd = [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0]), (902, [float("nan")] * 5), (903, [float("inf")] * 5), (904, []), (905, [1e300] * 5),
           (910, [1.0, 2.0]), (911, [2.0, 1.0]), (912, [0.0, 0.5]), (913, [7.0])]
    df = spark.createDataFrame([(*v, 0, "k") for v in good + odd], "vec_id long, embedding array<double>, n int, key string")
    x, ids = grid([v for _, v in good]), [i for i, _ in good]
    for by_count in (False, True):
        rows = whitening.whiten(df, by_count=by_count).toPandas()
        n, dev, white, share = brute_white(x, by_count or None)
        big = rows[rows.vec_id < 200]
        assert len(big) == 70 * 5 and (big.n == n).all()
        assert big[big.component == 1].set_index("vec_id").loc[ids].deviation.tolist() == dev
        assert (big.identity_error < 1e-4).all()
        z = big.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
        assert np.allclose(np.abs(z[:, 0]), np.abs(white[:, 0]), atol=1e-6)
        assert set(rows[rows.vec_id >= 900].vec_id) == {910, 911, 912, 913}
        alone = rows[rows.vec_id == 913].iloc[0]
        assert alone.n == 1 and alone.deviation == 0 and np.isnan(alone.whitened) and np.isnan(alone.explained) and alone.identity_error == 0
    assert whitening.whiten(df.limit(0)).count() == 0


def test_keys_are_equal_for_equal_vectors_only():
    import pyarrow as pa
    lists = pa.array([[1.0, 2.0], [1.0, 2.0], [1.0, 2.01], [1e6, -1e6], None, [float("nan"), 0.0], [1.0], []], pa.list_(pa.float64()))
    rows, dims, keys = whitening.keys_of(lists)
    assert rows.tolist() == [0, 1, 2, 3, 6] and dims.tolist() == [2, 2, 2, 2, 1] and keys[0] == keys[1] == keys[2] != keys[3]
    back = whitening.offsets_of(keys[:4], 2)
    assert back.tolist() == [[64, 128], [64, 128], [64, 128], [64_000_000, -64_000_000]]
    sums = [2 ** 68, 5]
    assert whitening.deviations(np.array([[1 << 40, 3]]), 1 << 28, sums) == [0 + (3 * (1 << 28) - 5) ** 2]
    assert whitening.deviations(np.array([[1 << 40, 3]]), 1 << 30, [0, 0]) == [None]
