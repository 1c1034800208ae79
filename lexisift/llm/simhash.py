"""SimHash near-duplicates by anchor-point covering.

Fingerprints are 64-bit majority votes over the XXH64 hashes (seed 42) of a
text's shingles.  Two fingerprints link at ``max_bits`` = 3 or fewer differing
bits; groups are the connected components.

Candidates.  The 64 bits are cut into blocks, each with a perfect code: one bit
(radius 0), three or five bits with the repetition code (radius 1, 2), seven
bits with the Hamming code (radius 1).  The product of the block codes is a
covering code of the whole space, and its codewords are the anchors: every
fingerprint has one nearest anchor, its home.  If x and y differ in at most
three bits, some point z lies at most one bit from x and two bits from y, so the
home of z is reached both by x with one flip and by y with two.  Each
fingerprint is therefore replicated to the anchors that some point within two
flips calls home - all of them within the covering radius plus the threshold -
and those within one flip are marked *near*.  Per anchor, near fingerprints are
compared with all others there; nothing is missed and every link is verified
by its bit distance.

Scale.  Equal fingerprints are one node (grouped with a combine before the
shuffle), so exact copies never meet as pairs.  The code is chosen by the
number of distinct fingerprints so that an anchor holds a few hundred rows.
An anchor that still holds more than ``split_rows`` is split into parts, and
near rows of part i meet the rows of part j in a chunk of their own, so no chunk
grows with the anchor.  Inside a task, pairs are reduced to a spanning forest
before they leave it.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, fresh, map_texts, roots, starts_of, tokens_of, written

SEED = 42
MAX_BITS = 3
#: Block widths of the codes: anchors double with every information bit.
CODES = ((5,) * 8 + (3,) * 8, (3,) * 21 + (1,), (7,) * 4 + (3,) * 12, (7,) * 9 + (1,))
INFO_BITS = {1: 1, 3: 1, 5: 1, 7: 4}
ROWS_PER_ANCHOR = 500
#: Hot anchors are broadcast up to this many rows (16 bytes each).
BROADCAST_ANCHORS = 1_000_000


# ------------------------------------------------------------ fingerprints --
def fingerprints(texts: pa.Array, shingle: int = 3) -> np.ndarray:
    """Unsigned 64-bit fingerprint of every text (no words: zero)."""
    flat, lengths = tokens_of(texts)
    first, out = starts_of(lengths), np.zeros(len(lengths), np.uint64)
    _, offsets, data = flat.buffers()
    at = np.frombuffer(offsets, np.int32)[flat.offset:flat.offset + len(flat) + 1].astype(np.int64) if len(flat) else None
    raw = data.to_pybytes() if len(flat) else b""
    hashed = xxhash.xxh64_intdigest
    for i, n in enumerate(lengths):
        if not n:
            continue
        lo, hi = first[i], first[i + 1]
        ends = at[lo:hi + 1] - at[lo]
        text = raw[at[lo]:at[hi]]
        parts = [text[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        if n < shingle:
            h = [hashed(b" ".join(parts), SEED)]
        else:
            joined = b" ".join(parts)
            begin = (ends[:-1] + np.arange(n)).tolist()
            end = (ends[1:] + np.arange(n)).tolist()
            h = [hashed(joined[a:b], SEED) for a, b in zip(begin, end[shingle - 1:])]
        out[i] = majority(np.array(h, np.uint64))
    return out


def majority(h: np.ndarray) -> np.uint64:
    """Bit j is set if it is set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(h), 1 << 16):
        part = np.unpackbits(h[lo:lo + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += part.sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(h)).view(">u8")[0].astype(np.uint64)


def with_fingerprint(docs: DataFrame, text_col: str, name: str, shingle: int = 3) -> DataFrame:
    """``docs`` without the text and with its fingerprint as a signed LONG."""
    return map_texts(docs, lambda t: [pa.array(fingerprints(t, shingle).view(np.int64))], f"`{name}` long", text_col)


# -------------------------------------------------------------------- code --
@lru_cache
def block_code(width: int) -> list[np.ndarray]:
    """For every pattern of a block: its home codeword, and for 1 and 2 flips
    the codewords that a point so many flips away (and none nearer) calls home,
    as XOR differences to the home index, padded with 0."""
    if width == 7:
        words = [w for w in range(128) if all(
            bin(w & m).count("1") % 2 == 0 for m in (0b1010101, 0b0110011, 0b0001111))]
    else:
        words = [0, (1 << width) - 1]
    n = 1 << width
    home = np.array([min(range(len(words)), key=lambda c: (bin(p ^ words[c]).count("1"), c)) for p in range(n)])
    near = [{int(home[p])} for p in range(n)]
    tables = [home]
    reach = [set(s) for s in near]
    for _ in (1, 2):
        wider = [set().union(*(reach[p ^ (1 << b)] for b in range(width))) | reach[p] for p in range(n)]
        added = [sorted(wider[p] - reach[p]) for p in range(n)]
        table = np.zeros((n, max(1, *(len(a) for a in added))), np.int64)
        for p in range(n):
            for j, c in enumerate(added[p]):
                table[p, j] = c ^ home[p]
        tables.append(table)
        reach = wider
    return tables


def anchors_of(fp: np.ndarray, code: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index into ``fp``, anchor, near) of every replica."""
    n, home, shift, low = len(fp), np.zeros(len(fp), np.int64), 0, 0
    one, two = [], []
    for block, width in enumerate(code):
        p = ((fp >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64)
        own, first, second = (t[p] for t in block_code(width))
        home |= own << shift
        one += [(block, first[:, j] << shift) for j in range(first.shape[1])]
        two += [second[:, j] << shift for j in range(second.shape[1])]
        low, shift = low + width, shift + INFO_BITS[width]
    rows, keys, near = [np.arange(n)], [home], [np.ones(n, bool)]

    def add(delta, is_near):
        at = np.flatnonzero(delta)
        rows.append(at)
        keys.append(home[at] ^ delta[at])
        near.append(np.full(len(at), is_near))

    for i, (block, d) in enumerate(one):
        add(d, True)
        for other, e in one[i + 1:]:
            if other != block:
                add(np.where((d != 0) & (e != 0), d ^ e, 0), False)
    for d in two:
        add(d, False)
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(near)


@lru_cache
def replicas(code: tuple[int, ...]) -> float:
    """Mean number of anchors that a fingerprint goes to."""
    fp = np.random.default_rng(0).integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2)
    return len(anchors_of(fp, code)[0]) / len(fp)


def choose_code(n: int) -> tuple[int, ...]:
    for code in CODES:
        if n * replicas(code) <= ROWS_PER_ANCHOR * 2 ** sum(INFO_BITS[w] for w in code):
            return code
    return CODES[-1]


# ----------------------------------------------------------------- linking --
def close_pairs(fp: np.ndarray, near: np.ndarray, group: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (i, j) inside each run of equal ``group``; near rows come
    first in a run and are compared with all later rows of it.  Runs with many
    links give a spanning forest instead of all pairs."""
    n = len(fp)
    begin = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    size = np.diff(np.concatenate([begin, [n]]))
    end = np.repeat(begin + size, size)
    big, a, b = size > 2048, [], []
    small_near = np.flatnonzero(near & ~np.repeat(big, size))
    left, step = small_near, 1
    while len(left):
        left = left[left + step < end[left]]
        other = left + step
        ok = np.bitwise_count(fp[left] ^ fp[other]) <= max_bits
        a.append(left[ok])
        b.append(other[ok])
        step += 1
    for lo, m in zip(begin[big], size[big]):
        i, j = forest(fp[lo:lo + m], near[lo:lo + m], max_bits)
        a.append(i + lo)
        b.append(j + lo)
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64),) * 2


def forest(fp: np.ndarray, near: np.ndarray, max_bits: int, rows: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links of one large run, in blocks of bounded
    memory: each round every near row takes the smallest label it links to."""
    m, k = len(fp), int(near.sum())
    label = np.arange(m)
    while True:
        before = label.copy()
        for lo in range(0, k, rows):
            linked = np.bitwise_count(fp[lo:min(k, lo + rows), None] ^ fp[None, :]) <= max_bits
            low = np.where(linked, label[None, :], m).min(axis=1)
            high = np.where(linked, low[:, None], m).min(axis=0)
            own = np.arange(lo, lo + len(low))
            np.minimum.at(label, label[own], low)
            label = np.minimum(label, high)
            label[own] = np.minimum(label[own], low)
        while not np.array_equal(nxt := label[label], label):
            label = nxt
        if np.array_equal(before, label):
            at = np.flatnonzero(label != np.arange(m))
            return at, label[at]


def links(fps: DataFrame, max_bits: int = MAX_BITS, split_rows: int = 100_000) -> DataFrame:
    """``a, b``: links between the distinct fingerprints of ``fps`` (fp LONG),
    enough of them to give the same connected components as all links."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError("the covering is built for at most 3 differing bits")
    code = choose_code(fps.count())

    def emit(batches):
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for lo in range(0, len(fp), 4096):
                row, key, near = anchors_of(part := fp[lo:lo + 4096], code)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(near), pa.array(part[row].view(np.int64))], names=["anchor", "near", "fp"])

    def tally(batches):
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            keys = [np.unique(anchors_of(fp[lo:lo + 4096], code)[1], return_counts=True)
                    for lo in range(0, len(fp), 4096)]
            if keys:
                key, at = np.unique(np.concatenate([k for k, _ in keys]), return_inverse=True)
                n = np.bincount(at, weights=np.concatenate([c for _, c in keys])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["hot", "n"])

    wide = fps.select("fp")
    hot = written(wide.mapInArrow(tally, "hot long, n long").groupBy("hot").agg(F.sum("n").alias("n"))
                  .filter(F.col("n") > split_rows)
                  .select("hot", F.ceil(F.col("n") / split_rows).cast("int").alias("c")), "hot-anchors")
    rows, n_hot = wide.mapInArrow(emit, "anchor long, near boolean, fp long"), hot.count()
    dealt = rows.withColumn("chunk", F.lit(0))
    if n_hot:
        # near rows of part i of a hot anchor meet the rows of part j in chunk (i, j)
        side = F.broadcast(hot) if n_hot <= BROADCAST_ANCHORS else hot
        own, parts = F.pmod(F.xxhash64("fp"), F.col("c")).cast("int"), F.sequence(F.lit(0), F.col("c") - 1)
        spot = lambda i, j, near: F.struct((i * F.col("c") + j).alias("chunk"), near.alias("near"))
        both = F.concat(F.when(F.col("near"), F.transform(parts, lambda j: spot(own, j, F.lit(True)))).otherwise(F.array()),
                        F.transform(parts, lambda i: spot(i, own, F.lit(False))))
        dealt = (rows.join(side, F.col("anchor") == F.col("hot"), "left")
                 .select("anchor", "fp", F.explode(F.when(F.col("c").isNull(), F.array(
                     F.struct(F.lit(0).alias("chunk"), F.col("near")))).otherwise(both)).alias("x"))
                 .select("anchor", "fp", "x.chunk", "x.near"))
    dealt = dealt.select("anchor", "chunk", "fp", "near")

    def compare(batches):
        held, n = [], 0
        for b in batches:
            held.append([b.column(i).to_numpy(zero_copy_only=False) for i in range(4)])
            n += b.num_rows
            if n < 1 << 19:
                continue
            cols = [np.concatenate(x) for x in zip(*held)]
            other = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield from _linked([x[:cut] for x in cols], max_bits)
            held, n = [[x[cut:] for x in cols]], n - cut
        if n:
            yield from _linked([np.concatenate(x) for x in zip(*held)], max_bits)

    return (dealt.repartition("anchor", "chunk").sortWithinPartitions("anchor", "chunk", F.desc("near"))
            .mapInArrow(compare, "a long, b long").distinct())


def _linked(cols, max_bits):
    anchor, chunk, fp, near = cols
    fp = fp.view(np.uint64)
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (chunk[1:] != chunk[:-1])])
    i, j = close_pairs(fp, near, np.cumsum(new), max_bits)
    if len(i):
        nodes, at = np.unique(np.concatenate([fp[i], fp[j]]), return_inverse=True)
        top = roots(at[:len(i)], at[len(i):], len(nodes))
        low = np.flatnonzero(top != np.arange(len(nodes)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[low].view(np.int64)), pa.array(nodes[top[low]].view(np.int64))],
                                         names=["a", "b"])


def groups(prints: DataFrame, low, max_bits: int = MAX_BITS) -> DataFrame:
    """``fp, low, root`` for every distinct fingerprint of the written table
    ``prints`` (fp, ...): ``low`` is the aggregate given, over the rows of the
    fingerprint, and ``root`` names its component."""
    distinct = written(prints.groupBy("fp").agg(low.alias("low")), "prints")
    found = components(links(distinct, max_bits))
    return distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col="doc_id", text_col="text", shingle: int = 3,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint, component_id``.

    The fingerprint is 16 lower-case hex digits.  Null and empty texts have
    fingerprint zero and link like any other; a text with fewer words than a
    shingle is one shingle.  Repeated rows give a row each; a null id never is
    a component's smallest unless all of its ids are null.  Other columns are
    not read; an empty table gives no rows.
    """
    prints = written(with_fingerprint(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
                                      "text", "fp", shingle), "fingerprints")
    node = written(groups(prints, F.min("doc_id"), max_bits), "components")
    least = node.groupBy("root").agg(F.min("low").alias("component_id"))
    out = prints.join(node.join(least, "root").select("fp", "component_id"), "fp")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col="doc_id", text_col="text", shingle: int = 3,
             max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id (of
    repeated rows with that id, one; if all ids of a group are null, one of its
    rows).  All columns are kept; null and empty texts are one group."""
    fp, row, text2 = fresh(docs, "fp_"), fresh(docs, "row_"), fresh(docs, "text_")
    wide = written(with_fingerprint(docs.withColumn(row, F.monotonically_increasing_id())
                                    .withColumn(text2, F.col(text_col)), text2, fp, shingle), "with-prints")
    prints = wide.select(F.col(fp).alias("fp"), F.col(id_col).alias("id"), F.col(row).alias("row"))
    node = groups(prints, F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")), max_bits)
    best = node.groupBy("root").agg(F.min("low").alias("low")).select(F.col("low.row").alias(row))
    return wide.join(best, row, "left_semi").select(*docs.columns)
