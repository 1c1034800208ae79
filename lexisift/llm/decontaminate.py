"""Benchmark decontamination by a prefix-filtered join on item-sized windows.

A window is ``size`` consecutive words of a benchmark item (an item with fewer
words, but not none, is one window).  A document holds a window only if it
holds every word of it, so one necessary prefix token is enough to find it:
words are ordered by their count in the corpus, and the rarest word of a window
is its prefix.  The join is then

* a probe of every document word against the prefix words,
* the positional bound: the prefix word's place in the window fixes where the
  window would start,
* the length bound: the window must fit between that start and the end,
* an exact comparison of the words.

The order of the words comes from one pass over the documents that counts them
in ``BUCKETS`` hash buckets, a table of 8 MB at every size of the corpus and of
the benchmark.

The benchmark side is cut into blocks of at most ``block_windows`` windows of
bounded total bytes, and one block at a time is broadcast, met by one map over
the documents and dropped; no worker and no driver ever holds two.  If there is
one block, that map is the whole join.  With more, a map writes what the block
hits, a row per text that is hit, named by the text's digest (equal texts are
hit alike, so copies need no more rows and row ids are not needed); the blocks'
rows meet by digest and go back to the documents.  Only digests and spans are
shuffled to find the hits, never a text, and neither a hot word nor a hot passage can
gather rows in one task.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_BYTES, fresh, map_texts, release, written

BLOCK_WINDOWS = 200_000
BLOCK_BYTES = 64 << 20
BUCKETS = 1 << 20
SPANS = "n_words long, starts array<long>, ends array<long>, items array<string>"


def words_of(text: str | None) -> list[bytes]:
    """Runs of digits, letters and non-ASCII characters, A-Z lower-cased."""
    return [] if text is None else text.encode("utf-8", "replace").translate(WORD_BYTES).split()


def windows_of(words: list[bytes], size: int) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    return [tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]


def window_table(benchmark: DataFrame, item_col: str, text_col: str, size: int) -> DataFrame:
    """``item``, ``win`` (space-joined words): the distinct windows of every item."""
    def cut(frames):
        for f in frames:
            out = [(str(i), b" ".join(w).decode("utf-8", "replace"))
                   for i, t in zip(f["item"], f["text"]) for w in set(windows_of(words_of(t), size))]
            yield pd.DataFrame(out, columns=["item", "win"])
    src = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                           F.col(text_col).alias("text"))
    return src.mapInPandas(cut, "item string, win string").distinct()


def bucket_of(word: bytes) -> int:
    return zlib.crc32(word) % BUCKETS


def word_counts(docs: DataFrame, text_col: str) -> np.ndarray:
    """Words of all documents by hash bucket."""
    def count(frames):
        total = np.zeros(BUCKETS, np.int64)
        for f in frames:
            seen = Counter()
            for t in f["text"]:
                seen.update(words_of(t))
            np.add.at(total, np.fromiter(map(bucket_of, seen), np.int64, len(seen)),
                      np.fromiter(seen.values(), np.int64, len(seen)))
        at = np.flatnonzero(total)
        yield pd.DataFrame({"b": at, "n": total[at]})

    got = docs.select(F.col(text_col).alias("text")).mapInPandas(count, "b long, n long") \
        .groupBy("b").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(BUCKETS, np.int64)
    counts[got.column("b").to_numpy()] = got.column("n").to_numpy()
    return counts


class Block:
    """Windows of one block, findable by their rarest word."""

    def __init__(self, rows: list[tuple[str, str]], counts: np.ndarray):
        items = defaultdict(list)
        for item, win in rows:
            items[tuple(win.encode().split(b" "))].append(item)
        self.by_prefix: dict[bytes, list] = defaultdict(list)
        for win, its in items.items():
            at = min(range(len(win)), key=lambda i: (counts[bucket_of(win[i])], win[i]))
            self.by_prefix[win[at]].append((at, win, its))
        self.by_prefix = dict(self.by_prefix)

    def find(self, words: list[bytes]):
        """(start, length, items) of every occurrence of a window."""
        get, n = self.by_prefix.get, len(words)
        for pos, found in enumerate(map(get, words)):
            for at, win, its in found or ():
                start = pos - at
                if 0 <= start and start + len(win) <= n and tuple(words[start:start + len(win)]) == win:
                    yield start, len(win), its


def match(text: str | None, block: Block) -> tuple[list[bytes], list[tuple[int, int]], set[str]]:
    """The words of a text, the spans of them that are hit, and the items found."""
    words, spans, items = words_of(text), [], set()
    for start, length, its in block.find(words):
        items.update(its)
        if spans and spans[-1][0] <= start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], start + length))
        else:
            spans.append((start, start + length))
    return words, spans, items


def is_dirty(n_words: int, n_hit: int, share: int) -> bool:
    return n_hit > 0 and share * n_hit >= n_words


def verdict(n_words: int, spans: list[tuple[int, int]], items: set[str], share: int) -> tuple:
    """``n_hit, n_items, items_sha256, contaminated`` of a text."""
    n = covered(spans)
    return n, len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), is_dirty(n_words, n, share)


def covered(spans: list[tuple[int, int]]) -> int:
    """Words inside any of the spans."""
    total = end = 0
    for a, b in sorted(spans):
        total += max(0, b - max(a, end))
        end = max(end, b)
    return total


def blocks_of(docs: DataFrame, benchmark: DataFrame, item_col="item_id", bench_text="text", text_col="text",
              size: int = 13, block_windows: int = BLOCK_WINDOWS) -> tuple[int, Iterator[Broadcast]]:
    """The number of blocks of the benchmark, and the blocks, broadcast one by
    one as they are asked for; the prefixes follow the words' counts over all
    of ``docs``."""
    spark = docs.sparkSession
    wins = written(window_table(benchmark, item_col, bench_text, size), "windows")
    n, size_bytes = wins.agg(F.count("*"), F.sum(F.octet_length("win") + F.octet_length("item") + 64)).first()
    parts = max(1, -(-n // block_windows), -(-(size_bytes or 0) // BLOCK_BYTES))

    def load():
        counts = word_counts(docs, text_col) if n else np.zeros(BUCKETS, np.int64)
        for part in range(parts):
            got = wins.filter(F.pmod(F.xxhash64("item", "win"), F.lit(parts)) == part).toArrow()
            rows = zip(got.column("item").to_pylist(), got.column("win").to_pylist())
            if part == parts - 1:
                release(wins)
            yield spark.sparkContext.broadcast(Block(rows, counts))

    return parts, load()


def digest_of(text: str | None) -> bytes:
    return hashlib.sha256((text or "").encode("utf-8", "replace")).digest()


def hits(docs: DataFrame, blocks: Iterator[Broadcast], text_col: str, share: int) -> DataFrame:
    """``digest, n_hit, n_items, items_sha256, contaminated`` of every text
    that some block hits: a written table for each block, met by digest."""
    src = docs.select(F.col(text_col).alias("text"))

    def probe(block):
        def run(frames):
            for f in frames:
                seen = {}
                for t in f["text"]:
                    words, spans, items = match(t, block.value)
                    if spans:
                        seen[digest_of(t)] = (len(words), [a for a, _ in spans], [b for _, b in spans], sorted(items))
                yield pd.DataFrame([(k, *v) for k, v in seen.items()],
                                   columns=["digest", "n_words", "starts", "ends", "items"])
        return run

    tables = []
    for k, block in enumerate(blocks):
        one = src.mapInPandas(probe(block), f"digest binary, {SPANS}")
        tables.append(written(one.dropDuplicates(["digest"]), f"hits-{k}"))
        block.unpersist()
    every = tables[0]
    for t in tables[1:]:
        every = every.union(t)

    def judge(frames):
        for f in frames:
            rows = [(d, *verdict(n, [s for a, b in zip(starts, ends) for s in zip(a, b)], {i for x in items for i in x}, share))
                    for d, n, starts, ends, items in f.itertuples(index=False)]
            yield pd.DataFrame(rows, columns=["digest", "n_hit", "n_items", "items_sha256", "contaminated"])

    per = every.groupBy("digest").agg(F.max("n_words").alias("n_words"), *(F.collect_list(c).alias(c) for c in ("starts", "ends", "items")))
    out = written(per.mapInPandas(judge, "digest binary, n_hit long, n_items long, items_sha256 string, contaminated boolean"), "hits")
    for t in tables:
        release(t)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col="doc_id", text_col="text",
                  item_col="item_id", bench_text="text", size: int = 13, share: int = 20,
                  block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_hit, n_items,
    items_sha256, contaminated``.

    A document is contaminated if some word is hit and at least one word in
    ``share`` is.  A null or empty text has no words and is never contaminated;
    items without words have no window; repeated items count once per id, a
    null item id counts as the empty text, repeated documents give a row each,
    null document ids stay null.  Other columns, whatever their names, are not
    read.
    """
    parts, blocks = blocks_of(docs, benchmark, item_col, bench_text, text_col, size, block_windows)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if parts == 1:
        block = next(blocks)

        def scan(texts):
            found = (match(t, block.value) for t in texts.to_pylist())
            out = [(len(words), *verdict(len(words), spans, items, share)) for words, spans, items in found]
            return list(zip(*out)) if out else [[]] * 5

        return map_texts(src, scan, "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")

    found = hits(docs, blocks, text_col, share)

    def measure(texts):
        texts = texts.to_pylist()
        return [[len(words_of(t)) for t in texts], [digest_of(t) for t in texts]]

    none = verdict(0, [], set(), share)
    names = ("n_hit", "n_items", "items_sha256", "contaminated")
    return (map_texts(src, measure, "n_words long, digest binary").join(found, "digest", "left")
            .select("doc_id", "n_words", *(F.coalesce(c, F.lit(v).cast(found.schema[c].dataType)).alias(c) for c, v in zip(names, none))))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col="text", item_col="item_id", bench_text="text",
                      size: int = 13, share: int = 20, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns,
    also those with names this function uses.  Null and empty texts stay,
    repeated rows stay or go together, an empty table gives none.  One block of
    windows is a map over the documents without any shuffle; more blocks end in
    an anti join by the digest of the text."""
    parts, blocks = blocks_of(docs, benchmark, item_col, bench_text, text_col, size, block_windows)
    flag = fresh(docs, "dirty")
    if parts == 1:
        block = next(blocks)

        @F.pandas_udf("boolean")
        def dirty(texts: pd.Series) -> pd.Series:
            found = (match(t, block.value) for t in texts)
            return pd.Series([is_dirty(len(words), covered(spans), share) for words, spans, _ in found], dtype=bool)

        return docs.withColumn(flag, dirty.asNondeterministic()(text_col)).filter(~F.col(flag)).drop(flag)
    bad = hits(docs, blocks, text_col, share).filter("contaminated").select(F.col("digest").alias(flag))
    digest = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256))
    return docs.join(bad, digest == bad[flag], "left_anti")
