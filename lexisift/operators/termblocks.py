"""N-grams of many texts at once: the words of a block of rows lie in one Arrow
array, n-grams are hashed, joined, looked up and counted over the whole block.

Every function of this module runs inside a task (``mapInArrow``) on rows
``(..., _words array<string>)``; ``tfidf`` and ``neural`` call them."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

#: Words (and 16-byte units of text) taken at once; a longer text is a block of its own.
BLOCK = 1_000_000
#: Count table of hashed n-grams.
BITS = 21


def blocks(batches):
    """The incoming batches in slices of at most about ``BLOCK`` words, as
    (slice without the words, words, row of each word)."""
    for batch in batches:
        words = batch.column("_words")
        rest = batch.drop_columns("_words")
        n = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = words.flatten()
        size = pc.binary_length(flat).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(n)])
        load = ends + np.concatenate([[0], np.cumsum(size, dtype=np.int64)])[ends] // 16
        a = 0
        while a < len(n):
            b = max(a + 1, int(np.searchsorted(load, load[a] + BLOCK, "right")) - 1)
            yield rest.slice(a, b - a), flat.slice(ends[a], ends[b] - ends[a]), np.repeat(np.arange(b - a), n[a:b])
            a = b


def hashed(flat, n_max):
    """64-bit hashes of the n-grams that start at each word, for n up to ``n_max``."""
    coded = flat.dictionary_encode()
    # the dictionary is never empty for hash_array, whose empty result has no type
    one = pd.util.hash_array(np.append(coded.dictionary.to_numpy(zero_copy_only=False), "").astype(object), categorize=False)
    one = one[coded.indices.to_numpy()]
    out, h = [], one
    for n in range(1, n_max + 1):
        if n > 1:
            h = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ one[n - 1:]
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        out.append(h)
    return out


def starts(rows, n):
    """Words at which an n-gram within one row starts."""
    last = max(len(rows) - n + 1, 0)
    return np.flatnonzero(rows[:last] == rows[len(rows) - last:])


def joined(flat, at, n):
    """The n-grams that start at the words ``at``, joined by one space."""
    parts = [flat.take(pa.array(at + k)) for k in range(n)]
    return parts[0] if n == 1 else pc.binary_join_element_wise(*parts, " ")


def bucket(h):
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def terms(flat, rows, n_min, n_max, chosen=None):
    """(row, term) of every n-gram of a block; with ``chosen``, a flag per
    bucket, only n-grams of the flagged buckets."""
    at_rows, found = [], []
    hashes = hashed(flat, n_max) if chosen is not None else None
    for n in range(n_min, n_max + 1):
        at = starts(rows, n)
        if hashes is not None and len(at):
            at = at[chosen[bucket(hashes[n - 1][at])]]
        at_rows.append(rows[at])
        found.append(joined(flat, at, n))
    return np.concatenate(at_rows), pa.concat_arrays(found)


def counted(rows, found):
    """Table (row, term, tf)."""
    t = pa.table({"row": rows, "term": found})
    return t.group_by(["row", "term"]).aggregate([([], "count_all")]).rename_columns(["row", "term", "tf"])


def frequencies(n_min, n_max):
    """Rows (key..., term, tf)."""
    def run(batches):
        for rest, flat, rows in blocks(batches):
            t = counted(*terms(flat, rows, n_min, n_max)).combine_chunks()
            keys = rest.take(t["row"].combine_chunks())
            yield from pa.table([*keys.columns, t["term"], t["tf"]], names=[*keys.schema.names, "term", "tf"]).to_batches(max_chunksize=100_000)
    return run


def totals(n_min, n_max):
    """Rows (term, count), combined over each block."""
    def run(batches):
        for _, flat, rows in blocks(batches):
            t = pa.table({"term": terms(flat, rows, n_min, n_max)[1]})
            t = t.group_by("term").aggregate([([], "count_all")]).rename_columns(["term", "count"])
            yield from t.to_batches(max_chunksize=100_000)
    return run


def statistics(n_min, n_max, chosen=None):
    """Rows (term, df, ctf), combined over each block."""
    def run(batches):
        flags = None if chosen is None else np.unpackbits(np.frombuffer(chosen.value, np.uint8)).astype(bool)
        for _, flat, rows in blocks(batches):
            t = counted(*terms(flat, rows, n_min, n_max, flags))
            t = t.group_by("term").aggregate([([], "count_all"), ("tf", "sum")]).rename_columns(["term", "df", "ctf"])
            yield from t.to_batches(max_chunksize=100_000)
    return run


def bucket_counts(n_min, n_max):
    """Rows (bucket, n): the occurrences of n-grams in each bucket, over the task."""
    def run(batches):
        table = np.zeros(1 << BITS, np.int64)
        for _, flat, rows in blocks(batches):
            hashes = hashed(flat, n_max)
            for n in range(n_min, n_max + 1):
                at = starts(rows, n)
                if len(at):
                    table += np.bincount(bucket(hashes[n - 1][at]), minlength=1 << BITS)
        full = np.flatnonzero(table)
        yield pa.record_batch([pa.array(full.astype(np.int32)), pa.array(table[full])], names=["bucket", "n"])
    return run


def entries(vocab, n_min, n_max, sublinear):
    """Rows (key..., _e array<struct<idx, w>>): each row's vocabulary terms by
    index with their weights before the norm."""
    def run(batches):
        known, idf = vocab.value
        known = pa.array(known, pa.string())
        flags = np.zeros(1 << BITS, bool)
        by_n = [t.split(" ") for t in known.to_pylist()]
        for n in {len(t) for t in by_n}:
            some = [t for t in by_n if len(t) == n]
            flat = pa.array([w for t in some for w in t], pa.string())
            flags[bucket(hashed(flat, n)[n - 1][::n])] = True
        for rest, flat, rows in blocks(batches):
            at, found = terms(flat, rows, n_min, n_max, flags)
            idx = pc.index_in(found, value_set=known)
            hit = idx.is_valid().to_numpy(zero_copy_only=False)
            pair, tf = np.unique(at[hit] * (len(idf) + 1) + idx.drop_null().to_numpy(), return_counts=True)
            row, idx = np.divmod(pair, len(idf) + 1)
            raw = 1.0 + np.log(tf) if sublinear else tf.astype(float)
            e = pa.StructArray.from_arrays([pa.array(idx.astype(np.int32)), pa.array(raw * idf[idx])], names=["idx", "w"])
            ends = np.searchsorted(row, np.arange(rest.num_rows + 1)).astype(np.int32)
            yield pa.record_batch([*rest.columns, pa.ListArray.from_arrays(pa.array(ends), e)], names=[*rest.schema.names, "_e"])
    return run


def word_ids(vocab, unknown):
    """Rows (key..., _ids array<int>): the id of each word, ``unknown`` without one."""
    def run(batches):
        known, ids = vocab.value
        known = pa.array(known, pa.string())
        ids = np.append(ids, unknown).astype(np.int32)
        for rest, flat, rows in blocks(batches):
            at = pc.fill_null(pc.index_in(flat, value_set=known), len(known)).to_numpy()
            ends = np.searchsorted(rows, np.arange(rest.num_rows + 1)).astype(np.int32)
            yield pa.record_batch([*rest.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(ids[at]))],
                                  names=[*rest.schema.names, "_ids"])
    return run
