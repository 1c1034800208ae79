"""Licence scans: sparse TF-IDF cosine to templates, then inheritance along paths.

Passages of a text (whole texts are searched) are compared with short templates
of public licences by the cosine of their TF-IDF vectors; the best passage gives
the text's own licence.  Passages are lines and sentences, up to three of them
joined, and windows of the text's words whatever the line breaks, so a wrapped
notice is read as a whole.  A match shares at least two words besides ``COMMON``
ones with its template (one is a name, not a notice), and a reservation of
rights yields to any licence that is found.  Only passages without a trigger
word are skipped, which cannot match: a cosine is at most the root of the squared
weights that passage and template share, and a template's triggers are all its
words but ``COMMON`` ones and either one more, or those whose squared weights
stay, with the ``COMMON`` ones', under the squared threshold.

A text that is a licence file - by its name, or because most of its words are
such passages - licenses its directory, and a text without a licence of its own
inherits from the nearest ancestor directory that has one.

Texts are only mapped, once, to narrow rows.  The path joins work on distinct
directories: each is expanded to its ancestors, joined with the licensed
directories, and the longest match wins, so a directory with a third of all
texts is one row there.  The licence of a directory goes back to the texts as a
broadcast up to ``BROADCAST_DIRS`` directories, by a plain join (split at hot
directories by adaptive execution) beyond.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, release, written

THRESHOLD = 0.6
FILE_SHARE = 0.5
LONG = 60
#: Words before and from a trigger word, of the windows over the text.
WINDOWS = ((0, 7), (0, 10), (0, 15), (0, 25), (5, 10), (15, 30))
BROADCAST_DIRS = 200_000
RESERVED = "Proprietary"
COMMON = frozenset("a all and any are by for in into is of or that the this to under with without".split())
CUT = re.compile(r"\n+|(?<=[.!?;])\s+(?=[^0-9])")
FILE_NAME = re.compile(r"(?:^|/)(?:un)?(?:licen[sc]es?|copying|copyright)(?:[.\-_][^/]*)?$", re.I)
TOKEN = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")

#: Notices as the licences' own texts suggest them.
TEMPLATES = {
    "MIT": ["Released under the MIT License", "Licensed under the MIT License", "SPDX-License-Identifier: MIT",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0", "Apache License Version 2.0, January 2004",
                   "SPDX-License-Identifier: Apache-2.0"],
    "GPL-2.0": ["licensed under the GNU General Public License, version 2", "SPDX-License-Identifier: GPL-2.0",
                "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "GPL-3.0": ["licensed under the GNU General Public License, version 3", "SPDX-License-Identifier: GPL-3.0",
                "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "LGPL-2.1": ["licensed under the GNU Lesser General Public License, version 2.1", "SPDX-License-Identifier: LGPL-2.1",
                 "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"],
    "LGPL-3.0": ["licensed under the GNU Lesser General Public License, version 3", "SPDX-License-Identifier: LGPL-3.0",
                 "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "AGPL-3.0": ["licensed under the GNU Affero General Public License, version 3", "SPDX-License-Identifier: AGPL-3.0",
                 "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "BSD": ["Licensed under the BSD License", "Redistribution and use in source and binary forms, with or without modification, "
            "are permitted provided that the following conditions are met"],
    "ISC": ["Licensed under the ISC License", "Permission to use, copy, modify, and/or distribute this software for any purpose "
            "with or without fee is hereby granted"],
    "MPL-2.0": ["subject to the terms of the Mozilla Public License, version 2.0", "licensed under the Mozilla Public License 2.0"],
    "Unlicense": ["This is free and unencumbered software released into the public domain"],
    "CC0-1.0": ["CC0 1.0 Universal public domain dedication", "released under CC0 1.0"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0", "licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA-4.0": ["Licensed under CC BY-NC-SA 4.0",
                        "licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
    "CC-BY-NC-ND-4.0": ["Licensed under CC BY-NC-ND 4.0",
                        "licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"],
    "Proprietary": ["Copyright. All rights reserved."],
}


class Templates:
    """TF-IDF vectors of the templates and an index by term."""

    def __init__(self, templates: dict[str, list[str]]):
        rows = [(name, Counter(TOKEN.findall(t.lower()))) for name, ts in sorted(templates.items()) for t in ts]
        df = Counter(w for _, c in rows for w in c)
        self.idf = {w: 1 + math.log(len(rows) / n) for w, n in df.items()}
        self.unseen = 1 + math.log(len(rows) + 1)
        self.names, self.index, self.triggers = [name for name, _ in rows], {}, set()
        for k, (_, c) in enumerate(rows):
            norm = math.sqrt(sum((n * self.idf[w]) ** 2 for w, n in c.items()))
            for w, n in c.items():
                self.index.setdefault(w, []).append((k, n * self.idf[w] / norm))
            light = sum((c[w] * self.idf[w] / norm) ** 2 for w in c if w in COMMON)
            for i, w in enumerate(sorted(c.keys() - COMMON, key=lambda w: (c[w] * self.idf[w], w))):
                light += (c[w] * self.idf[w] / norm) ** 2
                if i and light >= THRESHOLD ** 2 - 1e-9:
                    self.triggers.add(w)

    def best(self, words: list[str]) -> tuple[float, str | None]:
        """Largest cosine and its licence (ties: the first name); words that no
        template has count a little, since notices stand among other words."""
        c, dots, norm, shared = Counter(words), {}, 0.0, {}
        for w, n in c.items():
            idf = self.idf.get(w)
            if idf is None:
                norm += (0.25 * n * self.unseen) ** 2
                continue
            norm += (n * idf) ** 2
            for k, v in self.index[w]:
                dots[k] = dots.get(k, 0.0) + n * idf * v
                if w not in COMMON:
                    shared[k] = shared.get(k, 0) + 1
        dots = {k: v for k, v in dots.items() if shared.get(k, 0) > 1}
        if not dots:
            return 0.0, None
        k = min(dots, key=lambda k: (-round(dots[k], 12), self.names[k]))
        return dots[k] / math.sqrt(norm), self.names[k]


def passages(text: str, templates: Templates):
    """The words of a text, and for every trigger word the passages that hold
    it, as (start, end): its line or sentence if that is not long (else None),
    and the joined neighbours and windows round the word."""
    low = text.lower()
    if templates.triggers.isdisjoint(TOKEN.findall(low)):
        return [], []
    words, ends = [], [0]
    for part in CUT.split(low):
        words += TOKEN.findall(part)
        if len(words) > ends[-1]:
            ends.append(len(words))
    out, piece, n = [], 0, len(words)
    for i, w in enumerate(words):
        if w not in templates.triggers:
            continue
        while ends[piece + 1] <= i:
            piece += 1
        own = (ends[piece], ends[piece + 1])
        joined = [(ends[max(0, piece - a)], ends[min(len(ends) - 1, piece + 1 + b)]) for a, b in ((1, 0), (0, 1), (1, 1), (0, 2), (2, 0))]
        ways = [(max(0, i - a), min(n, i + b)) for a, b in WINDOWS] + [x for x in joined if x[1] - x[0] <= LONG]
        out.append((own if own[1] - own[0] <= LONG else None, ways))
    return words, out


def own_licence(text: str | None, templates: Templates) -> tuple[str | None, float, float]:
    """Best licence of a text, its cosine, and the share of the text's words in licensing passages."""
    if not text:
        return None, 0.0, 0.0
    words, found = passages(text, templates)
    best, spoken, known = (0.0, None), set(), {}

    def got(span):
        if span not in known:
            known[span] = templates.best(words[span[0]:span[1]])
        return known[span]

    def order(x):
        return x[0] < THRESHOLD, x[1] == RESERVED, -x[0], x[1] or ""

    for own, ways in found:
        top = min([own, *ways] if own else ways, key=lambda x: order(got(x)))
        for span in {own, top} - {None}:
            if got(span)[0] >= THRESHOLD:
                spoken.update(range(*span))
        best = min(best, got(top), key=order)
    return (best[1] if best[0] >= THRESHOLD else None), best[0], len(spoken) / max(1, len(words))


def scan(docs: DataFrame, path, id_col="doc_id", text_col="text", templates=None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, path, license, score, origin,
    license_dir``; ``origin`` is ``own``, ``inherited`` or ``none``.

    ``path`` is a column of slash-separated paths.  A null or empty text has no
    licence of its own and may inherit; a null path neither gives nor inherits.
    If licence files of one directory disagree, the best cosine and then the
    first name wins.  Repeated rows give a row each; other columns are not read."""
    known = docs.sparkSession.sparkContext.broadcast(Templates(templates or TEMPLATES))

    def run(texts):
        return list(zip(*(own_licence(t, known.value) for t in texts.to_pylist()))) or [[], [], []]

    src = docs.select(F.col(id_col).alias("doc_id"), F.regexp_replace(path, "/+", "/").alias("path"), F.col(text_col).alias("text"))
    rows = written(map_texts(src, run, "license string, score double, share double")
                   .withColumn("dir", F.regexp_replace("path", "/?[^/]*$", "")), "licences")
    named = F.coalesce(F.col("path").rlike(FILE_NAME.pattern.replace("(?:^|/)", "(?i)(^|/)", 1)), F.lit(False))
    files = (rows.filter(F.col("license").isNotNull() & F.col("dir").isNotNull() & (named | (F.col("share") >= FILE_SHARE)))
             .groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("b"))
             .select(F.col("dir").alias("up"), F.col("b.license").alias("given"), (-F.col("b.s")).alias("given_score")))
    # distinct directories, expanded to their ancestors, the root ("") last
    dirs = rows.filter(F.col("dir").isNotNull()).select("dir").distinct()
    parts = F.split("dir", "/")
    ups = dirs.select("dir", F.explode(F.when(F.col("dir") == "", F.array(F.lit(""))).otherwise(F.concat(
        F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)),
                                        lambda n: F.array_join(F.slice(parts, 1, n), "/"))))).alias("up"))
    near = written(ups.join(files, "up").groupBy("dir").agg(F.max(F.struct(F.length("up").alias("n"), "up", "given", "given_score"))
                                                            .alias("b")).select("dir", "b.up", "b.given", "b.given_score"), "dirs")
    side = F.broadcast(near) if near.count() <= BROADCAST_DIRS else near
    own, inherits = F.col("license").isNotNull(), F.col("given").isNotNull()
    return rows.join(side, "dir", "left").select(
        "doc_id", "path", F.coalesce("license", "given").alias("license"),
        F.when(own, F.col("score")).when(inherits, F.col("given_score")).otherwise(F.col("score")).alias("score"),
        F.when(own, "own").when(inherits, "inherited").otherwise("none").alias("origin"),
        F.when(~own & inherits, F.col("up")).alias("license_dir"))
