"""Queries of the corpus operators over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline

from . import conversations, decontaminate, embeddings, html_text, langid, language_model, licenses, lsh_search, mixing, quality, simhash, toxicity, whitening

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return register


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op1_toxicity")
def op1(spark, sf_dir):
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_language_model")
def op2(spark, sf_dir):
    return language_model.score(table(spark, sf_dir, "documents"))


@query("op3_quality")
def op3(spark, sf_dir):
    """The source is the host; the language is its first directory, as in the pages' urls."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_html_text")
def op4(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
        r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op5_decontaminate", sql=f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({WORDS.format('text')}, []) AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS.format('text')} AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(list_slice(w, p, p + least(13, len(w)) - 1), ' ') AS win
        FROM i, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS u(p) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
pos AS (SELECT r, n, p, array_to_string(list_slice(w, p, p + n - 1), ' ') AS win
        FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS u(p) WHERE len(w) >= n),
found AS (SELECT r, p, n, item FROM pos JOIN win USING (n, win)),
hit AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT DISTINCT r, p, n FROM found) f, unnest(range(p, p + n)) AS u(q) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)""")
def op5(spark, sf_dir):
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_langid")
def op6(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op7_embeddings", sql="""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
         AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
         WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(node, seen) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.node, l.b FROM reach r JOIN link l ON l.a = r.seen)
SELECT v.vec_id, (SELECT count(*) FROM link WHERE link.a = v.vec_id) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN (SELECT node, min(seen) AS component_id FROM reach GROUP BY node) c ON c.node = v.vec_id""")
def op7(spark, sf_dir):
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op8_simhash")
def op8(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op9_mixing")
def op9(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op10_licenses")
def op10(spark, sf_dir):
    """The path of a document is source/lang/doc_id.txt."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat(F.coalesce("source", F.lit("")), F.lit("/"), F.coalesce("lang", F.lit("")), F.lit("/"),
                    F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(".txt"))
    return licenses.scan(docs, path)


@query("op11_nearest")
def op11(spark, sf_dir):
    return lsh_search.search(table(spark, sf_dir, "embeddings"))


#: crc32 of an ASCII text, byte by byte and bit by bit.
CRC = """xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split({}, ''), lambda c: ord(c)::UBIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda i: i::UBIGINT)),
    lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END)), 4294967295::UBIGINT)"""


def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _edit(cost: str, letter: str, line: str, behind: str) -> str:
    """A value (cost, audit, output) before one edit of the value ``behind``."""
    return f"{{'c': {behind}.c + {cost}, 'a': '{letter}' || {behind}.a, 'o': {line} || {behind}.o}}"


def _never(value: str, test: str) -> str:
    return f"CASE WHEN {test} THEN {value} ELSE {{'c': 1000000000::BIGINT, 'a': '~', 'o': ''}} END"


def _row_options(state: str, kept: dict, reroled: tuple) -> str:
    """The least value of a state when the next row is kept, reroled or deleted."""
    line = "chr(10) || role || ':' || text"
    keeps = [_never(_edit("late", "K", line, f"v{t}"), f"NOT gone AND initial = '{i}'") for i, t in kept.items()]
    role, t = reroled
    return _least(_edit("3", "D", "''", f"v{state}"), *keeps,
                  _never(_edit("2 + late", "R", f"chr(10) || '{role}:' || text", f"v{t}"), "NOT gone"))


def _insert(role: str, behind: str) -> str:
    return _edit("2", "I", f"(chr(10) || '{role}:')", behind)


@query("op12_conversations", sql=f"""
WITH RECURSIVE fate AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {CRC.format("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS f FROM conversations),
hurt AS (SELECT conv_id, turn, f, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
                CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text FROM fate WHERE f <> 0),
twice AS (SELECT * FROM hurt UNION ALL SELECT * FROM hurt WHERE f = 3),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(role || chr(0) || text)) AS i,
                  left(role, 1) AS initial, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank,
                  NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') AS late FROM twice),
seen AS (SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
                coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au'), FALSE) AS odd FROM placed),
told AS (SELECT conv_id, i, initial, role, text, odd, turn, blank, again, NOT blank AND NOT again AND late AS short, blank OR again AS gone FROM seen),
sums AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
                count(*) FILTER (again) AS duplicate, count(*) FILTER (short) AS truncated, count(*) FILTER (odd) AS illegal, count(*) AS n
         FROM told GROUP BY conv_id),
walk(conv_id, i, vN, vS, vU, vA) AS (
  SELECT conv_id, n + 1, {{'c': 0::BIGINT, 'a': '', 'o': ''}}, {{'c': 4::BIGINT, 'a': 'II', 'o': chr(10) || 'user:' || chr(10) || 'assistant:'}},
         {{'c': 2::BIGINT, 'a': 'I', 'o': chr(10) || 'assistant:'}}, {{'c': 0::BIGINT, 'a': '', 'o': ''}} FROM sums
  UNION ALL
  SELECT conv_id, i, {_least("bN", _insert("user", "wU"))}, {_least("bS", _insert("user", "wU"))}, wU, {_least("bA", _insert("user", "bU"))}
  FROM (SELECT *, {_least("bU", _insert("assistant", "bA"))} AS wU FROM (
    SELECT r.conv_id, r.i, {_row_options("N", {"s": "S", "u": "U"}, ("user", "U"))} AS bN, {_row_options("S", {"u": "U"}, ("user", "U"))} AS bS,
           {_row_options("U", {"a": "A"}, ("assistant", "A"))} AS bU, {_row_options("A", {"u": "U"}, ("user", "U"))} AS bA
    FROM walk JOIN (SELECT *, short::BIGINT AS late FROM told) r ON r.conv_id IS NOT DISTINCT FROM walk.conv_id AND r.i = walk.i - 1))),
done AS (SELECT conv_id, vN AS v FROM walk WHERE i = 1)
SELECT k.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(v.c, 0) AS cost, coalesce(v.a, '') AS audit, sha256(coalesce(substr(v.o, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) k LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM k.conv_id
LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM k.conv_id""")
def op12(spark, sf_dir):
    return conversations.repair(table(spark, sf_dir, "conversations"))


@query("op13_whitening")
def op13(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
