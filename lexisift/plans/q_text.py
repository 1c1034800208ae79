"""Testdata bindings: sources, filters, cleaning, tokens, classes, split.

``documents`` is the main fixture (``text`` -> code, ``lang`` -> language,
``doc_id`` -> key); ``pages`` and ``conversations`` are further sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..functions import tokens as T
from ..functions.labels import LANGUAGE_ALIASES, sql_map_case
from ..operators import classes as K
from ..operators import split as S
from ..operators import tfidf as TF
from ..session import cut_lineage, spread
from .registry import query, table

DOC_CLASSES = ["de", "en", "es", "fr"]


def docs(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.col("text").alias("code"), F.col("lang").alias("language"))


def cleaned(spark, sf):
    """Cleaned, non-empty documents, written once to the checkpoint folder
    (several aggregates read it)."""
    d = spread(docs(spark, sf), "doc_id")
    return cut_lineage(K.with_nonempty(d, C.clean_text("code"), "clean_code").drop("code"), "cleaned")


def balanced(spark, sf, n=400):
    return S.balance_classes(cleaned(spark, sf), "language", "doc_id", n, 2, seed=42)


def balanced_table(spark, sf):
    """The balanced documents written once (read by several branches)."""
    return cut_lineage(balanced(spark, sf).select("doc_id", "language", "clean_code"), "balanced")


# ------------------------------------------------------------- SQL pieces --
SQL_CLEANED = f"""SELECT doc_id, text AS code, lang AS language, {C.sql_clean_text('text')} AS clean_code
FROM documents"""
SQL_CLEANED_NONEMPTY = f"SELECT * FROM ({SQL_CLEANED}) WHERE length(clean_code) > 0"
SQL_BALANCED = f"""SELECT doc_id, code, language, clean_code FROM (
  SELECT c.*, row_number() OVER (PARTITION BY language ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) AS rn,
         count(*) OVER (PARTITION BY language) AS n_class
  FROM ({SQL_CLEANED_NONEMPTY}) c)
WHERE n_class >= 2 AND rn <= (
  SELECT greatest(least(min(cnt), 400), 2) FROM (
    SELECT count(*) AS cnt FROM ({SQL_CLEANED_NONEMPTY}) GROUP BY language HAVING count(*) >= 2))"""


def _group_query(name, group, tbl="documents", key="doc_id", col="text"):
    @query(name, sql=f"SELECT {key}, {C.sql_group(col, group)} AS clean FROM {tbl}")
    def _q(spark, sf):
        t = table(spark, sf, tbl)
        fn = {"block_comments": C.remove_block_comments, "line_comments": C.remove_line_comments,
              "html_comments": C.remove_html_comments, "string_literals": C.remove_string_literals,
              "whitespace": C.normalize_whitespace}[group]
        return t.transform(lambda x: spread(x, key)).select(key, fn(col).alias("clean"))
    return _q


_group_query("clean_block_comments", "block_comments")
_group_query("clean_line_comments", "line_comments")
_group_query("clean_html_comments", "html_comments", "pages", "page_id", "html")
_group_query("clean_string_literals", "string_literals")
_group_query("normalize_whitespace", "whitespace")


@query("clean_text", sql=f"SELECT doc_id, {C.sql_clean_text('text')} AS clean_code FROM documents")
def q_clean_text(spark, sf):
    return docs(spark, sf).transform(lambda x: spread(x, "doc_id")).select("doc_id", C.clean_text("code").alias("clean_code"))


@query("clean_and_filter", sql=f"SELECT doc_id, language, clean_code FROM ({SQL_CLEANED_NONEMPTY})")
def q_clean_and_filter(spark, sf):
    d = docs(spark, sf).transform(lambda x: spread(x, "doc_id"))
    return K.with_nonempty(d, C.clean_text("code"), "clean_code").select("doc_id", "language", "clean_code")


# ---------------------------------------------------------------- tokens --
@query("tokenize", sql=f"""SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens,
  md5(coalesce(array_to_string(t, chr(1)), '')) AS tokens_md5
FROM (SELECT doc_id, {T.sql_code_tokens('text')} AS t FROM documents)""")
def q_tokenize(spark, sf):
    d = docs(spark, sf).transform(lambda x: spread(x, "doc_id")).select("doc_id", T.code_tokens("code").alias("t"))
    return d.select("doc_id", F.size("t").cast("long").alias("n_tokens"),
                    F.md5(F.concat_ws("\u0001", "t")).alias("tokens_md5"))


@query("tokenize_column", sql=f"""SELECT token, count(*) AS count
FROM (SELECT unnest({T.sql_code_tokens('text')}) AS token FROM documents) GROUP BY token""")
def q_tokenize_column(spark, sf):
    d = docs(spark, sf).transform(lambda x: spread(x, "doc_id"))
    return (K.tokenize_column(d, "code")
            .select(F.explode("code_tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("count")))


@query("word_tokens", sql=f"""SELECT doc_id, CAST(len(t) AS BIGINT) AS n_words,
  md5(coalesce(array_to_string(t, chr(1)), '')) AS words_md5
FROM (SELECT doc_id, {T.sql_word_tokens('text')} AS t FROM documents)""")
def q_word_tokens(spark, sf):
    d = docs(spark, sf).transform(lambda x: spread(x, "doc_id")).select("doc_id", T.word_tokens("code").alias("t"))
    return d.select("doc_id", F.size("t").cast("long").alias("n_words"),
                    F.md5(F.concat_ws("\u0001", "t")).alias("words_md5"))


SQL_NGRAM_LIST = ("list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i+1]), "
                  "list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i+1] || ' ' || t[i+2]))")


@query("ngrams", sql=f"""SELECT term, count(*) AS count FROM (
  SELECT unnest({SQL_NGRAM_LIST}) AS term
  FROM (SELECT {T.sql_word_tokens('text')} AS t FROM documents)) GROUP BY term""")
def q_ngrams(spark, sf):
    d = docs(spark, sf).transform(lambda x: spread(x, "doc_id"))
    return TF.ngram_counts(d, "code", 1, 3)


# ---------------------------------------------------------- label filters --
LANG_NAMES = {"en": "english", "fr": "french", "de": "german"}


#: Labels given to the documents in turn: aliases, names that stay, one unknown.
RAW_LABELS = ["C++", "JS", "golang", "CSS", "html", "Python", "Kotlin"]
SQL_RAW_LABEL = f"{RAW_LABELS!r}[doc_id % {len(RAW_LABELS)} + 1]"


@query("normalize_labels", sql=f"""SELECT doc_id,
  coalesce({sql_map_case(f'lower({SQL_RAW_LABEL})', LANGUAGE_ALIASES)}, lower({SQL_RAW_LABEL})) AS language FROM documents""")
def q_normalize_labels(spark, sf):
    raw = F.element_at(F.array(*(F.lit(x) for x in RAW_LABELS)), (F.col("doc_id") % len(RAW_LABELS) + 1).cast("int"))
    d = table(spark, sf, "documents").select("doc_id", raw.alias("raw"))
    return K.normalize_labels(d, "raw", out_col="language").select("doc_id", "language")


@query("tag_map_join", sql=f"""SELECT doc_id, {sql_map_case('lang', LANG_NAMES)} AS language
FROM documents WHERE {sql_map_case('lang', LANG_NAMES)} IS NOT NULL""")
def q_tag_map_join(spark, sf):
    d = table(spark, sf, "documents")
    return K.map_tags(d, "lang", "language", LANG_NAMES).select("doc_id", "language")


@query("filter_known_classes", sql="SELECT doc_id, lang AS language FROM documents WHERE lang IN ('en', 'fr', 'de')")
def q_filter_known_classes(spark, sf):
    return K.filter_known_classes(docs(spark, sf), "language", ["en", "fr", "de"]).select("doc_id", "language")


@query("filter_min_length", sql="""SELECT conv_id, turn, role FROM conversations
WHERE length(coalesce(text, 'nan')) > 40""")
def q_filter_min_length(spark, sf):
    c = table(spark, sf, "conversations")
    return K.filter_min_length(c, "text", 40).select("conv_id", "turn", "role")


# ------------------------------------------------------- class aggregates --
@query("class_distribution", sql="SELECT lang AS language, count(*) AS count FROM documents GROUP BY lang")
def q_class_distribution(spark, sf):
    return K.class_distribution(docs(spark, sf), "language")


@query("class_distribution_orders", sql="""SELECT o_orderpriority AS language, count(*) AS count
FROM orders GROUP BY o_orderpriority""")
def q_class_distribution_orders(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("language"))
    return K.class_distribution(o, "language")


@query("distinct_labels", sql="SELECT DISTINCT event_type FROM events")
def q_distinct_labels(spark, sf):
    return K.distinct_labels(table(spark, sf, "events"), "event_type")


@query("drop_rare_classes", sql="""SELECT doc_id, lang AS language FROM documents
WHERE lang IN (SELECT lang FROM documents GROUP BY lang HAVING count(*) >= 130)""")
def q_drop_rare_classes(spark, sf):
    return K.drop_rare_classes(docs(spark, sf), "language", 130).select("doc_id", "language")


@query("balance_target", sql=f"""SELECT CAST(greatest(least(min(cnt), 400), 2) AS BIGINT) AS target
FROM (SELECT count(*) AS cnt FROM ({SQL_CLEANED_NONEMPTY}) GROUP BY language)""")
def q_balance_target(spark, sf):
    # only the label and whether anything is left after cleaning are needed
    d = spread(docs(spark, sf), "doc_id")
    left = K.with_nonempty(d, C.clean_text("code"), "clean_code").select("language")
    return K.balance_target(left, "language", 400, 2)


@query("balance_classes", sql=f"SELECT doc_id, language FROM ({SQL_BALANCED})")
def q_balance_classes(spark, sf):
    return balanced(spark, sf).select("doc_id", "language")


LI_KEY_SQL = "concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


@query("balance_classes_lineitem", sql=f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY md5('7:' || {LI_KEY_SQL}), {LI_KEY_SQL}) AS rn
  FROM lineitem)
WHERE rn <= (SELECT greatest(least(min(c), 5000), 2) FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_returnflag))""")
def q_balance_classes_lineitem(spark, sf):
    """A5 at volume: 5,000 rows per return flag, keyed by a unique composite
    key (order, line, part, supplier)."""
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
        F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("k"))
    out = S.balance_classes(li, "l_returnflag", "k", 5000, 2, seed=7)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")


@query("encode_labels", sql="""SELECT doc_id, lang AS language,
  CAST(dense_rank() OVER (ORDER BY lang) - 1 AS DOUBLE) AS label FROM documents""")
def q_encode_labels(spark, sf):
    return K.encode_labels(docs(spark, sf), "language", "label").select("doc_id", "language", "label")


def sql_split(src: str, test_size: float = 0.2) -> str:
    return f"""WITH b AS ({src}),
counts AS (SELECT language, count(*) AS n_class FROM b GROUP BY language),
tot AS (SELECT sum(n_class) AS n, CAST(ceil(CAST(sum(n_class) AS DOUBLE) * {test_size}) AS BIGINT) AS n_test FROM counts),
p AS (SELECT language, n_class, n, n - n_test AS n_train_total,
        (n_class * (n - n_test)) // n AS fl, (n_class * (n - n_test)) % n AS rem FROM counts, tot),
p2 AS (SELECT *, n_train_total - sum(fl) OVER () AS short,
        row_number() OVER (ORDER BY rem DESC, language) AS r FROM p),
plan AS (SELECT language, fl + CASE WHEN r <= short THEN 1 ELSE 0 END AS n_train FROM p2),
ranked AS (SELECT b.*, row_number() OVER (PARTITION BY language ORDER BY md5('42:split:' || CAST(doc_id AS VARCHAR)), doc_id) AS rk FROM b)
SELECT doc_id, ranked.language, CASE WHEN rk <= n_train THEN 'train' ELSE 'test' END AS split, clean_code
FROM ranked JOIN plan ON ranked.language = plan.language"""


#: The split that the classifiers are fitted on (balanced documents).
SQL_SPLIT = sql_split(SQL_BALANCED)
SQL_SPLIT_ALL = sql_split(SQL_CLEANED_NONEMPTY)


def sql_folds(src: str, key: str, k: int = 5) -> str:
    """(key, language, fold) of the rows of ``src``: classes in the order of their first rows."""
    return f"""WITH b AS ({src}),
counts AS (SELECT language, count(*) AS n_class, min({key}) AS first FROM b GROUP BY language),
plan AS (SELECT language, n_class, coalesce(sum(n_class) OVER (ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM counts),
ranked AS (SELECT b.{key}, b.language, row_number() OVER (PARTITION BY language ORDER BY {key}) - 1 AS r0 FROM b)
SELECT {key}, ranked.language, {S.sql_fold_of('r0', 'start', 'n_class', k)} AS fold
FROM ranked JOIN plan ON ranked.language = plan.language"""


def split_all(spark, sf):
    return S.stratified_split(cleaned(spark, sf), "language", "doc_id", 0.2, 42)


@query("stratified_split", sql=f"SELECT doc_id, language, split FROM ({SQL_SPLIT_ALL})")
def q_stratified_split(spark, sf):
    return split_all(spark, sf).select("doc_id", "language", "split")


@query("train_label_counts", sql=f"""SELECT language, count(*) AS count FROM ({SQL_SPLIT_ALL})
WHERE split = 'train' GROUP BY language""")
def q_train_label_counts(spark, sf):
    """A10: label counts of the training rows."""
    return K.class_distribution(split_all(spark, sf).filter(F.col("split") == "train"), "language")


@query("split_overlap", sql=f"""SELECT count(*) AS n_shared_texts FROM (
  SELECT DISTINCT clean_code FROM ({SQL_SPLIT_ALL}) WHERE split = 'train'
  INTERSECT SELECT DISTINCT clean_code FROM ({SQL_SPLIT_ALL}) WHERE split = 'test')""")
def q_split_overlap(spark, sf):
    return S.split_overlap(split_all(spark, sf), "clean_code").agg(F.count(F.lit(1)).alias("n_shared_texts"))


@query("stratified_folds", sql=sql_folds(SQL_CLEANED_NONEMPTY, "doc_id"))
def q_stratified_folds(spark, sf):
    return S.stratified_folds(cleaned(spark, sf), "language", "doc_id", 5).select("doc_id", "language", "fold")


STRING_KEY = "'k' || CAST(c_custkey AS VARCHAR) AS k"


@query("stratified_folds_string_key", sql=sql_folds(f"SELECT {STRING_KEY}, c_mktsegment AS language FROM customer", "k"))
def q_stratified_folds_string_key(spark, sf):
    c = table(spark, sf, "customer").selectExpr("concat('k', c_custkey) AS k", "c_mktsegment AS language")
    return S.stratified_folds(c, "language", "k", 5)


@query("stratified_folds_orders", sql=sql_folds("SELECT o_orderkey, o_orderpriority AS language FROM orders", "o_orderkey"))
def q_stratified_folds_orders(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("language"))
    return S.stratified_folds(o, "language", "o_orderkey", 5).select("o_orderkey", "language", "fold")


# ------------------------------------------------------------- set logic --
EXPECTED = ["en", "fr", "de", "es", "it", "pt"]


@query("missing_classes", sql="""SELECT language FROM (VALUES ('en'), ('fr'), ('de'), ('es'), ('it'), ('pt')) v(language)
EXCEPT SELECT lang FROM documents""")
def q_missing_classes(spark, sf):
    return K.missing_classes(docs(spark, sf), "language", EXPECTED)


def _page_lang():
    return F.regexp_extract("url", "/([a-z][a-z])/", 1)


@query("fill_missing_classes", sql="""WITH prim AS (SELECT text AS code, lang AS language FROM documents WHERE lang <> 'es'),
fb AS (SELECT html AS code, regexp_extract(url, '/([a-z][a-z])/', 1) AS language FROM pages)
SELECT md5(code) AS code_md5, language FROM prim
UNION ALL SELECT md5(code), language FROM fb
WHERE language IN (SELECT language FROM (VALUES ('en'), ('fr'), ('de'), ('es')) v(language) EXCEPT SELECT language FROM prim)""")
def q_fill_missing_classes(spark, sf):
    prim = docs(spark, sf).filter(F.col("language") != "es").select("code", "language")
    fb = table(spark, sf, "pages").select(F.col("html").alias("code"), _page_lang().alias("language"))
    out = K.fill_missing_classes(prim, fb, "language", DOC_CLASSES)
    return out.select(F.md5("code").alias("code_md5"), "language")


@query("canonicalize_union", sql="""SELECT md5(text) AS code_md5, lang AS language FROM documents
UNION ALL SELECT md5(html), 'html' FROM pages
UNION ALL SELECT md5(text), role FROM conversations""")
def q_canonicalize_union(spark, sf):
    out = K.canonicalize_union([
        (table(spark, sf, "documents"), "text", "lang"),
        (table(spark, sf, "pages"), "html", F.lit("html")),
        (table(spark, sf, "conversations"), "text", "role"),
    ])
    return out.select(F.md5("code").alias("code_md5"), "language")


FIRST_TARGETS = [("en", "english"), ("de", "german"), ("xx", "unknown")]


@query("first_per_key", sql="""SELECT t.target_pos, t.language, d.text AS program FROM
(VALUES (0, 'en', 'english'), (1, 'de', 'german'), (2, 'xx', 'unknown')) t(target_pos, name, language)
JOIN (SELECT lang, text, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM documents) d
ON d.lang = t.name AND d.rn = 1""")
def q_first_per_key(spark, sf):
    d = table(spark, sf, "documents").select(F.col("lang").alias("language_name"), "doc_id",
                                             F.col("text").alias("program"))
    return K.first_per_key(d, FIRST_TARGETS, "language_name", ["program"], ["doc_id"], "language")
