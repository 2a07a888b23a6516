"""Encyclopedia-style text: article filter, terms, document frequencies,
TF-IDF and latent semantic analysis (fixtures F-docs, F-articles)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.functions.rng import duck_uniform_sql, uniform
from tabulon.functions.text import LETTER_RUN, MIN_TERM_LENGTH, english_stop_words
from tabulon.operators import text as T
from tabulon.operators.clean import filter_articles
from tabulon.operators.topk import top_k_per_group
from tabulon.plans import duck
from tabulon.plans import fixtures as fx
from tabulon.session import checkpoint_dir, written
from tabulon.sources.files import read_xml, write_xml
from tabulon.sources.text import parse_wordlist

NUM_TERMS = 50_000       # vocabulary size of the reference's LSA run
K_CONCEPTS = 100         # concepts of the reference's LSA run
TOP_PER_GROUP = 10
SAMPLE_SEED, SAMPLE_FRACTION = 11, 0.1


def article_terms(spark, sf_dir) -> DataFrame:
    a = filter_articles(fx.articles(spark, sf_dir))
    return T.tokenize_terms(a)


def article_tf(spark, sf_dir) -> DataFrame:
    return T.filter_min_terms(T.term_freq(article_terms(spark, sf_dir)))


def model(spark, sf_dir):
    # tf feeds the document count, document frequencies, totals and tf-idf
    tf = written(article_tf(spark, sf_dir))
    n_docs = tf.select("doc_id").distinct().agg(F.count(F.lit(1))).scalar()
    vocab = T.vocabulary(T.doc_freq(tf), NUM_TERMS)
    idf = T.idf(vocab, n_docs)
    return tf, vocab, idf, T.tfidf(tf, idf)


def q_filter_articles(spark, sf_dir):
    return filter_articles(fx.articles(spark, sf_dir)).select("doc_id", "title")


def q_scan_wordlist(spark, sf_dir):
    lines = fx.docs(spark, sf_dir).select(F.explode(F.split("text", "\n")).alias("value"))
    return parse_wordlist(lines)


def q_tokenize_terms(spark, sf_dir):
    return article_terms(spark, sf_dir).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_tokens"))


def q_term_freq(spark, sf_dir):
    return T.term_freq(article_terms(spark, sf_dir))


def q_filter_min_terms(spark, sf_dir):
    return T.doc_totals(article_tf(spark, sf_dir))


def q_doc_freq(spark, sf_dir):
    return T.doc_freq(article_tf(spark, sf_dir))


def q_topk_terms_by_df(spark, sf_dir):
    _tf, vocab, _idf, _w = model(spark, sf_dir)
    return vocab


def q_idf(spark, sf_dir):
    _tf, _v, idf, _w = model(spark, sf_dir)
    return idf.select("term", F.round("idf", 6).alias("idf"))


def q_tfidf(spark, sf_dir):
    _tf, _v, _idf, w = model(spark, sf_dir)
    return w.select("doc_id", "term", F.round("w", 6).alias("w"))


def q_term_lookup(spark, sf_dir):
    tf, _v, idf, _w = model(spark, sf_dir)
    return tf.join(F.broadcast(idf), "term").select("doc_id", "term_id", "n")


def q_term_doc_matrix(spark, sf_dir):
    _tf, _v, _idf, w = model(spark, sf_dir)
    v = T.term_doc_vectors(w, NUM_TERMS)
    return v.select("doc_id", F.size("indices").cast("bigint").alias("nnz"),
                    F.round(F.aggregate("values", F.lit(0.0), lambda a, x: a + x * x), 6).alias("norm2"))


def q_topk_per_group(spark, sf_dir):
    _tf, _v, _idf, w = model(spark, sf_dir)
    t = top_k_per_group(w, "doc_id", TOP_PER_GROUP, [F.desc("w"), "term"])
    return t.select("doc_id", "term", "rank")


def q_sample_fraction(spark, sf_dir):
    a = fx.articles(spark, sf_dir)
    return a.where(uniform(SAMPLE_SEED, "doc_id") < SAMPLE_FRACTION).select("doc_id")


def q_sink_docfreq_tsv(spark, sf_dir):
    dfq = T.doc_freq(article_tf(spark, sf_dir))
    out = f"{checkpoint_dir(spark).rstrip('/')}/docfreq-{uuid.uuid4().hex}"
    dfq.write.option("sep", "\t").csv(out)
    back = spark.read.schema("term STRING, df BIGINT").option("sep", "\t").csv(out)
    return back


PAGE = ("_id BIGINT, title STRING, ns BIGINT, revision STRUCT<_size: BIGINT, contributor: STRUCT<id: STRING>, "
        "text: STRUCT<_VALUE: STRING, _empty: BOOLEAN, _lang: STRING>>")


def q_scan_xml(spark, sf_dir):
    """Article dump as an XML file: the id is an attribute of the page, the
    text a nested element with attributes beside its value."""
    a = fx.articles(spark, sf_dir)
    text = F.struct(F.col("text").alias("_VALUE"), (F.col("text") == "").alias("_empty"), F.lit("x").alias("_lang"))
    pages = a.select(F.col("doc_id").alias("_id"), "title", "ns", F.struct(
        F.length("text").cast("bigint").alias("_size"), F.struct(F.concat(F.lit("u"), "doc_id").alias("id")).alias("contributor"),
        text.alias("text")).alias("revision"))
    out = f"{checkpoint_dir(spark).rstrip('/')}/articles-{uuid.uuid4().hex}"
    write_xml(pages, out, root_tag="mediawiki", row_tag="page")
    back = read_xml(spark, out, row_tag="page", schema=PAGE)
    # an empty element has no value: its attribute tells it from a missing one
    body = F.when(F.col("revision.text._empty"), F.lit("")).otherwise(F.col("revision.text._VALUE"))
    return back.select(F.col("_id").alias("doc_id"), "title", "ns", F.length(body).cast("bigint").alias("text_chars"), F.md5(body).alias("text_md5"))


def lsa(spark, sf_dir, k=K_CONCEPTS):
    """The fitted LSA model: vocabulary, s, V and U."""
    _tf, vocab, _idf, w = model(spark, sf_dir)
    n_terms = vocab.agg(F.count(F.lit(1))).first()[0]
    s, v, u = T.svd(w, n_terms, min(k, n_terms))
    return vocab, s, v, u


def q_svd_factor(spark, sf_dir):
    _vocab, s, _v, _u = lsa(spark, sf_dir)
    return spark.createDataFrame([(i, float(x)) for i, x in enumerate(s)], "concept INT, singular_value DOUBLE")


def concept_docs(spark, sf_dir, u):
    """Top documents per concept of the model's ``u``, tied to their titles by
    doc_id (carried through the SVD as the row index, not by position)."""
    titles = fx.articles(spark, sf_dir).select("doc_id", "title")
    return top_k_per_group(u, "concept", TOP_PER_GROUP, [F.desc("weight"), "doc_id"]).join(titles, "doc_id") \
        .select("concept", F.lit("doc").alias("kind"), "rank", F.col("title").alias("item"), "weight")


def q_concept_docs_join(spark, sf_dir):
    _vocab, _s, _v, u = lsa(spark, sf_dir)
    return concept_docs(spark, sf_dir, u)


def q_lsa_concepts(spark, sf_dir):
    vocab, _s, v, u = lsa(spark, sf_dir)
    terms = T.top_of_columns(spark, v, TOP_PER_GROUP).join(F.broadcast(vocab.select("term_id", "term")), "term_id")
    tt = top_k_per_group(terms, "concept", TOP_PER_GROUP, [F.desc("weight"), "term"]) \
        .select("concept", F.lit("term").alias("kind"), "rank", F.col("term").alias("item"), "weight")
    return tt.unionByName(concept_docs(spark, sf_dir, u))


QUERIES = {
    "filter_articles": q_filter_articles,
    "scan_wordlist": q_scan_wordlist,
    "tokenize_terms": q_tokenize_terms,
    "term_freq": q_term_freq,
    "filter_min_terms": q_filter_min_terms,
    "doc_freq": q_doc_freq,
    "topk_terms_by_df": q_topk_terms_by_df,
    "idf": q_idf,
    "tfidf": q_tfidf,
    "term_lookup": q_term_lookup,
    "term_doc_matrix": q_term_doc_matrix,
    "topk_per_group": q_topk_per_group,
    "sample_fraction": q_sample_fraction,
    "sink_docfreq_tsv": q_sink_docfreq_tsv,
    "scan_xml": q_scan_xml,
    "svd_factor": q_svd_factor,
    "lsa_concepts": q_lsa_concepts,
    "concept_docs_join": q_concept_docs_join,
}

# ---------------------------------------------------------------- oracle SQL


def _stop_values() -> str:
    return "SELECT * FROM (VALUES " + ", ".join("('" + w.replace("'", "''") + "')" for w in english_stop_words()) + ") s(word)"


def _ctes(**more):
    c = dict(
        arts=duck.F_ARTICLES,
        a="SELECT * FROM arts WHERE ns = 0 AND NOT (contains(substring(text, 1, 50), '#REDIRECT') OR "
          "contains(substring(text, 1, 50), '#redirect')) AND NOT contains(title, '(disambiguation)')",
        sw=_stop_values(),
        toks=f"SELECT doc_id, unnest(regexp_extract_all(lower(text), '{LETTER_RUN}', 1)) AS term FROM a",
        terms=f"SELECT doc_id, term FROM toks WHERE length(term) >= {MIN_TERM_LENGTH} "
              "AND term NOT IN (SELECT word FROM sw)",
        tf0="SELECT doc_id, term, COUNT(*) AS n FROM terms GROUP BY doc_id, term",
        tf="SELECT * FROM tf0 WHERE doc_id IN (SELECT doc_id FROM tf0 GROUP BY doc_id HAVING SUM(n) >= 2)",
        dfq="SELECT term, COUNT(*) AS df FROM tf GROUP BY term",
        vocab=f"SELECT term, df, ROW_NUMBER() OVER (ORDER BY df DESC, term) - 1 AS term_id FROM dfq "
              f"ORDER BY df DESC, term LIMIT {NUM_TERMS}",
        idf="SELECT term, term_id, ln((SELECT COUNT(DISTINCT doc_id) FROM tf) / df) AS idf FROM vocab",
        tot="SELECT doc_id, SUM(n) AS total FROM tf GROUP BY doc_id",
        w="SELECT tf.doc_id, tf.term, idf.term_id, idf.idf * tf.n / tot.total AS w FROM tf "
          "JOIN idf ON tf.term = idf.term JOIN tot ON tf.doc_id = tot.doc_id",
    )
    c.update(more)
    return c


def _q(body, **more):
    return duck.with_ctes(body, **_ctes(**more))


def oracle() -> dict:
    return {
        "filter_articles": _q("SELECT doc_id, title FROM a"),
        "scan_wordlist": duck.with_ctes(
            "SELECT DISTINCT lower(word) AS word FROM (SELECT unnest(regexp_split_to_array(trim(line), '\\s+')) AS word "
            "FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) l) x WHERE word <> ''",
            d="SELECT 1"),
        "tokenize_terms": _q("SELECT doc_id, COUNT(*) AS n_tokens FROM terms GROUP BY doc_id"),
        "term_freq": _q("SELECT doc_id, term, n FROM tf0"),
        "filter_min_terms": _q("SELECT doc_id, CAST(SUM(n) AS BIGINT) AS total FROM tf GROUP BY doc_id"),
        "doc_freq": _q("SELECT term, df FROM dfq"),
        "topk_terms_by_df": _q("SELECT term, df, CAST(term_id AS INTEGER) AS term_id FROM vocab"),
        "idf": _q("SELECT term, ROUND(idf, 6) AS idf FROM idf"),
        "tfidf": _q("SELECT doc_id, term, ROUND(w, 6) AS w FROM w"),
        "term_lookup": _q("SELECT tf.doc_id, CAST(idf.term_id AS INTEGER) AS term_id, tf.n FROM tf JOIN idf ON tf.term = idf.term"),
        "term_doc_matrix": _q("SELECT doc_id, COUNT(*) AS nnz, ROUND(SUM(w * w), 6) AS norm2 FROM w GROUP BY doc_id"),
        "topk_per_group": _q(f"SELECT doc_id, term, rank FROM (SELECT doc_id, term, ROW_NUMBER() OVER "
                             f"(PARTITION BY doc_id ORDER BY w DESC, term) AS rank FROM w) r WHERE rank <= {TOP_PER_GROUP}"),
        "sample_fraction": duck.with_ctes(
            f"SELECT doc_id FROM arts WHERE {duck_uniform_sql(SAMPLE_SEED, 'doc_id')} < {SAMPLE_FRACTION}",
            arts=duck.F_ARTICLES),
        "sink_docfreq_tsv": _q("SELECT term, df FROM dfq"),
        "scan_xml": duck.with_ctes("SELECT doc_id, title, CAST(ns AS BIGINT) AS ns, length(text) AS text_chars, md5(text) AS text_md5 FROM arts",
                                   arts=duck.F_ARTICLES),
    }
