"""Registered queries: text cleaning, skills, TF-IDF, embeddings, similarity
evaluation (H1-H11, G2, G3, H4, C3, F4, F6, D24-D27)."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchlake.functions import text as TX
from matchlake.functions.numeric import round_half_away
from matchlake.operators import curves as CU
from matchlake.operators import similarity as SI
from matchlake.operators import tfidf as TF
from matchlake.operators.quantiles import percentiles
from matchlake.plans.oracle_base import with_ctes
from matchlake.plans.registry import query, r
from matchlake.sources import adapter as AD
from matchlake.sources.adapter import REQ_COLS, SCORE_COLS
from matchlake.session import cut_lineage
from matchlake.sources.tables import table

# ------------------------------------------------------------ SQL fragments
STOP_SQL = "[" + ", ".join(f"'{w}'" for w in TX.STOP_WORDS) + "]"
SKILLS_SQL = "[" + ", ".join(f"'{s}'" for s in TX.KNOWN_SKILLS) + "]"


def clean_sql(t):
    return (f"CASE WHEN regexp_full_match(coalesce({t}, ''), '\\s*') THEN '' ELSE "
            f"regexp_replace(regexp_replace(lower(coalesce({t}, '')), '{TX.TAG_RE}', '', 'g'), "
            f"'{TX.URL_RE}', '', 'g') END")


def tokens_sql(cleaned, min_len=1):
    cond = "NOT list_contains(" + STOP_SQL + ", x)" + (f" AND length(x) >= {min_len}" if min_len > 1 else "")
    return f"list_filter(regexp_extract_all({cleaned}, '{TX.WORD_RE}'), lambda x: {cond})"


def skills_sql(t):
    return f"list_sort(list_filter({SKILLS_SQL}, lambda s: contains(lower(coalesce({t}, '')), s)))"


def skill_list_sql(cols):
    return "concat_ws(', ', " + ", ".join(
        f"CASE WHEN {c} > 0 THEN '{n}' END" for c, n in zip(cols, TX.SKILL_DISPLAY)) + ")"


R, J = TX.RESUME_TEMPLATE, TX.JD_TEMPLATE
RESUME_SQL = (f"'{R[0]}' || coalesce(CAST(years_experience AS VARCHAR), '0') || '{R[1]}' || '{R[2]}' || "
              f"coalesce(location, 'Unknown') || '{R[3]}' || '{R[4]}' || coalesce(education_level, 'Unknown') || "
              f"'{R[5]}' || '{R[6]}' || {skill_list_sql(SCORE_COLS)} || '{R[7]}'")
JD_SQL = (f"'{J[0]}' || coalesce(company, 'a leading company') || '{J[1]}' || coalesce(title, 'Professional') || "
          f"'{J[2]}' || '{J[3]}' || coalesce(location, 'Unknown') || '{J[4]}' || '{J[5]}' || "
          f"coalesce(CAST(exp_required_years AS VARCHAR), '0') || '{J[6]}' || coalesce(edu_minimum, 'Unknown') || "
          f"'{J[7]}' || '{J[8]}' || {skill_list_sql(REQ_COLS)} || '{J[9]}'")

TEXT_CTES = [
    ("apps", "SELECT application_id, candidate_id, job_id, is_good_match FROM modelling"),
    ("resumes", f"SELECT candidate_id AS doc, {RESUME_SQL} AS text FROM candidates"),
    ("jds", f"SELECT job_id AS doc, {JD_SQL} AS text FROM jobs"),
    ("rweights", "SELECT candidate_id AS doc, count(*) AS weight FROM apps GROUP BY 1"),
    ("rterms", f"""SELECT doc, term, count(*) AS tf FROM (
        SELECT doc, unnest({tokens_sql(clean_sql('text'), 2)}) AS term FROM resumes) GROUP BY ALL"""),
    ("jterms", f"""SELECT doc, term, count(*) AS tf FROM (
        SELECT doc, unnest({tokens_sql(clean_sql('text'), 2)}) AS term FROM jds) GROUP BY ALL"""),
    ("vocab", """SELECT term, ln((1.0 + (SELECT sum(weight) FROM rweights)) / (1.0 + df)) + 1 AS idf FROM (
        SELECT t.term, sum(w.weight * t.tf) AS cf, sum(w.weight) AS df
        FROM rterms t JOIN rweights w USING (doc) GROUP BY t.term ORDER BY cf DESC, term LIMIT 5000)"""),
    ("rpost", """SELECT doc, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc)) AS w FROM (
        SELECT t.doc, t.term, t.tf * v.idf AS w FROM rterms t JOIN vocab v USING (term)
        WHERE t.doc IN (SELECT doc FROM rweights))"""),
    ("jpost", """SELECT doc, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc)) AS w FROM (
        SELECT t.doc, t.term, t.tf * v.idf AS w FROM jterms t JOIN vocab v USING (term)
        WHERE t.doc IN (SELECT job_id FROM apps))"""),
    ("tfsim", """SELECT p.candidate_id, p.job_id, coalesce(d.s, 0.0) AS tfidf_similarity FROM
        (SELECT DISTINCT candidate_id, job_id FROM apps) p LEFT JOIN (
          SELECT a.candidate_id, a.job_id, sum(r.w * j.w) AS s
          FROM (SELECT DISTINCT candidate_id, job_id FROM apps) a
          JOIN rpost r ON r.doc = a.candidate_id JOIN jpost j ON j.doc = a.job_id AND j.term = r.term
          GROUP BY ALL) d USING (candidate_id, job_id)"""),
    ("emb", "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings"),
    ("embsim", """SELECT a.application_id, a.candidate_id, a.job_id, a.is_good_match,
        round(CASE WHEN sqrt(list_dot_product(l.v, l.v)) * sqrt(list_dot_product(rv.v, rv.v)) = 0 THEN 0.0
             ELSE list_dot_product(l.v, rv.v) / (sqrt(list_dot_product(l.v, l.v)) * sqrt(list_dot_product(rv.v, rv.v))) END, 6)
             AS embedding_similarity
      FROM apps a
      LEFT JOIN emb l ON l.vec_id = a.candidate_id % (SELECT count(*) FROM embeddings)
      LEFT JOIN emb rv ON rv.vec_id = (a.job_id * 7 + 3) % (SELECT count(*) FROM embeddings)"""),
    ("skills", f"""SELECT a.application_id, {skills_sql('r.text')} AS resume_skills, {skills_sql('j.text')} AS jd_skills
      FROM apps a JOIN resumes r ON r.doc = a.candidate_id JOIN jds j ON j.doc = a.job_id"""),
    ("nlp", """SELECT e.application_id, e.is_good_match, e.embedding_similarity,
        round(t.tfidf_similarity, 6) AS tfidf_similarity,
        len(list_intersect(s.resume_skills, s.jd_skills)) AS skill_overlap_count,
        CASE WHEN len(list_distinct(s.jd_skills)) = 0 THEN 1.0
             ELSE len(list_intersect(s.resume_skills, s.jd_skills)) / len(list_distinct(s.jd_skills)) END
             AS keyword_coverage_percentage,
        len(list_filter(s.jd_skills, lambda x: NOT list_contains(s.resume_skills, x))) AS missing_required_skills
      FROM embsim e JOIN tfsim t USING (candidate_id, job_id) JOIN skills s USING (application_id)"""),
]


# ------------------------------------------------------------ Spark side
def resumes(spark, sf):
    c = AD.candidates(spark, sf)
    return c.select(F.col("candidate_id").alias("doc"), TX.resume_text(
        F.col("years_experience"), F.col("location"), F.col("education_level"),
        [F.col(s) for s in SCORE_COLS]).alias("text"))


def jds(spark, sf):
    j = AD.jobs(spark, sf)
    return j.select(F.col("job_id").alias("doc"), TX.jd_text(
        F.col("company"), F.col("title"), F.col("location"), F.col("exp_required_years"),
        F.col("edu_minimum"), [F.col(r_) for r_ in REQ_COLS]).alias("text"))


def apps(spark, sf):
    return AD.applications(spark, sf).select("application_id", "candidate_id", "job_id", "is_good_match")


def tfidf_parts(spark, sf, a=None):
    """The applications, each resume's weight, the vocabulary, and the postings
    of resumes and jobs. Each text is tokenised once, for fit and transform."""
    a = a if a is not None else cut_lineage(apps(spark, sf))
    weights = a.groupBy(F.col("candidate_id").alias("doc")).agg(F.count(F.lit(1)).alias("weight"))
    rdocs = resumes(spark, sf).join(weights, "doc")
    counts = cut_lineage(TF.term_counts(rdocs))
    vocab = cut_lineage(TF.fit_counts(counts, rdocs, weight="weight", max_features=5000))
    jdocs = jds(spark, sf).join(a.select(F.col("job_id").alias("doc")).distinct(), "doc")
    return a, weights, vocab, TF.transform_counts(counts, vocab), TF.transform(jdocs, vocab)


def side_tokens(docs):
    """(doc, tokens) of resumes or jobs, written once; the texts are dealt out first, however few files hold them."""
    dealt = docs.repartition(docs.sparkSession.sparkContext.defaultParallelism, "doc")
    return cut_lineage(dealt.select("doc", TX.token_array(TX.clean(F.col("text"))).alias("tokens")))


def tfidf_similarity(spark, sf, a=None, tokens=None):
    """H9. ``a``, if given, is written; texts become packed vectors where they are made, or from
    the ``side_tokens`` of resumes and jobs."""
    a = a if a is not None else cut_lineage(apps(spark, sf))
    weights = a.groupBy(F.col("candidate_id").alias("doc")).agg(F.count(F.lit(1)).alias("weight"))
    rdocs, jdocs = tokens or (resumes(spark, sf), jds(spark, sf))
    made = "tokens" if tokens else None
    vocab = cut_lineage(TF.fit(rdocs.join(weights, "doc"), weight="weight", max_features=5000, tokens=made))
    return TF.pair_cosine(a, TF.packed_vectors(rdocs, vocab, tokens=made), TF.packed_vectors(jdocs, vocab, tokens=made),
                          "candidate_id", "job_id")


def embedding_similarity(spark, sf, a=None):
    a = a if a is not None else apps(spark, sf)
    n = table(spark, sf, "embeddings").select(F.count(F.lit(1))).scalar()
    pairs = a.select("*", (F.col("candidate_id") % n).alias("_lv_id"),
                     ((F.col("job_id") * 7 + 3) % n).alias("_rv_id"))
    s = SI.pair_cosine(pairs, table(spark, sf, "embeddings"), "_lv_id", "_rv_id",
                       name="embedding_similarity")
    return s.drop("_lv_id", "_rv_id")


def skills(spark, sf, a=None):
    a = a if a is not None else apps(spark, sf)
    rs = resumes(spark, sf).select(F.col("doc").alias("candidate_id"),
                                   TX.extract_skills(F.col("text")).alias("resume_skills"))
    js = jds(spark, sf).select(F.col("doc").alias("job_id"), TX.extract_skills(F.col("text")).alias("jd_skills"))
    return a.join(rs, "candidate_id").join(js, "job_id")


def nlp_features(spark, sf):
    """The NLP feature row per application. What a candidate and a job bring
    (TF-IDF vector, skills, embedding) is one row each; the narrow application
    frame meets the two in one join each, and every feature is an expression."""
    a, _, _, rp, jp = tfidf_parts(spark, sf)
    e = table(spark, sf, "embeddings")
    n = e.select(F.count(F.lit(1))).scalar()

    def side(docs, postings, vec_id, prefix):
        vector = e.select(F.col("vec_id").alias("_vec"), F.col("embedding").alias(f"{prefix}_e"),
                          TX.norm(F.col("embedding")).alias(f"{prefix}_n"))
        return (docs.select("doc", TX.extract_skills(F.col("text")).alias(f"{prefix}_s"), vec_id.alias("_vec"))
                .join(TF.vectors(postings).withColumnRenamed("vector", f"{prefix}_t"), "doc", "left")
                .join(vector, "_vec", "left").drop("_vec"))

    cand = side(resumes(spark, sf), rp, F.col("doc") % n, "r").withColumnRenamed("doc", "candidate_id")
    job = side(jds(spark, sf), jp, (F.col("doc") * 7 + 3) % n, "j").withColumnRenamed("doc", "job_id")
    rs, js, norms = F.col("r_s"), F.col("j_s"), F.col("r_n") * F.col("j_n")
    return a.join(cand, "candidate_id").join(job, "job_id").select(
        "application_id", "is_good_match",
        round_half_away(F.when(norms == 0, F.lit(0.0)).otherwise(TX.dot(F.col("r_e"), F.col("j_e")) / norms), 6)
        .alias("embedding_similarity"),
        round_half_away(TF.vector_dot(F.col("r_t"), F.col("j_t")), 6).alias("tfidf_similarity"),
        TX.overlap_count(rs, js).alias("skill_overlap_count"),
        TX.coverage(rs, js).alias("keyword_coverage_percentage"),
        TX.missing_count(js, rs).alias("missing_required_skills"))


def skill_features(spark, sf):
    """G2, G3, H4 on the skills alone."""
    rs, js = F.col("resume_skills"), F.col("jd_skills")
    return skills(spark, sf).select("application_id", TX.overlap_count(rs, js).alias("skill_overlap_count"),
                                    TX.missing_count(js, rs).alias("missing_required_skills"),
                                    TX.coverage(rs, js).alias("keyword_coverage_percentage"))


# ------------------------------------------------------------ registrations
query("h05_resume_text", with_ctes("SELECT doc AS candidate_id, text AS resume_text FROM resumes", TEXT_CTES))(
    lambda s, d: resumes(s, d).select(F.col("doc").alias("candidate_id"), F.col("text").alias("resume_text")))
query("h06_jd_text", with_ctes("SELECT doc AS job_id, text AS jd_text FROM jds", TEXT_CTES))(
    lambda s, d: jds(s, d).select(F.col("doc").alias("job_id"), F.col("text").alias("jd_text")))
query("h01_clean_documents", f"""SELECT doc_id, md5(c) AS clean_md5, length(c) AS clean_chars
    FROM (SELECT doc_id, {clean_sql('text')} AS c FROM documents)""")(
    lambda s, d: table(s, d, "documents").select("doc_id", TX.clean(F.col("text")).alias("c")).select(
        "doc_id", F.md5("c").alias("clean_md5"), F.length("c").alias("clean_chars")))
query("h01_clean_pages", f"""SELECT page_id, md5(c) AS clean_md5, length(c) AS clean_chars
    FROM (SELECT page_id, {clean_sql('html')} AS c FROM pages)""")(
    lambda s, d: table(s, d, "pages").select("page_id", TX.clean(F.col("html")).alias("c")).select(
        "page_id", F.md5("c").alias("clean_md5"), F.length("c").alias("clean_chars")))
query("h02_tokens_documents", f"""SELECT doc_id, md5(array_to_string(t, ' ')) AS tokens_md5, len(t) AS n_tokens
    FROM (SELECT doc_id, {tokens_sql(clean_sql('text'))} AS t FROM documents)""")(
    lambda s, d: table(s, d, "documents").select("doc_id", TX.token_array(TX.clean(F.col("text"))).alias("t"))
    .select("doc_id", F.md5(F.array_join("t", " ")).alias("tokens_md5"), F.size("t").alias("n_tokens")))
query("h02_tokens_resumes", with_ctes(
    f"SELECT doc AS candidate_id, array_to_string({tokens_sql(clean_sql('text'))}, ' ') AS tokens FROM resumes",
    TEXT_CTES))(
    lambda s, d: resumes(s, d).select(F.col("doc").alias("candidate_id"), TX.tokens(TX.clean(F.col("text"))).alias("tokens")))
query("h03_skills_documents", f"SELECT doc_id, array_to_string({skills_sql('text')}, '|') AS skills FROM documents")(
    lambda s, d: table(s, d, "documents").select("doc_id", F.array_join(TX.extract_skills(F.col("text")), "|").alias("skills")))
query("h03_skills_applications", with_ctes(
    "SELECT application_id, array_to_string(resume_skills, '|') AS resume_skills, "
    "array_to_string(jd_skills, '|') AS jd_skills FROM skills", TEXT_CTES))(
    lambda s, d: skills(s, d).select("application_id", F.array_join("resume_skills", "|").alias("resume_skills"),
                                     F.array_join("jd_skills", "|").alias("jd_skills")))
query("g02_skill_overlap", with_ctes("SELECT application_id, skill_overlap_count FROM nlp", TEXT_CTES))(
    lambda s, d: skill_features(s, d).select("application_id", "skill_overlap_count"))
query("g03_missing_skills", with_ctes("SELECT application_id, missing_required_skills FROM nlp", TEXT_CTES))(
    lambda s, d: skill_features(s, d).select("application_id", "missing_required_skills"))
query("h04_keyword_coverage", with_ctes("SELECT application_id, keyword_coverage_percentage FROM nlp", TEXT_CTES))(
    lambda s, d: skill_features(s, d).select("application_id", "keyword_coverage_percentage"))
query("h08_tfidf_vocabulary", with_ctes("SELECT term, round(idf, 9) AS idf FROM vocab", TEXT_CTES))(
    lambda s, d: tfidf_parts(s, d)[2].select("term", r(F.col("idf")).alias("idf")))
query("h08_tfidf_postings", with_ctes(
    "SELECT doc AS candidate_id, term, round(w, 9) AS w FROM rpost", TEXT_CTES))(
    lambda s, d: tfidf_parts(s, d)[3].select(F.col("doc").alias("candidate_id"), "term", r(F.col("w")).alias("w")))
query("h09_tfidf_similarity", with_ctes(
    "SELECT application_id, round(tfidf_similarity, 6) AS tfidf_similarity FROM apps JOIN tfsim USING (candidate_id, job_id)",
    TEXT_CTES))(
    lambda s, d: tfidf_similarity(s, d).select("application_id", round_half_away(F.col("tfidf_similarity"), 6).alias("tfidf_similarity")))
query("h10_embedding_similarity", with_ctes("SELECT application_id, embedding_similarity FROM embsim", TEXT_CTES))(
    lambda s, d: embedding_similarity(s, d).select("application_id", "embedding_similarity"))
query("h07_cosine_dense_pairs", """SELECT a.vec_id AS left_id, b.vec_id AS right_id,
    round(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) /
      (sqrt(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[]))) *
       sqrt(list_dot_product(CAST(b.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])))), 6) AS similarity
  FROM embeddings a JOIN embeddings b ON b.vec_id = (a.vec_id + 1) % (SELECT count(*) FROM embeddings)""")(
    lambda s, d: SI.pair_cosine(
        table(s, d, "embeddings").select(F.col("vec_id").alias("left_id"),
                                         ((F.col("vec_id") + 1) % table(s, d, "embeddings").select(
                                             F.count(F.lit(1))).scalar()).alias("right_id")),
        table(s, d, "embeddings"), "left_id", "right_id"))
query("h11_nlp_features", with_ctes("SELECT * EXCLUDE (is_good_match) FROM nlp", TEXT_CTES))(
    lambda s, d: nlp_features(s, d).drop("is_good_match"))
query("f04_top_tfidf_terms", with_ctes(
    """SELECT term, round(sum(p.w * w.weight), 9) AS total_weight FROM rpost p JOIN rweights w USING (doc)
       GROUP BY term ORDER BY sum(p.w * w.weight) DESC, term LIMIT 20""", TEXT_CTES))(
    lambda s, d: (lambda parts: TF.top_terms(parts[3], parts[1], k=20))(tfidf_parts(s, d)).select(
        "term", r(F.col("total_weight")).alias("total_weight")))


def _heat(spark, sf):
    e = table(spark, sf, "embeddings")
    return SI.heatmap(e, e.select("vec_id", F.reverse("embedding").alias("embedding")), "vec_id", "embedding", 10)


query("f06_similarity_heatmap", """SELECT a.vec_id AS left_id, b.vec_id AS right_id,
    round(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(list_reverse(b.embedding) AS DOUBLE[])) /
      (sqrt(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[]))) *
       sqrt(list_dot_product(CAST(b.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])))), 6) AS similarity
  FROM (SELECT * FROM embeddings ORDER BY vec_id LIMIT 10) a, (SELECT * FROM embeddings ORDER BY vec_id LIMIT 10) b""")(_heat)
query("d24_skill_frequency", with_ctes(
    "SELECT skill, count(*) AS n FROM (SELECT unnest(resume_skills) AS skill FROM skills) GROUP BY skill", TEXT_CTES))(
    lambda s, d: skills(s, d).select(F.explode("resume_skills").alias("skill")).groupBy("skill").agg(
        F.count(F.lit(1)).alias("n")))


def _error_analysis(spark, sf):
    f = cut_lineage(embedding_similarity(spark, sf).select("is_good_match", "embedding_similarity"))
    med = percentiles(f, "embedding_similarity", [0.5]).select(F.col("q")[0]).scalar()
    pred = (F.col("embedding_similarity") > med).cast("int")
    y = F.col("is_good_match")
    return f.agg(F.first(med).alias("threshold_used"),
                 F.count_if((y == 0) & (pred == 1)).alias("false_positives"),
                 F.count_if((y == 1) & (pred == 0)).alias("false_negatives"))


query("d25_similarity_error_analysis", with_ctes(
    """SELECT (SELECT quantile_cont(embedding_similarity, 0.5) FROM nlp) AS threshold_used,
        count(*) FILTER (WHERE is_good_match = 0 AND embedding_similarity > (SELECT quantile_cont(embedding_similarity, 0.5) FROM nlp)) AS false_positives,
        count(*) FILTER (WHERE is_good_match = 1 AND NOT embedding_similarity > (SELECT quantile_cont(embedding_similarity, 0.5) FROM nlp)) AS false_negatives
       FROM nlp""", TEXT_CTES))(_error_analysis)


def _auc_sql(score):
    return f"""(SELECT CAST(sum(2 * pos * neg_below + pos * neg) AS DOUBLE) / (2.0 * sum(pos) * sum(neg)) FROM (
        SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
        FROM (SELECT {score} AS score, sum(is_good_match) AS pos, sum(1 - is_good_match) AS neg FROM nlp GROUP BY 1)))"""


def _representation(spark, sf):
    a = cut_lineage(apps(spark, sf))
    t = tfidf_similarity(spark, sf, a).withColumn("tfidf_similarity", round_half_away(F.col("tfidf_similarity"), 6))
    f = embedding_similarity(spark, sf, a).withColumnRenamed("is_good_match", "label")
    t = t.withColumnRenamed("is_good_match", "label")
    e = CU.roc_auc(f, score="embedding_similarity", name="embedding_auc")
    t = CU.roc_auc(t, score="tfidf_similarity", name="tfidf_auc")
    ea, ta = e.select("embedding_auc").scalar(), t.select("tfidf_auc").scalar()
    return spark.range(1).select(ea.alias("embedding_auc"), ta.alias("tfidf_auc"),
                                 F.when(ea > ta, "embedding").otherwise("tfidf").alias("best_representation"))


query("d26_representation_choice", with_ctes(
    f"""SELECT {_auc_sql('embedding_similarity')} AS embedding_auc, {_auc_sql('tfidf_similarity')} AS tfidf_auc,
        CASE WHEN {_auc_sql('embedding_similarity')} > {_auc_sql('tfidf_similarity')} THEN 'embedding' ELSE 'tfidf' END
        AS best_representation""", TEXT_CTES))(_representation)
query("d27_similarity_histogram", with_ctes(
    """SELECT is_good_match, CASE WHEN hi = lo THEN 0 ELSE least(CAST(floor((embedding_similarity - lo) / ((hi - lo) / 30)) AS INTEGER), 29) END AS bin,
        count(*) AS n FROM nlp, (SELECT min(embedding_similarity) AS lo, max(embedding_similarity) AS hi FROM nlp) GROUP BY ALL""",
    TEXT_CTES))(
    lambda s, d: SI.histogram(embedding_similarity(s, d), "embedding_similarity", ["is_good_match"], 30))
