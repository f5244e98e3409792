"""Hand-written 5-10 row fixtures for the semantic pitfalls (nulls, absent
columns, ties, single class, edges, empty input)."""

import math

import pytest
from pyspark.sql import functions as F

from matchlake.functions import features as FE
from matchlake.functions import rules as RU
from matchlake.functions import text as TX
from matchlake.operators import board as BO
from matchlake.operators import clustering as CL
from matchlake.operators import curves as CU
from matchlake.operators import metrics as ME
from matchlake.operators import prep as PR
from matchlake.operators import sampling as SA
from matchlake.operators import slices as SL


def test_fill_or_create_and_gaps(spark):
    df = spark.createDataFrame([(None, 50.0, 2, 1.5), (80.0, None, None, None)],
                               "python_score double, python_required double, years_experience int, "
                               "exp_required_years double")
    out = FE.gap_features(df, [], ["diff_python", "diff_sql", "diff_experience"]).collect()
    assert out[0]["diff_python"] == -50.0 and out[1]["diff_python"] == 80.0
    assert out[0]["diff_sql"] == 0.0  # both columns absent -> 0
    assert out[0]["diff_experience"] == 0.5 and out[1]["diff_experience"] == 0.0


def test_education_ordinal_defaults(spark):
    df = spark.createDataFrame([("PhD", "UG"), ("Diploma", "PG"), (None, None)],
                               "education_level string, edu_minimum string")
    assert [r[0] for r in FE.gap_features(df, [], ["diff_education"]).collect()] == [2, -1, 0]


def test_three_location_rules(spark):
    df = spark.createDataFrame([(None, None), ("A", None), ("A", "A"), ("A", "B")],
                               "location_student string, location_job string")
    feat = [r[0] for r in FE.gap_features(df, [], ["location_match"]).collect()]
    vec = [r["location_match"] for r in FE.match_vector(df).collect()]
    rule = [r["location"] for r in RU.validate_thresholds(df, {"location_match_required": True}).collect()]
    assert feat == [1, 0, 1, 0]      # null = null matches in the feature form
    assert vec == [0, 0, 1, 0]       # strict form: missing never matches
    assert rule == [True, False, True, False]  # rule form: missing = missing passes


def test_substring_skills_and_domain(spark):
    df = spark.createDataFrame([("Mumbai plain text",), ("uses SQL and Python",), (None,)], "t string")
    got = [r[0] for r in df.select(TX.extract_skills(F.col("t"))).collect()]
    assert got[0] == ["ai"]            # 'ai' inside another word counts (substring semantics)
    assert got[1] == ["python", "sql"]  # sorted
    assert got[2] == []
    wb = df.select(TX.extract_skills(F.col("t"), word_boundary=True)).collect()[0][0]
    assert wb == []
    t = spark.createDataFrame([("Email Specialist", 10.0, 90.0)], "title string, python_score double, "
                              "javascript_score double")
    assert FE.gap_features(t, [], ["domain_match"]).first()[0] == 10.0  # 'ai' in 'Email' -> data branch


def test_overrides_precedence(spark):
    df = spark.createDataFrame([(60.0, 70.0, None), (60.0, 50.0, 65.0)],
                               "python_score double, python_required double, min_python double")
    got = [r["python"] for r in RU.validate_thresholds(df, {"min_python": 55.0}).collect()]
    assert got == [True, False]  # row override > literal override > job value


def test_coverage_when_nothing_required(spark):
    df = spark.createDataFrame([(["sql"], []), (["sql"], ["sql", "aws"])], "a array<string>, b array<string>")
    got = [r[0] for r in df.select(TX.coverage(F.col("a"), F.col("b"))).collect()]
    assert got == [1.0, 0.5]


def test_auc_ties_single_class_and_zero_division(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "label int, probability double")
    assert CU.roc_auc(df).first()[0] == pytest.approx(0.875)
    one = spark.createDataFrame([(1, 0.5), (1, 0.7)], "label int, probability double")
    assert CU.roc_auc(one).first()[0] is None
    none_pos = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    r = ME.binary_rates(none_pos).first()
    assert r["precision"] == 0.0 and r["recall"] == 0.0 and r["f1"] == 0.0


def test_pr_auc_matches_trapezoid(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1)], "label int, probability double")
    # points (r, p): (0,1) (.5,1) (.5,.5) (1,2/3) (1,.5)
    exp = 0.5 * 1.0 + 0 + 0.5 * (0.5 + 2 / 3) / 2 + 0
    assert CU.pr_auc(df).first()[0] == pytest.approx(exp)


def test_reliability_bin_edges(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 0.1), (0, 0.3), (1, 1.0)], "label int, probability double")
    bins = sorted((r["bin"], r["n"]) for r in CU.reliability(df).collect())
    assert bins == [(0, 2), (2, 1), (9, 1)]  # 0.1 and 0.3 sit on inner edges -> lower bin


def test_grid_index_exact_and_first_wins(spark):
    grid = CU.arange_grid(0.1, 0.9, 0.05)
    assert len(grid) == 16 and grid[7] == 0.1 + 7 * 0.05
    df = spark.createDataFrame([(float(t),) for t in grid] + [(0.0,), (1.0,)], "p double")
    got = [r[0] for r in df.select(CU.grid_index(F.col("p"), grid)).collect()]
    assert got == list(range(1, 17)) + [0, 16]
    sweep = spark.createDataFrame([(0, 0.1, 0.5), (1, 0.2, 0.5), (2, 0.3, 0.4)], "i int, threshold double, f1 double")
    assert CU.best_f1_threshold(sweep).first()["best_threshold"] == 0.1
    zero = spark.createDataFrame([(0, 0.1, 0.0)], "i int, threshold double, f1 double")
    assert CU.best_f1_threshold(zero).first()["best_threshold"] == 0.5


def test_median_segments_strict_vs_inclusive(spark):
    df = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (3, 1, 1), (4, 0, 1)],
                               "years_experience int, label int, prediction int")
    seg = {r["segment"]: r["tp"] + r["fp"] + r["tn"] + r["fn"]
           for r in SL.segment_by_median(df, "years_experience").collect()}
    assert seg == {"freshers": 2, "experienced": 2}  # median 2.5, <= goes to freshers


def test_fairness_empty_positive_segment_scores_one(spark):
    df = spark.createDataFrame([("UG", 0, 0), ("PG", 1, 1), ("PG", 1, 0)], "edu string, label int, prediction int")
    r = SL.fairness_gap(df, "edu").first()
    assert r["max_f1"] == 1.0 and r["min_f1"] == pytest.approx(2 / 3)


def test_cosine_zero_and_identical(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0]), ([1.0, 2.0], [1.0, 2.0])], "a array<double>, b array<double>")
    got = [r[0] for r in df.select(TX.cosine(F.col("a"), F.col("b"))).collect()]
    assert got[0] == 0.0 and got[1] == pytest.approx(1.0)


def test_cluster_metrics_singleton_and_permutation(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0), (0.1, 0.0, 0), (5.0, 5.0, 1), (9.0, 9.0, 2)], "x double, y double, cluster int")
    sil = CL.silhouette_sq(df, ["x", "y"]).first()[0]
    assert -1 <= sil <= 1
    lab = spark.createDataFrame([(0, 1), (0, 1), (1, 0), (2, 2)], "a int, b int")
    assert CL.adjusted_rand(lab, "a", "b").first()[0] == pytest.approx(1.0)
    assert CL.normalized_mutual_info(lab, "a", "b").first()[0] == pytest.approx(1.0)


def test_standardize_constant_column_scale_one(spark):
    df = spark.createDataFrame([(1.0, 3.0), (1.0, 5.0)], "c double, v double")
    rows = PR.standardize(df, ["c", "v"]).collect()
    assert [r["c"] for r in rows] == [0.0, 0.0] and sorted(r["v"] for r in rows) == [-1.0, 1.0]


def test_dedup_first_url_wins_and_anti_join(spark):
    inc = spark.createDataFrame([(3, "u1", "c"), (1, "u1", "a"), (2, "u2", "b"), (4, "u3", "d")],
                                "id long, url string, title string")
    existing = spark.createDataFrame([("u2",)], "url string")
    got = sorted((r["url"], r["id"]) for r in BO.new_postings(inc, existing).collect())
    assert got == [("u1", 1), ("u3", 4)]


def test_domain_validation_quarantine(spark):
    df = spark.createDataFrame([(-1.0, 50.0), (1.0, 101.0), (1.0, float("nan")), (1.0, float("inf")), (2.0, 99.0)],
                               "years_experience double, python_score double")
    valid, bad = RU.split_valid(df)
    assert valid.count() == 1 and bad.count() == 4


def test_exact_row_number_matches_window(spark):
    from pyspark.sql import Window
    df = spark.range(0, 500).withColumnRenamed("id", "k").withColumn("label", (F.col("k") % 3 == 0).cast("int"))
    a = {(r["k"], r["rn"]) for r in SA.exact_row_number(df, "k", 42, ["label"]).collect()}
    w = Window.partitionBy("label").orderBy(SA.order_hash("k", 42), "k")
    b = {(r["k"], r["rn"]) for r in df.select("k", F.row_number().over(w).alias("rn")).collect()}
    assert a == b


def test_empty_input_keeps_schema(spark):
    e = spark.createDataFrame([], "label int, prediction int, probability double")
    assert ME.binary_rates(e).count() == 1  # global aggregate: one zero row
    assert CU.roc_auc(e).count() in (0, 1)
    assert CU.threshold_sweep(e, CU.linspace_grid(0.01, 0.99, 99)).count() == 99
    assert set(ME.confusion(e, ["label"]).columns) >= {"tn", "fp", "fn", "tp"}


def test_impute_median_even_count_and_absent(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "a double")
    rows = [r for r in PR.impute_median(df, ["a", "missing"]).collect()]
    assert rows[-1]["a"] == 2.5 and all(r["missing"] == 0.0 for r in rows)
    assert not math.isnan(rows[0]["a"])


def test_round_half_away_matches_duckdb(spark):
    import duckdb
    vals = [0.25275, 0.1234565, 0.5, 0.0000005, 0.9999995, 1e-7, 0.3333333333, 0.7071067811865476]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    from matchlake.functions.numeric import round_half_away
    got = [r[0] for r in df.select(round_half_away(F.col("x"), 6)).collect()]
    con = duckdb.connect()
    exp = [con.execute(f"SELECT round({v!r}::DOUBLE, 6)").fetchone()[0] for v in vals]
    assert got == exp


def test_grid_mean_is_exact_and_matches_sql(spark):
    import duckdb
    from matchlake.functions.numeric import grid_mean, grid_mean_sql
    vals = [0.123456, 0.5, 0.999999, 0.000001, 0.25, 0.75, 0.1, 0.3]
    df = spark.createDataFrame([(v,) for v in vals], "p double").repartition(3)
    got = df.agg(grid_mean(F.col("p"), 6)).first()[0]
    con = duckdb.connect()
    con.execute("CREATE TABLE t(p DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?)", [(v,) for v in vals])
    assert got == con.execute(f"SELECT {grid_mean_sql('p')} FROM t").fetchone()[0]
    assert got == sum(round(v * 1e6) for v in vals) / len(vals) / 1e6


def test_rank_metrics_of_raw_scores(spark):
    """Unrounded scores of any sign and size, with ties, nulls in the group and infinities."""
    import random

    from matchlake.operators import curves as CU
    rng = random.Random(5)
    special = [0.0, -0.0, 1.0, 0.5, float("inf"), float("-inf"), -3.5, 1e-300, 1 - 2 ** -53, 7.25]
    rows = [(g, rng.choice([rng.random(), rng.gauss(0, 5), rng.choice(special), round(rng.random(), 1)]),
             int(rng.random() < 0.4)) for g in ("a", None) for _ in range(400)]
    df = spark.createDataFrame(rows, "g string, probability double, label int")
    auc = {r["g"]: r["roc_auc"] for r in CU.roc_auc(df, ["g"]).collect()}
    points = {(r["g"], r["score"] + 0.0): (r["tp"], r["fp"]) for r in CU.cumulative_counts(df, ["g"]).collect()}
    for g in ("a", None):
        own = [(s, y) for k, s, y in rows if k == g]
        pos, neg = [s for s, y in own if y], [s for s, y in own if not y]
        u = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
        assert auc[g] == u / (len(pos) * len(neg))
        for s in {s for s, _ in own}:
            assert points[g, s + 0.0] == (sum(p >= s for p in pos), sum(n >= s for n in neg))


def test_auc_of_billions_of_rows(spark, monkeypatch):
    """Counts of 4.4e9 positives and negatives; the product passes 64 bits."""
    counts = spark.createDataFrame([(0.2, 1_100_000_000, 3_300_000_000), (0.7, 3_300_000_000, 1_100_000_000)],
                                   "score double, pos long, neg long")
    monkeypatch.setattr(CU, "score_counts", lambda *a, **k: counts)
    assert CU.roc_auc(counts).first()[0] == pytest.approx(0.75 * 0.75 + 2 * 0.75 * 0.25 / 2)


def test_pair_cosine_products_and_odd_vectors(spark):
    from matchlake.functions.text import cosine
    from matchlake.operators import similarity as SI
    odd = [(1, [1.5, -2.0, 0.1]), (2, [0.0, 0.0, 0.0]), (3, None), (4, [1.0, None, 2.0]), (5, [2.0, 1.0]), (6, []), (7, [0.3, 0.7, float("nan")]),
           (8, [3.25, 1.0, 1e-3])]
    v = spark.createDataFrame(odd, "vec_id long, embedding array<float>")
    ids = [i for i, _ in odd] + [99, None]
    pairs = spark.createDataFrame([(a, b) for a in ids for b in ids], "l long, r long")
    key = lambda rows: sorted(map(str, map(tuple, rows)))
    left, right = v.select(F.col("vec_id").alias("l"), F.col("embedding").alias("x")), v.select(
        F.col("vec_id").alias("r"), F.col("embedding").alias("y"))
    want = pairs.join(left, "l", "left").join(right, "r", "left").select("l", "r", cosine(F.col("x"), F.col("y")).alias("similarity"))
    got = SI.pair_cosine(pairs, v, "l", "r", decimals=None)
    assert key(got.select("l", "r", "similarity").collect()) == key(want.collect())
    assert got._jdf.queryExecution().executedPlan().toString().count("zip_with") <= 2  # norms only


def test_histogram_works_out_its_values_once(spark):
    from matchlake.operators import similarity as SI
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def value(i):
        seen.add(1)
        return float(i)

    df = spark.range(100).select((F.col("id") % 2).alias("g"), value("id").alias("v"), F.lit("wide").alias("w"))
    out = SI.histogram(df, "v", ["g"], 10).collect()
    assert sorted(map(tuple, out)) == [(g, b, 5) for g in (0, 1) for b in range(10)] and seen.value == 100


def test_packed_tfidf_equals_postings(spark):
    from matchlake.operators import tfidf as TF

    texts = [(1, "Deep learning, deep water and a cat"), (2, None), (3, "the of and"), (4, "water cat " * 400 + "zebra"), (5, "x unknown zz")]
    docs = spark.createDataFrame(texts, "doc long, text string")
    weights = spark.createDataFrame([(1, 3), (2, 1), (3, 2), (4, 1)], "doc long, weight long")
    fitted = docs.join(weights, "doc")
    vocab = TF.fit(fitted, weight="weight", max_features=6)
    assert vocab.collect() == TF.fit_counts(TF.term_counts(docs), fitted, weight="weight", max_features=6).collect()
    vectors = TF.packed_vectors(docs, vocab)
    plain = {}
    for r in TF.transform(docs, vocab).collect():
        plain.setdefault(r["doc"], {})[r["term"]] = r["w"]
    pairs = spark.createDataFrame([(i, l, r) for i, (l, r) in enumerate(
        [(l, r) for l in (1, 2, 3, 4, 5, 6, None) for r in (1, 2, 4, 5)] + [(4, 1)] * 30)], "id long, l long, r long")
    for part_pairs in (200_000, 7):  # with and without keys that are spread
        got = TF.pair_cosine(pairs, vectors, vectors.repartition(3), "l", "r", part_pairs=part_pairs)
        assert got.columns == ["id", "l", "r", "tfidf_similarity"]
        rows = got.collect()
        assert sorted(r["id"] for r in rows) == list(range(58))
        for r in rows:
            a, b = plain.get(r["l"], {}), plain.get(r["r"], {})
            assert r["tfidf_similarity"] == pytest.approx(sum(w * b.get(t, 0.0) for t, w in a.items()), abs=1e-12)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "array<struct" not in plan and got.rdd.getNumPartitions() >= math.ceil(58 / 7)
