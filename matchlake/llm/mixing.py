"""Mixing to target weights with soft domain membership.

A classifier learned from the labelled table gives every document a posterior
over domains. A sample of the labelled ids (``LABELLED`` a domain at most, by md5;
one half of them all) shows which words speak for
``poor`` and for ``toxic``: those in at least ``LEAST_DOCS`` of the domain's documents and
``LEAST_RATIO`` times as common there as elsewhere, the ``MOST_WORDS`` strongest. How
many of them a whole text holds is a binned feature, beside its length, word
length and shares of capitals, digits, marks and repeated words; the other half of the ids gives the
naive Bayes probabilities of the bins. Documents get non-negative rates r so that the expected
tokens of each domain, sum(r * tokens * posterior), come as near as possible to
the targets: projected-gradient least squares with momentum, held towards rate
1 by a small ridge. A document's gradient, in units of its own tokens, depends
on its posterior only, and the posterior on binned features only. So one
aggregate folds the documents into a table with a row per bin combination (its
size is bounded by the bins, not by the documents), every gradient step is one
aggregate over that table, and a document's rate is recomputed from the short
list of step residuals by a higher-order function, without a join.

Only DataFrame and SQL functions are used. Null and empty texts have 0 tokens;
their rate is defined like any other. Repeated rows are documents of their own.
A labelled id with several rows counts once, as toxic before poor before good;
labels that are null in both columns are no evidence. Without labels posteriors
are equal; without tokens all rates are 1.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.llm.batches import written
from matchlake.operators.small import small_rows

DOMAINS = ("good", "poor", "toxic")
TARGETS = {"good": 0.85, "poor": 0.10, "toxic": 0.05}
STEPS, RIDGE = 40, 0.002
#: Bounds of the word lists that speak for a domain.
LEAST_DOCS, LEAST_RATIO, MOST_WORDS = 5, 8.0, 1000
#: Labelled ids of a domain that words are chosen from, about: a bound on the fit's sample.
LABELLED = 10_000
MARKS = "!#$%&*+/<=>@^_`{|}~"
SIGNS = ".,;:?()[]|*#$%&!"
LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ" + SIGNS, "abcdefghijklmnopqrstuvwxyz" + " " * len(SIGNS))
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"

#: Number of values of each binned feature.
BINS = {"b_len": 16, "b_upper": 11, "b_mark": 11, "b_digit": 11, "b_word": 16, "b_poor": 11, "b_toxic": 6, "b_again": 21}


def matches(text: Column, letters: str) -> Column:
    """Characters of a class in a text (an array of the matches could outgrow memory)."""
    return F.length(text) - F.length(F.regexp_replace(text, letters, ""))


def words_of(text: Column) -> Column:
    """Words with small A-Z, without signs."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), *LETTERS), F.lit(f"({WORD})"), F.lit(1))


def learning_half(doc_id: Column) -> Column:
    """Whether a labelled id helps to choose words (else it helps to weigh the bins)."""
    return F.substring(F.md5(doc_id.cast("string").cast("binary")), 1, 1) < "8"


def evidence(docs: DataFrame, labels: DataFrame) -> dict[str, list[str]]:
    """The words that speak for ``poor`` and for ``toxic``, at most ``MOST_WORDS`` each."""
    known = domains_of(labels).where(learning_half(F.col("doc_id")))
    sizes = {r["domain"]: r["n"] for r in small_rows(known.groupBy("domain").agg(F.count(F.lit(1)).alias("n")), len(DOMAINS))}
    share = F.coalesce(*[F.when(F.col("domain") == d, F.lit(min(1.0, LABELLED / n))) for d, n in sizes.items()], F.lit(0.0))
    place = F.conv(F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 2, 6), 16, 10).cast("double")
    # About LABELLED rows a domain by construction: far below any broadcast limit.
    drawn = F.broadcast(known.where(place < share * F.lit(float(16 ** 6))))
    marked = docs.select("doc_id", "text").join(drawn, "doc_id")
    counts = {r["domain"]: r["n"] for r in small_rows(marked.groupBy("domain").agg(F.count(F.lit(1)).alias("n")), len(DOMAINS))}
    per = marked.select("domain", F.explode(F.array_distinct(words_of(F.col("text")))).alias("word")).groupBy("word").agg(
        *[F.count_if(F.col("domain") == d).alias(d) for d in DOMAINS])
    per = written(per.where(F.greatest("poor", "toxic") >= LEAST_DOCS), "mix-words")
    out = {}
    for d in ("poor", "toxic"):
        rest = sum((F.col(o) for o in DOMAINS if o != d), F.lit(0))
        n, others = counts.get(d, 0), sum(c for o, c in counts.items() if o != d)
        ratio = ((2 * F.col(d) + 1) * F.lit(float(others + 1))) / ((2 * rest + 1) * F.lit(float(n + 1)))
        top = per.select("word", F.col(d).alias("n"), ratio.alias("ratio")).where((F.col("n") >= LEAST_DOCS) & (F.col("ratio") >= LEAST_RATIO))
        out[d] = [r["word"] for r in small_rows(top.orderBy(F.col("ratio").desc(), "word").limit(MOST_WORDS), MOST_WORDS)]
    return out


def features(docs: DataFrame, speak: dict[str, list[str]], keep: str = "doc_id", text: str = "text") -> DataFrame:
    """``keep``, n_tokens and the binned features of each row, in integer steps."""
    body = F.coalesce(F.col(text), F.lit(""))
    split = F.transform(F.array(words_of(body)), lambda words: F.struct(
        F.size(words).alias("n"), F.size(F.array_distinct(words)).alias("different"),
        F.filter(words, lambda w: w.isin(speak["poor"] + speak["toxic"])).alias("found")))
    split = F.transform(split, lambda s: F.struct(
        s["n"].alias("n"), s["different"].alias("different"),
        F.size(F.filter(s["found"], lambda w: w.isin(speak["poor"]))).alias("poor"),
        F.size(F.filter(s["found"], lambda w: w.isin(speak["toxic"]))).alias("toxic")))
    words = F.length(F.regexp_replace(F.regexp_replace(body, WORD, "x"), BLANKS, ""))
    counted = docs.select(F.col(keep), words.cast("long").alias("n_tokens"),
                          F.length(body).cast("long").alias("chars"),
                          matches(body, "[A-Z]").cast("long").alias("upper"),
                          matches(body, f"[{MARKS}]").cast("long").alias("marks"),
                          matches(body, "[0-9]").cast("long").alias("digits"),
                          F.get(split, F.lit(0)).alias("said"))
    return counted.select(
        keep, "n_tokens",
        F.expr("cast(least(15, length(bin(n_tokens + 1)) - 1) as int) AS b_len"),
        F.expr("cast(least(10, (20 * upper) div (chars + 1)) as int) AS b_upper"),
        F.expr("cast(least(10, (40 * marks) div (chars + 1)) as int) AS b_mark"),
        F.expr("cast(least(10, (40 * digits) div (chars + 1)) as int) AS b_digit"),
        F.expr("cast(least(15, chars div greatest(n_tokens, 1)) as int) AS b_word"),
        F.expr("cast(least(10, (20 * said.poor) div (n_tokens + 1)) as int) AS b_poor"),
        F.expr("cast(least(5, said.toxic) as int) AS b_toxic"),
        F.expr("cast((20 * (said.n - said.different)) div (said.n + 1) as int) AS b_again"))


def domains_of(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labelled table: toxic, else poor, else good."""
    known = labels.where(F.col("doc_id").isNotNull() & (F.col("quality").isNotNull() | F.col("toxic").isNotNull()))
    return (known.groupBy("doc_id").agg(F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"),
                                        F.min(F.coalesce("quality", F.lit(1))).alias("quality"))
            .select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor")
                    .otherwise("good").alias("domain")))


@dataclass
class Mix:
    """What turns a row's bins into posteriors and a rate."""

    prior: dict[str, float]
    table: dict[str, dict[tuple[str, int], float]]  # feature -> (domain, bin) -> probability
    residuals: list[tuple[float, ...]]  # of each step, by domain
    ridge: float = RIDGE

    def posterior(self) -> list[Column]:
        """Posterior of each domain from the bin columns."""
        joint = {}
        for d in DOMAINS:
            terms = [f"element_at(array({', '.join(number(self.table[f][d, b]) for b in range(n))}), {f} + 1)"
                     for f, n in BINS.items()]
            joint[d] = " * ".join([number(self.prior[d]), *terms])
        total = " + ".join(f"({p})" for p in joint.values())
        return [F.expr(f"({p}) / ({total}) AS p_{d}") for d, p in joint.items()]

    def replayed(self, steps: int) -> str:
        """SQL of the rate after so many steps, from the posterior columns."""
        if not steps:
            return "1.0D"
        size = 1.0 / (1.0 + self.ridge)
        rows = ", ".join(f"named_struct('b', {number(momentum(k))}, "
                         + ", ".join(f"'{d}', {number(x)}" for d, x in zip(DOMAINS, e, strict=True)) + ")"
                         for k, e in enumerate(self.residuals[:steps]))
        moved = "(s.now + e.b * (s.now - s.before))"
        slope = " + ".join([*(f"e.{d} * s.{d}" for d in DOMAINS), f"{number(self.ridge)} * ({moved} - 1.0D)"])

        def state(now: str, before: str, of: str) -> str:
            # The posteriors ride along: named inside the lambda they would be worked out at every step.
            return f"named_struct('now', {now}, 'before', {before}, {', '.join(f"'{d}', {of}{d}" for d in DOMAINS)})"

        return (f"aggregate(array({rows}), {state('1.0D', '1.0D', 'p_')}, (s, e) -> "
                f"{state(f'greatest(0.0D, {moved} - {number(size)} * ({slope}))', 's.now', 's.')}, s -> s.now)")

    def rate(self) -> Column:
        """The rate after all steps, from the posterior columns."""
        return F.expr(self.replayed(len(self.residuals)))

    def point(self) -> Column:
        """Where the next gradient is taken: the rate moved on by the momentum."""
        k = len(self.residuals)
        if not k:
            return F.lit(1.0)
        now, before = self.replayed(k), self.replayed(k - 1)
        return F.expr(f"{now} + {number(momentum(k))} * ({now} - {before})")


def number(x: float) -> str:
    """A double literal that reads back as ``x``."""
    return f"{float(x)!r}D"


def momentum(k: int) -> float:
    """Nesterov's weight for step k."""
    t = 1.0
    for _ in range(k):
        before, t = t, (1 + sqrt(1 + 4 * t * t)) / 2
    return 0.0 if k == 0 else (before - 1) / t


def classifier(marked: DataFrame, labels: DataFrame) -> Mix:
    """Naive Bayes with one added per bin, from the labelled documents that chose no words."""
    weighed = domains_of(labels).where(~learning_half(F.col("doc_id")))
    joined = marked.join(weighed, "doc_id").groupBy("domain", *BINS).agg(F.count(F.lit(1)).alias("n"))
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("bin")) for f in BINS])
    rows = small_rows(joined.select("domain", "n", F.explode(pairs).alias("x"))
                      .groupBy("domain", "x.feature", "x.bin").agg(F.sum("n").alias("n")),
                      len(DOMAINS) * sum(BINS.values()))
    seen = {(r["domain"], r["feature"], r["bin"]): r["n"] for r in rows}
    count = {d: sum(n for (a, f, _), n in seen.items() if a == d and f == "b_len") for d in DOMAINS}
    total = sum(count.values())
    return Mix({d: (count[d] + 1.0) / (total + len(DOMAINS)) for d in DOMAINS},
               {f: {(d, b): (seen.get((d, f, b), 0) + 1.0) / (count[d] + n) for d in DOMAINS for b in range(n)}
                for f, n in BINS.items()}, [])


def fitted(marked: DataFrame, labels: DataFrame, targets: dict[str, float], steps: int = STEPS) -> Mix:
    """Classifier and gradient steps for the feature rows ``marked``."""
    mix = classifier(marked, labels)
    cells = written(marked.groupBy(*BINS).agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0")
                    .select("tokens", *mix.posterior()), "mix-cells")
    total = cells.agg(F.sum("tokens")).first()[0]
    if not total:
        return mix
    goal = sum(targets.values())
    for _ in range(steps):
        held = cells.withColumn("y", mix.point())
        got = held.agg(*[(F.sum(F.col("tokens") * F.col("y") * F.col(f"p_{d}")) / F.lit(float(total))).alias(d)
                         for d in DOMAINS]).first()
        mix.residuals.append(tuple(got[d] - targets[d] / goal for d in DOMAINS))
    return mix


def mixing_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """doc_id, n_tokens, the posterior of each domain and the rate of every row.
    ``targets``: share of each domain in the expected tokens; their sum is as
    many tokens as the documents have."""
    marked = written(features(docs, evidence(docs, labels)), "mix-features")
    mix = fitted(marked, labels, targets)
    return marked.select("doc_id", "n_tokens", *mix.posterior()).withColumn("rate", mix.rate())


def mixed_documents(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """The rows of ``docs`` with a rate over 0, with their rate (which replaces
    a column of that name)."""
    speak = evidence(docs, labels)
    mix = fitted(written(features(docs, speak), "mix-features"), labels, targets)
    row = F.struct(*[c for c in docs.columns if c != "rate"]).alias("_row")
    marked = features(docs.select(row), speak, "_row", "_row.text").select("_row", *mix.posterior())
    # Not a filter: pushed down to the scan, it would work out features and rate once more.
    positive = F.filter(F.array(mix.rate()), lambda r: r > 0)
    return marked.select("_row", F.explode(positive).alias("rate")).select("_row.*", "rate")
