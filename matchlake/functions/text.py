"""Text functions as column expressions.

All of these are built-in Spark expressions (regex, arrays, higher-order
functions): no Python UDF, whole texts, codegen-friendly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The twelve skill phrases matched as substrings of lowercased text.
KNOWN_SKILLS = ["python", "sql", "machine learning", "javascript", "data structures",
                "statistics", "ai", "data analysis", "deep learning", "aws", "cloud", "backend"]

# Display names of the six scored skills used in synthesized texts
# (order: python, sql, ml, javascript, data_structures, statistics).
SKILL_DISPLAY = ["Python", "SQL", "Machine Learning", "JavaScript", "Data Structures", "Statistics"]

# Sentence templates of the synthesized resume and job texts.
RESUME_TEMPLATE = ["Highly motivated professional with ", " years of experience. ",
                   "Located in ", ". ", "Education level: ", ". ",
                   "Core competencies include: ", ". "]
JD_TEMPLATE = ["We are ", " looking for a ", ". ", "This role is based in ", ". ",
               "We require at least ", " years of experience and a minimum education of ", ". ",
               "Must have expertise in: ", "."]

# Compact English stop list (parameter; shared verbatim with the SQL twins).
STOP_WORDS = sorted(set("""
a about above after again against all also am an and any are as at be because been before being
below between both but by can could did do does doing down during each few for from further had
has have having he her here hers herself him himself his how i if in into is it its itself just me
more most my myself no nor not now of off on once only or other our ours ourselves out over own
per same she should so some such than that the their theirs them themselves then there these they
this those through to too under until up upon us very via was we were what when where which while
who whom why will with within without would you your yours yourself yourselves
""".split()))

TAG_RE = r"<[^>]+>"
URL_RE = r"http\S+|www\S+|https\S+"
WORD_RE = r"\p{L}+"
TFIDF_TOKEN_RE = r"[\p{L}\p{N}_]{2,}"


def clean(text: Column) -> Column:
    """H1: null/blank -> '', lower case, strip tags, strip URLs."""
    t = F.lower(F.coalesce(text, F.lit("")))
    t = F.regexp_replace(F.regexp_replace(t, TAG_RE, ""), URL_RE, "")
    return F.when(F.coalesce(text, F.lit("")).rlike(r"^\s*$"), F.lit("")).otherwise(t)


def token_array(cleaned: Column, stop: bool = True) -> Column:
    """H2 tokens: alphabetic runs, stop words removed (array)."""
    toks = F.regexp_extract_all(cleaned, F.lit(WORD_RE), 0)
    if not stop:
        return toks
    return F.filter(toks, lambda x: ~x.isin(*STOP_WORDS))  # a hash set in the generated code


def tokens(cleaned: Column) -> Column:
    """H2: alphabetic, stop-word-free tokens joined by a space (no lemma)."""
    return F.array_join(token_array(cleaned), " ")


def extract_skills(text: Column, skills=KNOWN_SKILLS, word_boundary: bool = False) -> Column:
    """H3: sorted skill phrases found in the lowercased text (substring by default)."""
    t = F.lower(F.coalesce(text, F.lit("")))
    if word_boundary:
        found = [F.when(t.rlike(rf"\b{s}\b"), F.lit(s)) for s in skills]
    else:
        found = [F.when(t.contains(s), F.lit(s)) for s in skills]
    return F.array_sort(F.array_compact(F.array(*found)))


def overlap_count(a: Column, b: Column) -> Column:
    """Size of the skill-set intersection."""
    return F.size(F.array_intersect(a, b))


def missing_count(required: Column, have: Column) -> Column:
    """Required skills not present."""
    return F.size(F.array_except(required, have))


def coverage(have: Column, required: Column) -> Column:
    """H4: overlap / required, 1.0 when nothing is required."""
    return F.when(F.size(F.array_distinct(required)) == 0, F.lit(1.0)).otherwise(
        overlap_count(have, required) / F.size(F.array_distinct(required)))


def _skill_list(values: list[Column]) -> Column:
    parts = [F.when(v > 0, F.lit(name)) for v, name in zip(values, SKILL_DISPLAY)]
    return F.concat_ws(", ", *parts)


def resume_text(years: Column, location: Column, education: Column, scores: list[Column]) -> Column:
    """H5: resume text from candidate columns (null or 0 score omits the skill)."""
    t = RESUME_TEMPLATE
    return F.concat(F.lit(t[0]), F.coalesce(years.cast("string"), F.lit("0")), F.lit(t[1]),
                    F.lit(t[2]), F.coalesce(location, F.lit("Unknown")), F.lit(t[3]),
                    F.lit(t[4]), F.coalesce(education, F.lit("Unknown")), F.lit(t[5]),
                    F.lit(t[6]), _skill_list(scores), F.lit(t[7]))


def jd_text(company: Column, title: Column, location: Column, years: Column, education: Column,
            required: list[Column]) -> Column:
    """H6: job text from job columns."""
    t = JD_TEMPLATE
    return F.concat(F.lit(t[0]), F.coalesce(company, F.lit("a leading company")), F.lit(t[1]),
                    F.coalesce(title, F.lit("Professional")), F.lit(t[2]),
                    F.lit(t[3]), F.coalesce(location, F.lit("Unknown")), F.lit(t[4]),
                    F.lit(t[5]), F.coalesce(years.cast("string"), F.lit("0")), F.lit(t[6]),
                    F.coalesce(education, F.lit("Unknown")), F.lit(t[7]),
                    F.lit(t[8]), _skill_list(required), F.lit(t[9]))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, v: acc + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """H7: cosine of two dense vectors; a zero vector gives 0."""
    den = norm(a) * norm(b)
    return F.when(den == 0, F.lit(0.0)).otherwise(dot(a, b) / den)
