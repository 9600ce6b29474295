"""Quality rules with robust multivariate outliers (operator 9); DataFrame functions only.

Base statistics fail a document outright. Of the others, three transformed statistics -
log mean word length, log symbols per word, root share of repeated words - are held, within
each language and source, against a minimum-covariance-determinant estimate, and documents
at a large Mahalanobis distance are rejected.

The estimate: several deterministic starts (the half of a group that is nearest to its medians, in
units of median absolute deviations: over all statistics together, and by the one farthest off), each
followed by concentration steps - mean and covariance of the half, distances of all, and the half with
the smallest distances again - until no group's half changes any more, at most ``STEPS`` of them. Of a
group's results the one with the least determinant is taken. It is reweighted once: mean and covariance
of all documents within the 97.5 % ellipsoid, with the factor that makes such a covariance consistent.
Distances are scaled down where their median is beyond a normal distribution's.

Every document is judged: a language and source with fewer than ``MIN_GROUP`` valid documents has too
few for a covariance and is held against the pooled estimate of its language, and a language with too few
against that of all documents.

Statistics are fixed-point numbers and their moments exact sums, so results depend neither on partitions
nor on the order of rows. Equal rows of statistics are counted once and weighted, and each step is one
aggregation of those few rows, combined before the shuffle, and a join with one row a group; medians are
weighted percentiles of few distinct values.

Edge cases: null text counts as empty and fails the base rules; null language or source
counts as the empty name; rows with a null id are left out, rows that repeat an id are
judged separately; statistics that are constant in a group get a least spread, so a group of one
document (or of equal ones) rejects none; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm.common import discard, table, written

MIN_WORDS = 50
#: Percent of words in repeated windows beyond which a document fails.
MAX_REPEATED = 50
#: Concentration steps at most, and the smallest group with an estimate of its own.
STEPS = 12
MIN_GROUP = 20
#: Fixed-point units of the transformed statistics, and the least spread of each. The third is at
#: most sqrt(MAX_REPEATED / 100) = 0.707 past the base rules, and can reject as its spread is below 0.154.
UNIT = 1000
LEAST_SPREAD = (0.05, 0.2, 0.1)
#: Median of the chi-squared distribution with three degrees of freedom, and the rejecting
#: squared distance, its 0.9999 quantile.
CHI_MEDIAN = 2.366
CUTOFF = 21.1
#: The 97.5 % point of that distribution, and what the covariance within it is to be multiplied by:
#: 0.975 / P(chi-squared with five degrees of freedom <= 9.348).
INNER = 9.348
CONSISTENT = 0.975 / 0.9041

WHITE = " \\t\\n\\u000B\\u000C\\r"
X = ("x1", "x2", "x3")

_STATS = r"""
transform(array(filter(split(t, '[\\x20\\x09-\\x0D]+'), w -> w <> '')), w -> named_struct(
  'n', size(w),
  'g', CASE WHEN size(w) >= 3
       THEN transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2]))
       ELSE CAST(array() AS array<bigint>) END))[0]
"""
_LINES = r"""
transform(array(filter(split(t, '\n'), l -> translate(l, '{white}', '') <> '')), l -> size(l) - size(array_distinct(l)))[0]
""".replace("{white}", WHITE)
# positions of windows that are found twice or more, in order
_PLACES = """
CASE WHEN size(array_distinct(g)) = size(g) THEN CAST(array() AS array<int>)
ELSE transform(array(array_sort(transform(g, (x, i) -> named_struct('x', x, 'i', i)))), s ->
  array_sort(transform(filter(transform(s, (e, j) -> named_struct('i', e.i, 'again',
    coalesce(get(s, j - 1).x = e.x, false) OR coalesce(get(s, j + 1).x = e.x, false))), e -> e.again), e -> e.i)))[0]
END
"""
_COVERED = """
aggregate(p, named_struct('n', 0L, 'upto', 0), (a, i) -> named_struct(
  'n', a.n + (i + 3 - greatest(a.upto, i)), 'upto', i + 3)).n
"""


def statistics(documents: DataFrame) -> DataFrame:
    """doc_id, lang, source and the base statistics of every document."""
    rows = documents.selectExpr(
        "CAST(doc_id AS BIGINT) AS doc_id",
        "coalesce(lang, '') AS lang",
        "coalesce(source, '') AS source",
        "coalesce(text, '') AS t",
    ).where("doc_id IS NOT NULL")
    counted = rows.selectExpr(
        "doc_id",
        "lang",
        "source",
        f"length(translate(t, '{WHITE}', '')) AS word_chars",
        "length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols",
        f"{_LINES} AS n_dup_lines",
        f"{_STATS} AS s",
    )
    # each array is bound to a lambda variable, so nothing is computed again for each element
    covered = f"transform(array(s.g), g -> transform(array({_PLACES}), p -> {_COVERED})[0])[0]"
    return counted.selectExpr(
        "doc_id",
        "lang",
        "source",
        "CAST(s.n AS BIGINT) AS n_words",
        "CAST(word_chars AS BIGINT) AS word_chars",
        "CAST(n_symbols AS BIGINT) AS n_symbols",
        "CAST(n_dup_lines AS BIGINT) AS n_dup_lines",
        f"{covered} AS n_repeat_words",
    )


def _moments() -> list[str]:
    """Expressions of mean and covariance from the sums of a subset."""
    m = [f"(s{i} / n)" for i in range(3)]
    floor = [(UNIT * s) ** 2 for s in LEAST_SPREAD]
    c = {(i, j): f"(q{i}{j} / n - {m[i]} * {m[j]}" + (f" + {floor[i]}D)" if i == j else ")") for i in range(3) for j in range(i, 3)}
    return [f"{m[i]} AS m{i}" for i in range(3)] + [f"{c[i, j]} AS c{i}{j}" for i, j in c]


SHAPE = [*(f"m{i}" for i in range(3)), *(f"c{i}{j}" for i in range(3) for j in range(i, 3))]
_ADJUGATE = {
    (0, 0): "(c11 * c22 - c12 * c12)", (1, 1): "(c00 * c22 - c02 * c02)", (2, 2): "(c00 * c11 - c01 * c01)",
    (0, 1): "(c02 * c12 - c01 * c22)", (0, 2): "(c01 * c12 - c02 * c11)", (1, 2): "(c01 * c02 - c00 * c12)",
}
_DETERMINANT = f"(c00 * {_ADJUGATE[0, 0]} + c01 * {_ADJUGATE[0, 1]} + c02 * {_ADJUGATE[0, 2]})"


def _distance() -> str:
    """Squared Mahalanobis distance by the adjugate of the covariance c with mean m."""
    d = [f"({x} - m{i})" for i, x in enumerate(X)]
    terms = [f"{1 if i == j else 2} * {a} * {d[i]} * {d[j]}" for (i, j), a in _ADJUGATE.items()]
    return f"greatest(0D, ({' + '.join(terms)}) / {_DETERMINANT})"


#: Distances in coarse steps, so that a group has few distinct ones.
_COARSE = "CAST(round(100 * log2(1 + {d})) AS BIGINT)"


def _shapes(rows: DataFrame, key: list[str]) -> DataFrame:
    """Mean and covariance of weighted rows (``weight``) by ``key``."""
    sums = rows.groupBy(*key).agg(
        F.sum("weight").alias("n"),
        *(F.expr(f"sum({x} * weight)").alias(f"s{i}") for i, x in enumerate(X)),
        *(F.expr(f"sum(CAST({X[i]} * {X[j]} AS DECIMAL(18, 0)) * CAST(weight AS DECIMAL(18, 0)))").alias(f"q{i}{j}") for i in range(3) for j in range(i, 3)),
    )
    cast = [f"CAST({c} AS DOUBLE) AS {c}" for c in sums.columns if c not in key]
    return sums.selectExpr(*key, *cast).selectExpr(*key, *_moments())


def _median(rows: DataFrame, key: list[str], what: dict[str, str]) -> DataFrame:
    return rows.groupBy(*key).agg(*(F.expr(f"percentile({e}, 0.5, weight)").alias(n) for n, e in what.items()))


def estimates(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """A row for each ``grp`` of the weighted rows (grp, x1, x2, x3, weight): mean m, covariance c and the scale of distances."""
    spark, key, scratch = rows.sparkSession, ["grp", "start"], []
    centre = written(_median(rows, ["grp"], {f"m{i}": x for i, x in enumerate(X)}), "centre", scratch)
    floor = [UNIT * s for s in LEAST_SPREAD]
    spread = _median(rows.join(centre, "grp"), ["grp"], {f"s{i}": f"abs({x} - m{i})" for i, x in enumerate(X)})
    centre = written(centre.join(spread, "grp"), "spread", scratch)
    off = [f"pow(({x} - m{i}) / greatest(1.4826 * s{i}, {floor[i]}D), 2)" for i, x in enumerate(X)]
    starts = {0: " + ".join(off), 1: f"greatest({', '.join(off)})"}
    tried = rows.join(centre, "grp").withColumn("start", F.explode(F.array(*(F.lit(i) for i in starts))))
    by_start = "CASE start " + " ".join(f"WHEN {i} THEN {e}" for i, e in starts.items()) + " END"
    near = tried.selectExpr(*key, *X, "weight", f"{_COARSE.format(d=by_start)} AS d")
    shape = None
    for _ in range(steps + 1):
        half = _median(near, key, {"h": "d"})
        now = written(_shapes(near.join(half, key).where("d <= h"), key), "shape", scratch)
        if shape is not None and now.join(shape, [*key, *SHAPE], "left_anti").isEmpty():
            break
        shape = now
        near = rows.join(shape, "grp").selectExpr(*key, *X, "weight", f"{_COARSE.format(d=_distance())} AS d")
    # the least determinant; then once more with all that are within the inner ellipsoid, at normal scale
    least = shape.selectExpr("grp", f"named_struct('det', {_DETERMINANT}, {', '.join(f"'{c}', {c}" for c in SHAPE)}) AS s")
    least = least.groupBy("grp").agg(F.min("s").alias("s")).selectExpr("grp", *(f"s.{c} AS {c}" for c in SHAPE))
    least = written(least, "least", scratch)

    def scaled(of: DataFrame) -> DataFrame:
        """``of`` with ``scale``: a median distance under the normal one means that the least spread decides, and is left."""
        middle = _median(rows.join(of, "grp"), ["grp"], {"h": _COARSE.format(d=_distance())})
        return of.join(middle, "grp").withColumn("scale", F.expr(f"{CHI_MEDIAN} / greatest(pow(2, h / 100) - 1, {CHI_MEDIAN})")).drop("h")

    first = written(scaled(least), "first", scratch)
    inner = rows.join(first, "grp").where(f"{_distance()} * scale <= {INNER}").select("grp", *X, "weight")
    again = _shapes(inner, ["grp"]).selectExpr("grp", "m0", "m1", "m2", *(f"c{i}{j} * {CONSISTENT!r}D AS c{i}{j}" for i in range(3) for j in range(i, 3)))
    out = written(scaled(written(again, "weighted", scratch)), "estimates")
    discard(spark, scratch)
    return out


def distances(rows: DataFrame, steps: int = STEPS, least: int = MIN_GROUP) -> DataFrame:
    """doc_id and scaled squared distance ``d2`` of ``rows`` (doc_id, lang, source, x1, x2, x3), by the estimate of their group."""
    key = ["lang", "source"]
    counted = rows.groupBy(*key, *X).agg(F.count(F.lit(1)).alias("weight"))
    names = counted.groupBy(*key).agg(F.sum("weight").alias("n"))
    by_lang = names.groupBy("lang").agg(F.sum("n").alias("n_lang"))
    # the group whose estimate a language and source is held against; a name and a number, so no two coincide
    level = f"CASE WHEN n >= {least} THEN 2 WHEN n_lang >= {least} THEN 1 ELSE 0 END"
    held = written(
        names.join(by_lang, "lang").selectExpr(*key, f"{level} AS level")
        .selectExpr(*key, "named_struct('level', level, 'lang', if(level > 0, lang, ''), 'source', if(level > 1, source, '')) AS grp"),
        "groups",
    )
    # pooled groups have the rows of all their members, whatever those are held against themselves
    counted = written(counted, "weights")
    wanted = held.select("grp").distinct()
    pools = [
        counted.selectExpr("named_struct('level', 2, 'lang', lang, 'source', source) AS grp", *X, "weight"),
        counted.selectExpr("named_struct('level', 1, 'lang', lang, 'source', '') AS grp", *X, "weight"),
        counted.selectExpr("named_struct('level', 0, 'lang', '', 'source', '') AS grp", *X, "weight"),
    ]
    pooled = reduce(DataFrame.unionByName, pools).join(wanted, "grp", "left_semi")
    pooled = written(pooled.groupBy("grp", *X).agg(F.sum("weight").alias("weight")), "pooled")
    shape = held.join(estimates(pooled, steps), "grp")
    return rows.join(shape, key).selectExpr("doc_id", *key, f"{_distance()} * scale AS d2")


def judged(documents: DataFrame, steps: int = STEPS, cutoff: float = CUTOFF, least: int = MIN_GROUP) -> DataFrame:
    """Base statistics, base_failed and kept of every document."""
    stats = written(
        statistics(documents)
        .withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words"))
        .withColumn("row", F.monotonically_increasing_id()),
        "statistics",
    )
    rows = stats.where("NOT base_failed").selectExpr(
        "row AS doc_id",
        "lang",
        "source",
        f"CAST(round({UNIT} * ln(word_chars / n_words)) AS BIGINT) AS x1",
        f"CAST(round({UNIT} * ln(1 + 100 * n_symbols / n_words)) AS BIGINT) AS x2",
        f"CAST(round({UNIT} * sqrt(n_repeat_words / n_words)) AS BIGINT) AS x3",
    )
    rejected = distances(rows, steps, least).where(F.col("d2") > cutoff)
    out = stats.join(rejected.select(F.col("doc_id").alias("row"), F.lit(True).alias("_out")), "row", "left")
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.col("_out").isNull()).alias("kept"),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and robust outliers over all documents."""
    return judged(table(spark, sf_dir, "documents"))
