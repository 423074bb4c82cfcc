"""Quality rules: robust multivariate outliers by minimum-covariance-determinant estimates.

Every text becomes a vector of transformed statistics. For each language and source the mean and
covariance of the most central ``SUPPORT`` of its vectors are found by concentration steps: measure
all distances, keep the nearest share, estimate anew. Texts far from the estimate are rejected.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import GAP, cut, words_of

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
#: Least spread of each statistic (standard deviation): what is never varied must not reject.
SPREAD = {"length": 0.5, "word_length": 0.1, "symbols": 0.03, "dup_lines": 0.25, "repeats": 0.15, "capitals": 0.08}
DIMS = list(SPREAD)
SUPPORT = 0.75
STEPS = 6
#: Share of texts of a normal distribution that lie beyond the cutoff.
TAIL = 1e-9
#: Groups with fewer texts are pooled by language, and fewer still over all languages.
MIN_GROUP = 120
#: The pool of all languages; where it is too small as well, the whole table's estimate judges it.
ALL, TABLE = "\x00all", "\x00table"


def chi2_cdf(x: float, dims: int) -> float:
    """Of an even number of dimensions."""
    term = total = 1.0
    for k in range(1, dims // 2):
        term *= x / 2 / k
        total += term
    return 1 - math.exp(-x / 2) * total


def chi2_quantile(share: float, dims: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, dims) < share else (low, mid)
    return low


CUTOFF = chi2_quantile(1 - TAIL, len(DIMS))
#: The covariance of the central share of normal data, times this, is that of all of them.
CONSISTENCY = SUPPORT / chi2_cdf(chi2_quantile(SUPPORT, len(DIMS)), len(DIMS) + 2)


def add_statistics(docs: DataFrame, to: str = "q") -> DataFrame:
    """``docs`` with a struct column of counts; every step is one expression within the row."""
    t = F.coalesce("text", F.lit(""))
    gap = F.col(f"{to}_words")
    df = docs.withColumn(f"{to}_words", words_of(F.col("text")))
    df = df.withColumn(
        f"{to}_grams",
        F.when(
            F.size(gap) >= WINDOW,
            F.transform(F.sequence(F.lit(1), F.size(gap) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(gap, i, WINDOW))),
        ),
    )
    grams = F.col(f"{to}_grams")
    df = df.withColumn(
        f"{to}_sorted",
        F.when(
            F.size(F.array_distinct(grams)) < F.size(grams),
            F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    ranked = F.col(f"{to}_sorted")
    # Equal windows lie side by side.
    twice = F.filter(ranked, lambda x, i: F.coalesce(
        (x["h"] == F.get(ranked, i - 1)["h"]), F.lit(False)
    ) | F.coalesce(x["h"] == F.get(ranked, i + 1)["h"], F.lit(False)))
    df = df.withColumn(f"{to}_at", F.sort_array(F.transform(twice, lambda x: x["i"])))
    at = F.col(f"{to}_at")
    covered = F.aggregate(
        F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda a, b: a + b,
    )
    df = df.withColumn(f"{to}_lines", F.filter(F.split(t, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    lines = F.col(f"{to}_lines")
    counts = F.struct(
        F.size(gap).cast("long").alias("n_words"),
        F.length(F.array_join(gap, "")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
    )
    return df.withColumn(to, counts).drop(*[f"{to}_{x}" for x in ("words", "grams", "sorted", "at", "lines")])


def base_failed(q: str = "q") -> Column:
    n = F.col(f"{q}.n_words")
    return (n < MIN_WORDS) | (100 * F.col(f"{q}.n_repeat_words") > MAX_REPEAT_PERCENT * n)


def vector(q: str = "q") -> list[Column]:
    """Transformed statistics: logarithms of sizes, arc sines of the roots of shares."""
    c = lambda name: F.col(f"{q}.{name}").cast("double")
    share = lambda a, b: F.asin(F.sqrt(F.least(F.lit(1.0), F.coalesce(F.try_divide(a, b), F.lit(0.0)))))
    return [
        F.log1p(c("n_words")),
        F.coalesce(F.log(F.try_divide(c("word_chars"), c("n_words"))), F.lit(0.0)),
        share(c("n_symbols"), c("word_chars")),
        share(c("n_dup_lines"), c("n_lines")),
        share(c("n_repeat_words"), c("n_words")),
        share(c("n_capitals"), c("word_chars")),
    ]


def _pairs():
    return [(i, j) for i in range(len(DIMS)) for j in range(i + 1)]


def _moments() -> list[Column]:
    return [F.count("*").alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(len(DIMS))],
            *[F.expr(f"sum(x{i} * x{j})").alias(f"s{i}_{j}") for i, j in _pairs()]]


def _factor(df: DataFrame, scale: float) -> DataFrame:
    """From sums to the mean and the inverse of the covariance's Cholesky factor.

    Each line may use the names before it. With the inverse a distance is one matrix product.
    """
    d, made = len(DIMS), ["g"]
    made += [f"s{i} / n as m{i}" for i in range(d)]
    made += [f"{scale} * {f'greatest(s{i}_{i} / n - m{i} * m{i}, 0)' if i == j else f'(s{i}_{j} / n - m{i} * m{j})'} as c{i}_{j}" for i, j in _pairs()]
    for j in range(d):
        floor = SPREAD[DIMS[j]] ** 2
        done = "".join(f" - l{j}_{k} * l{j}_{k}" for k in range(j))
        made.append(f"sqrt(greatest(c{j}_{j} + {floor}D{done}, {floor / 4}D)) as l{j}_{j}")
        for i in range(j + 1, d):
            made.append(f"(c{i}_{j}" + "".join(f" - l{i}_{k} * l{j}_{k}" for k in range(j)) + f") / l{j}_{j} as l{i}_{j}")
    for j in range(d):
        made.append(f"1 / l{j}_{j} as w{j}_{j}")
        for i in range(j + 1, d):
            made.append("-(" + " + ".join(f"l{i}_{k} * w{k}_{j}" for k in range(j, i)) + f") / l{i}_{i} as w{i}_{j}")
    return df.selectExpr(*made).select("g", *[f"m{i}" for i in range(d)], *[f"w{i}_{j}" for i, j in _pairs()])


def _distance() -> Column:
    """Squared Mahalanobis distance of x0.. from the estimate beside it."""
    rows = (" + ".join(f"w{i}_{j} * (x{j} - m{j})" for j in range(i + 1)) for i in range(len(DIMS)))
    return F.expr(" + ".join(f"pow({r}, 2)" for r in rows))


def _with_group(vectors: DataFrame, groups: DataFrame) -> DataFrame:
    return vectors.join(groups, [vectors["lang"].eqNullSafe(groups["g_lang"]), vectors["source"].eqNullSafe(groups["g_source"])])


def estimate(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From vectors (lang, source, x0..): the group of each lang and source, and the estimates.

    A group is a language and source, or, where these have under ``MIN_GROUP`` texts, all such
    sources of the language, or all such languages. If those are too few as well, they are judged by
    an estimate from all vectors of the table.
    """
    d = len(DIMS)
    xs = [f"x{i}" for i in range(d)]
    n = vectors.groupBy("lang", "source").count()
    own = F.col("count") >= MIN_GROUP
    by_lang = n.withColumn("left_lang", F.sum(F.when(own, 0).otherwise(F.col("count"))).over(Window.partitionBy("lang")))
    pooled = ~own & (F.col("left_lang") < MIN_GROUP)
    by_lang = cut(by_lang.withColumn("own", own).withColumn("pooled", pooled), "mcd-sizes")
    left = by_lang.where("pooled").agg(F.sum("count")).first()[0]
    rest = ALL if left is None or left >= MIN_GROUP else TABLE
    name = F.when(F.col("own"), F.to_json(F.struct("lang", "source"))).when(
        ~F.col("pooled"), F.to_json(F.struct("lang", F.lit(ALL).alias("source")))).otherwise(rest)
    groups = cut(by_lang.select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), name.alias("g")), "mcd-groups")
    at = _with_group(vectors, groups).select("g", *xs)
    if rest == TABLE:
        at = at.where(F.col("g") != TABLE).union(vectors.select(F.lit(TABLE).alias("g"), *xs))
    at = cut(at, "mcd-vectors")
    # Start: medians, with spreads from the quartiles.
    quartiles = at.groupBy("g").agg(*[
        F.percentile_approx(f"x{i}", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 1000).alias(f"p{i}") for i in range(d)])
    start = quartiles.select("g", *[F.col(f"p{i}")[1].alias(f"m{i}") for i in range(d)], *[
        (1 / F.sqrt(((F.col(f"p{i}")[2] - F.col(f"p{i}")[0]) / 1.349) ** 2 + SPREAD[DIMS[i]] ** 2)).alias(f"w{i}_{j}")
        if i == j else F.lit(0.0).alias(f"w{i}_{j}") for i, j in _pairs()
    ])
    fit = cut(start, "mcd-start")
    bins = Window.partitionBy("g").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("g")
    for _ in range(STEPS):
        # Sums by distance, 16 steps to a doubling: the nearest share is a prefix of the bins.
        far = _distance()
        summed = at.join(fit, "g").withColumn("bin", F.floor(16 * F.log2(far + 2.0**-20))).groupBy("g", "bin").agg(*_moments())
        near = summed.withColumn("upto", F.sum("n").over(bins)).withColumn("of", F.sum("n").over(whole)).where(
            F.col("upto") - F.col("n") < F.ceil(SUPPORT * F.col("of"))
        )
        names = ["n", *[f"s{i}" for i in range(d)], *[f"s{i}_{j}" for i, j in _pairs()]]
        fit = cut(_factor(near.groupBy("g").agg(*[F.sum(x).alias(x) for x in names]), CONSISTENCY), "mcd-step")
    return groups, fit


def _judge(docs: DataFrame, carry: list[str]) -> DataFrame:
    """A struct ``c`` of the columns ``carry``, ``q`` (the counts), ``base_failed``, ``distance``, ``kept``.

    Null and empty texts have no words and fail the base rules. Null languages and sources are
    groups of their own. Texts that pass the base rules enter the estimate, and each of them has a
    distance, if only from the estimate of the whole table. Repeated rows count as often as they stand there. Columns of
    ``docs`` other than text, lang, source and ``carry`` are not touched.
    """
    plain = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("c"), "text", "lang", "source")
    counted = add_statistics(plain).drop("text")
    xs = [x.alias(f"x{i}") for i, x in enumerate(vector())]
    counted = cut(counted.select("*", base_failed().alias("base_failed"), *xs), "quality-counts")
    groups, fit = estimate(counted.where(~F.col("base_failed")).select("lang", "source", *[f"x{i}" for i in range(len(DIMS))]))
    judged = counted.join(
        groups, [counted["lang"].eqNullSafe(groups["g_lang"]), counted["source"].eqNullSafe(groups["g_source"])], "left"
    ).join(fit, "g", "left")
    far = _distance()
    ok = ~F.col("base_failed") & F.coalesce(far <= CUTOFF, F.lit(True))
    return judged.select("c", "q", "base_failed", far.alias("distance"), ok.alias("kept"))


def score(docs: DataFrame, carry: list[str]) -> DataFrame:
    """``carry``, q, base_failed, distance and kept of every text (see ``_judge``)."""
    return _judge(docs, carry).select("c.*", "q", "base_failed", "distance", "kept")


def quality_rules(docs: DataFrame) -> DataFrame:
    """The documents that are kept, whole rows as they came (see ``_judge``)."""
    return _judge(docs, docs.columns).where("kept").select(*[F.col(f"c.`{c}`") for c in docs.columns])
