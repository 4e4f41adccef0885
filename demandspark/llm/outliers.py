"""Quality rules: robust multivariate outliers by minimum covariance determinants. DataFrame functions only.

Statistics of each whole text are transformed into a vector. For each language and source the mean and covariance of the
most concentrated ``core`` share of rows are found by concentration steps: order rows by their Mahalanobis distance,
estimate anew from the nearest, repeat until the determinant of the covariance falls no more. The steps run side by side from
three starts (medians and spreads of the coordinates; mean and covariance of all rows; lower quartiles and narrow
spreads); the smallest determinant wins, and is estimated once more from all rows that fit. A row whose distance exceeds
the chi-square quantile ``cutoff`` is rejected.

A step is one aggregate: rows are counted and summed (values and products) by group and by a narrow class of their
distance, and whole classes are taken from the nearest on until they hold the core. Rows of a group never meet in one
task, however many they are, and partial sums are combined before the shuffle.

Only rows that pass the base rules enter estimates. Groups of fewer than ``least_rows`` such rows are estimated together with the other small groups of their language, small
languages together with each other; a pool that is still too small rejects nothing. Spreads that are zero in a clean
group (no symbols at all, say) are held up by ``FLOORS``, so that a single odd character is no outlier.

Null text counts as empty; a text without words fails the base rules. Null language or source is a value of its own.
Repeated rows are judged alike. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize

SPACE = r"[\x20\x09-\x0D]+"
VECTOR = ["x1", "x2", "x3", "x4", "x5"]
# Least standard deviations, in transformed units. Repeated words have a base rule of their own: its limit, a fifth of the
# words, lies at four and a half of these spreads.
FLOORS = [0.35, 0.12, 0.5, 0.6, 0.1]
CUTOFF = 20.515                          # fixed value: chi-square with 5 degrees of freedom, 0.999
FITS = 12.833                            # fixed value: the same at 0.975, for the last estimate
CORE_FACTOR = 1.41                       # fixed value: consistency of the covariance of the nearest three quarters in 5 dimensions
_CLASSES = 16.0                          # classes of distance for each factor e
_STOP = 1e-3                             # steps go on while the logarithm of some determinant falls by more


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the base counts of each whole text."""
    text = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", "lang", "source", text.alias("text"))
    base = base.select("doc_id", "lang", "source", F.array_remove(F.split("text", SPACE), "").alias("words"),
                       F.length(F.regexp_replace("text", SPACE, "")).cast("long").alias("word_chars"),
                       F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
                       F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    base = base.select("doc_id", "lang", "source", "word_chars", "n_symbols", F.size("words").alias("n"),
                       (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                       F.transform("words", lambda w: F.xxhash64(w)).alias("h1"))
    later = lambda column, k: F.slice(column, F.lit(k + 1), F.greatest(F.col("n") - k, F.lit(0)))
    base = base.withColumn("h2", F.zip_with("h1", later("h1", 1), lambda a, b: F.xxhash64(a, b)))
    base = base.withColumn("h4", F.zip_with("h2", later("h2", 2), lambda a, b: F.xxhash64(a, b)))
    base = base.withColumn("h5", F.slice(F.zip_with("h4", later("h1", 4), lambda a, b: F.xxhash64(a, b)), F.lit(1), F.greatest(F.col("n") - 4, F.lit(0))))
    base = base.select("doc_id", "lang", "source", "n", "word_chars", "n_symbols", "n_dup_lines",
                       F.when(F.size(F.array_distinct("h5")) < F.size("h5"), F.col("h5")).otherwise(F.array().cast("array<bigint>")).alias("grams"))
    # Only texts with a repeated window are sorted: equal windows stand next to each other, their places give the cover.
    base = base.withColumn("ranked", F.array_sort(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))))
    base = base.withColumn("places", F.array_sort(F.transform(F.filter(
        F.transform("ranked", lambda e, k: F.struct(e["i"].alias("i"), (
            F.coalesce(F.try_element_at("ranked", F.nullif(k, F.lit(0)))["g"] == e["g"], F.lit(False))
            | F.coalesce(F.try_element_at("ranked", k + 2)["g"] == e["g"], F.lit(False))).alias("again"))),
        lambda e: e["again"]), lambda e: e["i"])))
    covered = F.aggregate(F.transform("places", lambda p, k: F.least(F.lit(5), F.coalesce(F.try_element_at("places", k + 2) - p, F.lit(5)))),
                          F.lit(0), lambda a, b: a + b)
    return base.select("doc_id", "lang", "source", F.col("n").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
                       covered.cast("long").alias("n_repeat_words"))


def vectors(stats: DataFrame) -> DataFrame:
    """The statistics with their transformed vector: length, word length, symbols, repeated lines, repeated words."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return stats.withColumns({
        "x1": F.log1p(F.col("n_words").cast("double")), "x2": F.log1p(F.col("word_chars") / n), "x3": F.log1p(100 * F.col("n_symbols") / n),
        "x4": F.log1p(100 * F.col("n_dup_lines") / n), "x5": F.sqrt(F.col("n_repeat_words") / n)})


def _grouped(rows: DataFrame, least_rows: int) -> DataFrame:
    """Adds ``pool``: language and source, or the pool that a small group belongs to; null where nothing can be estimated."""
    mark = lambda c: F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-"))
    sizes = rows.groupBy("lang", "source").agg(F.count_if(~F.col("base_failed")).alias("rows"))
    small = F.col("rows") < least_rows
    by_lang = Window.partitionBy("lang", small)
    sizes = sizes.withColumn("lang_rows", F.sum("rows").over(by_lang))  # a row for each source, not for each document
    tiny = small & (F.col("lang_rows") < least_rows)
    rest = sizes.where(tiny).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rest_rows"))
    sizes = sizes.join(F.broadcast(rest)).withColumn(
        "pool", F.when(~small, F.concat(F.lit("s"), mark("lang"), mark("source"))).when(~tiny, F.concat(F.lit("l"), mark("lang")))
        .when(F.col("rest_rows") >= least_rows, F.lit("all")))
    pools = materialize(sizes.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), "pool"), "outlier-pools")
    return rows.join(pools, F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")), "left").drop("_l", "_s")


def _inverse_root(estimates: DataFrame) -> DataFrame:
    """pool, start, means m1.., the inverse of the covariance's lower Cholesky factor, i11, i21, i22, ..., and the determinant's logarithm."""
    p = len(VECTOR)
    def rest(i: int, j: int) -> Column:
        return F.col(f"c{i}{j}") - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))

    def solved(i: int, j: int) -> Column:
        return (F.lit(1.0 if i == j else 0.0) - sum((F.col(f"l{i}{k}") * F.col(f"i{k}{j}") for k in range(j, i)), F.lit(0.0))) / F.col(f"l{i}{i}")
    for j in range(p):  # a column at a time, what depends on it afterwards
        estimates = estimates.withColumn(f"l{j}{j}", F.sqrt(F.greatest(rest(j, j), F.lit(FLOORS[j] ** 2))))
        estimates = estimates.withColumns({f"l{i}{j}": rest(i, j) / F.col(f"l{j}{j}") for i in range(j + 1, p)})
    for apart in range(p):
        estimates = estimates.withColumns({f"i{j + apart}{j}": solved(j + apart, j) for j in range(p - apart)})
    log_det = sum((2 * F.log(f"l{i}{i}") for i in range(p)), F.lit(0.0)).alias("log_det")
    return estimates.select("pool", "start", log_det, *[f"m{i}" for i in range(p)], *[f"i{i}{j}" for i in range(p) for j in range(i + 1)])


def _distance() -> Column:
    p = len(VECTOR)
    return sum(((sum(F.col(f"i{i}{j}") * (F.col(VECTOR[j]) - F.col(f"m{j}")) for j in range(i + 1))) ** 2 for i in range(p)), F.lit(0.0))


def _estimate(rows: DataFrame, roots: DataFrame, core: float, fits: float | None) -> DataFrame:
    """Means and covariances of the nearest ``core`` of each pool or, with ``fits``, of all rows within that distance."""
    p = len(VECTOR)
    near = rows.join(roots, "pool").withColumn("d", _distance())
    klass = F.floor(_CLASSES * F.log(F.col("d") + 1e-6)) if fits is None else (F.col("d") > fits).cast("bigint")
    sums = ([F.count("*").alias("n")] + [F.sum(x).alias(f"t{i}") for i, x in enumerate(VECTOR)]
            + [F.sum(F.col(VECTOR[i]) * F.col(VECTOR[j])).alias(f"q{i}{j}") for i in range(p) for j in range(i + 1)])
    classes = near.groupBy("pool", "start", klass.alias("k")).agg(*sums)
    if fits is None:  # few classes a pool, whatever its size
        before = F.sum("n").over(Window.partitionBy("pool", "start").orderBy("k").rowsBetween(Window.unboundedPreceding, -1))
        whole = F.sum("n").over(Window.partitionBy("pool", "start"))
        classes = classes.withColumns({"before": F.coalesce(before, F.lit(0)), "whole": whole}).where(F.col("before") < F.col("whole") * core)
    else:
        classes = classes.where("k = 0")
    total = classes.groupBy("pool", "start").agg(F.sum("n").alias("n"), *[F.sum(f"t{i}").alias(f"t{i}") for i in range(p)],
                                        *[F.sum(f"q{i}{j}").alias(f"q{i}{j}") for i in range(p) for j in range(i + 1)])
    return _moments(total, CORE_FACTOR if fits is None else 1.0)


def _moments(total: DataFrame, factor: float) -> DataFrame:
    """pool, start, means and covariances from sums of values and products."""
    p = len(VECTOR)
    return total.select("pool", "start", *[(F.col(f"t{i}") / F.col("n")).alias(f"m{i}") for i in range(p)],
                        *[(factor * (F.col(f"q{i}{j}") / F.col("n") - F.col(f"t{i}") / F.col("n") * F.col(f"t{j}") / F.col("n"))).alias(f"c{i}{j}")
                          for i in range(p) for j in range(i + 1)])


def _starts(rows: DataFrame) -> DataFrame:
    """Three first estimates of each pool, from one aggregate."""
    p = len(VECTOR)
    sums = [F.sum(x).alias(f"t{i}") for i, x in enumerate(VECTOR)] + [F.sum(F.col(VECTOR[i]) * F.col(VECTOR[j])).alias(f"q{i}{j}") for i in range(p) for j in range(i + 1)]
    found = materialize(rows.groupBy("pool").agg(F.count("*").alias("n"), *sums, *[
        F.percentile_approx(x, [0.25, 0.5, 0.75], 1000).alias(f"p{i}") for i, x in enumerate(VECTOR)]), "outlier-start")

    def around(start: int, quartile: int, width: float) -> DataFrame:
        spread = lambda i: F.pow(width * (F.col(f"p{i}")[2] - F.col(f"p{i}")[0]) / 1.349, F.lit(2.0))
        return found.select("pool", F.lit(start).alias("start"), *[F.col(f"p{i}")[quartile].alias(f"m{i}") for i in range(p)],
                            *[(spread(i) if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i in range(p) for j in range(i + 1)])
    return around(0, 1, 1.0).unionByName(_moments(found.withColumn("start", F.lit(1)), 1.0)).unionByName(around(2, 0, 0.5))


def smallest_determinants(rows: DataFrame, core: float, steps: int) -> DataFrame:
    """The roots of each pool's most concentrated estimate: concentration steps from all starts until no determinant falls.

    Whole classes of distance are taken, so a step may also rise a little; the estimate before it is kept then.
    """
    roots = materialize(_inverse_root(_estimate(rows, materialize(_inverse_root(_starts(rows)), "outlier-roots"), core, None)), "outlier-roots")
    for _ in range(steps):
        nearer = materialize(_inverse_root(_estimate(rows, roots, core, None)), "outlier-roots")
        both = nearer.select("pool", "start", "log_det").join(roots.select("pool", "start", F.col("log_det").alias("before")), ["pool", "start"])
        fell = both.agg(F.max(F.col("before") - F.col("log_det"))).first()[0]  # a row per pool and start
        if fell is None or fell < _STOP:
            break
        roots = materialize(_least(roots.unionByName(nearer), ["pool", "start"]), "outlier-roots")
    return _least(roots, ["pool"])


def _least(roots: DataFrame, keys: list[str]) -> DataFrame:
    """The estimate with the smallest determinant per key."""
    others = [c for c in roots.columns if c not in keys]
    best = F.min_by(F.struct(*others), F.struct("log_det", *[c for c in ("start",) if c in others])).alias("best")
    return roots.groupBy(*keys).agg(best).select(*keys, "best.*")


def quality_verdicts(docs: DataFrame, core: float = 0.75, steps: int = 10, cutoff: float = CUTOFF, least_rows: int = 60) -> DataFrame:
    """Per row: doc_id, the base statistics, base_failed, kept, and the squared distance (null where none is estimated)."""
    stats = vectors(statistics(docs)).withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    rows = materialize(stats, "outlier-statistics")
    rows = materialize(_grouped(rows, least_rows), "outlier-rows")
    usable = rows.where("pool is not null and not base_failed").select("pool", *VECTOR)
    roots = materialize(smallest_determinants(usable, core, steps), "outlier-roots")
    roots = materialize(_inverse_root(_estimate(usable, roots, core, FITS)), "outlier-roots")
    judged = rows.join(roots, "pool", "left").withColumn("distance", _distance())
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff)).alias("kept"), "distance")
