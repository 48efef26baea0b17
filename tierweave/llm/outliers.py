"""Quality rules: base statistics of a text, and robust multivariate outliers by minimum covariance determinant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierweave.llm.common import WHITE, WHITE_CHARS, broadcast_below, let, staged

SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

#: Components of the transformed vector, and the smallest standard deviation each is given: where nearly all
#: texts of a group agree exactly, a covariance would else be singular and the slightest difference an outlier.
#: That of symbols is counting noise: a share of n characters has 1 / (2 sqrt(n)) under the arc sine, and the shortest
#: texts that pass the base rules have about 400 characters with the prior's.
FEATURES = {"f_length": 0.08, "f_symbol": 0.025, "f_lines": 0.15, "f_repeat": 0.10, "f_upper": 0.06, "f_mark": 0.08}
#: Share of rows that an estimate rests on: with half of them, no smaller part can carry it away.
SUPPORT = 0.5
#: A group's concentration ends when the logarithm of its determinant falls by less than FALL, at the latest after STEPS steps.
FALL, STEPS = 1e-3, 30
#: Quantiles of the chi-squared distribution with six degrees of freedom: the median and 1 - 1e-4 (fixed values).
CHI2_MEDIAN = 5.348
CHI2_CUT = 27.86
#: Accuracy of percentile sketches, 1 / ACCURACY of a group's rows. All tasks' sketches of a group meet in one, so they are kept small.
ACCURACY = 1_000
#: Groups with fewer usable rows take the estimate over all rows.
MIN_GROUP = 200
#: Pseudo-words: the statistics of short texts are drawn to a common value, as they vary more.
PRIOR_WORDS = 60
#: Estimates of so many groups at most are broadcast (about 250 bytes each); beyond, the join shuffles narrow rows.
MOST_BROADCAST = 20_000


def base_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: dict[str, str] | None = None) -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper, n_marks, base_failed.

    All of it is computed inside the row. Null text has no words. keep: further columns to carry, by new name.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), *(F.col(c).alias(n) for n, c in (keep or {}).items()), text.alias("_text"))
    trimmed = F.btrim("_text", F.lit(WHITE_CHARS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{WHITE}]+"))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(f"[^{WHITE}]"))
    counted = rows.withColumn("_w", let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeat_words(w).alias("repeats"))))
    counted = counted.withColumn("_l", let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), F.size(F.array_distinct(x)).cast("long").alias("distinct"))))
    counted = counted.select(
        *(c for c in rows.columns if c != "_text"),
        F.col("_w.n").alias("n_words"),
        (F.char_length("_text") - F.regexp_count("_text", F.lit(f"[{WHITE}]"))).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.col("_l.n") - F.col("_l.distinct")).alias("n_dup_lines"),
        F.col("_w.repeats").alias("n_repeat_words"),
        F.col("_l.n").alias("n_lines"),
        F.regexp_count("_text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count("_text", F.lit(r"[!?]")).cast("long").alias("n_marks"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def _repeat_words(words: Column) -> Column:
    """Words in windows that occur twice or more. Most texts have none, which hashes of the windows show at once;
    the others are counted over the windows themselves, sorted, so that equals are neighbours."""
    n = F.size(words)
    starts = lambda w: F.sequence(F.lit(0), F.size(w) - WINDOW)
    hashes = F.transform(starts(words), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))))
    windows = F.transform(starts(words), lambda i: F.struct(F.array_join(F.slice(words, i + 1, F.lit(WINDOW)), " ").alias("w"), i.alias("i")))

    def twice(s: Column) -> Column:
        found = F.filter(s, lambda x, k: (F.get(s, k - 1)["w"] == x["w"]) | (F.get(s, k + 1)["w"] == x["w"]))
        return F.array_sort(F.transform(found, lambda x: x["i"]))

    covered = F.aggregate(
        let(F.array_sort(windows), twice),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda a, i: F.struct((a["n"] + i + WINDOW - F.greatest(i, a["end"])).cast("long").alias("n"), (i + WINDOW).alias("end")),
        lambda a: a["n"],
    )
    repeated = F.size(F.array_distinct(hashes)) < n - WINDOW + 1
    return F.when(n < WINDOW + 1, F.lit(0).cast("long")).when(repeated, covered).otherwise(F.lit(0).cast("long"))


def features(stats: DataFrame) -> DataFrame:
    """Adds the transformed vector: shares under a variance-stabilising arc sine, drawn to a prior for short texts."""
    share = lambda n, total, prior: F.asin(F.sqrt(F.least(F.lit(1.0), (n + prior) / total)))
    words, chars = F.col("n_words") + PRIOR_WORDS, F.col("word_chars") + 6 * PRIOR_WORDS
    return stats.withColumns(
        {
            "f_length": F.log((F.col("word_chars") + 6 * PRIOR_WORDS) / words),
            "f_symbol": share(F.col("n_symbols"), chars, 0.1),
            "f_lines": share(F.col("n_dup_lines"), F.col("n_lines") + 10, 0.1),
            "f_repeat": share(F.col("n_repeat_words"), words, 0.1),
            "f_upper": share(F.col("n_upper"), chars, 6.0),
            "f_mark": share(F.col("n_marks"), chars, 0.1),
        }
    )


def _names() -> list[str]:
    return list(FEATURES)


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(FEATURES)) for j in range(i + 1)]


def _moments(rows: DataFrame, by: list[str]) -> DataFrame:
    """Mean vector m_i and covariance c_i_j of each group, from sums that combine before the shuffle."""
    f = _names()
    sums = [F.count(F.lit(1)).alias("support"), *(F.avg(x).alias(f"m{i}") for i, x in enumerate(f))]
    sums += [F.covar_pop(f[i], f[j]).alias(f"c{i}{j}") for i, j in _pairs()]
    return rows.groupBy(*by).agg(*sums)


def _inverted(estimates: DataFrame, scale: Column) -> DataFrame:
    """Adds w_i_j, the inverse of the covariance's Cholesky factor: the squared distance is the sum of squares of w (x - m)."""
    d, floors = len(FEATURES), list(FEATURES.values())
    out = estimates
    for j in range(d):
        own = F.greatest(F.col(f"c{j}{j}") * scale, F.lit(floors[j] ** 2))
        left = own - sum((F.col(f"l{j}{k}") ** 2 for k in range(j)), F.lit(0.0))
        # Components that follow from each other leave nothing of the variance.
        out = out.withColumn(f"l{j}{j}", F.sqrt(F.greatest(left, F.lit(0.01 * floors[j] ** 2))))
        for i in range(j + 1, d):
            rest = F.col(f"c{i}{j}") * scale - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            out = out.withColumn(f"l{i}{j}", rest / F.col(f"l{j}{j}"))
    for j in range(d):
        out = out.withColumn(f"w{j}{j}", 1 / F.col(f"l{j}{j}"))
        for i in range(j + 1, d):
            out = out.withColumn(f"w{i}{j}", -sum((F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)), F.lit(0.0)) / F.col(f"l{i}{i}"))
    out = out.withColumn("logdet", 2 * sum((F.log(f"l{j}{j}") for j in range(d)), F.lit(0.0)))
    return out.select("grp", "logdet", *(f"m{i}" for i in range(d)), *(f"{x}{i}{j}" for x in "cw" for i, j in _pairs()))


def _with_distance(rows: DataFrame, estimates: DataFrame, how: str = "inner") -> DataFrame:
    f = _names()
    joined = rows.join(broadcast_below(estimates, MOST_BROADCAST), "grp", how)
    parts = (sum((F.col(f"w{i}{j}") * (F.col(f[j]) - F.col(f"m{j}")) for j in range(i + 1)), F.lit(0.0)) for i in range(len(f)))
    distance = sum((p * p for p in parts), F.lit(0.0))
    return joined.withColumn("d2", distance).drop(*(c for c in estimates.columns if c != "grp"))


def estimates(rows: DataFrame, steps: int = STEPS, support: float = SUPPORT) -> DataFrame:
    """Minimum-covariance-determinant estimates per group (column grp) of feature rows, by deterministic start and concentration.

    Start: each component by its median and the median distance from it, which no smaller half of the rows moves far. Each step
    keeps the share `support` of a group's rows with the smallest distances (threshold: a percentile sketch, accurate to
    1/1,000 of the rows) and takes their mean and covariance, which lowers the determinant until it rests; groups that rest take no further
    steps. At the end the covariance is scaled so that the median distance is the one of a normal sample.
    """
    d, f = len(FEATURES), _names()
    middles = staged(rows.groupBy("grp").agg(*(F.percentile_approx(x, F.lit(0.5), ACCURACY).alias(f"m{i}") for i, x in enumerate(f))))
    off = rows.join(broadcast_below(middles, MOST_BROADCAST), "grp")
    spreads = off.groupBy("grp").agg(*(F.percentile_approx(F.abs(F.col(x) - F.col(f"m{i}")), F.lit(0.5), ACCURACY).alias(f"s{i}") for i, x in enumerate(f)))
    start = middles.join(spreads, "grp").select(
        "grp",
        *(f"m{i}" for i in range(d)),
        *(((1.4826 * F.col(f"s{i}")) ** 2 if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in _pairs()),
    )
    now = staged(_inverted(start, F.lit(1.0)).withColumn("logdet", F.lit(float("inf"))))
    rested = now.limit(0)
    for _ in range(steps):
        far = _with_distance(rows, now)
        edge = staged(far.groupBy("grp").agg(F.percentile_approx("d2", F.lit(support), ACCURACY).alias("edge")))
        core = far.join(broadcast_below(edge, MOST_BROADCAST), "grp").where("d2 <= edge")
        before = now.select("grp", F.col("logdet").alias("before"))
        after = staged(_inverted(_moments(core, ["grp"]), F.lit(1.0)).join(before, "grp"))
        falls = F.col("logdet") < F.col("before") - FALL
        rested = rested.unionByName(after.where(~falls).drop("before"))
        now = after.where(falls).drop("before")
        if now.isEmpty():
            break
    final = staged(rested.unionByName(now))
    middle = _with_distance(rows, final).groupBy("grp").agg(F.percentile_approx("d2", F.lit(0.5), ACCURACY).alias("middle"))
    scale = F.greatest(F.lit(1.0), F.col("middle") / CHI2_MEDIAN)
    return staged(_inverted(final.join(middle, "grp"), scale))


def robust_outliers(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    cut: float = CHI2_CUT,
    min_group: int = MIN_GROUP,
) -> DataFrame:
    """Per row of docs: the base statistics, base_failed, distance (squared Mahalanobis) and kept.

    Estimates are made per language and source from rows that pass the base rules; a null language or source is a
    value of its own. Groups with fewer than min_group such rows take the estimate over all rows; if there are
    too few of these as well, only the base rules decide and distance is null. Rows that fail the
    base rules are judged false whatever their distance. Repeated rows are judged one by one, alike. An empty
    table gives an empty result. Columns that are not named are never read.
    """
    stats = staged(features(base_statistics(docs, id_col, text_col, {"_lang": lang_col, "_source": source_col})))
    # No cell, no source name can clash: JSON keeps null apart from text.
    named = stats.withColumn("own", F.to_json(F.struct(F.col("_lang").alias("l"), F.col("_source").alias("s"))))
    usable = named.where("NOT base_failed")
    sizes = staged(usable.groupBy("own").count().where(F.col("count") >= min_group).select("own", F.lit(True).alias("large")))
    grouped = lambda rows: rows.join(broadcast_below(sizes, MOST_BROADCAST), "own", "left").withColumn("grp", F.when(F.col("large"), F.col("own")).otherwise("all"))
    shaped = usable.select("own", *FEATURES)
    whole = shaped.withColumn("grp", F.lit("all"))
    fitted = estimates(grouped(shaped).where("grp != 'all'").select("grp", *FEATURES).unionByName(whole.select("grp", *FEATURES)))
    enough = usable.limit(min_group).count() >= min_group
    judged = _with_distance(grouped(named), fitted if enough else fitted.limit(0), "left")
    verdict = ~F.col("base_failed") & (F.coalesce(F.col("d2"), F.lit(0.0)) <= cut)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        verdict.alias("kept"), F.col("d2").alias("distance"),
    )
