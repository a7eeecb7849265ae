"""Quality rules: robust multivariate outliers among text statistics.

Each text gives four numbers: log of the mean word length, root of the share of
symbols, share of repeated lines, share of words in repeated three-word windows.
Texts that pass the base rules are grouped by language and source; each group's
centre and scatter are minimum-covariance-determinant estimates, and a text
whose Mahalanobis distance from its group is over the cut-off is rejected.

The estimates come from two starts (the plain mean and scatter, and the medians
with a fixed scatter) and concentration steps: the nearest three quarters of a
group give the next centre and scatter. The start with the smaller determinant
wins. Distances are ranked by fine steps of their logarithm, so a step needs two
aggregations with partial results and no sorting of a group. A number whose
spread is under a floor gets the floor instead, as in many groups most texts have
no symbols or repeats at all and the scatter would be singular. Sums are of whole numbers, so
they do not depend on the order in which partitions are merged.

The table of groups is broadcast if it is small enough, and joined by shuffle
beyond that. Groups with too few rows are pooled by language, what is then still too small in
one group. Null language and source are values of their own. Null and empty
texts have zeros and fail the base rules. With no row at all nothing is estimated.
Each row gives one row, whatever its id. Everything is a column expression.
Windows of words are compared by 64-bit hashes.
"""

from __future__ import annotations

from math import exp

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import small, stored

# What a word, a symbol and white space are, and the base rules.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
LEAST_WORDS = 50
MOST_REPEAT_PERCENT = 50

FEATURES = ("word_length", "symbols", "dup_lines", "repeats")
# The least spread of each number beside those before it; what is larger stays as it is estimated.
FLOORS = (0.075, 0.03, 0.1125, 0.09)
SHARE = 0.75
STEPS = 4
LEAST_ROWS = 40
# Squared distance: the quantile of the chi-square law of four numbers at 0.999.
CUTOFF = 18.47

_SCALE = 1 << 16
_BIN = 64
_PER_OCTAVE = 8
_COUNT = len(FEATURES)
_PAIRS = [(i, j) for i in range(_COUNT) for j in range(i + 1)]


def statistics(docs: DataFrame, *more: str) -> DataFrame:
    """(doc_id, more..., n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.regexp_extract_all("_text", F.lit(WORD), F.lit(0))
    lines = F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(WORD))
    word = lambda i: F.element_at("_words", i)
    windows = F.when(
        F.size("_words") >= 3,
        F.transform(
            F.sequence(F.lit(1), F.size("_words") - 2),
            lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2)),
        ),
    )
    repeated = F.size("_windows") > F.size(F.array_distinct("_windows"))
    placed = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    at = lambda k: F.get("_placed", k)["h"]
    same = F.filter(
        "_placed",
        lambda x, k: F.coalesce(at(k - 1) == x["h"], F.lit(False))
        | F.coalesce(at(k + 1) == x["h"], F.lit(False)),
    )
    covered = F.aggregate(
        F.array_sort(F.transform(same, lambda x: x["i"])),
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda s, p: F.struct(
            p.alias("last"), (s["n"] + F.least(F.lit(3), p - s["last"])).alias("n")
        ),
        lambda s: s["n"],
    )
    kept = ["doc_id", *more]
    return (
        docs.select(*kept, text.alias("_text"))
        .select(
            *kept,
            words.alias("_words"),
            lines.alias("_lines"),
            F.regexp_count("_text", F.lit(SYMBOL)).alias("_symbols"),
        )
        .select(*kept, "_words", "_lines", "_symbols", windows.alias("_windows"))
        .withColumn("_placed", F.when(repeated, F.array_sort(placed)))
        .select(
            *kept,
            F.size("_words").cast("bigint").alias("n_words"),
            F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
            F.col("_symbols").cast("bigint").alias("n_symbols"),
            F.size("_lines").cast("bigint").alias("n_lines"),
            (F.size("_lines") - F.size(F.array_distinct("_lines")))
            .cast("bigint")
            .alias("n_dup_lines"),
            F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"),
        )
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEAT_PERCENT * F.col("n_words")
    )


def features() -> list[Column]:
    """The transformed statistics as whole numbers; null for texts without words."""
    share = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))
    values = [
        F.log(share("word_chars", "n_words")),
        F.sqrt(share("n_symbols", "word_chars")),
        share("n_dup_lines", "n_lines"),
        share("n_repeat_words", "n_words"),
    ]
    return [
        F.round(v * _SCALE).cast("bigint").alias(n) for n, v in zip(FEATURES, values, strict=True)
    ]


def with_groups(stats: DataFrame, least_rows: int = LEAST_ROWS) -> DataFrame:
    """`grp`: language and source, or what small groups are pooled in."""
    fine = F.to_json(F.struct(F.lit(0).alias("level"), "lang", "source"))
    coarse = F.to_json(F.struct(F.lit(1).alias("level"), "lang"))
    counted = F.count_if(~F.col("base_failed"))
    sizes = (
        stats.select("base_failed", "lang", fine.alias("fine"), coarse.alias("coarse"))
        .groupBy("fine", "coarse")
        .agg(counted.alias("n"))
    )
    rest = F.sum(F.when(F.col("n") < least_rows, F.col("n"))).over(Window.partitionBy("coarse"))
    group = (
        F.when(F.col("n") >= least_rows, F.col("fine"))
        .when(rest >= least_rows, F.col("coarse"))
        .otherwise("rest")
    )
    named = stored(sizes.select("fine", group.alias("grp")), "group-names")
    return stats.withColumn("fine", fine).join(small(named), "fine").drop("fine")


def _decimal_sum(value: Column) -> Column:
    return F.sum(value.cast("decimal(38,0)")).cast("double")


def _estimates(nearest: DataFrame, *keys: str) -> DataFrame:
    """Mean and scatter by `keys`."""
    sums = [_decimal_sum(F.col(n)).alias(f"s{i}") for i, n in enumerate(FEATURES)]
    products = [
        _decimal_sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"p{i}{j}") for i, j in _PAIRS
    ]
    found = nearest.groupBy(*keys).agg(F.count("*").cast("double").alias("m"), *sums, *products)
    mean = [F.col(f"s{i}") / F.col("m") for i in range(_COUNT)]
    unit = float(_SCALE * _SCALE)
    return found.select(
        *keys,
        *[(mean[i] / _SCALE).alias(f"c{i}") for i in range(_COUNT)],
        *[
            ((F.col(f"p{i}{j}") / F.col("m") - mean[i] * mean[j]) / unit).alias(f"v{i}{j}")
            for i, j in _PAIRS
        ],
    )


def consistency(share: float) -> float:
    """What the scatter of the nearest `share` must be multiplied by under a normal law."""

    def below(x: float, half_freedom: int) -> float:
        term, total = 1.0, 0.0
        for k in range(half_freedom):
            total += term
            term *= x / 2 / (k + 1)
        return 1 - exp(-x / 2) * total

    lo, hi = 0.0, 200.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid, _COUNT // 2) < share else (lo, mid)
    return share / below(lo, _COUNT // 2 + 1)


def _triangles(estimates: DataFrame, *keys: str, factor: float) -> DataFrame:
    """The centre and the triangular root l of the scatter, not under the floors; its log determinant."""
    df = estimates
    for i, j in _PAIRS:
        value = F.greatest(F.col(f"v{i}{j}"), F.lit(0.0)) if i == j else F.col(f"v{i}{j}")
        value = value * factor
        for k in range(j):
            value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        least = F.lit(FLOORS[i] ** 2)
        root = F.sqrt(F.greatest(value, least)) if i == j else value / F.col(f"l{j}{j}")
        df = df.withColumn(f"l{i}{j}", root)
    logs = [F.log(f"l{i}{i}") for i in range(_COUNT)]
    return df.select(
        *keys,
        *[f"c{i}" for i in range(_COUNT)],
        *[f"l{i}{j}" for i, j in _PAIRS],
        sum(logs[1:], logs[0]).alias("size"),
    )


def _distance() -> Column:
    """Squared Mahalanobis distance of the features from c under l."""
    steps: list[Column] = []
    for i in range(_COUNT):
        value = F.col(FEATURES[i]) / _SCALE - F.col(f"c{i}")
        for j in range(i):
            value = value - F.col(f"l{i}{j}") * steps[j]
        steps.append(value / F.col(f"l{i}{i}"))
    squares = [s * s for s in steps]
    return sum(squares[1:], squares[0])


def _median_start(points: DataFrame) -> DataFrame:
    """Medians to within a fine bin; no scatter, so that only the floors count."""
    value = F.explode(
        F.array(
            *[
                F.struct(F.lit(i).alias("i"), F.floor(F.col(n) / _BIN).alias("bin"))
                for i, n in enumerate(FEATURES)
            ]
        )
    )
    bins = (
        points.select("grp", value.alias("x"))
        .groupBy("grp", "x.i", "x.bin")
        .agg(F.count("*").alias("n"))
    )
    up = Window.partitionBy("grp", "i").orderBy("bin")
    whole = Window.partitionBy("grp", "i")
    reached = bins.withColumn("upto", F.sum("n").over(up)).withColumn("all", F.sum("n").over(whole))
    middle = reached.filter("2 * upto >= all").groupBy("grp", "i").agg(F.min("bin").alias("bin"))
    centres = [
        (F.max(F.when(F.col("i") == i, F.col("bin"))) * _BIN / _SCALE).alias(f"c{i}")
        for i in range(_COUNT)
    ]
    none = [F.lit(0.0).alias(f"v{i}{j}") for i, j in _PAIRS]
    return middle.groupBy("grp").agg(*centres).select("grp", *[f"c{i}" for i in range(_COUNT)], *none)


def covariance_determinant(
    points: DataFrame, share: float = SHARE, steps: int = STEPS
) -> DataFrame:
    """Per `grp`: centre c, triangular root l of the scatter and size, the log of its determinant.

    `points` (grp and the features) should be stored, as each step reads it.
    """
    plain = _estimates(points, "grp").withColumn("start", F.lit(0))
    medians = _median_start(points).withColumn("start", F.lit(1))
    now = _triangles(plain.unionByName(medians), "start", "grp", factor=1.0)
    keys = ("start", "grp")
    for _ in range(steps):
        now = stored(now, "estimates")
        ranked = points.join(small(now), "grp").withColumn(
            "rank",
            F.floor(F.log2(F.greatest(_distance(), F.lit(1e-9))) * _PER_OCTAVE).cast("int"),
        )
        counts = ranked.groupBy(*keys, "rank").agg(F.count("*").alias("n"))
        up, whole = Window.partitionBy(*keys).orderBy("rank"), Window.partitionBy(*keys)
        limits = (
            counts.withColumn("upto", F.sum("n").over(up))
            .withColumn("all", F.sum("n").over(whole))
            .filter(F.col("upto") >= F.col("all") * share)
            .groupBy(*keys)
            .agg(F.min("rank").alias("limit"))
        )
        limits = small(stored(limits, "limits"))
        near = ranked.join(limits, list(keys)).filter(F.col("rank") <= F.col("limit"))
        now = _triangles(_estimates(near, *keys), *keys, factor=consistency(share))
    best = Window.partitionBy("grp").orderBy("size", "start")
    return (
        stored(now, "estimates")
        .withColumn("place", F.row_number().over(best))
        .filter("place = 1")
        .drop("place", "start")
    )


def judge(
    docs: DataFrame,
    cutoff: float = CUTOFF,
    share: float = SHARE,
    steps: int = STEPS,
    least_rows: int = LEAST_ROWS,
) -> DataFrame:
    """One row per row of `docs` (doc_id, text, lang, source).

    The statistics, base_failed, grp, distance (squared; null if the base rules
    failed) and kept.
    """
    counted = statistics(docs, "lang", "source").withColumn("base_failed", base_failed())
    stats = stored(counted.select("*", *features()), "statistics")
    grouped = stored(with_groups(stats, least_rows), "groups")
    points = grouped.filter("not base_failed").select("grp", *FEATURES)
    found = small(stored(covariance_determinant(points, share, steps), "estimates"))
    distance = F.when(~F.col("base_failed"), _distance())
    judged = grouped.join(found, "grp", "left").withColumn("distance", distance)
    names = [c for c in grouped.columns if c not in FEATURES]
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff)
    return judged.select(*names, "distance", kept.alias("kept"))
