"""Quality rules: fixed rules, then robust multivariate outliers by minimum covariance determinants. DataFrame and SQL
functions only.

Words are [^\\x20\\x09-\\x0D]+. A document fails the fixed rules if it has under MIN_WORDS words or more than MOST_REPEATED
of them stand in windows of WINDOW words that occur twice or more. The others are judged within their language and
source by a vector of transformed statistics (STATISTICS). For each group a minimum-covariance-determinant estimate is
made. The search has STARTS first estimates: medians with median deviations, and means with covariances of disjoint parts
of the group, dealt by a hash of doc_id. From each, concentration steps follow: the SUBSET share of documents nearest by
Mahalanobis distance gives the next mean and covariance, until a step lowers no determinant by a share of CONVERGED (or
after MOST_STEPS). Of all estimates of a group the one with the least determinant is kept. Distances are scaled so that
their median is what it is for normal data (never up), and a document is rejected beyond CUTOFF, the squared distance
under which the share TAIL of normal data lies, in all groups. Quantiles are taken on a logarithmic grid (1 / GRID of
e), whose cells carry the sums that means and covariances need, so that a step is one aggregation and no group is
gathered. Covariances get FLOOR on their diagonals, so that a statistic that doesn't vary in a group (say, no symbols at
all) rejects by what is beyond the floor's scale only.

A group of under MIN_GROUP documents is judged by the estimate of its language, one of a language under MIN_GROUP by
that of its source, and else by that of all documents, so that each document that passes the fixed rules has a distance.
(The language comes first, as words' lengths are its own; a rare language's documents are held against the others of
their source.) Where all documents together are under MIN_GROUP, their covariance is mixed with the unit matrix, the
more the fewer they are.

Cases: a null or empty text has no words and fails the fixed rules; very long texts are read whole; null languages and
sources are groups like others; a null doc_id counts as 0 where parts are dealt; a start whose part has no document takes
the medians; of equal determinants the first start's estimate is kept; rows that repeat a doc_id are judged apart; an
empty table gives no rows; columns other than those named are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirelight.llm.common import HOT_ROWS, bit_filter, flagged, narrow, spread_join, stored

MIN_WORDS = 20
MOST_REPEATED = 0.3
WINDOW = 8
SUBSET = 0.75
STARTS = 4
MOST_STEPS = 12
CONVERGED = 0.01
MIN_GROUP = 40
FEW_GROUPS = 20_000
GRID = 64
FLOOR = 0.01
TAIL = 0.9999
STATISTICS = ("log_words", "word_length", "symbols", "dup_lines", "repeats")
WORD = r"[^\x20\x09-\x0D]+"


def chi2_quantile(p: float) -> float:
    """Of five degrees of freedom, as many as there are statistics."""
    lo, hi = 0.0, 1000.0
    for _ in range(100):
        x = (lo + hi) / 2
        below = math.erf(math.sqrt(x / 2)) - math.sqrt(2 * x / math.pi) * math.exp(-x / 2) * (1 + x / 3) < p
        lo, hi = (x, hi) if below else (lo, x)
    return lo


CHI2_MEDIAN = chi2_quantile(0.5)
CUTOFF = chi2_quantile(TAIL)


def repeated_words(docs: DataFrame) -> DataFrame:
    """Adds n_repeat_words, words in windows whose hash (column hashes) occurs twice or more: the hashes are sorted with
    their places, neighbours compared, and the places' windows joined, each word once. Each array that is read by
    place is a column of its own, so that it is made once a row."""
    some = F.size(F.array_distinct("hashes")) < F.size("hashes")
    docs = docs.withColumn("ordered", F.when(some, F.array_sort(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    last = F.size("ordered") - 1
    h_at = lambda i: F.get("ordered", i)["h"]
    twice = F.transform("ordered", lambda x, i: F.when(((i > 0) & (x["h"] == h_at(i - 1))) | ((i < last) & (x["h"] == h_at(i + 1))), x["i"]))
    docs = docs.withColumn("at", F.array_sort(F.filter(twice, lambda x: x.isNotNull())))
    cover = F.transform("at", lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get("at", i + 1) - x, F.lit(WINDOW))))
    return docs.withColumn("n_repeat_words", F.coalesce(F.aggregate(cover, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long"))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = F.coalesce("text", F.lit(""))
    docs = narrow(docs, "doc_id", "lang", "source", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", text.alias("t"))
    docs = docs.withColumn("w", F.regexp_extract_all("t", F.lit(WORD), F.lit(0))).withColumn("n", F.size("w"))
    # a line is a duplicate if it is not the first of its kind: lines with a word, less the distinct ones
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    docs = docs.withColumn("lines", lines)
    docs = docs.withColumn("wh", F.transform("w", lambda x: F.xxhash64(x)))
    window = lambda i: F.xxhash64(*[F.get(F.col("wh"), i + k) for k in range(WINDOW)])
    hashes = F.when(F.col("n") >= WINDOW, F.transform(F.sequence(F.lit(0), F.col("n") - WINDOW), window)).otherwise(F.array().cast("array<bigint>"))
    docs = docs.withColumn("hashes", hashes)
    return repeated_words(docs).select(
        "doc_id",
        "lang",
        "source",
        F.col("n").cast("long").alias("n_words"),
        F.length(F.regexp_replace("t", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
    )


def transformed(stats: DataFrame) -> DataFrame:
    """The vector: log of the words, log of the mean word length, and logs of the shares of symbols, duplicate lines
    and repeated words, so that differences of a share count less the larger it is."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    share = lambda c: F.log1p(20.0 * F.col(c) / n)
    return stats.select("*", F.log1p(F.col("n_words")).alias("log_words"), (2.0 * F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n)).alias("word_length"), share("n_symbols").alias("symbols"), share("n_dup_lines").alias("dup_lines"), share("n_repeat_words").alias("repeats"))


PAIRS = [(a, b) for i, b in enumerate(STATISTICS) for a in STATISTICS[: i + 1]]
MOMENTS = [f"m_{c}" for c in STATISTICS] + [f"c_{a}_{b}" for a, b in PAIRS]
FACTOR = [f"l_{i}_{j}" for i in range(len(STATISTICS)) for j in range(i + 1)]


def _cell(value: Column) -> Column:
    """The cell of a logarithmic grid in which a non-negative value lies."""
    return F.floor(F.log(value + 1e-9) * GRID)


def _edge(cell: Column) -> Column:
    return F.exp((cell + 1) / GRID)


def _medians(values: DataFrame) -> DataFrame:
    """values: g, name, v (non-negative). g and, for each statistic, the upper edge of the cell of its median: all
    statistics in one aggregation."""
    cells = values.groupBy("g", "name", _cell(F.col("v")).alias("cell")).agg(F.count("*").alias("n"))
    own = Window.partitionBy("g", "name")
    cells = cells.withColumn("upto", F.sum("n").over(own.orderBy("cell"))).withColumn("all_n", F.sum("n").over(own))
    found = cells.where(F.col("upto") >= 0.5 * F.col("all_n")).groupBy("g", "name").agg(F.min("cell").alias("cell"))
    return found.groupBy("g").agg(*[F.max(F.when(F.col("name") == c, _edge(F.col("cell")))).alias(c) for c in STATISTICS])


def _joined(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    named = other.select(*[F.col(k).alias(f"o_{k}") for k in keys], *[c for c in other.columns if c not in keys])
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"o_{k}"))
    return df.join(named, same, "left").drop(*[f"o_{k}" for k in keys])


def _group() -> Column:
    """A number for a pool and the language and source that it has: 0 has both, 1 the language, 2 the source, 3 neither."""
    lang, source = F.when(F.col("pool") < 2, F.col("lang")), F.when(F.col("pool") % 2 == 0, F.col("source"))
    return F.xxhash64("pool", lang.isNull(), F.coalesce(lang, F.lit("")), source.isNull(), F.coalesce(source, F.lit("")))


class Groups:
    """Joins documents (columns doc_id and g) with a row or a few rows a group. Up to FEW_GROUPS groups are sent to every
    task; of more, those of over HOT_ROWS documents are dealt over many tasks."""

    def __init__(self, good: DataFrame):
        sizes = stored(good.groupBy("g").count(), "quality-groups")
        self.few = sizes.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS
        self.hot = None if self.few else bit_filter(sizes.where(F.col("count") > HOT_ROWS).select("g"))

    def join(self, rows: DataFrame, groups: DataFrame, how: str = "inner") -> DataFrame:
        groups = groups.withColumnRenamed("g", "of_g")
        found = rows.join(F.broadcast(groups), F.col("g") == F.col("of_g"), how) if self.few else spread_join(rows, "g", "doc_id", groups, "of_g", self.hot, how)
        return found.drop("of_g")


def _with_factor(estimate: DataFrame) -> DataFrame:
    """Adds the Cholesky factor of the covariance with the floor, and the log of its determinant (by lateral aliases)."""
    out = []
    for i, a in enumerate(STATISTICS):
        for j in range(i + 1):
            inner = f"c_{STATISTICS[j]}_{a}" + "".join(f" - l_{i}_{k} * l_{j}_{k}" for k in range(j))
            out.append(f"sqrt(greatest({inner} + {FLOOR}D, {FLOOR * 0.1}D)) AS l_{i}_{i}" if i == j else f"({inner}) / l_{j}_{j} AS l_{i}_{j}")
    return estimate.selectExpr("*", *out, " + ".join(f"2 * ln(l_{i}_{i})" for i in range(len(STATISTICS))) + " AS log_det")


def _with_distance(df: DataFrame) -> DataFrame:
    """Replaces the estimate's columns by d2, the squared Mahalanobis distance."""
    out = []
    for i, c in enumerate(STATISTICS):
        out.append(f"({c} - m_{c}" + "".join(f" - l_{i}_{k} * y_{k}" for k in range(i)) + f") / l_{i}_{i} AS y_{i}")
    kept = [c for c in df.columns if c not in FACTOR and not c.startswith("m_")]
    return df.selectExpr("*", *out).selectExpr(*kept, " + ".join(f"y_{i} * y_{i}" for i in range(len(STATISTICS))) + " AS d2")


OFF = {c: f"({c} - o_{c})" for c in STATISTICS}
SUMS = ["count(*) AS n", *[f"sum({OFF[c]}) AS s_{c}" for c in STATISTICS], *[f"sum({OFF[a]} * {OFF[b]}) AS p_{a}_{b}" for a, b in PAIRS]]
SUM_NAMES = [x.split(" AS ")[1] for x in SUMS]


def _estimates(sums: DataFrame, keys: list[str], *others: str) -> DataFrame:
    """keys, others and MOMENTS from sums of values (s_) and products (p_) about the group's origin (o_) over n documents.
    The fewer they are, the more of the unit matrix the covariance has."""
    own = f"least(n / {SUBSET * MIN_GROUP}D, 1D)"
    covariance = [f"{own} * (p_{a}_{b} / n - s_{a} / n * s_{b} / n) + (1 - {own}) * {float(a == b)}D AS c_{a}_{b}" for a, b in PAIRS]
    return sums.selectExpr(*keys, *others, *[f"s_{c} / n + o_{c} AS m_{c}" for c in STATISTICS], *covariance)


def covariance_determinants(good: DataFrame, most_steps: int = MOST_STEPS) -> DataFrame:
    """good: doc_id, g, STATISTICS. g, m_ and l_ columns of the estimate with the least determinant, log_det, scale."""
    named = lambda value: ", ".join(f"struct('{c}' AS name, {value.format(c)} AS v)" for c in STATISTICS)
    origin = stored(_medians(good.selectExpr("g", f"inline(array({named('{0}')}))")).selectExpr("g", *[f"{c} AS o_{c}" for c in STATISTICS]), "quality-origin")
    groups = Groups(good)
    near = stored(groups.join(good, origin), "quality-centred")
    spread = _medians(near.selectExpr("g", f"inline(array({named('abs({0} - o_{0})')}))")).selectExpr("g", *[f"power(1.4826D * {c}, 2) AS v_{c}" for c in STATISTICS])
    keys = ["g", "start"]
    first = origin.join(spread, "g").selectExpr("g", *[f"o_{c} AS m_{c}" for c in STATISTICS], *[f"{f'v_{a}' if a == b else '0D'} AS c_{a}_{b}" for a, b in PAIRS])
    part = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(0)), F.lit(STARTS)), F.lit(STARTS - 1)).cast("int") + 1
    others = _estimates(near.groupBy("g", part.alias("start")).agg(*map(F.expr, SUMS)).join(origin, "g"), keys).selectExpr("g AS a_g", "start AS a_start", *[f"{c} AS a_{c}" for c in MOMENTS])
    every = first.selectExpr("g", f"explode(sequence(0, {STARTS - 1})) AS start", *MOMENTS)
    every = every.join(others, F.expr("g = a_g AND start = a_start"), "left").selectExpr(*keys, "1e300D AS least", *[f"coalesce(a_{c}, {c}) AS {c}" for c in MOMENTS])
    columns = [*[f"m_{c}" for c in STATISTICS], *FACTOR]
    estimate = stored(_with_factor(every).selectExpr(*keys, "log_det", "least", *columns), "quality-estimate")
    best = "struct(log_det, start, " + ", ".join(columns) + ")"
    kept = None  # the starts themselves aren't estimates of the share
    for _ in range(most_steps):
        own = Window.partitionBy(*keys)
        cells = _with_distance(groups.join(near, estimate.drop("log_det"))).groupBy(*keys, "least", _cell(F.col("d2")).alias("cell")).agg(*map(F.expr, SUMS))
        cells = cells.select("*", F.sum("n").over(own.orderBy("cell")).alias("upto"), F.sum("n").over(own).alias("all_n"))
        inside = cells.where(f"upto - n < {SUBSET} * all_n").groupBy(*keys).agg(F.first("least").alias("least"), *[F.sum(c).alias(c) for c in SUM_NAMES]).join(origin, "g")
        # least: the determinant's log is told apart from the lowest before by more than CONVERGED, or stands for it
        after = _with_factor(_estimates(inside, keys, "least AS before")).selectExpr(*keys, "log_det", "least(log_det, before) AS least", f"before - log_det > {CONVERGED} AS lower", *columns)
        after = stored(after, "quality-estimate")
        estimate = after.drop("lower")
        found = estimate.selectExpr("g", f"{best} AS b")
        kept = found if kept is None else kept.unionByName(found)
        if not after.where("lower").limit(1).count():
            break
    found = stored(kept.groupBy("g").agg(F.min("b").alias("b")).selectExpr("g", "b.log_det", *[f"b.{c}" for c in columns]), "quality-best")
    cells = _with_distance(groups.join(good, found.drop("log_det"))).groupBy("g", _cell(F.col("d2")).alias("cell")).agg(F.count("*").alias("n"))
    own = Window.partitionBy("g")
    cells = cells.select("*", F.sum("n").over(own.orderBy("cell")).alias("upto"), F.sum("n").over(own).alias("all_n"))
    median = cells.where("upto >= 0.5 * all_n").groupBy("g").agg(_edge(F.min("cell")).alias("median"))
    return stored(found.join(median.select("g", F.greatest(F.col("median") / CHI2_MEDIAN, F.lit(1.0)).alias("scale")), "g"), "quality-model")


def judged(stats: DataFrame) -> DataFrame:
    """statistics() with base_failed, distance (squared, null where the fixed rules fail) and kept."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > int(100 * MOST_REPEATED) * F.col("n_words"))
    stats = stored(transformed(stats).withColumn("base_failed", failed), "quality-statistics")
    sizes = stats.where(~F.col("base_failed")).groupBy("lang", "source").agg(F.count("*").alias("group_n"))
    for c in ("lang", "source"):
        sizes = _joined(sizes, sizes.groupBy(c).agg(F.sum("group_n").alias(f"{c}_n")), [c])
    pool = F.when(F.col("group_n") >= MIN_GROUP, 0).when(F.col("lang_n") >= MIN_GROUP, 1).when(F.col("source_n") >= MIN_GROUP, 2).otherwise(3)
    judge = sizes.select("lang", "source", pool.alias("pool")).withColumn("judge_g", _group())
    judge = stored(judge.withColumn("pool", F.lit(0)).select(_group().alias("g"), "judge_g"), "quality-pools")
    # a document counts in each pool that judges some group and that it belongs to
    used = judge.select(F.col("judge_g").alias("used_g")).distinct()
    good = stats.where(~F.col("base_failed")).select("doc_id", "lang", "source", *STATISTICS, F.explode(F.array(*[F.lit(i) for i in range(4)])).alias("pool")).withColumn("g", _group())
    in_use = bit_filter(used)  # saves work only
    good = flagged(good.select("doc_id", "g", *STATISTICS), "g", in_use).where("may_be").drop("may_be")
    good = stored(Groups(good).join(good, used.withColumnRenamed("used_g", "g")), "quality-vectors")
    model = covariance_determinants(good).drop("log_det").withColumnRenamed("g", "model_g")
    model = stored(judge.join(model, F.col("judge_g") == F.col("model_g")).drop("judge_g", "model_g"), "quality-judges")  # a row for each language and source
    stats = stats.withColumn("pool", F.lit(0)).withColumn("g", _group()).drop("pool")
    final = Groups(stats).join(stats, model, "left")
    distance = F.when(~F.col("base_failed"), F.col("d2") / F.col("scale"))
    return _with_distance(final).withColumn("distance", distance).withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= CUTOFF, F.lit(False)))


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance."""
    return judged(statistics(docs)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")
