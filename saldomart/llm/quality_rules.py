"""Quality rules whose cutoffs come from labelled rows, with a bound on false rejection.

A rule compares one share of a text, as a level from 0 to 100, with a cutoff. Cutoffs are
chosen by stratum (the language) on labelled rows. A cutoff is safe if the exact upper
binomial bound (Clopper and Pearson) of the share of good rows it rejects stays at or
under the risk of the rule. The levels of a rule are tested in a fixed order, from 100
down, up to the first that is not safe, so they share one error level; the rules and
strata share the error level of the whole by Bonferroni's division. The risk of a
stratum is divided among the rules, so that all rules together keep within it.
Of the safe cutoffs the most useful is taken: rejected bad rows less ``GOOD_WEIGHT``
times rejected good rows, the loosest where several are equal; none if none is useful.

Only DataFrame functions run here: no Python on the executors.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saldomart.llm.common import stored

RISK = 0.02  # of rejecting a good document, by stratum and for all rules together
ERROR = 0.05  # chance that any bound does not hold
GOOD_WEIGHT = 4
LEVELS = 100
WINDOW = 5

# Fixed values of the contract.
_SPACES = "\t\n\x0b\x0c\r "
_SYMBOLS = "#*$%&|<>"

RULES = ("symbols", "exclamations", "duplicate_lines", "repeated_words")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, where ``value`` is worked out once per row."""
    return F.transform(F.array(value), use)[0]


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _covered(windows: Column) -> Column:
    """Words in windows that occur twice or more. ``windows`` has a hash for each start."""
    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(ordered: Column) -> Column:
        def twin(e: Column, k: Column) -> Column:
            same = F.coalesce(F.get(ordered, k - 1)["h"] == e["h"], F.lit(False)) | F.coalesce(
                F.get(ordered, k + 1)["h"] == e["h"], F.lit(False)
            )
            return F.when(same, e["i"])

        return F.array_sort(F.array_compact(F.transform(ordered, twin)))

    def length(at: Column) -> Column:
        new = F.transform(at, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - x, F.lit(WINDOW))))
        return F.aggregate(new, F.lit(0).cast("long"), lambda a, x: a + x)

    return _let(_let(pairs, starts), length)


def _repeated_words(words: Column) -> Column:
    def windows(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - WINDOW)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))

    def count(found: Column) -> Column:
        repeated = F.size(F.array_distinct(found)) < F.size(found)
        return F.when(repeated, _covered(found)).otherwise(F.lit(0).cast("long"))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return _let(
        hashes,
        lambda h: F.when(F.size(h) < WINDOW, F.lit(0).cast("long")).otherwise(_let(windows(h), count)),
    )


def text_stats(text: Column) -> Column:
    """Counts of a text as a struct; NULL counts as empty. Windows are compared by 64-bit hashes."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: _without(line, _SPACES) != "")

    def of_words(words: Column) -> Column:
        return F.struct(F.size(words).cast("long").alias("n_words"), _repeated_words(words).alias("n_repeat_words"))

    def of_lines(found: Column) -> Column:
        n = F.size(found).cast("long")
        return F.struct(n.alias("n_lines"), (n - F.size(F.array_distinct(found))).alias("n_dup_lines"))

    words = _let(F.array_remove(F.split(text, "[ \\t\\n\\x0b\\f\\r]+", -1), ""), of_words)
    lined = _let(lines, of_lines)
    n_chars = F.char_length(text)
    return _let(
        F.struct(words.alias("w"), lined.alias("l")),
        lambda s: F.struct(
            s["w"]["n_words"].alias("n_words"),
            F.char_length(_without(text, _SPACES)).cast("long").alias("word_chars"),
            (n_chars - F.char_length(_without(text, _SYMBOLS))).cast("long").alias("n_symbols"),
            (n_chars - F.char_length(_without(text, "!"))).cast("long").alias("n_exclamations"),
            s["l"]["n_lines"].alias("n_lines"),
            s["l"]["n_dup_lines"].alias("n_dup_lines"),
            s["w"]["n_repeat_words"].alias("n_repeat_words"),
        ),
    )


def _level(part: Column, whole: Column) -> Column:
    return F.coalesce(F.floor(F.lit(LEVELS) * part / F.greatest(whole, F.lit(1))), F.lit(0)).cast("int")


def rule_levels(stats: Column) -> dict[str, Column]:
    """The level of a text under each rule, from its counts."""
    return {
        "symbols": _level(stats["n_symbols"], stats["word_chars"]),
        "exclamations": _level(stats["n_exclamations"], stats["word_chars"]),
        "duplicate_lines": _level(stats["n_dup_lines"], stats["n_lines"]),
        "repeated_words": _level(stats["n_repeat_words"], stats["n_words"]),
    }


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < 10) | (100 * stats["n_repeat_words"] > 20 * stats["n_words"])


def tail_log(k: Column, n: Column, risk: float) -> Column:
    """log P(X <= k) for X binomial(n, risk). The upper bound of k in n is at most ``risk`` where this is low."""
    odds = F.lit(risk / (1 - risk))
    first = n.cast("double") * F.log(F.lit(1 - risk))
    start = F.struct(first.alias("term"), first.alias("total"))

    def step(a: Column, i: Column) -> Column:
        term = a["term"] + F.log((n - i + 1) / i * odds)
        high, low = F.greatest(a["total"], term), F.least(a["total"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k.cast("long"))).otherwise(F.array().cast("array<long>"))
    return F.aggregate(steps, start, step, lambda a: a["total"])


def choose_cutoffs(labelled: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """One row per stratum: the cutoff level of each rule, NULL where no cutoff is safe and useful.

    ``labelled`` has stratum, quality (1 is good) and a level column for each rule.
    """
    rule_risk = risk / len(RULES)
    long = labelled.select(
        "stratum",
        (F.col("quality") == 1).alias("good"),
        F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("level")) for r in RULES])).alias("x"),
    ).select("stratum", "good", "x.rule", F.least(F.col("x.level"), F.lit(LEVELS)).alias("level"))
    counts = long.groupBy("stratum", "rule", "level").agg(
        F.count_if("good").alias("n_good"), F.count_if(~F.col("good")).alias("n_bad")
    )
    family = Window.partitionBy("stratum", "rule")
    from_top = family.orderBy(F.desc("level"))
    families = counts.select(F.count_distinct("stratum") * len(RULES)).scalar()
    tested = (
        counts.select(
            "*",
            F.sum("n_good").over(from_top).alias("false_rejections"),
            F.sum("n_bad").over(from_top).alias("rejected_bad"),
            F.sum("n_good").over(family).alias("n"),
        )
        # Beyond the expected count no bound can be at or under the risk.
        .filter((F.col("level") > 0) & (F.col("false_rejections") < F.col("n") * rule_risk))
        .withColumn("log_p", tail_log(F.col("false_rejections"), F.col("n"), rule_risk))
        .filter(F.col("log_p") <= F.log(F.lit(error) / families))
        .withColumn("use", F.col("rejected_bad") - GOOD_WEIGHT * F.col("false_rejections"))
        .filter("use > 0")
    )
    best = tested.groupBy("stratum", "rule").agg(F.max(F.struct("use", "level"))["level"].alias("cutoff"))
    return best.groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in RULES]
    )


def _judged(docs: DataFrame, labels: DataFrame, risk: float, error: float, keep: Sequence[str] = ("*",)) -> DataFrame:
    """Rows of ``docs``, or the columns to ``keep``, as a struct ``row``, with their counts and verdicts."""
    counted = stored(docs.select(F.struct(*keep).alias("row"), text_stats(F.col("text")).alias("stats")), "quality-stats")
    levels = [level.alias(rule) for rule, level in rule_levels(F.col("stats")).items()]
    stratum = F.coalesce(F.col("row.lang"), F.lit(""))
    label = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
    label = label.agg(F.min("quality").alias("quality"))
    labelled = counted.select(F.col("row.doc_id").alias("doc_id"), stratum.alias("stratum"), *levels)
    cutoffs = stored(choose_cutoffs(labelled.join(label, "doc_id"), risk, error), "quality-cutoffs")
    rejected = F.lit(False)
    for rule, level in rule_levels(F.col("stats")).items():
        rejected = rejected | F.coalesce(level >= F.col(f"cut_{rule}"), F.lit(False))
    return (
        counted.withColumn("stratum", stratum)
        .join(cutoffs, "stratum", "left")
        .withColumn("base_failed", base_failed(F.col("stats")))
        .withColumn("kept", ~F.col("base_failed") & ~rejected)
    )


def judged(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """doc_id, a struct ``stats`` of counts, base_failed and kept, one row per input row.

    ``docs`` has doc_id, text and lang; other columns are ignored, repeated rows are
    repeated, a NULL doc_id stays NULL. ``labels`` has doc_id and quality; a document with
    several labels counts as bad if one of them is 0, rows with NULL in either are not used.
    NULL or empty texts have no words and fail the base. A NULL language is a stratum of its
    own, together with the empty one. Without enough labels no rule has a cutoff and the
    base decides alone.

    Counts are worked out once and stored in the shared folder; the cutoffs are a row per
    stratum, joined by whatever join their stored size allows.
    """
    found = _judged(docs, labels, risk, error, ("doc_id", "lang"))
    return found.select("row.doc_id", "stats", "base_failed", "kept")


def passing(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns, whatever their names."""
    return _judged(docs, labels, risk, error).filter("kept").select("row.*")
