"""Quality rules as a short-circuit cascade.

Every document gets its base measures. The rules beyond them are evaluated as
one CASE expression, so a row stops at the first rule that rejects it. The order
is worked out before: each rule's cost is timed on a bounded sample and its
selectivity counted there, and the rule with the most rejections per second among
the rows that are still left comes next. The order changes the work, never the
verdict, which is the same for any order.

Defined results: a null text counts as empty; an empty text has no words and fails
the base rule; repeated rows are judged one by one; an empty table gives an empty
result; other columns of the input are left alone. Repeated windows of words are
found by the 64-bit hash of their three words.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formflow.llm.common import ROW, packed, text_of

# White space, words and symbols as the measures define them.
SPACE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "[#*$%&|<>]+"

#: A rule is timed once it takes so long, or on so many copies of the sample.
CLEAR_SECONDS, MOST_TIMES = 0.1, 256

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``rejects`` is a SQL condition over the measures and ``text``."""

    name: str
    rejects: str


RULES = (
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 20 * n_words"),
    Rule("dup_lines", "10 * n_dup_lines > 3 * size(split(text, '\\n', -1))"),
    Rule("repeats", "100 * n_repeat_words > 40 * n_words"),
    Rule("exclaiming", "4 * (length(text) - length(replace(text, '!', ''))) > n_words"),
    Rule("shouting", "2 * length(regexp_replace(text, '\\\\P{Lu}+', '')) > word_chars"),
    Rule("letters", "2 * length(regexp_replace(text, '\\\\P{L}+', '')) < word_chars"),
)


def _windows(words: Column) -> Column:
    """Three-word windows as (hash, place), sorted, so that equal ones are neighbours."""
    at = lambda i: F.get(words, i)
    return F.when(
        F.size(words) >= 3,
        F.sort_array(
            F.transform(
                F.sequence(F.lit(0), F.size(words) - 3),
                lambda i: F.struct(F.xxhash64(at(i), at(i + 1), at(i + 2)).alias("h"), i.alias("p")),
            )
        ),
    )


def _repeated(windows: Column) -> Column:
    """Sorted places of the windows that equal a neighbour."""
    near = lambda i: F.get(windows, i)["h"]
    return F.sort_array(F.filter(windows, lambda x, i: (x["h"] == near(i - 1)) | (x["h"] == near(i + 1)))["p"])


def _covered(places: Column) -> Column:
    """Words in those windows: each place covers the words up to the next place, three at most."""
    reach = F.transform(places, lambda p, i: F.coalesce(F.least(F.lit(3), F.get(places, i + 1) - p), F.lit(3)))
    return F.aggregate(reach, F.lit(0), lambda s, x: s + x)


def measured(df: DataFrame) -> DataFrame:
    """``df`` (with a column ``text``, not null) with the base measures added.

    Each array is a column of its own: several expressions read it, so the
    optimizer keeps it as a projection and it is worked out once per row. The
    measures leave through a one-row generator, which a later filter on them does
    not pass; below it, the filter would repeat all of these expressions.
    """
    step = df.withColumn("__words", F.array_remove(F.split("text", SPACE, -1), ""))
    step = step.withColumn("__windows", _windows(F.col("__words")))
    step = step.withColumn("__places", _repeated(F.col("__windows")))
    step = step.withColumn("__lines", F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD)))
    measures = F.struct(
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(_covered(F.col("__places")), F.lit(0)).cast("long").alias("n_repeat_words"),
    )
    return step.select(*df.columns, F.inline(F.array(measures)))


BASE_FAILED = "(n_words < 50 or 100 * n_repeat_words > 50 * n_words)"


def order_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = 400) -> list[Rule]:
    """Rules by rejections per cost, greedily, on a sample of ``sample_rows`` rows.

    At most 2 ** len(rules) counts come to the driver. An empty table keeps the
    order as given.
    """
    spark = docs.sparkSession
    taken = docs.select(text_of("text").alias("text")).take(sample_rows)
    if not taken:
        return list(rules)
    sample = measured(spark.createDataFrame(taken, "text string")).where(f"not {BASE_FAILED}")
    rows = [tuple(r) for r in sample.collect()]
    if not rows:
        return list(rules)
    left = spark.createDataFrame(rows, sample.schema)

    def seconds(condition: str, times: int) -> float:
        """Of a job that evaluates ``condition`` on every row of the sample so many times."""
        repeated = left.withColumn("__again", F.explode(F.sequence(F.lit(1), F.lit(times))))
        start = time.perf_counter()
        repeated.agg(F.count_if(F.expr(condition))).collect()
        return time.perf_counter() - start

    idle: dict[int, float] = {}

    def cost_of(rule: Rule) -> float:
        """Seconds for the sample: it is repeated within the job until the rule stands out from the job itself."""
        times = 4
        while True:
            if times not in idle:
                idle[times] = min(seconds("n_words > 0", times) for _ in range(2))
            spent = seconds(rule.rejects, times) - idle[times]
            if spent >= CLEAR_SECONDS or times >= MOST_TIMES:
                return max(spent, 1e-6) / times
            times *= 8

    cost = {r.name: cost_of(r) for r in rules}
    flags = left.selectExpr(*(f"coalesce({r.rejects}, false) as `{r.name}`" for r in rules))
    counts = [(r.asDict(), r["count"]) for r in flags.groupBy(*(f"`{x.name}`" for x in rules)).count().collect()]
    out, open_rules = [], list(rules)
    while open_rules:
        best = max(open_rules, key=lambda r: (sum(n for hit, n in counts if hit[r.name]) / cost[r.name], -cost[r.name]))
        out.append(best)
        open_rules.remove(best)
        counts = [(hit, n) for hit, n in counts if not hit[best.name]]
    return out


def cascade(ordered: Sequence[Rule]) -> Column:
    """Name of the first rule that rejects the row, else null; later ones are not evaluated."""
    out = F.when(F.expr(BASE_FAILED), F.lit("base"))
    for rule in ordered:
        out = out.when(F.expr(rule.rejects), F.lit(rule.name))
    return out


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = 400) -> DataFrame:
    """Each row of ``docs`` packed, with its measures, ``rejected_by`` and ``kept``."""
    rows = measured(packed(docs, text=text_of("text")))
    judged = rows.withColumn("rejected_by", cascade(order_rules(docs, rules, sample_rows)))
    return judged.select(
        ROW, *MEASURES, F.expr(BASE_FAILED).alias("base_failed"), "rejected_by", F.col("rejected_by").isNull().alias("kept")
    )


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = 400) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their columns."""
    return judge(docs, rules, sample_rows).where("kept").select(f"{ROW}.*")
