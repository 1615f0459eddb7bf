"""Quality rules with risk-controlled cutoffs, on DataFrame functions only.

Documents are measured natively. Base rules reject what is too short or repeats itself. The further rules are tested
together, in each stratum on labelled documents: a vector has one cutoff of a fixed list for each rule, or none, and rejects
what any of them rejects. With n good documents of which a vector rejects k, it is safe if so few rejections are too unlikely
for a false-rejection rate at the limit, by the exact binomial tail. Vectors are tested along paths: a path takes the rules
one after another and tightens each from its laxest cutoff to its strictest, up to the first vector that is not safe (a fixed
sequence, which needs no correction of its own). There is one path for each rule to begin with, so that a rule that stops one
path comes last in another; the allowed error is divided by the number of paths in all strata. So with the stated confidence
no stratum loses more than `limit` of its good documents. Of the safe vectors the one that meets the most bad documents over
good ones is taken, and of each of its rules the strictest cutoff, as lax or laxer, that meets more bad than good documents;
a rule without any is off in that stratum, and all are with fewer good labels than could show safety (286 for four strata).

Defined cases. Null or empty text: all measures 0, rejected as too short. Null stratum: a stratum of its own. Labels that
repeat an id: good if any says so. Null ids have no label. Extra columns pass through; ones named like a measure are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waitlens.llm.work import stored

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent of the words
LIMIT = 0.02
ERROR = 0.05
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Rules: what is measured (a document fails if it is greater than the cutoff), and the cutoffs tried.
RULES = {
    "symbols": ("n_symbols / greatest(word_chars, 1)", (0.02, 0.05, 0.1, 0.15, 0.2, 0.3)),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", (0.05, 0.1, 0.15, 0.2, 0.25)),
    "lines": ("n_dup_lines / greatest(n_words, 1)", (0.005, 0.01, 0.02, 0.05)),
    "long_words": ("word_chars / greatest(n_words, 1)", (8.0, 9.0, 10.0, 12.0, 15.0)),
}


def _let(value: Column, body) -> Column:
    """`body` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _covered(windows: Column, size: int) -> Column:
    """How many places windows cover that are found twice or more."""
    pairs = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

    def places(s: Column) -> Column:
        twice = F.filter(s, lambda e, i: (F.get(s, i - 1)["x"] == e["x"]) | F.coalesce(F.get(s, i + 1)["x"] == e["x"], F.lit(False)))
        return F.sort_array(F.transform(twice, lambda e: e["i"]))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, i: F.least(F.coalesce(F.get(p, i + 1) - x, F.lit(size)), F.lit(size)))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    return _let(_let(pairs, places), covered)


def _repeated(words: Column, size: int) -> Column:
    def found(hashes: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(hashes) - size), lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(size)))
        )
        some = _let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(_covered(w, size)))
        return F.when(F.size(hashes) > size, some).otherwise(0)

    return _let(F.transform(words, lambda w: F.xxhash64(w)), found)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs` with the measures and base_failed."""
    docs = docs.drop(*(m for m in (*MEASURES, "base_failed") if m != text))
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(body, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    found = _let(words, lambda w: F.struct(F.size(w).alias("n"), _repeated(w, WINDOW).alias("r")))
    measured = docs.withColumns(
        {
            "_wl_found": found,
            "word_chars": F.length(F.translate(body, " \t\n\x0b\x0c\r", "")).cast("long"),
            "n_symbols": (F.length(body) - F.length(F.translate(body, "#*$%&|<>", ""))).cast("long"),
            "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        }
    )
    n, r = F.col("_wl_found.n").cast("long"), F.col("_wl_found.r").cast("long")
    return measured.withColumns(
        {"n_words": n, "n_repeat_words": r, "base_failed": (n < LEAST_WORDS) | (100 * r > MOST_REPEATED * n)}
    ).drop("_wl_found")


def _tail(n: Column, k: Column, p: float) -> Column:
    """The exact chance of at most k of n at rate p; 1 where k is no less than expected."""
    odds = p / (1 - p)

    def step(a: Column, j: Column) -> Column:
        term = a["t"] + F.log((n - j + 1) / j * odds)
        return F.struct(term.alias("t"), (a["s"] + F.exp(term)).alias("s"))

    none = n * F.log(F.lit(1 - p))
    start = F.struct(none.alias("t"), F.exp(none).alias("s"))
    several = F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1))), start, step)["s"]
    return F.when(k >= n * p, 1.0).when(k == 0, F.exp(none)).otherwise(several)


def _paths() -> list[tuple[int, int, list[int]]]:
    """path, step, and of each rule the place of its cutoff; a place beyond the last is no cutoff."""
    cuts = [len(c) for _, c in RULES.values()]
    steps = []
    for path in range(len(cuts)):
        places, step = list(cuts), 0
        for rule in (*range(path, len(cuts)), *range(path)):
            for place in reversed(range(cuts[rule])):
                places[rule], step = place, step + 1
                steps.append((path, step, list(places)))
    return steps


def calibrate(measured: DataFrame, labels: DataFrame, stratum: str = "lang", id_column: str = "doc_id", limit: float = LIMIT, error: float = ERROR) -> DataFrame:
    """stratum, cutoffs: of each stratum the cutoff by rule, for rules with a safe one."""
    known = labels.where("quality is not null").groupBy(F.col(id_column).alias("_wl_id")).agg(F.max("quality").alias("_wl_good"))
    sample = measured.where("not base_failed").join(known, F.col(id_column) == F.col("_wl_id"))
    exceeded = [sum((F.expr(f"{value} > {cut}D").cast("int") for cut in cuts), F.lit(0)) for value, cuts in RULES.values()]
    # of each stratum a row for each combination of cutoffs exceeded, whatever the number of labels
    alike = sample.groupBy(F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), F.array(*exceeded).alias("over")).agg(
        F.count_if(F.col("_wl_good") == 1).alias("good"), F.count_if(F.col("_wl_good") == 0).alias("bad")
    )
    singles = [
        (-1 - rule, place, [place if i == rule else len(c) for i, (_, c) in enumerate(RULES.values())])
        for rule, (_, cuts) in enumerate(RULES.values())
        for place in range(len(cuts))
    ]
    tried = F.array(*(F.struct(F.lit(p).alias("path"), F.lit(s).alias("step"), F.array(*map(F.lit, v)).alias("places")) for p, s, v in [*_paths(), *singles]))
    fails = F.exists(F.arrays_zip("over", "places"), lambda x: x["over"] > x["places"])
    by_step = (
        alike.select("stratum", "over", "good", "bad", F.inline(tried))
        .groupBy("stratum", "path", "step", "places")
        .agg(F.sum("good").alias("n"), F.sum(F.when(fails, F.col("good")).otherwise(0)).alias("k"), F.sum(F.when(fails, F.col("bad")).otherwise(0)).alias("bad"))
    )
    strata = alike.agg(F.count_distinct("stratum").alias("strata"))
    each = by_step.where("path >= 0").withColumn("strata", strata.scalar())
    safe = _tail(F.col("n"), F.col("k"), limit) <= error / len(RULES) / F.col("strata")
    ended = F.coalesce(F.min(F.when(~F.col("safe"), F.col("step"))).over(Window.partitionBy("stratum", "path")), F.lit(1 << 30))
    certified = each.withColumn("safe", safe).withColumn("ended", ended).where("step < ended")
    order = F.struct(F.col("bad") - F.col("k"), -F.col("k"), F.col("step"), -F.col("path"))
    taken = certified.groupBy("stratum").agg(F.max_by("places", order).alias("taken"))
    useful = by_step.where("path < 0 and bad > k").select("stratum", (-1 - F.col("path")).alias("rule"), F.col("step").alias("place"))
    held = useful.join(taken, "stratum").where(F.col("place") >= F.get("taken", "rule")).groupBy("stratum", "rule").agg(F.min("place").alias("place"))
    names = F.array(*map(F.lit, RULES))
    cutoffs = F.array(*(F.array(*map(F.lit, cuts)) for _, cuts in RULES.values()))
    named = held.select("stratum", F.get(names, "rule").alias("rule"), F.get(F.get(cutoffs, "rule"), "place").alias("cut"))
    return named.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cut"))).alias("cutoffs"))


def judge(measured: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """The rows of `measured` with failed_rules and kept."""
    fails = [
        F.when(F.expr(value) > F.col("_wl_cutoffs")[name], F.lit(name)) for name, (value, _) in RULES.items()
    ]
    own = cutoffs.select(F.col("stratum").alias("_wl_stratum"), F.col("cutoffs").alias("_wl_cutoffs"))
    # a stratum has a row only with some hundred labels
    joined = measured.drop("failed_rules", "kept").join(F.broadcast(own), F.coalesce(F.col(stratum).cast("string"), F.lit("")) == F.col("_wl_stratum"), "left")
    judged = joined.withColumn("failed_rules", F.array_compact(F.array(*fails)))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop("_wl_stratum", "_wl_cutoffs")


def verdicts(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", stratum: str = "lang", keep: tuple[str, ...] = ()) -> DataFrame:
    """For each document: the id, stratum, columns to keep, measures, base_failed, failed_rules and kept."""
    measured = stored(measure(docs.select(id_column, text, stratum, *keep), text).drop(text))
    return judge(measured, calibrate(measured, labels, stratum, id_column), stratum)
