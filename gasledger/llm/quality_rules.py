"""Quality rules whose cutoffs are chosen under a proven limit on false rejection.

Every document is measured by DataFrame functions alone.  A rule rejects a
document when one of its measures reaches a cutoff.  Cutoffs are chosen per
stratum (language) on labelled documents:

- a candidate cutoff is a bin edge of the measure (``RULES``);
- with ``k`` of ``n`` good labelled documents rejected, the exact binomial tail
  P(Bin(n, risk) <= k) is the p-value of "this cutoff rejects more than ``risk``
  of the good documents";
- candidates are tested from the mildest on, and testing stops at the first
  that fails, so they need no further correction among themselves (fixed
  sequence); the level ``delta`` is divided by rules times strata (Bonferroni),
  and ``risk`` by the number of rules, as one document may meet several;
- of the certified cutoffs the one that rejects most bad documents net of good
  ones is used, the milder at ties.

With probability at least 1 - ``delta`` no stratum loses more than ``risk`` of
its good documents.  A stratum with too few labels has no cutoff and rejects
nothing beyond the base rules.

Defined results: a null text is empty; a null stratum is the stratum ''; labels
that are null or of unknown documents are not used, and of repeated labels the
lowest counts; an empty table or empty labels give no rows or no cutoffs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gasledger.llm.common import WHITE, stored

RISK = 0.01      # largest share of a stratum's good documents that may be lost
DELTA = 0.05     # chance that any stratum exceeds it

#: rule -> (measure, bins per unit, last bin); a document's bin is floor(measure * bins), at most the last
RULES: dict[str, tuple[Callable[[], Column], int, int]] = {
    "symbols": (lambda: _share("n_symbols", "n_words"), 50, 200),
    "dup_lines": (lambda: _share("n_dup_lines", "n_lines"), 100, 100),
    "repeats": (lambda: _share("n_repeat_words", "n_words"), 100, 100),
    "word_length": (lambda: _share("word_chars", "n_words"), 5, 250),
}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def _share(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def measures(text: Column) -> Column:
    """Struct of the ``MEASURES`` of a text, in one expression."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    symbols = F.length(F.regexp_replace(text, "[^#*$%&|<>]+", ""))
    return let(
        F.filter(F.split(text, WHITE), lambda w: w != ""),
        lambda w: let(lines, lambda x: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            symbols.cast("long").alias("n_symbols"),
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            let(_windows(w), _repeated).cast("long").alias("n_repeat_words"),
        )),
    )


def _windows(words: Column) -> Column:
    """Hash of every run of three words."""
    return F.when(F.size(words) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )).otherwise(F.array().cast("array<bigint>"))


def _repeated(windows: Column) -> Column:
    """Number of words in windows that occur more than once: equal hashes meet by sorting."""
    def same(s: Column, x: Column, i: Column) -> Column:
        near = lambda j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
        return F.struct(x["at"].alias("at"), (near(i - 1) | near(i + 1)).alias("again"))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    order = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    places = let(order, lambda s: F.array_sort(F.transform(
        F.filter(F.transform(s, lambda x, i: same(s, x, i)), lambda y: y["again"]), lambda y: y["at"])))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(places, covered))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """doc_id, stratum, the measures, base_failed and one bin per rule (``bin_<rule>``)."""
    m = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"),
        measures(F.col(text_col)).alias("m"),
    ).select("doc_id", "stratum", *[F.col(f"m.{c}").alias(c) for c in MEASURES])
    return _binned(m).withColumn("base_failed", base_failed())


def _binned(m: DataFrame) -> DataFrame:
    return m.withColumns({
        f"bin_{rule}": F.least(F.lit(last), F.floor(measure() * bins)).cast("int")
        for rule, (measure, bins, last) in RULES.items()})


def binomial_tail(n: Column, k: Column, risk: float) -> Column:
    """P(Bin(n, risk) <= k), summed term by term in logarithms; 1 where k reaches the mean."""
    odds = F.lit(risk / (1 - risk))
    first = n.cast("double") * F.log1p(F.lit(-risk))

    def add(s: Column, j: Column) -> Column:
        term = s["term"] + F.log((n - j + 1).cast("double") / j.cast("double") * odds)
        top = F.greatest(s["sum"], term)
        return F.struct(term.alias("term"),
                        (top + F.log(F.exp(s["sum"] - top) + F.exp(term - top))).alias("sum"))

    terms = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    total = F.aggregate(terms, F.struct(first.alias("term"), first.alias("sum")), add, lambda s: F.exp(s["sum"]))
    return F.when(k >= n * F.lit(risk), F.lit(1.0)).otherwise(total)


def cutoffs(m: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA,
            id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """Per stratum and rule with a certified cutoff: stratum, rule, cutoff (lowest rejected bin),
    good (n), lost (k) and p_value."""
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("doc_id")).agg(F.min(label_col).alias("good")))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"bin_{r}").alias("bin")) for r in RULES]))
    counts = (m.where(~F.col("base_failed")).join(known, "doc_id")
              .select("stratum", "good", rules.alias("x")).select("stratum", "good", "x.rule", "x.bin")
              .groupBy("stratum", "rule", "bin")
              .agg(F.count_if(F.col("good") == 1).alias("good"), F.count_if(F.col("good") == 0).alias("bad")))
    # at most strata x rules x bins rows from here on
    whole = Window.partitionBy("stratum", "rule")
    down = whole.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    strata = Window.partitionBy()
    per_rule = risk / len(RULES)
    tested = (counts.withColumns({"n": F.sum("good").over(whole), "k": F.sum("good").over(down),
                                  "hit": F.sum("bad").over(down),
                                  "strata": F.size(F.collect_set("stratum").over(strata))})
              .withColumn("p_value", binomial_tail(F.col("n"), F.col("k"), per_rule))
              .withColumn("passes", F.col("p_value") <= F.lit(delta) / (F.col("strata") * len(RULES)))
              .withColumn("certified", F.min("passes").over(down)))
    best = F.max_by(F.struct("bin", "n", "k", "p_value"), F.struct(F.col("hit") - F.col("k"), F.col("bin")))
    return (tested.where(F.col("certified") & (F.col("hit") > F.col("k")) & (F.col("bin") > 0))
            .groupBy("stratum", "rule").agg(best.alias("b"))
            .select("stratum", "rule", F.col("b.bin").alias("cutoff"), F.col("b.n").alias("good"),
                    F.col("b.k").alias("lost"), F.col("b.p_value").alias("p_value")))


def _wide(cuts: DataFrame) -> DataFrame:
    """One row per stratum: cut_<rule>."""
    return cuts.groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in RULES])


def verdict() -> Column:
    fails = [F.coalesce(F.col(f"bin_{r}") >= F.col(f"cut_{r}"), F.lit(False)) for r in RULES]
    out = F.col("base_failed")
    for f in fails:
        out = out | f
    return ~out


def judged(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA, id_col: str = "doc_id",
           text_col: str = "text", stratum_col: str = "lang", label_col: str = "quality") -> DataFrame:
    """Per row of ``docs``: its measures, bins, cutoffs, base_failed and kept.

    Measures are stored once; the cutoffs come from them and are joined back by stratum.
    """
    m = stored(measured(docs, id_col, text_col, stratum_col), "measures")
    cuts = _wide(cutoffs(m, labels.withColumnRenamed(id_col, "doc_id"), risk, delta, "doc_id", label_col))
    return m.join(cuts, "stratum", "left").withColumn("kept", verdict())


def drop_rejected(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """The kept rows of ``docs`` with their own columns.

    Texts are measured twice, for the cutoffs and for the verdict, rather than shuffled.
    """
    m = _once(docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("stratum"), "text"))
    cuts = stored(_wide(cutoffs(m, labels, risk, delta)), "cutoffs")
    rows = _once(docs.select(F.struct("*").alias("row"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("stratum"), "text"))
    return rows.join(cuts, "stratum", "left").where(verdict()).select("row.*")


def _once(rows: DataFrame) -> DataFrame:
    """``rows`` with the measures of ``text`` in its place, bins and base_failed.

    The measures come out of a generator: filters on them stay above it, where a
    projection would repeat the measuring expression in each filter pushed below.
    """
    kept = [c for c in rows.columns if c != "text"]
    m = rows.select(*kept, F.inline(F.array(measures(F.col("text")))))
    return _binned(m).withColumn("base_failed", base_failed())
