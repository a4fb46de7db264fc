"""Quality rules whose cutoffs carry a guarantee: labelled holdouts, exact binomial bounds.

A rule rejects a document when a statistic of its text exceeds a cutoff.  In each
stratum the labelled documents tell, for every cutoff, how many good ones it would
reject; a cutoff is certified if the exact binomial test shows, at a level divided
by the number of rules and strata, that it falsely rejects no more than the rule's
part of the allowed share.  Loose cutoffs are tested before strict ones and testing
ends at the first that fails, so the many cutoffs of a rule need no further
correction.  Of the certified cutoffs a rule takes the one that gains most; the
shares of all rules add up to ``risk``, so with probability ``1 - level`` no stratum
loses more than ``risk`` of its good documents to these rules.

Everything is built-in DataFrame work.  Texts are read once; a repeated passage is
found inside its row by sorting window hashes and then comparing windows, nothing is
shuffled but histograms and labels.

Defined results: null and empty texts have no words and fail the base rules; a null
stratum is a stratum of its own; equal rows are judged alike; a document is weighed
with each of its labels, a null label is none; without enough labels a stratum has no
certified cutoff and only the base rules reject there; an empty table gives an empty
result; other columns do not matter, names of the input cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.exchange import stored

#: Between words, and what at least one word makes a line match.
BREAK, WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"

#: Words in a window, fewest words of a document, largest percentage of its words in repeated windows.
WINDOW, FEWEST, REPEATED = 5, 10, 20

#: Share of good documents that a stratum may lose to the rules, and the probability that one loses more.
RISK, LEVEL = 0.02, 0.05

#: A cutoff gains the share of bad documents it rejects less so many times the share of good ones.
PRICE = 10

#: Statistics are counted per thousand; larger values meet in the last bin.
TOP = 4000

#: Terms of a binomial tail that are added one by one; a geometric series bounds the rest from above.
TERMS = 4096

#: What a rule looks at: numerator and denominator.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "capitals": ("n_capitals", "word_chars"),
    "exclamations": ("n_loud", "n_words"),
    "repeated_words": ("n_repeat_words", "n_words"),
    "repeated_lines": ("n_dup_lines", "n_lines"),
}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _twice(keyed: Column) -> Column:
    """Places of the keys that occur more than once, of an array of ``(key, place)``."""

    def marked(entries: Column) -> Column:
        same = lambda i, j: F.get(entries, i)["key"].eqNullSafe(F.get(entries, j)["key"])
        hit = F.filter(entries, lambda x, i: ((i > 0) & same(i, i - 1)) | ((i < F.size(entries) - 1) & same(i, i + 1)))
        return F.transform(hit, lambda x: x["at"])

    return _let(F.array_sort(keyed), marked)


def _windows(words: Column) -> Column:
    """First places (from 1) of all windows of a list of words."""
    none = F.array().cast("array<int>")
    return F.when(F.size(words) >= WINDOW, F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))).otherwise(none)


def _repeat_words(words: Column) -> Column:
    """Number of words in windows that the list holds more than once.

    Most texts repeat no window; those whose window hashes are all different need no sorting.
    """

    def entry(key: Column, at: Column) -> Column:
        return F.struct(key.alias("key"), at.alias("at"))

    def covered(at: Column) -> Column:
        return F.aggregate(
            at,
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
            lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")),
            lambda acc: acc["n"],
        )

    def counted(hashes: Column) -> Column:
        keyed = F.transform(hashes, lambda key, i: entry(key, i + 1))
        # Words hold no space, so joined windows are equal only if their words are.
        spelled = F.transform(_twice(keyed), lambda i: entry(F.array_join(F.slice(words, i, WINDOW), " "), i))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            _let(F.array_sort(_twice(spelled)), covered)
        )

    return _let(F.transform(_windows(words), lambda i: F.xxhash64(*[F.get(words, i + k - 1) for k in range(WINDOW)])), counted)


def statistics(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """``doc_id, stratum`` and the counts of every whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def counted(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            _repeat_words(words).alias("n_repeat_words"),
        )

    def lined(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        )

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    found = docs.select(
        "doc_id",
        F.col(stratum).alias("stratum"),
        _let(F.array_remove(F.split(text, BREAK), ""), counted).alias("w"),
        F.length(F.regexp_replace(text, BREAK, "")).cast("long").alias("word_chars"),
        _let(lines, lined).alias("l"),
        *(F.regexp_count(text, F.lit(p)).cast("long").alias(n) for n, p in (("n_symbols", SYMBOL), ("n_capitals", "[A-Z]"), ("n_loud", "!"))),
    )
    base = (F.col("w.n_words") < FEWEST) | (100 * F.col("w.n_repeat_words") > REPEATED * F.col("w.n_words"))
    return found.select("doc_id", "stratum", "w.*", "word_chars", "l.*", "n_symbols", "n_capitals", "n_loud", base.alias("base_failed"))


def _measured(rule: str) -> Column:
    """A rule's statistic in thousandths, whole."""
    above, below = RULES[rule]
    return F.least(F.lit(TOP), F.coalesce(F.try_divide(1000 * F.col(above) - F.pmod(1000 * F.col(above), F.col(below)), F.col(below)), F.lit(0))).cast("int")


def _stirling_rest(n: Column) -> Column:
    """What Stirling's formula leaves of ln n!; exact to a double."""
    small = F.log(F.factorial(F.least(n, F.lit(15)).cast("int"))) - ((n + 0.5) * F.log(n) - n + 0.5 * F.log(2 * F.pi()))
    series = (F.lit(1 / 12) - (F.lit(1 / 360) - (F.lit(1 / 1260) - F.lit(1 / 1680) / (n * n)) / (n * n)) / (n * n)) / n
    return F.when(n <= 15, small).otherwise(series)


def _deviance(x: Column, mean: Column) -> Column:
    return x * F.log(x / mean) + mean - x


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(X <= k) for X binomial with ``n`` tries of probability ``p``; never less than the truth.

    The k-th term comes from its saddle-point form, those below it by their ratios.
    """
    n, k = n.cast("double"), k.cast("double")
    inner = F.exp(
        _stirling_rest(n) - _stirling_rest(k) - _stirling_rest(n - k) - _deviance(k, n * p) - _deviance(n - k, n * (1 - p))
    ) * F.sqrt(n / (2 * F.pi() * k * (n - k)))
    term = F.when(k == 0, F.exp(n * F.log1p(F.lit(-p)))).when(k == n, F.pow(F.lit(p), n)).otherwise(inner)
    ratio = lambda j: (k - j) * (1 - p) / ((n - k + j + 1) * p)
    summed = F.aggregate(
        F.sequence(F.lit(0), F.least(k, F.lit(TERMS)).cast("int")),
        F.struct(F.lit(0.0).alias("sum"), F.lit(1.0).alias("term")),
        lambda acc, j: F.struct((acc["sum"] + acc["term"]).alias("sum"), (acc["term"] * ratio(j)).alias("term")),
        lambda acc: acc["sum"]
        + F.when(k > TERMS, acc["term"] / F.greatest(F.lit(1e-300), 1 - ratio(F.lit(TERMS + 1)))).otherwise(0.0),
    )
    return F.when(k >= n, F.lit(1.0)).otherwise(F.least(F.lit(1.0), term * summed))


def certified(stats: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """``stratum, rule, cutoff, n_good, n_bad, good_lost, bad_lost, tail``: one row for each rule in use.

    ``labels`` is ``doc_id, label`` (1 is good); documents that the base rules reject
    are gone before the rules see them and do not count.
    """
    weights = (
        labels.where(F.col("label").isNotNull())
        .groupBy("doc_id")
        .agg(F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") != 1).alias("bad"))
    )
    known = stats.where("NOT base_failed").join(weights, "doc_id")
    bins = stored(
        known.select("stratum", "good", "bad", F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), _measured(r).alias("bin")) for r in RULES])).alias("m"))
        .groupBy("stratum", "m.rule", "m.bin")
        .agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")),
        "rule-bins",
    )
    all_of = Window.partitionBy("stratum", "rule")
    above = all_of.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
    tallied = bins.select(
        "stratum", "rule", F.col("bin").alias("cutoff"),
        F.sum("good").over(all_of).alias("n_good"), F.sum("bad").over(all_of).alias("n_bad"),
        F.coalesce(F.sum("good").over(above), F.lit(0)).alias("good_lost"),
        F.coalesce(F.sum("bad").over(above), F.lit(0)).alias("bad_lost"),
    )
    share = risk / len(RULES)
    tests = bins.select("stratum").distinct().count() * len(RULES)
    tested = (
        tallied.where((F.col("n_good") > 0) & (F.col("good_lost") <= F.col("n_good") * share))
        .withColumn("tail", binomial_tail(F.col("n_good"), F.col("good_lost"), share))
        .where(F.col("tail") * tests <= level)
    )
    # The loss of good documents only grows as cutoffs get stricter, and the tail with it:
    # what passes here is what testing in order, up to the first failure, lets pass.
    gain = F.col("bad_lost") * F.col("n_good") - PRICE * F.col("good_lost") * F.col("n_bad")
    best = Window.partitionBy("stratum", "rule").orderBy(F.desc("gain"), F.desc("cutoff"))
    return (
        tested.withColumn("gain", gain)
        .where("gain > 0")
        .withColumn("place", F.row_number().over(best))
        .where("place = 1")
        .select("stratum", "rule", "cutoff", "n_good", "n_bad", "good_lost", "bad_lost", "tail")
    )


def judged(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """Every document's ``doc_id``, counts, ``base_failed``, ``failed`` (names of rules that reject it) and ``kept``."""
    stats = stored(statistics(docs, stratum), "rule-statistics")
    chosen = stored(certified(stats, labels, risk, level), "rule-cutoffs")
    cutoffs = chosen.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))
    over = [F.when(_measured(r) > F.col("cutoffs")[r], F.lit(r)) for r in RULES]
    failed = F.array_compact(F.array(*over))
    return (
        stats.alias("d")
        .join(cutoffs.alias("c"), F.expr("d.stratum <=> c.stratum"), "left")
        .select("d.*", failed.alias("failed"))
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
    )


ORACLE = r"""
WITH spread AS (
  SELECT row_number() OVER () AS row, doc_id, lang AS stratum, coalesce(text, '') AS text FROM documents
), listed AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM spread
), windows AS (
  SELECT row, i, array_to_string(words[i : i + 4], ' ') AS w5
  FROM (SELECT row, words, unnest(generate_series(1, len(words) - 4)) AS i FROM listed WHERE len(words) >= 5)
), twice AS (
  SELECT row, i FROM (SELECT *, count(*) OVER (PARTITION BY row, w5) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT row, sum(least(5, i - before))::BIGINT AS n
  FROM (SELECT row, i, lag(i, 1, -5) OVER (PARTITION BY row ORDER BY i) AS before FROM twice) GROUP BY row
), stats AS (
  SELECT doc_id, stratum, len(words)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(regexp_extract_all(text, '[A-Z]'))::BIGINT AS n_capitals,
         len(regexp_extract_all(text, '!'))::BIGINT AS n_loud, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM listed LEFT JOIN covered USING (row)
), based AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM stats
), measured AS (
  SELECT *, least(4000, CASE WHEN word_chars > 0 THEN 1000 * n_symbols // word_chars ELSE 0 END) AS m_symbols,
         least(4000, CASE WHEN word_chars > 0 THEN 1000 * n_capitals // word_chars ELSE 0 END) AS m_capitals,
         least(4000, CASE WHEN n_words > 0 THEN 1000 * n_loud // n_words ELSE 0 END) AS m_loud,
         least(4000, CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words ELSE 0 END) AS m_words,
         least(4000, CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines ELSE 0 END) AS m_lines
  FROM based
), holdout AS (
  SELECT m.*, l.good, l.bad FROM measured m JOIN (
    SELECT doc_id, count_if(quality = 1) AS good, count_if(quality <> 1) AS bad FROM labels
    WHERE quality IS NOT NULL GROUP BY doc_id
  ) l USING (doc_id) WHERE NOT base_failed
), long AS (
  UNPIVOT (SELECT stratum, good, bad, m_symbols, m_capitals, m_loud, m_words, m_lines FROM holdout)
  ON m_symbols, m_capitals, m_loud, m_words, m_lines INTO NAME rule VALUE bin
), bins AS (
  SELECT stratum, rule, bin, sum(good)::BIGINT AS good, sum(bad)::BIGINT AS bad FROM long GROUP BY ALL
), tallied AS (
  SELECT stratum, rule, bin AS cutoff,
         sum(good) OVER a AS n_good, sum(bad) OVER a AS n_bad,
         coalesce(sum(good) OVER b, 0) AS good_lost, coalesce(sum(bad) OVER b, 0) AS bad_lost
  FROM bins WINDOW a AS (PARTITION BY stratum, rule),
       b AS (PARTITION BY stratum, rule ORDER BY bin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), tested AS (
  SELECT *, bad_lost * n_good - 10 * good_lost * n_bad AS gain,
         list_sum(list_transform(range(0, good_lost::BIGINT + 1), lambda i: exp(
           lgamma(n_good::DOUBLE + 1) - (CASE WHEN i = 0 THEN 0 ELSE lgamma(i::DOUBLE + 1) END) - lgamma(n_good::DOUBLE - i + 1)
           + i * ln({share}) + (n_good - i) * ln(1 - {share})))) * 5 * (SELECT count(*) FROM (SELECT DISTINCT stratum FROM bins)) AS tail
  FROM tallied WHERE n_good > 0 AND good_lost <= n_good * {share}
), chosen AS (
  SELECT stratum, rule, cutoff FROM tested WHERE tail <= {level} AND gain > 0
  QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY gain DESC, cutoff DESC) = 1
), cutoffs AS (
  SELECT stratum, {cutoffs} FROM chosen GROUP BY stratum
)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(m_symbols > c_symbols, false) AND NOT coalesce(m_capitals > c_capitals, false)
       AND NOT coalesce(m_loud > c_loud, false) AND NOT coalesce(m_words > c_words, false)
       AND NOT coalesce(m_lines > c_lines, false) AS kept
FROM measured m LEFT JOIN cutoffs c ON m.stratum IS NOT DISTINCT FROM c.stratum
"""


def oracle(risk: float = RISK, level: float = LEVEL) -> str:
    """The query in SQL."""
    cutoffs = ", ".join(f"max(CASE WHEN rule = 'm_{r}' THEN cutoff END) AS c_{r}" for r in "symbols capitals loud words lines".split())
    return (
        ORACLE.replace("{share}", repr(risk / len(RULES))).replace("{level}", repr(level)).replace("{cutoffs}", cutoffs)
    )


def op13_quality_rules(spark, sf_dir: str) -> DataFrame:
    """All documents under rules whose cutoffs falsely reject at most 2% per language, as all labels together assure."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    return judged(docs, labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
