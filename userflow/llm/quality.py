"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Each rule rejects a text whose signal (a ratio in thousandths) reaches a
cutoff.  The cutoff of a rule is chosen for each stratum (language) from the
labelled good texts of the stratum: for a cutoff that rejects k of the n good
texts, ``P(Bin(n, ALPHA / rules) <= k)`` is the exact binomial p-value of "this
cutoff falsely rejects more than ALPHA / rules".  Cutoffs of one rule are
nested, so they are tested from the loosest on (a fixed sequence, which needs no
correction within the rule); over rules and strata the level DELTA is divided
by their number (Bonferroni).  With probability 1 - DELTA, every stratum loses
at most ALPHA of its good texts to all rules together.  Copies of a text are one
trial.  The guarantee is about good texts that pass the base rules below; what
those reject comes on top.  A stratum with too few labels to prove a cutoff gets
none: its texts only face the base rules.

Base rules: fewer than 50 words, or more than half of the words inside 3-word
runs that occur twice or more in the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from userflow.llm.common import pack, unpack
from userflow.session import materialize

ALPHA = 0.05
DELTA = 0.05
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Cutoffs in thousandths, the same for every rule.
GRID = (5, 10, 20, 30, 50, 75, 100, 150, 200, 250, 300, 400, 500, 600, 700, 800, 900, 1000, 1500, 2000, 3000)
#: Signal: (numerator, denominator) among the counts of :func:`count_columns`.
RULES = {
    "symbols": ("n_symbols", "n_words"),
    "exclaims": ("n_exclaims", "n_words"),
    "capitals": ("n_capitals", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_exclaims", "n_capitals")

_GAP = r"[\x20\x09-\x0D]+"
_NOT_GAP = r"[^\x20\x09-\x0D]"


def _repeat_words_sql(grams: str) -> str:
    """Words inside 3-word runs (hashes in array column ``grams``) that occur
    twice or more: sort the runs, keep the places of those equal to a
    neighbour, and add up the words they cover."""
    return f"""
    CASE WHEN size(array_distinct({grams})) = size({grams}) THEN 0L ELSE
      element_at(transform(array(sort_array(transform({grams}, (h, i) -> struct(h as h, i as i)))), s ->
        aggregate(
          sort_array(transform(
            filter(sequence(0, size(s) - 1), k -> (k > 0 AND s[k].h = s[k - 1].h)
                                              OR (k < size(s) - 1 AND s[k].h = s[k + 1].h)),
            k -> s[k].i)),
          struct(0L as n, -3 as last),
          (a, p) -> struct(a.n + least(3, p - a.last) as n, p as last),
          a -> a.n)), 1)
    END"""


def count_columns(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with the columns of :data:`COUNTS` (longs) for ``text`` (null: no
    word), each text read whole.  A 3-word run is known by its 64-bit hash."""
    keep = [F.col(f"`{c}`") for c in df.columns]
    step = df.select(*keep, F.coalesce(text, F.lit("")).alias("__t"))
    step = step.select(
        *keep, "__t",
        F.array_remove(F.split("__t", _GAP), "").alias("__w"),
        F.filter(F.split("__t", "\n"), lambda line: line.rlike(_NOT_GAP)).alias("__l"))
    step = step.select(
        *keep, "__t", "__w", "__l",
        F.expr("CASE WHEN size(__w) < 3 THEN array() ELSE transform(sequence(0, size(__w) - 3), "
               "i -> xxhash64(__w[i], __w[i + 1], __w[i + 2])) END").alias("__g"))

    def count_of(pattern: str) -> Column:
        return F.char_length("__t") - F.char_length(F.regexp_replace("__t", pattern, ""))

    return step.select(
        *keep,
        F.size("__w").cast("long").alias("n_words"),
        F.char_length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        count_of(r"[#*$%&|<>]").cast("long").alias("n_symbols"),
        F.size("__l").cast("long").alias("n_lines"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.expr(_repeat_words_sql("__g")).alias("n_repeat_words"),
        count_of("!").cast("long").alias("n_exclaims"),
        count_of("[A-Z]").cast("long").alias("n_capitals"))


def _signal(rule: str, prefix: str = "") -> str:
    top, bottom = RULES[rule]
    return f"({prefix}{top} * 1000 div greatest({prefix}{bottom}, 1L))"


def _base_failed(prefix: str = "") -> str:
    return (f"({prefix}n_words < {MIN_WORDS} OR "
            f"100 * {prefix}n_repeat_words > {MAX_REPEAT_PERCENT} * {prefix}n_words)")


def _tail_sql(n: str, k: str, p: float) -> str:
    """P(Bin(n, p) <= k), its terms built up in logarithms."""
    return f"""
    aggregate(CASE WHEN {k} < 1 THEN cast(array() as array<bigint>) ELSE sequence(1L, {k}) END,
      struct({n} * ln(1 - {p}D) as t, exp({n} * ln(1 - {p}D)) as s),
      (a, i) -> struct(a.t + ln(({n} - i + 1) / i) + ln({p}D / (1 - {p}D)) as t,
                       a.s + exp(a.t + ln(({n} - i + 1) / i) + ln({p}D / (1 - {p}D))) as s),
      a -> a.s)"""


def cutoffs(counts: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, one cutoff per rule, null where none is proven), from the counts
    of labelled good texts with column ``stratum``: one pre-aggregated pass."""
    share = alpha / len(RULES)
    per_stratum = materialize(counts.where(f"NOT {_base_failed()}").groupBy("stratum").agg(
        F.count("*").alias("n"),
        *[F.expr(f"count_if({_signal(r)} >= {c})").alias(f"{r}_{c}") for r in RULES for c in GRID]))
    tests = per_stratum.selectExpr("stratum", "n", "inline(array(" + ", ".join(
        f"struct('{r}' as rule, {c} as cutoff, {r}_{c} as k)" for r in RULES for c in GRID) + "))")
    level = delta / (max(1, per_stratum.count()) * len(RULES))
    passed = tests.where(f"k < {share}D * n").where(f"{_tail_sql('n', 'k', share)} <= {level}D")
    return passed.groupBy("stratum").agg(
        *[F.min(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in RULES])


def _verdict(counts: DataFrame, cuts: DataFrame) -> DataFrame:
    """``counts`` with ``base_failed``, ``rejected_by`` and ``kept``."""
    joined = counts.join(cuts.withColumnRenamed("stratum", "__s"), F.col("stratum") == F.col("__s"), "left").drop("__s")
    failing = [F.when(F.expr(f"{_signal(r)} >= cut_{r}"), F.lit(r)) for r in RULES]
    return (joined.withColumn("base_failed", F.expr(_base_failed()))
            .withColumn("rejected_by", F.concat_ws(",", *failing))
            .withColumn("kept", F.expr("NOT base_failed AND rejected_by = ''"))
            .drop(*[f"cut_{r}" for r in RULES]))


def _good(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """The labelled good texts, each once in a stratum: copies of a text are no
    further trials (texts are told apart by a 64-bit hash, column ``text_id``)."""
    ids = labels.where("quality = 1").select(F.col("doc_id").alias("__good")).distinct()
    good = counts.join(ids, F.col("doc_id") == F.col("__good"), "left_semi")
    return good.select("stratum", "text_id", *COUNTS).dropDuplicates(["stratum", "text_id"])


def _text_id(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_id")


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          stratum_col: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Per row: doc_id, stratum, the counts, base_failed, rejected_by, kept.

    Null and word-less texts have zero words and fail the base rule; a null
    stratum is a stratum of its own (the empty name); repeated rows each count;
    an id labelled twice is good if one label says so.  Without labels no cutoff
    is proven and only base rules reject.  An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"),
                       F.col(text_col).alias("text"), _text_id(F.col(text_col)))
    counts = materialize(count_columns(rows, F.col("text")).drop("text"))
    cuts = materialize(cutoffs(_good(counts, labels), alpha, delta))
    return _verdict(counts.drop("text_id"), cuts)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              stratum_col: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, all columns unchanged; nulls,
    repeated rows and empty tables as in :func:`score` (word-less texts go)."""
    rows = pack(docs).select(
        "_row", F.col(f"_row.{id_col}").alias("doc_id"),
        F.coalesce(F.col(f"_row.{stratum_col}").cast("string"), F.lit("")).alias("stratum"),
        _text_id(F.col(f"_row.{text_col}")))
    counts = materialize(count_columns(rows, F.col(f"_row.{text_col}")))
    cuts = materialize(cutoffs(_good(counts.select("doc_id", "stratum", "text_id", *COUNTS), labels), alpha, delta))
    return unpack(_verdict(counts, cuts).where("kept"))


def oracle_sql(alpha: float = ALPHA, delta: float = DELTA) -> str:
    """DuckDB SQL for the counts and verdicts of the documents table."""
    share = alpha / len(RULES)
    signals = ", ".join(f"({a} * 1000) // greatest({b}, 1) AS s_{r}" for r, (a, b) in RULES.items())
    long = " UNION ALL ".join(
        f"SELECT stratum, '{r}' AS rule, c AS cutoff, count(*) AS n, CAST(count_if(s_{r} >= c) AS BIGINT) AS k "
        "FROM good, (SELECT unnest([" + ", ".join(map(str, GRID)) + "]) AS c) GROUP BY ALL" for r in RULES)
    failing = " || ".join(f"CASE WHEN s_{r} >= c_{r} THEN ',{r}' ELSE '' END" for r in RULES)
    pivot = ", ".join(f"min(CASE WHEN rule = '{r}' THEN cutoff END) AS c_{r}" for r in RULES)
    return rf"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t
               FROM documents),
    parts AS (SELECT *, list_filter(string_split_regex(t, '[ 	-
]+'), lambda x: x <> '') AS w,
                     list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS l FROM d),
    places AS (SELECT rid, unnest(range(1, len(w) - 1)) AS i,
                      unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
                      AS g FROM parts WHERE len(w) >= 3),
    runs AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM places),
    covered AS (SELECT rid, count(DISTINCT p) AS n_repeat_words
                FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM runs WHERE c > 1) GROUP BY rid),
    counts AS (SELECT p.rid, doc_id, stratum, t, CAST(len(w) AS BIGINT) AS n_words,
                      CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                      CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                      CAST(len(l) AS BIGINT) AS n_lines,
                      CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
                      CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
                      length(t) - length(replace(t, '!', '')) AS n_exclaims,
                      length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_capitals
               FROM parts p LEFT JOIN covered c ON c.rid = p.rid),
    signals AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
                       {signals} FROM counts),
    good AS (SELECT DISTINCT stratum, t, {", ".join(f"s_{r}" for r in RULES)} FROM signals
             WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
    tests AS (SELECT *, {delta} / ((SELECT count(DISTINCT stratum) FROM good) * {len(RULES)}) AS level FROM ({long})),
    terms AS (SELECT stratum, rule, cutoff, level, n, unnest(range(0, k + 1)) AS i FROM tests WHERE k < {share} * n),
    passed AS (SELECT stratum, rule, cutoff FROM terms GROUP BY stratum, rule, cutoff, level
               HAVING sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
                              + i * ln({share}) + (n - i) * ln(1 - {share}))) <= level),
    cuts AS (SELECT stratum, {pivot} FROM passed GROUP BY stratum),
    verdict AS (SELECT s.*, substr({failing}, 2) AS rejected_by
                FROM signals s LEFT JOIN cuts c ON c.stratum = s.stratum)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND rejected_by = '' AS kept, stratum, rejected_by FROM verdict"""
