r"""Quality rules as a short-circuit cascade.

Rules reject a text. Their cost (seconds per row, in steps of two, without what a job takes that asks
nothing) and selectivity (share rejected) are measured on a sample, and the cascade asks the rules in the order of rejections per
cost; a row that one rule rejects is not put to the later ones. The order changes what
the work costs and which reason is named, never which rows are kept.

* Null or empty texts have no words. A rule that is null for a row does not reject it.
* Equal costs and shares: by name. Empty sample: by name.
* Columns of the input are carried through by ``cascade``, also those named like the rules' helpers; the features
  and ``rejected_by`` replace columns of the same name.
"""

from __future__ import annotations

import math
import time
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewise.llm.common import BLANK_PATTERN, BLANKS, free_name, let, table, whole
from sitewise.session import settle

SYMBOLS = "#*$%&|<>"
SAMPLE_ROWS = 2_000
ASKED = 40  # times that each row of the sample is put to a rule to see what it costs
LEAST = 2e-6  # seconds a row: rules that cost less are alike
HELPERS = ("_words", "_lines")


def words_of(text: Column) -> Column:
    return F.filter(F.split(whole(text), BLANK_PATTERN), lambda w: w != "")


def without(text: Column, characters: str) -> Column:
    """How many code points of the text are not among the characters."""
    return F.char_length(F.translate(text, characters, ""))


def repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more."""
    windows = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.struct(F.concat_ws(" ", w, F.get(words, i + 1), F.get(words, i + 2)).alias("w"), i.alias("i")),
    )

    def again(ordered: Column) -> Column:
        twice = F.filter(ordered, lambda x, k: (x["w"] == F.get(ordered, k - 1)["w"]) | (x["w"] == F.get(ordered, k + 1)["w"]))
        starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
        begin = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n"))
        step = lambda a, i: F.struct((i + 3).alias("upto"), (a["n"] + i + 3 - F.greatest(i, a["upto"])).alias("n"))
        return F.aggregate(starts, begin, step, lambda a: a["n"])

    return let(F.sort_array(windows), again)


def features(docs: DataFrame) -> DataFrame:
    """The rows with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the helpers of the rules."""
    text = whole(F.col("text"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, BLANKS, "") != "")
    own = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rows = docs.drop(*own, *HELPERS).withColumn("_words", words_of(F.col("text"))).withColumn("_lines", lines)
    return (
        rows.withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", without(text, BLANKS).cast("long"))
        .withColumn("n_symbols", (F.char_length(text) - without(text, SYMBOLS)).cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("n_repeat_words", repeated_words(F.col("_words")).cast("long"))
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def default_rules() -> dict[str, Column]:
    """Rules over the features; each is true where it rejects."""
    text = whole(F.col("text"))
    return {
        "symbols": 10 * F.col("n_symbols") > 3 * F.col("n_words"),
        "duplicate_lines": 10 * F.col("n_dup_lines") > 3 * F.size("_lines"),
        "word_length": (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 20 * F.col("n_words")),
        "shouting": 2 * F.char_length(F.regexp_replace(text, r"[^\p{Lu}]", "")) > F.col("word_chars"),
        "exclamations": 2 * (F.char_length(text) - without(text, "!")) > F.col("n_words"),
        "no_letters": 2 * F.char_length(F.regexp_replace(text, r"[^\p{L}]", "")) < F.col("word_chars"),
    }


def order_rules(sample: DataFrame, rules: Mapping[str, Column]) -> list[str]:
    """Rule names by rejections per cost, measured on the (settled, bounded) sample.

    A rule's cost is the time of a job that puts every row to it ``ASKED`` times, less that of one that puts
    them to none, the best of three each; to the next power of two, so that chance does not order alike rules.
    """
    counts = sample.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.when(r, 1)).alias(name) for name, r in rules.items()]).first()
    many = sample.select("*", F.explode(F.sequence(F.lit(1), F.lit(ASKED))).alias("_time"))

    def seconds(rule: Column) -> float:
        took = []
        for _ in range(3):
            start = time.perf_counter()
            many.agg(F.count(F.when(rule & (F.col("_time") > 0), 1))).collect()
            took.append(time.perf_counter() - start)
        return min(took)

    rows = max(1, counts["_n"]) * ASKED
    nothing = seconds(F.lit(True))
    rate = {}
    for name, rule in rules.items():
        cost = max(LEAST, (seconds(rule) - nothing) / rows)
        rate[name] = counts[name] / max(1, counts["_n"]) / 2.0 ** math.ceil(math.log2(cost))
    return sorted(rules, key=lambda name: (-rate[name], name))


def cascade(docs: DataFrame, rules: Mapping[str, Column], prepare=features, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``prepare(docs)`` with ``rejected_by``: the first rule, in measured order, that rejects; null if kept.

    ``prepare`` adds the columns the rules use. The sample, about ``sample_rows`` rows of the
    whole table, only sets the order.
    """
    aside = {c: free_name(docs.columns, f"{c}_aside") for c in docs.columns if c in HELPERS}
    docs = docs.withColumnsRenamed(aside)
    n = docs.count()
    sample = settle(prepare(docs.sample(fraction=min(1.0, sample_rows / max(1, n)), seed=5)))
    verdict = F.lit(None).cast("string")
    for name in reversed(order_rules(sample, rules)):
        verdict = F.when(rules[name], F.lit(name)).otherwise(verdict)
    judged = prepare(docs).drop("rejected_by").withColumn("rejected_by", verdict)
    return judged.drop(*HELPERS).withColumnsRenamed({held: c for c, held in aside.items()})


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = cascade(docs, default_rules()).withColumn("base_failed", base_failed())
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.col("rejected_by").isNull()).alias("kept"),
    )


OP5_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), w AS (
  SELECT id, unnest(range(1, len(words) - 1)) AS i,
         unnest(list_transform(range(1, len(words) - 1), lambda k: words[k] || ' ' || words[k + 1] || ' ' || words[k + 2])) AS s
  FROM d WHERE len(words) >= 3
), g AS (
  SELECT id, i, count(*) OVER (PARTITION BY id, s) AS n FROM w
), r AS (
  SELECT id, count(DISTINCT i + k) AS n FROM g, range(3) AS t(k) WHERE n > 1 GROUP BY id
), f AS (
  SELECT doc_id, text, lines, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(r.n, 0) AS n_repeat_words
  FROM d LEFT JOIN r USING (id)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         10 * n_symbols > 3 * n_words OR 10 * n_dup_lines > 3 * len(lines)
         OR word_chars < 2 * n_words OR word_chars > 20 * n_words
         OR 2 * length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) > word_chars
         OR 2 * length(regexp_replace(text, '[^!]', '', 'g')) > n_words
         OR 2 * length(regexp_replace(text, '[^\p{L}]', '', 'g')) < word_chars AS rejected
  FROM f
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT rejected AS kept FROM b
"""
