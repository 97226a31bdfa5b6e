"""Choosing: best letter per case and type, best option per rejection, first occurrence, last writer.

Every top-1 here is ``row_number() = 1``: Spark puts a partial group limit before the shuffle, so each
task sends at most one row per group and a hot group costs no more than its number of map tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill.operators.contain import contained
from lettermill.operators.extract import producer_bias
from lettermill.operators.urls import url_score
from lettermill.rules import (
    CONTAINED_BONUS, DEFAULT_MIN_LENGTH, MIN_LENGTHS, NULL_SCORE, SCORE_KEYS,
)
from lettermill.sources.scratch import fresh_dir


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group; ``order`` must be total within a group."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def dedup_first(df: DataFrame, key: Column, order: Sequence[str]) -> DataFrame:
    """The first row, in ``order``, of each value of ``key``."""
    return first_by(df.withColumn("_key", key), ["_key"], [F.col(c) for c in order]).drop("_key")


def merge_corpora(corpora: Sequence[tuple[DataFrame, int]], path: str = "path") -> DataFrame:
    """One row per base name; of equal names the corpus of higher priority wins.

    Names must be unique inside a corpus, as they are in a directory.
    """
    merged = None
    for df, priority in corpora:
        ranked = df.withColumn("_priority", F.lit(priority))
        merged = ranked if merged is None else merged.unionByName(ranked)
    named = merged.withColumn("_name", F.element_at(F.split(F.col(path), "/"), -1))
    return first_by(named, ["_name"], [F.desc("_priority"), F.col(path)]).drop("_name", "_priority")


def group_letters(letters: DataFrame) -> DataFrame:
    """Letters counted by case and type; the letters themselves stay in long form."""
    return letters.groupBy("case_id", "letter_type").agg(
        F.count("*").alias("n_letters"), F.min("path").alias("first_path"), F.max("path").alias("last_path"))


def keyword_score(text: Column, weights: Mapping[str, int]) -> Column:
    """Sum of the weights of the keywords present, any case."""
    def total(lowered: Column) -> Column:
        score = F.lit(0)
        for word, weight in weights.items():
            score = score + F.when(F.contains(lowered, F.lit(word.lower())), weight).otherwise(0)
        return score.cast("bigint")

    return F.transform(F.array(F.lower(text)), total)[0]


def score_letters(letters: DataFrame, status: DataFrame | None = None,
                  min_lengths: Mapping[str, int] = MIN_LENGTHS, mode: str = "intended",
                  short_penalty: float = 0.0, score_keys: Mapping[str, str] = SCORE_KEYS,
                  keyword_weights: Mapping[str, Mapping[str, int]] | None = None) -> DataFrame:
    """Add ``base_score``: all of a letter's score that does not depend on a rejection.

    Producer bias, links, then length: longer is better for appeals, shorter for all other types down
    to the minimum length of the type. Only letters with a link take part in the link join, so the
    texts without one are not shuffled.
    """
    if status is None:
        linked = letters.withColumn("_url_score", F.lit(0).cast("bigint"))
    else:
        has_link = F.coalesce(F.contains(F.lower("text"), F.lit("http")), F.lit(False))
        scores = url_score(letters.filter(has_link), status, ["path"])
        with_link = (letters.filter(has_link).join(scores, "path", "left").select(*letters.columns, "url_score")
                     .withColumn("_url_score", F.coalesce("url_score", F.lit(0).cast("bigint"))).drop("url_score"))
        without = letters.filter(~has_link).withColumn("_url_score", F.lit(0).cast("bigint"))
        linked = with_link.unionByName(without)

    minimum = F.lit(DEFAULT_MIN_LENGTH)
    for name, length in min_lengths.items():
        types = [t for t in (*min_lengths, *score_keys) if score_keys.get(t, t) == name]
        for scored_type in types:
            minimum = F.when(F.col("letter_type") == scored_type, length).otherwise(minimum)
    chars = F.length(F.lower("text"))
    by_length = F.when(F.col("letter_type") == "appeal", chars / F.lit(100.0)).when(
        chars < minimum, F.lit(-float(short_penalty))).otherwise(-(chars / F.lit(100.0)))
    weighted = F.lit(0).cast("bigint")
    for name, weights in (keyword_weights or {}).items():
        weighted = F.when(F.col("letter_type") == name, keyword_score(F.col("text"), weights)).otherwise(weighted)
    base = (producer_bias(F.col("producer"), mode) + F.col("_url_score") + weighted).cast("double") + by_length
    return linked.withColumn("base_score", F.when(F.col("text").isNull(), F.lit(NULL_SCORE)).otherwise(base)).drop("_url_score")


def choose_best(scored: DataFrame, keys: Sequence[str] = ("case_id", "letter_type")) -> DataFrame:
    """The best letter per key, with no rejection at hand; ties go to the first path.

    Empty text counts as contained in the absent rejection, except for appeals.
    """
    bonus = F.when((F.col("letter_type") != "appeal") & (F.col("text") == ""), F.lit(float(CONTAINED_BONUS))).otherwise(F.lit(0.0))
    return first_by(scored.withColumn("score", F.col("base_score") + bonus).drop("base_score"), keys,
                    [F.desc("score"), F.col("path")])


def case_wide(best: DataFrame, types: Sequence[str]) -> DataFrame:
    """One row per case, one column per type; ``best`` holds at most one row per case and type."""
    columns = [F.max(F.when(F.col("letter_type") == t, F.col("text"))).alias(t) for t in types]
    return best.groupBy("case_id").agg(*columns)


def best_per_rejection(scored: DataFrame, types: Sequence[str] = ("treatment",)) -> DataFrame:
    """Per rejection and type: the best option of the case when options found in the rejection gain a bonus.

    Returns ``rejection_path``, ``case_id``, ``letter_type``, ``option_path``, ``option_text``, ``score``.

    Not all pairs of a case are formed. Without the bonus the winner is the same for the whole case: one
    row. With it only distinct texts count, and only those within the bonus of that winner can overtake it;
    which of these a rejection holds is found through their words (``contain.contained``). The distinct options, and those
    that can win, are staged, as each of the next steps reads them: the letters are read once for them.
    """
    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{place}/{name}")
        return scored.sparkSession.read.schema(df.schema).parquet(f"{place}/{name}")

    place = fresh_dir(scored.sparkSession, "options")
    options = (scored.filter(F.col("letter_type").isin(*types) & F.col("text").isNotNull())
               .select("case_id", "letter_type", F.col("path").alias("option_path"),
                       F.col("text").alias("option_text"), F.lower("text").alias("_needle"), "base_score"))
    ranking = [F.desc("base_score"), F.col("option_path")]
    group = ["case_id", "letter_type"]
    distinct = kept(first_by(options, [*group, "_needle"], ranking), "distinct")
    bounds = distinct.groupBy(*group).agg(F.max("base_score").alias("_lead"))
    rivals = kept(distinct.join(bounds, group).filter(F.col("base_score") + CONTAINED_BONUS >= F.col("_lead")).drop("_lead"), "rivals")
    leader = first_by(rivals, group, ranking)
    rejections = (scored.filter("letter_type = 'rejection'")
                  .select("case_id", F.col("path").alias("rejection_path"), F.lower("text").alias("_rejection")))
    pairs = contained(rejections, ["rejection_path"], "_rejection", rivals, ["letter_type", "option_path"], "_needle", "case_id")

    plain = (rejections.select("case_id", "rejection_path").join(leader.drop("_needle"), "case_id")
             .withColumn("score", F.col("base_score")))
    bonus = (pairs.join(rivals.drop("_needle"), ["case_id", "letter_type", "option_path"])
             .withColumn("score", F.col("base_score") + F.lit(float(CONTAINED_BONUS))))
    # Grouped by the rejection alone: a path names one case, and a hot case then spreads over all tasks.
    return first_by(plain.unionByName(bonus).drop("base_score"), ["rejection_path", "letter_type"],
                    [F.desc("score"), F.col("option_path")])


def first_good(attempts: DataFrame, prompt_keys: Sequence[str], max_attempts: int = 3,
               attempt: str = "attempt", answer: str = "answer", good: Column | None = None) -> DataFrame:
    """Per prompt the first answer, of its first ``max_attempts``, that is not empty and is good; else an error.

    ``attempts`` has the prompt keys, ``prompt``, the attempt and the cleaned answer.
    """
    window = Window.partitionBy(*prompt_keys).orderBy(attempt)
    tried = attempts.withColumn("_nth", F.row_number().over(window)).filter(F.col("_nth") <= max_attempts)
    usable = F.col(answer) != ""
    if good is not None:
        usable = usable & good
    answered = F.min(F.when(usable, F.struct(F.col("_nth"), F.col(answer).alias("answer"))))
    return (tried.groupBy(*prompt_keys).agg(F.min_by("prompt", "_nth").alias("prompt"), answered.alias("_won"))
            .select(*prompt_keys, F.col("_won.answer").alias("result"),
                    # Fixed value: the error text.
                    F.when(F.col("_won").isNull(), F.concat(F.lit("Could not generate for "), F.col("prompt"))).alias("error")))
