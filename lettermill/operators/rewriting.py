"""Rewriting a table until its texts settle, in rounds in which only those still changing go on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.rules import OPEN, SETTLED, RewriteSet, after_passes, check_rewrites, one_pass_by_type, open_state


def rewrite_in_rounds(df: DataFrame, text: str, letter_type: str, rules: RewriteSet, stage: str, first_passes: int = 4,
                      max_passes: int = 4096) -> DataFrame:
    """``df`` with ``text`` rewritten, and ``converged``: whether no rule changes it any more.

    General rules, then those of the row's type, make a pass. Round after round twice as many passes are made, by
    the rows still changing only, which are dealt anew: a few stubborn texts hold up no one else. A text that comes back
    to what it was before is in a cycle, and stays as it was when that was seen; one that still changes after
    ``max_passes`` of a round stays as it is then; both are not converged. Null is converged. Each round is written
    under ``stage``, a path in shared storage. Columns named ``converged``, ``_state`` or ``_text`` are replaced.
    """
    spark = df.sparkSession
    for name in (None, *rules.types()):
        check_rewrites(rules.for_type(name))
    columns = [c for c in df.columns if c not in ("converged", "_state", "_text")]
    apply, may_match = one_pass_by_type(F.col(letter_type), rules)
    now = df.select(*[f"`{c}`" for c in columns]).withColumn("_state", open_state(F.col(text)))
    done, passes, n = [], first_passes, 0
    while True:
        after = now.withColumn("_state", F.when(F.col(text).isNotNull(), after_passes(F.col("_state"), F.lit(passes), apply, may_match)))
        after.write.mode("error").parquet(f"{stage}/round={n}")
        after = spark.read.schema(after.schema).parquet(f"{stage}/round={n}")
        still = F.coalesce(F.col("_state.status"), F.lit(SETTLED)) == OPEN
        passes, n = 2 * passes, n + 1
        last = passes > max_passes or after.filter(still).isEmpty()
        done.append(after if last else after.filter(~still))
        if last:
            break
        now = after.filter(still).repartition(F.xxhash64("_state.text"))
    whole = reduce(DataFrame.unionByName, done)
    converged = F.coalesce(F.col("_state.status") == SETTLED, F.lit(True))
    return whole.withColumn("_text", F.col("_state.text")).select(
        *[F.when(F.col(f"`{c}`").isNotNull(), F.col("_text")).alias(c) if c == text else F.col(f"`{c}`") for c in columns], converged.alias("converged"))

