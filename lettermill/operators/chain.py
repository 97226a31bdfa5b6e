"""Requests that need the answers of other requests, asked round by round."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.operators.requests import substitute

ANSWER_KEY = ("index", "model_index", "kind", "variant")


def needs(requests: DataFrame) -> dict[str, set[str]]:
    """Per kind of request the kinds whose answers its prompts ask for; as many pairs as kinds allow reach the driver."""
    marks = F.array_distinct(F.regexp_extract_all("prompt", F.lit(r"#(\w+)#"), F.lit(1)))
    kinds = requests.select("kind").distinct()
    asked = requests.select("kind", F.explode(marks).alias("needed")).distinct()
    known = asked.join(kinds.select(F.col("kind").alias("needed")), "needed", "left_semi")
    found: dict[str, set[str]] = {r["kind"]: set() for r in kinds.collect()}
    for r in known.collect():
        found[r["kind"]].add(r["needed"])
    return found


def rounds(needed: Mapping[str, set[str]]) -> list[list[str]]:
    """Kinds by round: each needs only kinds of earlier rounds. Kinds that wait for one another are refused."""
    left, out = {kind: set(own) for kind, own in needed.items()}, []
    while left:
        ready = sorted(kind for kind, own in left.items() if not own & left.keys())
        if not ready:
            raise ValueError(f"kinds wait for one another: {', '.join(sorted(left))}")
        out.append(ready)
        for kind in ready:
            del left[kind]
    return out


def answer_in_rounds(requests: DataFrame, answer: Callable[[DataFrame], DataFrame], stage: str, order: Sequence[str] | None = None) -> DataFrame:
    """``requests`` with their prompts filled in and ``response``, all rounds asked.

    ``requests`` are (index, kind, variant, model_index, prompt, ...); ``answer`` takes the requests of a round and returns
    them with ``response`` (null: no answer). A mark ``#kind#`` gets the answer to that kind of the same case and
    model, of its last variant; a mark of a kind that is not asked, or got no answer, stays. With an ``order`` only kinds
    that come earlier in it count. Every round is written under ``stage``, a path in shared storage, before the
    next one reads it: no request is asked twice, also not when an executor is lost.
    """
    spark, needed = requests.sparkSession, needs(requests)
    if order is not None:
        needed = {kind: {n for n in own if kind in order and n in order and order.index(n) < order.index(kind)} for kind, own in needed.items()}
    by_round = rounds(needed)
    sequence = list(order) if order is not None else [kind for kinds in by_round for kind in kinds]
    places = F.create_map(*[F.lit(x) for i, kind in enumerate(sequence) for x in (kind, i)]) if sequence else None
    done = None
    for n, kinds in enumerate(by_round):
        asked = requests.filter(F.col("kind").isin(kinds))
        if done is not None:
            ranked = asked.withColumn("ord", places[F.col("kind")])
            asked = substitute(ranked, done.select(*ANSWER_KEY, "response"), sequence).select(*requests.columns)
        answered = answer(asked).select(*requests.columns, "response")
        answered.write.mode("error").parquet(f"{stage}/round={n}")
        done = spark.read.schema(answered.schema).parquet(*[f"{stage}/round={i}" for i in range(n + 1)])
    return done if done is not None else answer(requests).select(*requests.columns, "response")
