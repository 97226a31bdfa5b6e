"""Mixing overlapping sources to target weights by a min-cost flow over membership patterns.

Spark sums document sizes per membership pattern; the flow between the few patterns and sources is worked
out on the driver; Spark then selects documents in a seeded order. What reaches the driver is one row per
membership pattern.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil, floor, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill.llm.common import fresh_dir, table, unused

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_COPIES = 2
RANGE_ROWS = 4096  # rows a range of the seeded order has about, if none of the patterns is hot


def word_count(text: Column) -> Column:
    """Number of words between white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("bigint")  # \s is ASCII white space


def source_order(names: Sequence[str | None]) -> list[str | None]:
    """Names by code point, null last."""
    return sorted(names, key=lambda n: (n is None, n or ""))


def targets(sizes: Mapping[str | None, int], weights: Sequence[int] = WEIGHTS, share: float = SHARE,
            most: int = MAX_COPIES) -> dict[str | None, float]:
    """Target size per source: by weight, at most ``most`` times its size, what is over shared by weight again.

    Sources fill like vessels up to one level: those that reach their limit first stop, and the level of
    the others is what is left over their weight. Weights repeat over the sources in code-point order.
    """
    names = source_order(list(sizes))
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    by_limit = sorted(range(len(names)), key=lambda i: (most * sizes[names[i]] / weight[names[i]], i))
    left_weight, stopped, total = sum(weight.values()), 0, share * sum(sizes.values())
    level, out = 0.0, {}
    for i in by_limit:
        name = names[i]
        level = (total - stopped) / left_weight
        if most * sizes[name] / weight[name] > level:
            break
        out[name] = float(most * sizes[name])
        stopped += most * sizes[name]
        left_weight -= weight[name]
    return {n: out.get(n, weight[n] * level) for n in names}


class _Network:
    """Arcs with capacities, and flow pushed through them by blocking flows: all shortest paths of a length at once."""

    def __init__(self, nodes: int) -> None:
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []

    def arc(self, a: int, b: int, capacity: int) -> int:
        """The number of a new arc; the next number is its way back."""
        self.out[a].append(len(self.to))
        self.out[b].append(len(self.to) + 1)
        self.to += [b, a]
        self.room += [capacity, 0]
        return len(self.to) - 2

    def _levels(self, begin: int, end: int) -> list[int]:
        level = [-1] * len(self.out)
        level[begin], front = 0, [begin]
        while front and level[end] < 0:
            reached = []
            for a in front:
                for arc in self.out[a]:
                    b = self.to[arc]
                    if self.room[arc] > 0 and level[b] < 0:
                        level[b] = level[a] + 1
                        reached.append(b)
            front = reached
        return level

    def fill(self, begin: int, end: int) -> None:
        """Pushes as much as goes from ``begin`` to ``end``."""
        while True:
            level, nth = self._levels(begin, end), [0] * len(self.out)
            if level[end] < 0:
                return
            path: list[int] = []
            at = begin
            while True:
                if at == end:
                    least = min(self.room[arc] for arc in path)
                    for arc in path:
                        self.room[arc] -= least
                        self.room[arc ^ 1] += least
                    cut = next(i for i, arc in enumerate(path) if not self.room[arc])
                    at = self.to[path[cut] ^ 1]
                    del path[cut:]
                    continue
                arcs = self.out[at]
                while nth[at] < len(arcs) and not (self.room[arcs[nth[at]]] > 0 and level[self.to[arcs[nth[at]]]] == level[at] + 1):
                    nth[at] += 1
                if nth[at] < len(arcs):
                    path.append(arcs[nth[at]])
                    at = self.to[path[-1]]
                elif path:
                    at = self.to[path.pop() ^ 1]
                    nth[at] += 1
                else:
                    break


def route(patterns: Mapping[tuple, int], quotas: Mapping[str | None, int], copies: int = MAX_COPIES) -> dict[tuple, dict]:
    """Tokens each membership pattern gives to each of its sources: a flow that fills the quotas as far as
    possible and, among those, costs least.

    The k-th copy of a token costs more than the (k-1)-th, so the costs are convex, and they lie on the arcs
    that leave the origin only: opening those arcs copy by copy and filling to the limit each time gives
    the least cost. Paths have three arcs where sources do not overlap, so their patterns, however many, are filled at
    once; the length of others depends on patterns and sources, not on their sizes.
    """
    names, place = list(patterns), {source: 1 + len(patterns) + i for i, source in enumerate(quotas)}
    end = 1 + len(patterns) + len(quotas)
    network = _Network(end + 1)
    opened = [network.arc(0, 1 + i, 0) for i in range(len(names))]
    given = [{s: network.arc(1 + i, place[s], copies * patterns[pattern]) for s in pattern} for i, pattern in enumerate(names)]
    for source, quota in quotas.items():
        network.arc(place[source], end, quota)
    for _ in range(copies):
        for arc, pattern in zip(opened, names):
            network.room[arc] += patterns[pattern]
        network.fill(0, end)
    return {pattern: {s: network.room[arc + 1] for s, arc in arcs.items()} for pattern, arcs in zip(names, given)}


def mix(documents: DataFrame, members: Column, size: Column, key: Column, seed: int = 7,
        weights: Sequence[int] = WEIGHTS, share: float = SHARE, copies: int = MAX_COPIES) -> tuple[DataFrame, dict[str | None, int], dict[str | None, float]]:
    """Documents with what the mix takes of them, and size and target per source.

    ``members`` is the array of sources a document belongs to (an element may be null). Adds ``size``,
    ``parts`` (array of source, taken, source_size, target) and ``taken`` (their sum, repeats counted, at most
    ``copies`` times the size); columns of these names are replaced, all others stay. Documents of a pattern stand in an
    order drawn by seed and ``key`` (null keys first); the pattern gives its routed tokens from the front of that order,
    whole rounds first, so only one document per pattern and source is cut. Equal keys are ordered by size. One row per
    membership pattern passes through the driver, where the flow is worked out.

    ``documents`` are staged with their sizes, so these are counted once. A pattern, however hot, is dealt into ranges
    of the order, the more the larger the table; sums per range tell where each begins.
    """
    spark = documents.sparkSession
    given_as, words, key_as, members_as, order_as, range_as, upto = unused(
        [*documents.columns, "size", "parts", "taken"], "given", "words", "key", "members", "order", "range", "upto")
    place = fresh_dir(spark, "sized-documents")
    documents.select("*", F.coalesce(F.array_sort(F.array_distinct(members)), F.array().cast("array<string>")).alias(members_as), size.alias(words), key.alias(key_as)).drop(
        "size", "parts", "taken").withColumnRenamed(words, "size").write.parquet(place)
    documents = spark.read.parquet(place)
    kept = [c for c in documents.columns if c not in (members_as, key_as, "size")]
    rows = documents.groupBy(F.col(members_as).alias("members")).agg(F.sum("size").alias("n"), F.count("*").alias("rows")).collect()
    patterns = {tuple(r["members"] or ()): int(r["n"]) for r in rows}
    digits = max(1, ceil(log(max(1, sum(r["rows"] for r in rows) / RANGE_ROWS), 16)))
    sizes: dict[str | None, int] = {}
    for pattern, n in patterns.items():
        for source in pattern:
            sizes[source] = sizes.get(source, 0) + n
    wanted = targets(sizes, weights, share, copies) if sizes else {}
    flow = route(patterns, {s: floor(t) for s, t in wanted.items()}, copies)

    # Per pattern: its size and, source after source, the stretch of its routed tokens that source gets.
    stretches = []
    for pattern, n in patterns.items():
        at, parts = 0, []
        for source in pattern:
            parts.append((source, at, at + flow[pattern][source], sizes[source], wanted[source]))
            at += flow[pattern][source]
        stretches.append((list(pattern), n, parts))
    routes = spark.createDataFrame(
        stretches, "m array<string>, pattern_size bigint, routes array<struct<source: string, begin: bigint, end: bigint, source_size: bigint, target: double>>")
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key_as).cast("string"), F.lit(""))))
    sized = documents.withColumn(order_as, order).withColumn(range_as, F.substring(order_as, 1, digits))
    ranges = sized.groupBy(F.col(members_as).alias("members"), F.col(range_as).alias("r")).agg(F.sum("size").alias("n"))
    before = Window.partitionBy("members").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("members", "r", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("range_begin"))
    facts = ranges.join(routes, ranges["members"].eqNullSafe(routes["m"])).select(
        F.struct("members", "r", "range_begin", "pattern_size", "routes").alias(given_as))
    inside = Window.partitionBy(members_as, range_as).orderBy(order_as, key_as, "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = sized.withColumn(upto, F.sum("size").over(inside))
    fact = F.col(given_as)
    joined = placed.join(facts, F.col(members_as).eqNullSafe(fact["members"]) & (F.col(range_as) == fact["r"]))
    start = fact["range_begin"] + F.col(upto) - F.col("size")

    def given(one: Column) -> Column:
        value = F.lit(0).cast("bigint")
        for copy in range(copies):
            low = start + fact["pattern_size"] * copy
            value = value + F.greatest(F.lit(0).cast("bigint"), F.least(low + F.col("size"), one["end"]) - F.greatest(low, one["begin"]))
        return F.struct(one["source"].alias("source"), value.alias("taken"), one["source_size"].alias("source_size"), one["target"].alias("target"))

    parts = joined.withColumn("parts", F.transform(fact["routes"], given))
    taken = F.aggregate("parts", F.lit(0).cast("bigint"), lambda total, p: total + p["taken"])
    return parts.select(*[f"`{c}`" for c in kept], "size", "parts", taken.alias("taken")), sizes, wanted


def mix_documents(documents: DataFrame, seed: int = 7) -> DataFrame:
    """doc_id, source, size, source_size, target and taken of every row; a document belongs to its one source.

    Null text has size 0; a null source is a source of its own; an empty table gives an empty result.
    """
    narrow = documents.select("doc_id", "source", word_count(F.col("text")).alias("words"))
    mixed, _, _ = mix(narrow, F.array("source"), F.col("words"), F.col("doc_id"), seed)
    only = F.col("parts")[0]
    return mixed.select("doc_id", "source", "size", only["source_size"].alias("source_size"), only["target"].alias("target"), "taken")


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    return mix_documents(table(spark, sf_dir, "documents")).drop("source")


OP9_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS ord FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM docs GROUP BY source),
weighed AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM sources),
ranked AS (
  SELECT *, (2 * source_size)::double / weight AS full_at,
    row_number() OVER (ORDER BY (2 * source_size)::double / weight, place) AS nth FROM weighed),
levels AS (
  SELECT *, (1.5::double * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER (ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / (sum(weight) OVER (ORDER BY nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level FROM ranked),
broke AS (SELECT min(nth) AS nth FROM levels WHERE full_at > level),
aims AS (
  SELECT l.source, l.source_size, CAST(CASE WHEN l.nth < coalesce(b.nth, 1e18) THEN 2 * l.source_size
      ELSE l.weight * (SELECT level FROM levels WHERE nth = b.nth) END AS DOUBLE) AS target
  FROM levels l CROSS JOIN broke b),
placed AS (
  SELECT d.doc_id, d.size, a.source_size, a.target, CAST(floor(a.target) AS BIGINT) AS quota,
    CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.ord, d.doc_id NULLS FIRST, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS BIGINT) AS start
  FROM docs d JOIN aims a ON d.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(greatest(0, least(start + size, quota) - start)
    + greatest(0, least(start + source_size + size, quota) - (start + source_size)) AS BIGINT) AS taken
FROM placed
"""
