"""A hook for a caller's own generator of answers."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULTS = "response string, attempts int, error string"


def generate(prompts: DataFrame, make: Callable[[], Callable[[Sequence[str], int], Sequence[str | None]]], good: Callable[[str], bool],
             attempts: int = 3, batch: int = 200, prompt: str = "prompt") -> DataFrame:
    """``prompts`` with ``response``, ``attempts`` and ``error``: the first good answer of at most ``attempts``, else an error.

    ``make`` is called once per task and gives the generator (a model, a client): it takes up to ``batch`` prompts and the
    number of the attempt, from 1, and returns an answer or null for each. An attempt that raises is lost for all its
    prompts, and its message is the error of those that get no good answer later. Only prompts without a good answer
    are asked again. A null prompt is not asked; its error says so. Columns named like the results are replaced.
    """
    kept = [c for c in prompts.columns if c not in ("response", "attempts", "error")]
    at = kept.index(prompt)

    def ask(generator, texts: list[str | None]) -> list[tuple[str | None, int, str | None]]:
        out = [(None, 0, "no prompt" if t is None else None) for t in texts]
        left = [i for i, t in enumerate(texts) if t is not None]
        for attempt in range(1, attempts + 1):
            missed = []
            for begin in range(0, len(left), batch):
                own = left[begin:begin + batch]
                try:
                    answers, problem = list(generator([texts[i] for i in own], attempt)), None
                except Exception as e:  # the caller's code: whatever it raises is an answer not given
                    answers, problem = [None] * len(own), f"{type(e).__name__}: {e}"
                for i, answer in zip(own, answers, strict=True):
                    if answer is not None and good(answer):
                        out[i] = (answer, attempt, None)
                    else:
                        # Fixed value: the error text.
                        out[i] = (None, attempt, problem or f"Could not generate for {texts[i]}")
                        missed.append(i)
            left = missed
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        generator = make()
        for rows in batches:
            found = ask(generator, rows.column(at).to_pylist())
            new = [pa.array([f[k] for f in found], t) for k, t in enumerate((pa.string(), pa.int32(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*rows.columns, *new], [*kept, "response", "attempts", "error"])

    asked = prompts.select(*[f"`{c}`" for c in kept])
    typed = asked.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (p.split(" ") for p in RESULTS.split(", "))])
    return asked.mapInArrow(run, typed.schema)
