"""Making workflow samples chain by chain: a seed for each, a cap on calls, a record of what failed, and a floor."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from loomline.errors import TooFewSamples
from loomline.sources import documents

ERROR_CHARS = 500

#: Makes one chain: (seed, count) to a sample, or None if it came to nothing; ``count()`` is told of each model call.
Maker = Callable[[int, Callable[[], None]], dict | None]


def generate_samples(spark: SparkSession, make: Maker, folder: str, num_chains: int, seed: int = 42, max_calls: int = 0, min_samples: int = 1) -> dict:
    """Writes a JSON file for each sample into ``folder``; returns num_samples, llm_calls, chains and failures.

    Chain k has the seed ``seed + k``. One that fails, or makes nothing, is recorded and doesn't end the run. With a
    cap on calls (zero: none) no further chain begins once they exceed it; the chain that does so is kept. Fewer samples
    than the floor are an error that carries the same facts. The chains are few and each is a dialogue with a model, so
    the driver makes them one after the other.
    """
    calls, made, failures, begun = [0], 0, [], 0

    def count() -> None:
        calls[0] += 1

    for k in range(num_chains):
        begun += 1
        problem = None
        try:
            sample = make(seed + k, count)
            if sample is None:
                problem = ("NoWorkflow", "the chain made no workflow")
        except Exception as e:  # a chain that fails is recorded
            problem = (type(e).__name__, str(e)[:ERROR_CHARS])
        if problem is None:
            documents.write_json(spark, f"{folder}/seed={seed + k}.json", sample)
            made += 1
        else:
            failures.append({"chain": k, "seed": seed + k, "error_type": problem[0], "error": problem[1]})
        if 0 < max_calls < calls[0]:
            break
    found = {"num_samples": made, "llm_calls": calls[0], "chains": begun, "failures": failures}
    if made < min_samples:
        raise TooFewSamples(f"{made} samples of {begun} chains, {len(failures)} of which failed; at least {min_samples} are required", found)
    return found
